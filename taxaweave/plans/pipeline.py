"""Merge, taxa, dedupe, fill, crosswalk and coverage (K4-K9), and the whole
chain. Steps are lazy DataFrame functions; the dense id and the gap fill write
scratch tables when they are called (to fix a numbering, to compute modes once).

Taxa are kept in long form (:class:`LinkedTaxa`): attributes one row per
taxon, external ids and source records as link tables. Nothing is collected
per taxon inside the chain, so a name that holds a third of all records is a
skewed join/aggregate key (split by AQE or reduced map-side), never one giant
array in one task. The source project's array columns are a view
(``LinkedTaxa.arrays``) for callers that need that format."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxaweave.functions.names import computed_once, extract_rank, normalize_names
from taxaweave.operators.crosswalk import crosswalk_join
from taxaweave.operators.dedupe import asc, desc, duplicate_members, rank_preference
from taxaweave.operators.fill import hierarchical_fill
from taxaweave.operators.marks import apart, marks
from taxaweave.operators.merge import collect_segments, union_conform
from taxaweave.operators.numbering import dense_id
from taxaweave.schemas import (
    CONFORMED_COLUMNS,
    DEDUPE_RANK_PREFERENCE,
    FILL_ORDER,
    MERGED_ATTRIBUTES,
    RANKS_SPECIFIC,
    TAXA_COLUMNS,
    TAXA_ID_ORDER,
)
from taxaweave.session import delete_scratch, scratch_mark, scratch_table
from taxaweave.sources.tables import Table

# Column order of the merged table: section moves next to subgenus.
MERGED_COLUMNS = [
    "id", "parent_id", "accepted_id", "original_id", "name", "generic_name",
    "specific_name", "infra_name", "kingdom", "phylum", "class", "order",
    "family", "subfamily", "tribe", "subtribe", "genus", "subgenus", "section",
    "rank", "taxonomic_status", "nomenclatural_status", "ipni_id", "tpl_id",
    "data_source",
]

# Those that the taxa, crosswalks and coverage read.
MERGED_READ = ["id", "name", "rank", *MERGED_ATTRIBUTES, "data_source"]


def merge_sources(*conformed: DataFrame) -> DataFrame:
    """Union of conformed sources, ranked rows only, names normalised, and
    subgenus/section taken from the (un-normalised) name when missing (K4)."""
    c = F.col
    unioned = union_conform(conformed, CONFORMED_COLUMNS)
    ranked = computed_once(unioned.where(c("rank") != "unranked"), name=c("name"))
    cols = {
        "name": normalize_names("name"),
        "subgenus": F.coalesce(c("subgenus"), extract_rank("name", "subg")),
        "section": F.coalesce(c("section"), extract_rank("name", "sect")),
    }
    return ranked.select(*[cols.get(x, c(f"`{x}`")).alias(x) for x in MERGED_COLUMNS])


def merged_once(merged: DataFrame) -> DataFrame:
    """The merged records with the columns that the taxa and crosswalks read,
    written once to scratch: attributes, ids and sources of the taxa are three
    readers or more, and each would conform the sources anew."""
    return scratch_table(merged.select(*[F.col(f"`{x}`") for x in MERGED_READ]), "merged")


def filled_once(taxa: LinkedTaxa) -> LinkedTaxa:
    """The taxa with their attributes written once to scratch, so that the exchanges
    behind them are off the disk before the array view makes its own."""
    return replace(taxa, attrs=scratch_table(taxa.attrs, "filled"))


def _null_safe_on(left: DataFrame, right: DataFrame, pairs) -> "F.Column":
    cond = None
    for a, b in pairs:
        e = left[a].eqNullSafe(right[b])
        cond = e if cond is None else (cond & e)
    return cond


@dataclass
class LinkedTaxa:
    """Taxa in long form: nothing is collected per taxon.

    * ``attrs``: one row per taxon - ``id``, ``name``, ``rank`` (the taxon's
      natural key, unique after the merge), the merged attributes and
      ``source_count`` (how many source records it merged).
    * ``ids``: (name, rank, external_id, merged) - the taxon's external ids;
      ``merged`` marks ids a near-duplicate winner took over (distinct).
    * ``sources``: (name, rank, external_id, data_source) - the taxon's own
      source records (what the source semantics keep as ``data_sources``).
    * ``links``: ids and sources in one, (name, rank, external_id, data_source,
      merged, is_id, is_source): a record that is both stands once. ``arrays()``
      reads it where it is given.

    Links use the natural key, so building them is a projection of the merged
    records (no shuffle). ``arrays()`` renders the source project's array
    columns; that view collects per taxon, so use it only where the format is
    required.
    """

    attrs: DataFrame
    ids: DataFrame
    sources: DataFrame
    links: DataFrame | None = None

    def _keyed(self, links: DataFrame, cols) -> DataFrame:
        keys = self.attrs.select(F.col("id").alias("taxon_id"), F.col("name").alias("__n"), F.col("rank").alias("__r"))
        return links.join(keys, _null_safe_on(links, keys, [("name", "__n"), ("rank", "__r")])).select("taxon_id", *cols)

    def _links(self) -> DataFrame:
        if self.links is not None:
            return self.links
        ids = self.ids.select("name", "rank", "external_id", F.lit(None).cast("string").alias("data_source"), "merged")
        srcs = self.sources.select("name", "rank", "external_id", "data_source", F.lit(False).alias("merged"))
        return _linked(ids, True, False).unionByName(_linked(srcs, False, True))

    def arrays(self) -> DataFrame:
        c = F.col
        # plain equality on columns without nulls: the join finds the links as they were grouped
        key = {
            "__n": F.coalesce(c("name"), F.lit("")), "__nn": c("name").isNull(),
            "__r": F.coalesce(c("rank"), F.lit("")), "__rn": c("rank").isNull(),
        }
        on = [e.alias(k) for k, e in key.items()]
        # one list of the links: an id that is a source too travels once
        link = F.struct(c("external_id").alias("i"), c("data_source").alias("s"), c("is_id").alias("d"), c("is_source").alias("o"))
        links = self._links().select(*on, F.when(c("is_id"), c("merged").cast("int")).alias("m"), link.alias("link"))
        links = links.groupBy(*key).agg(F.max("m").alias("__m"), F.sort_array(F.collect_list("link")).alias("__l"))
        ids = F.transform(F.filter("__l", lambda x: x["d"]), lambda x: x["i"])
        sources = F.transform(F.filter("__l", lambda x: x["o"]), lambda x: x["s"])
        links = links.select(*key, "__m", ids.alias("__ids"), sources.alias("__p"))
        links = links.select(
            *key,
            F.when(c("__m") == 1, F.array_sort("__ids")).when(F.size("__ids") > 0, c("__ids")).alias("external_ids"),
            F.when(F.size("__p") > 0, c("__p")).alias("data_sources"),
        )
        # name and rank travel as the join's keys only
        rest = [c(f"`{x}`") for x in self.attrs.columns if x not in ("name", "rank")]
        out = self.attrs.select(*rest, *on).join(links, list(key), "left")
        out = out.withColumns({"name": F.when(~c("__nn"), c("__n")), "rank": F.when(~c("__rn"), c("__r"))})
        return out.select(*[c(f"`{x}`") for x in TAXA_COLUMNS])

    def of_ranks(self, ranks) -> LinkedTaxa:
        """The taxa of the listed ranks with their links: a slice for ``arrays``,
        which then collects nothing of the other ranks."""
        return LinkedTaxa(*[x if x is None else rank_slice(x, ranks) for x in (self.attrs, self.ids, self.sources, self.links)])

    def id_segments(self, size: int = 1000) -> DataFrame:
        """(taxon_id, segment, external_ids): the taxon's ids in order, in arrays
        of at most ``size``. Equal ids of one taxon follow each other."""
        return collect_segments(self._keyed(self.ids, ["external_id"]), ["taxon_id"], {"external_ids": "external_id"}, ["external_id"], size)


def _linked(links: DataFrame, is_id: bool, is_source: bool) -> DataFrame:
    return links.withColumns({"is_id": F.lit(is_id), "is_source": F.lit(is_source)})


def build_taxa(merged: DataFrame, ranks=RANKS_SPECIFIC, num_partitions: int | None = None) -> LinkedTaxa:
    """One row per (name, rank) of the listed ranks with MAX attributes and a
    source count, numbered 1..n by the rank path (K5); its source records as
    links.

    The rank filter is on a grouping key, so Catalyst applies it before the
    aggregate (partial aggregation map-side). Numbering is the distributed
    dense id (no single-task window); whole rows are numbered, as the sort keys
    are 16 of their 17 columns and a join by key would aggregate twice (2.7 s
    against 2.0 s at sf0.1). The links are a projection.
    """
    c = F.col
    m = merged.where(c("rank").isin(list(ranks)))
    grouped = m.groupBy("name", "rank").agg(
        *[F.max(c(f"`{a}`")).alias(a) for a in MERGED_ATTRIBUTES],
        F.count(F.lit(1)).alias("source_count"),
    )
    numbered = dense_id(grouped, TAXA_ID_ORDER, out="id", num_partitions=num_partitions)
    attrs = numbered.select(*[c(f"`{x}`") for x in TAXA_COLUMNS[:-2]], "source_count")
    sources = m.select("name", "rank", c("id").alias("external_id"), "data_source")
    ids = sources.select("name", "rank", "external_id", F.lit(False).alias("merged"))
    return LinkedTaxa(attrs, ids, sources, _linked(sources.withColumn("merged", F.lit(False)), True, True))


def rank_slice(taxa: DataFrame, ranks) -> DataFrame:
    """Rows of the listed ranks (B15: ``genera`` / ``species`` views)."""
    return taxa.where(F.col("rank").isin(list(ranks)))


DEDUPE_KEYS = ["generic_name", "specific_name", "infra_name"]


def deduplicate_taxa(taxa: LinkedTaxa) -> LinkedTaxa:
    """Collapse taxa sharing (generic, specific, infra) names (K6): most source
    records first, then subspecies < variety < form < other, then name.

    NULL keys never form duplicate groups. The winner keeps its attributes and
    its own sources; the group's external ids move to it (distinct). Plan: one
    aggregate per key yields winner and group size; the member -> winner map
    covers duplicate-group members only and is the small side of the joins that
    drop losers and re-key their ids. What a bitmap of the members tells to be of
    no group is kept out of those joins and their exchanges. Re-keyed ids are made
    distinct on (winner, id), so a hot group is spread by id, never collected.
    """
    c = F.col
    attrs = taxa.attrs
    order = [
        desc("source_count"),
        asc(rank_preference("rank", DEDUPE_RANK_PREFERENCE)),
        asc("name"),
        asc("rank"),
        asc("id"),
    ]
    members = duplicate_members(attrs, DEDUPE_KEYS, order, ["id", "name", "rank"])
    mapping = members.select(
        c("id").alias("member_id"), c("name").alias("m_name"), c("rank").alias("m_rank"),
        c("best.id").alias("winner_id"), c("best.name").alias("w_name"), c("best.rank").alias("w_rank"),
    )
    mapping = scratch_table(mapping, "dedupe-members")  # narrow, and read by four joins
    losers = mapping.where(c("member_id") != c("winner_id"))
    others, some = apart(attrs, marks(losers, ["member_id"]), ["id"])
    new_attrs = others.unionByName(some.join(losers, some["id"] == losers["member_id"], "left_anti"))

    named = marks(mapping, ["m_name", "m_rank"])

    def on_member(links: DataFrame, members: DataFrame):
        return _null_safe_on(links, members, [("name", "m_name"), ("rank", "m_rank")])

    def moved(ids: DataFrame) -> DataFrame:
        won = ids.join(mapping, on_member(ids, mapping)).select(c("w_name").alias("name"), c("w_rank").alias("rank"), "external_id")
        return won.distinct().withColumn("merged", F.lit(True))

    alone, ids = apart(taxa.ids, named, ["name", "rank"])
    new_ids = moved(ids).unionByName(ids.join(mapping, on_member(ids, mapping), "left_anti")).unionByName(alone)
    kept, src = apart(taxa.sources, named, ["name", "rank"])
    new_sources = src.join(losers, on_member(src, losers), "left_anti").unionByName(kept)
    if taxa.links is None:
        return LinkedTaxa(new_attrs, new_ids, new_sources)
    kept, links = apart(taxa.links, named, ["name", "rank"])
    # a winner's own links stay as sources, its ids come with the group's
    own = links.join(mapping, on_member(links, mapping), "left")
    member, won = c("member_id").isNotNull(), c("member_id") == c("winner_id")
    own = own.where(~member | won & c("is_source")).withColumn("is_id", ~member & c("is_id")).select(*links.columns)
    ids = links.where("is_id").select("name", "rank", "external_id")
    none = moved(ids).withColumn("data_source", F.lit(None).cast("string"))
    return LinkedTaxa(new_attrs, new_ids, new_sources, kept.unionByName(own).unionByName(_linked(none, True, False)))


def fill_taxa(taxa: LinkedTaxa) -> LinkedTaxa:
    """Hierarchical gap fill (K7) with generic_name falling back to genus."""
    filled = hierarchical_fill(taxa.attrs, FILL_ORDER, extra={"generic_name": ["genus"]})
    return replace(taxa, attrs=filled)


def crosswalk_literal(taxa: DataFrame, merged: DataFrame, source: str = "WFO") -> DataFrame:
    """(taxon id, source id) on rank + three name parts, one source (K8).
    With WFO rows this is always empty (WFO carries no generic name)."""
    return crosswalk_join(
        taxa,
        merged,
        ["rank", "generic_name", "specific_name", "infra_name"],
        where=F.col("data_source") == source,
    )


def crosswalk_ids(taxa: LinkedTaxa, prefix: str = "wfo-") -> DataFrame:
    """(taxon id, source id) for one source: that source's id links joined to
    the taxon ids on the natural key."""
    links = taxa.ids.where(F.col("external_id").startswith(prefix))
    return taxa._keyed(links, ["external_id"]).withColumnRenamed("taxon_id", "id")


def coverage_all(sources: dict[str, tuple[DataFrame, str, str]], final: LinkedTaxa) -> DataFrame:
    """Coverage of several sources in one pass: (source_id, source_name,
    error_message) for every distinct source record whose id is linked to no
    final taxon. ``sources`` maps a key to (conformed frame, id prefix, label).
    One union, an anti join, and a distinct of what is missing: the join has the
    records dealt by their id already, so they are exchanged once."""
    c = F.col
    parts, linked = [], F.lit(False)
    for _key, (frame, prefix, label) in sources.items():
        parts.append(
            frame.select(c("id").alias("source_id"), c("name").alias("source_name"))
            .where(c("source_id").isNotNull() & c("source_id").startswith(prefix))
            .withColumn("error_message", F.lit(f"{label} source record missing from final dataset"))
        )
        linked = linked | c("external_id").startswith(prefix)
    src = parts[0]
    for p in parts[1:]:
        src = src.unionByName(p)
    present = final.ids.select("external_id").where(c("external_id").isNotNull() & linked)
    return src.join(present, src["source_id"] == present["external_id"], "left_anti").distinct()


def coverage(source_conformed: DataFrame, final: LinkedTaxa, prefix: str, label: str) -> DataFrame:
    """Distinct source (id, name) whose id is linked to no final taxon (K9):
    ``coverage_all`` of one source."""
    return coverage_all({label: (source_conformed, prefix, label)}, final)


@dataclass
class PipelineResult:
    wfo: DataFrame
    gbif: DataFrame
    wiz: DataFrame
    merged: DataFrame
    taxa: LinkedTaxa
    deduplicated: LinkedTaxa
    filled: LinkedTaxa


def run_pipeline(wfo: DataFrame, gbif: DataFrame, wiz: DataFrame, num_partitions: int | None = None) -> PipelineResult:
    """Conformed sources -> merged -> taxa -> deduplicated -> filled."""
    merged = merge_sources(wfo, gbif, wiz)
    taxa = build_taxa(merged, num_partitions=num_partitions)
    dedup = deduplicate_taxa(taxa)
    filled = fill_taxa(dedup)
    return PipelineResult(wfo, gbif, wiz, merged, taxa, dedup, filled)


def write_outputs(
    spark,
    wfo: DataFrame,
    gbif: DataFrame,
    wiz: DataFrame,
    out_dir: str,
    num_partitions: int | None = None,
    reference_arrays: bool = False,
    id_segments: int | None = None,
) -> dict[str, str]:
    """Run the chain and publish its tables under ``out_dir``.

    Published, like the source project's models: the conformed sources
    (``wfo``, ``gbif``, ``wiz``), ``taxonomy_merged``, ``taxa_deduplicated``
    with its id links ``taxa_external_ids``, ``taxa_filled``,
    ``crosswalk_wfo`` and ``missing_records`` (all three sources' coverage
    failures, labelled); with ``reference_arrays`` also ``taxa_filled_arrays``
    (array format), with ``id_segments`` also ``taxa_id_segments``, the external
    ids in arrays of at most so many. Each is a published table
    (:class:`taxaweave.sources.tables.Table`): it keeps its last state until the
    new one is whole, and that one until the next run. A taxon's own source records are the merged records of
    the surviving taxa (a semi join), derived only when needed.

    Every table that feeds more than one later step is written once and read
    back, so no part of the chain runs twice; each later read prunes to the
    columns it needs.
    """
    out_dir = out_dir.rstrip("/")
    paths: dict[str, str] = {}
    mark = scratch_mark()

    def publish(df: DataFrame, name: str) -> DataFrame:
        paths[name] = f"{out_dir}/{name}"
        table = Table(spark, paths[name])
        table.refresh(df)
        table.vacuum(keep=2)
        return table.read()

    conformed = {k: publish(v, k) for k, v in (("wfo", wfo), ("gbif", gbif), ("wiz", wiz))}
    merged = publish(merge_sources(conformed["wfo"], conformed["gbif"], conformed["wiz"]), "taxonomy_merged")
    dedup = deduplicate_taxa(build_taxa(merged, num_partitions=num_partitions))
    attrs = publish(dedup.attrs, "taxa_deduplicated")
    ids = publish(dedup.ids, "taxa_external_ids")
    # a taxon's own source records: the merged records of the surviving taxa
    recs = merged.where(F.col("rank").isin(list(RANKS_SPECIFIC))).select(
        "name", "rank", F.col("id").alias("external_id"), "data_source"
    )
    keys = attrs.select(F.col("name").alias("__n"), F.col("rank").alias("__r"))
    sources = recs.join(keys, _null_safe_on(recs, keys, [("name", "__n"), ("rank", "__r")]), "left_semi")
    stored = LinkedTaxa(attrs, ids, sources)
    final = LinkedTaxa(publish(fill_taxa(stored).attrs, "taxa_filled"), ids, sources)
    paths["taxa"] = paths["taxa_filled"]
    publish(crosswalk_ids(final, "wfo-"), "crosswalk_wfo")
    publish(
        coverage_all(
            {
                "wfo": (conformed["wfo"], "wfo-", "WFO"),
                "gbif": (conformed["gbif"], "gbif-", "GBIF"),
                "wiz": (conformed["wiz"], "wiz-", "OrchidWiz"),
            },
            final,
        ),
        "missing_records",
    )
    if reference_arrays:
        publish(final.arrays(), "taxa_filled_arrays")
    if id_segments:
        publish(final.id_segments(id_segments), "taxa_id_segments")
    delete_scratch(spark, mark)  # everything is written
    return paths
