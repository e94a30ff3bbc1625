"""Per-source conforming onto the shared 25-column schema (K1-K3).

Each function takes the raw, all-text source table(s) and returns the
conformed rows (columns in ``CONFORMED_COLUMNS`` order). ``loaded_at=True``
adds a ``dbt_loaded_at``-style timestamp column; it is off by default because
it can never be compared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxaweave.functions.names import (
    classify_by_tokens,
    compose_name_by_rank,
    concat_skip_null,
    guarded_prefix,
    map_vocabulary,
    not_blank,
    null_string,
    replace_first_marker,
    split_around_marker,
    split_part,
    unguarded_prefix,
)
from taxaweave.operators.dedupe import asc, desc, top1_per_key
from taxaweave.operators.joins import first_match, lookup_join
from taxaweave.operators.numbering import sequence_in_group
from taxaweave.schemas import (
    CONFORMED_COLUMNS,
    WFO_NOMENCLATURAL_STATUS_MAP,
    WFO_TAXONOMIC_STATUS_MAP,
    WIZ_CONSTANTS,
)

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the source project's)
# ---------------------------------------------------------------------------
WFO_PREFERRED_ID_PREFIX = "wfo-0000"
IPNI_URN_PREFIX = "urn:lsid:ipni.org:names:"
GBIF_NAME_MARKERS = {"subspecies": "subsp.", "variety": "var.", "form": "f."}

# OrchidWiz species names: rank by the first matching rule.
WIZ_MAIN_RANK_RULES = [
    ([" var. ", " v. ", " nv. ", " Br. fol. "], "variety"),
    ([" ssp. ", " subsp. "], "subspecies"),
    ([" f. ", " forma ", " nm. ", " monstr. "], "form"),
    ([" h.v. "], "variety"),
    ([" h.f. "], "form"),
    ([" sp. "], "species"),
]
WIZ_MAIN_SPLIT_MARKERS = [" var. ", " ssp. ", " subsp. ", " f. ", " h.v. ", " h.f. "]

# OrchidWiz infras: rank rules, default subspecies.
WIZ_INFRA_RANK_RULES = [
    ([" var. "], "variety"),
    ([" ssp. ", " subsp. "], "subspecies"),
    ([" f. ", " forma "], "form"),
    ([" nothovar. "], "variety"),
]
WIZ_INFRA_SPLIT_MARKERS = [" var. ", " ssp. ", " subsp. ", " nothovar. ", " f. "]

# Display name: only the first matching marker is rewritten.
WIZ_NAME_REWRITES = [
    (" h.v. ", " var. "),
    (" h.f. ", " f. "),
    (" v. ", " var. "),
    (" nm. ", " f. "),
    (" nv. ", " var. "),
    (" monstr. ", " f. "),
    (" subsp. ", " ssp. "),
    (" sp. ", " "),
    (" Br. fol. ", " var. "),
]


def _finish(df: DataFrame, columns: dict[str, Column], loaded_at: bool) -> DataFrame:
    cols = [columns.get(c, null_string()).alias(c) for c in CONFORMED_COLUMNS]
    if loaded_at:
        cols.append(F.current_timestamp().alias("dbt_loaded_at"))
    return df.select(*cols)


def conform_wfo(raw: DataFrame, loaded_at: bool = False) -> DataFrame:
    """WFO rows (K1): accepted, named rows; one row per scientific name
    preferring ``wfo-0000`` ids, then the newest ``created`` (a NULL date
    counts as newest), then the smallest id."""
    c = F.col
    kept = raw.where(
        c("taxonid").isNotNull() & not_blank("scientificname") & (c("taxonomicstatus") == "Accepted")
    )
    best = top1_per_key(
        kept,
        ["scientificname"],
        [
            asc(F.when(c("taxonid").startswith(WFO_PREFERRED_ID_PREFIX), F.lit(1)).otherwise(F.lit(2))),
            desc("created", nulls_first=True),
            asc("taxonid"),
        ],
    )
    sid = c("scientificnameid")
    return _finish(
        best,
        {
            "id": c("taxonid"),
            "parent_id": c("parentnameusageid"),
            "accepted_id": c("acceptednameusageid"),
            "original_id": c("originalnameusageid"),
            "name": c("scientificname"),
            "specific_name": c("specificepithet"),
            "infra_name": c("infraspecificepithet"),
            "family": c("family"),
            "subfamily": c("subfamily"),
            "tribe": c("tribe"),
            "subtribe": c("subtribe"),
            "genus": c("genus"),
            "subgenus": c("subgenus"),
            "rank": c("taxonrank"),
            "taxonomic_status": map_vocabulary("taxonomicstatus", WFO_TAXONOMIC_STATUS_MAP),
            "nomenclatural_status": map_vocabulary("nomenclaturalstatus", WFO_NOMENCLATURAL_STATUS_MAP),
            "ipni_id": F.when(sid.startswith(IPNI_URN_PREFIX), split_part(sid, ":", -1)).otherwise(sid),
            "tpl_id": c("tplid"),
            "data_source": F.lit("WFO"),
        },
        loaded_at,
    )


def conform_gbif(raw: DataFrame, loaded_at: bool = False) -> DataFrame:
    """GBIF rows (K2): plants with accepted status (any case)."""
    c = F.col
    kept = raw.where((c("kingdom") == "Plantae") & (F.lower(c("taxonomicStatus")) == "accepted"))
    return _finish(
        kept,
        {
            "id": unguarded_prefix("taxonID", "gbif-"),
            "parent_id": guarded_prefix("parentNameUsageID", "gbif-"),
            "accepted_id": guarded_prefix("acceptedNameUsageID", "gbif-"),
            "original_id": guarded_prefix("originalNameUsageID", "gbif-"),
            "name": compose_name_by_rank(
                "taxonRank",
                "genericName",
                "specificEpithet",
                "infraspecificEpithet",
                F.coalesce(c("canonicalName"), c("scientificName")),
                GBIF_NAME_MARKERS,
            ),
            "specific_name": c("specificEpithet"),
            "infra_name": c("infraspecificEpithet"),
            "kingdom": c("kingdom"),
            "phylum": c("phylum"),
            "class": c("class"),
            "order": c("order"),
            "family": c("family"),
            "genus": c("genus"),
            "generic_name": c("genericName"),
            "rank": c("taxonRank"),
            "taxonomic_status": F.lower(c("taxonomicStatus")),
            "nomenclatural_status": F.lower(c("nomenclaturalStatus")),
            "data_source": F.lit("GBIF"),
        },
        loaded_at,
    )


def _wiz_parts(df: DataFrame, spname: Column, rank_rules, split_markers, default_rank: str) -> DataFrame:
    c = F.col
    before, after = split_around_marker("Name", split_markers)
    return df.where(not_blank("Name") & not_blank("Genus")).select(
        spname.alias("spname_id"),
        c("Species").cast("int").alias("species_id"),
        c("Genus").cast("string").alias("genus_abbrev"),
        c("Name").cast("string").alias("full_name"),
        classify_by_tokens("Name", rank_rules, default_rank).alias("determined_rank"),
        before.alias("species_epithet"),
        after.alias("infraspecific_epithet"),
    )


def conform_wiz(
    species_names: DataFrame,
    infras: DataFrame,
    genera: DataFrame,
    classifications: DataFrame,
    loaded_at: bool = False,
) -> DataFrame:
    """OrchidWiz rows (K3): species names plus infras, genus attributes by
    abbreviation, subgenus/section by species id.

    Infra ids are ``wiz-infra-<species>-<n>`` where n numbers every joined row
    of the (species, genus) group by full name - primary rows included - as the
    source semantics do. Parent ids point to a species-rank row with the same
    species id, genus and epithet (the smallest such id).
    """
    c = F.col
    main = _wiz_parts(species_names, c("SpName").cast("int"), WIZ_MAIN_RANK_RULES, WIZ_MAIN_SPLIT_MARKERS, "species")
    infra = _wiz_parts(infras, F.lit(None).cast("int"), WIZ_INFRA_RANK_RULES, WIZ_INFRA_SPLIT_MARKERS, "subspecies")
    all_taxa = main.unionByName(infra)

    g = genera.select(
        c("Genus").alias("__g_abbrev"),
        c("Name").alias("g_name"),
        c("Subfamily").alias("g_subfamily"),
        c("Tribe").alias("g_tribe"),
        c("Subtribe").alias("g_subtribe"),
    )
    cl = classifications.select(
        c("Species").cast("string").alias("__c_species"),
        c("Subgenus").alias("c_subgenus"),
        c("Section").alias("c_section"),
    )
    # the smallest id there is; a parent without an id is still a parent
    parents = main.where(c("determined_rank") == "species").withColumn("__id", F.struct(c("spname_id").isNull().alias("none"), c("spname_id").alias("id")))
    joined = lookup_join(all_taxa, g, "genus_abbrev", "__g_abbrev")
    joined = lookup_join(joined, cl, c("species_id").cast("string"), "__c_species")

    numbered = sequence_in_group(
        joined,
        ["species_id", "genus_abbrev"],
        [
            c("full_name").asc_nulls_last(),
            c("spname_id").asc_nulls_last(),
            c("g_name").asc_nulls_last(),
            c("g_subfamily").asc_nulls_last(),
            c("g_tribe").asc_nulls_last(),
            c("g_subtribe").asc_nulls_last(),
            c("c_subgenus").asc_nulls_last(),
            c("c_section").asc_nulls_last(),
            c("determined_rank").asc_nulls_last(),
        ],
        out="__seq",
    )

    with_parent = first_match(numbered, parents, ["species_id", "genus_abbrev", "species_epithet"], "__id", "__parent")

    genus = F.coalesce(c("g_name"), c("genus_abbrev"))
    is_infra_rank = c("determined_rank").isin("subspecies", "variety", "form")
    out = {
        "id": F.when(c("spname_id").isNotNull(), concat_skip_null(F.lit("wiz-"), c("spname_id").cast("string"))).otherwise(
            concat_skip_null(F.lit("wiz-infra-"), c("species_id").cast("string"), F.lit("-"), c("__seq").cast("string"))
        ),
        "parent_id": F.when(
            is_infra_rank & c("__parent").isNotNull(),
            concat_skip_null(F.lit("wiz-"), c("__parent.id").cast("string")),
        ),
        "name": concat_skip_null(genus, F.lit(" "), replace_first_marker("full_name", WIZ_NAME_REWRITES)),
        "specific_name": c("species_epithet"),
        "infra_name": c("infraspecific_epithet"),
        "subfamily": c("g_subfamily"),
        "tribe": c("g_tribe"),
        "subtribe": c("g_subtribe"),
        "genus": genus,
        "subgenus": c("c_subgenus"),
        "generic_name": genus,
        "rank": c("determined_rank"),
        "taxonomic_status": F.lit("accepted"),
        "nomenclatural_status": F.lit("valid"),
        "data_source": F.lit("OrchidWiz"),
        "section": c("c_section"),
    }
    out.update({k: F.lit(v) for k, v in WIZ_CONSTANTS.items()})
    return _finish(with_parent, out, loaded_at)
