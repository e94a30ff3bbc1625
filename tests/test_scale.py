"""Scale behaviour: a key holding a third of all rows, and plan shapes
(partial reduction before every shuffle, pushdown into the scan)."""

import contextlib
import io
import tempfile

from pyspark.sql import functions as F

from taxaweave.operators import dedupe as D
from taxaweave.operators import fill as FL
from taxaweave.operators import numbering as R
from taxaweave.plans import conform, pipeline
from taxaweave.session import local_fs_path


def _plan(df, mode: str | None = None) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode) if mode else df.explain()
    return buf.getvalue()


def _hot(spark, n=30000):
    # a third of the rows share key 'hot'
    return spark.range(0, n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 997).cast("string"))).alias("k"),
        F.col("id"),
        (F.col("id") * 7 % 101).alias("v"),
        F.when(F.col("id") % 3 == 0, F.lit("G")).otherwise(F.concat(F.lit("g"), (F.col("id") % 50).cast("string"))).alias("genus"),
        F.when(F.col("id") % 5 == 0, F.lit(None)).otherwise(F.concat(F.lit("f"), (F.col("id") % 7).cast("string"))).alias("family"),
    )


def test_top1_reduces_hot_key_before_shuffle(spark):
    df = _hot(spark)
    best = D.top1_per_key(df, ["k"], [D.desc("v"), D.asc("id")])
    plan = _plan(best)
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert plan.index("Partial") > plan.index("Exchange hashpartitioning")  # partial sits below the exchange
    row = best.where(F.col("k") == "hot").first()
    expected = min(((-(i * 7 % 101), i) for i in range(0, 30000, 3)))
    assert (row["v"], row["id"]) == (-expected[0], expected[1])  # brute force: max v, then smallest id
    assert best.count() == 998


def test_build_taxa_aggregates_partially(spark, monkeypatch):
    cols = {"name": F.col("k"), "rank": F.lit("species"), "id": F.col("id").cast("string"), "data_source": F.lit("WFO"), "genus": F.col("genus"), "family": F.col("family")}
    merged = _hot(spark).select(*[cols.get(x, F.lit(None).cast("string")).alias(x) for x in pipeline.MERGED_COLUMNS])
    seen = []
    plain = pipeline.dense_id
    monkeypatch.setattr(pipeline, "dense_id", lambda df, *a, **b: seen.append(_plan(df)) or plain(df, *a, **b))
    taxa = pipeline.build_taxa(merged)
    assert "partial_max" in seen[0] and "partial_count" in seen[0]
    hot = taxa.attrs.where("name = 'hot'").first()
    assert hot["source_count"] == 10000 and taxa.attrs.count() == 998


def test_fill_explodes_once_and_fills_the_hot_path(spark):
    df = _hot(spark).select("id", "genus", "family", F.lit(None).cast("string").alias("order"))
    out = FL.hierarchical_fill(df, {"family": ["genus"], "order": ["genus", "family"]})
    assert "Generate" not in _plan(out)  # the mode table is read, not recomputed
    assert out.count() == df.count()
    best = sorted(df.where("genus = 'G' and family is not null").groupBy("family").count().collect(), key=lambda r: (-r["count"], r["family"]))[0]["family"]
    was = df.select("id", F.col("family").alias("own"))
    assert out.join(was, "id").where(f"genus = 'G' and own is null and family <> '{best}'").count() == 0
    assert out.join(was, "id").where("own is not null and own <> family").count() == 0
    assert out.where("genus = 'G' and family is null").count() == 0


def test_dense_id_with_hot_prefix_is_gap_free(spark):
    df = _hot(spark, 12000)
    out = R.dense_id(df, ["k", "id"], out="rid", num_partitions=9)
    ids = [r["rid"] for r in out.select("rid").collect()]
    assert sorted(ids) == list(range(1, 12001))


def _scratch_bytes(path) -> int:
    import os

    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(local_fs_path(path)) for f in names if f.endswith(".parquet"))


def test_numbering_writes_keys_and_positions_only(spark):
    from taxaweave import session

    narrow = _hot(spark, 12000).select("id", "v")
    wide = narrow.select("*", *[F.sha2(F.concat_ws("-", "id", F.lit(i)), 512).alias(f"w{i}") for i in range(10)])
    sizes, ids = [], []
    for df in (narrow, wide):
        mark = session.scratch_mark()
        out = R.dense_id(df, ["v", "id"], out="rid", num_partitions=6, key=["id"])
        sizes.append(sum(map(_scratch_bytes, session._SCRATCH[mark:])))
        assert out.columns == [*df.columns, "rid"]
        ids.append(sorted((r["v"], r["id"], r["rid"]) for r in out.select("v", "id", "rid").collect()))
    assert ids[0] == ids[1] and [r[2] for r in ids[0]] == list(range(1, 12001))
    assert sizes[1] <= 1.01 * sizes[0] < 12000 * 20


def test_sequence_of_a_hot_group_meets_no_group_key(spark):
    # a third of the rows in one group, groups of NULL, more partitions than small groups fill
    df = _hot(spark, 9000).withColumn("g", F.when(F.col("id") % 7 == 0, F.lit(None)).otherwise(F.col("k")))
    for n, key in ((1, None), (13, ["id"]), (64, None)):
        out = R.sequence_in_group(df, ["g"], [F.col("v").desc(), "id"], out="seq", num_partitions=n, key=key)
        plan = _plan(out)
        joins = [line for line in plan.splitlines() if "Join" in line]
        assert "k#" not in "".join(joins) and "g#" not in "".join(j for j in joins if "__p" not in j), joins
        groups = {}
        for r in df.collect():
            groups.setdefault(r["g"], []).append((-r["v"], r["id"]))
        want = {i: s for rows in groups.values() for s, (_, i) in enumerate(sorted(rows), 1)}
        assert {r["id"]: r["seq"] for r in out.collect()} == want
    stored = spark.read.parquet(session_scratch()[-1])
    parts = [r["n"] for r in stored.where("__g0 = 'hot'").groupBy("__pid").agg(F.count("*").alias("n")).collect()]
    assert len(parts) > 10 and max(parts) < 1500  # the hot group is numbered in many partitions


def test_segments_spread_a_hot_key_and_keep_its_order(spark):
    from taxaweave.operators.merge import collect_segments

    df = _hot(spark, 6000).withColumn("v", F.when(F.col("id") % 5 == 0, F.lit(None)).otherwise(F.col("v")))
    out = collect_segments(df, ["k"], {"ids": "id", "vs": "v"}, [F.col("id").desc()], size=100, num_partitions=9)
    rows = out.where("k = 'hot'").orderBy("segment").collect()
    assert [r["segment"] for r in rows] == list(range(20)) and all(len(r["ids"]) == 100 for r in rows)
    want = [(i, None if i % 5 == 0 else i * 7 % 101) for i in range(0, 6000, 3)][::-1]
    assert [p for r in rows for p in zip(r["ids"], r["vs"])] == want
    assert out.agg(F.sum(F.size("ids")).alias("n")).first()["n"] == 6000 and out.agg(F.max(F.size("ids")).alias("n")).first()["n"] == 100
    plan = _plan(out)
    assert "hashpartitioning(k" in plan and "segment" in plan.split("hashpartitioning(k")[1].split(")")[0] or "_groupingexpression" in plan


def test_ten_checks_take_one_scan(spark, tmp_path):
    from taxaweave.operators import quality as QC
    from taxaweave.operators import rowchecks as RC
    from taxaweave.plans import proxies
    from taxaweave.schemas import RANKS_INFRASPECIFIC

    path = str(tmp_path / "parts")
    proxies._checked(spark, "/root/testdata/sf0.001").write.parquet(path)
    df = spark.read.parquet(path)
    plans = []
    writer = RC.scratch_table

    def noted(rows, name):
        plans.append(_plan(rows))
        return writer(rows, name)

    RC.scratch_table = noted
    try:
        done = RC.run_checks(df, proxies.ten_checks(), keep=["p_partkey"])
    finally:
        RC.scratch_table = writer
    assert len(plans) == 1 and plans[0].count("FileScan") == 1
    assert path not in _plan(done.counts) and path not in _plan(done.rows("range"))  # later reads are of the failing rows
    single = {
        "not_null": QC.not_null(df, "name"),
        "accepted_values": QC.accepted_values(df, "p_type", ["SMALL", "MEDIUM", "ECONOMY"]),
        "not_empty": QC.not_empty_string(df, "name"),
        "expression": QC.expression_is_true(df, "p_size > length(name)"),
        "range": QC.accepted_range(df, "p_size", 5, 40),
        "not_accepted_values": QC.not_accepted_values(df, "p_brand", ["Brand#1", "Brand#2"]),
        "single_word": QC.single_word(df, ["epithet"]),
        "period": QC.period_only_below_species(df, "epithet", "rank", RANKS_INFRASPECIFIC),
        "no_digits": QC.no_digits(df, ["p_brand"]),
        "no_unranked": QC.no_value(df, "rank"),
    }
    counts = {r["check"]: r["n_failures"] for r in done.counts.collect()}
    assert list(counts) == list(single)
    for name, rows in single.items():
        keys = sorted(r["p_partkey"] for r in rows.collect())
        assert sorted(r["p_partkey"] for r in done.rows(name).collect()) == keys and counts[name] == len(keys) > 0


def test_more_checks_than_bits_of_a_long(spark):
    from taxaweave.operators import rowchecks as RC

    done = RC.run_checks(spark.range(200), {f"c{i}": F.col("id") == i for i in range(150)} | {"none": F.lit(None) == 1, "all": F.lit(True)})
    counts = {r["check"]: r["n_failures"] for r in done.counts.collect()}
    assert len(counts) == 152 and counts["none"] == 0 and counts["all"] == 200 and all(counts[f"c{i}"] == 1 for i in range(150))
    assert [r["id"] for r in done.rows("c149").collect()] == [149] and done.labelled().count() == 350


def session_scratch():
    from taxaweave import session

    return session._SCRATCH


def test_raw_filters_reach_the_scan(spark):
    d = tempfile.mkdtemp(prefix="tw-scan-")
    cols = ["taxonID", "parentNameUsageID", "acceptedNameUsageID", "originalNameUsageID", "taxonRank", "genericName",
            "specificEpithet", "infraspecificEpithet", "canonicalName", "scientificName", "kingdom", "phylum", "class",
            "order", "family", "genus", "taxonomicStatus", "nomenclaturalStatus"]
    spark.createDataFrame([tuple(f"{c}{i}" for c in cols) for i in range(10)], ", ".join(f"`{c}` string" for c in cols)) \
        .write.mode("overwrite").parquet(d)
    plan = _plan(conform.conform_gbif(spark.read.parquet(d)), "formatted")
    assert "EqualTo(kingdom,Plantae)" in plan.split("PushedFilters:")[1].split("\n")[0]


def test_taxa_links_are_projections(spark):
    df = spark.createDataFrame(
        [("a", "species", "1", "WFO"), ("a", "species", "2", "GBIF"), ("b", "form", "3", "WFO")],
        "name string, rank string, id string, data_source string",
    )
    full = df
    for a in pipeline.MERGED_ATTRIBUTES:
        full = full.withColumn(a, F.lit(None).cast("string"))
    lt = pipeline.build_taxa(full)
    assert "Exchange" not in _plan(lt.ids)
    assert sorted(r["source_count"] for r in lt.attrs.collect()) == [1, 2]


def _star(spark, path):
    """A few line items and parts, with nulls."""
    from datetime import datetime

    day = datetime(1995, 3, 1)
    lines = [(o, p, p % 7, n, 0.01, t, f, s, day) for o in range(40) for n, p, t, f, s in ((1 + o % 7, o % 9, 0.07, "N", "O"), (1 + o % 4, o % 5, 0.02, "AR"[o % 2], "F"))]
    lines += [(None, 3, None, 1, 0.01, 0.0, "N", "O", None), (7, None, 2, None, None, None, None, None, None)]
    schema = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"
    spark.createDataFrame(lines, schema).write.parquet(f"{path}/lineitem.parquet")
    parts = [(k, k % 11, ["SMALL", "MEDIUM", "LARGE", None][k % 4], f"Brand#{k % 3}") for k in range(30)]
    spark.createDataFrame(parts, "p_partkey long, p_size int, p_type string, p_brand string").write.parquet(f"{path}/part.parquet")
    return str(path)


def _optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_sources_are_conformed_once_for_taxa_and_fill(spark, tmp_path):
    """What reads the merged records reads their scratch table: no plan after
    the merge scans the line items again, with the rows of the lazy chain."""
    from taxaweave.plans import pipeline, proxies

    sf = _star(spark, tmp_path / "in")
    for name in ("pipe_taxa", "pipe_crosswalk", "fill_taxonomy_gaps", "pipe_coverage_check"):
        assert "l_partkey" not in _optimized(proxies.REGISTRY[name][0](spark, sf)), name
    lazy = pipeline.run_pipeline(*proxies._conformed(spark, sf)).filled.arrays()
    stored = proxies._stage(spark, sf, "filled").arrays()
    assert stored.count() > 0
    assert stored.columns == lazy.columns
    assert sorted(map(str, stored.collect())) == sorted(map(str, lazy.collect()))


def test_derived_words_are_spelled_once_a_row(spark, tmp_path):
    """Every word of the derived sources stands once in the plan, however many
    rules, filters and sort keys read it; the words are the digit rule's."""
    from taxaweave.plans import conform, derived, proxies

    sf = _star(spark, tmp_path / "in")
    li = derived.load(spark, sf, "lineitem")
    for plan in (conform.conform_wfo(derived.wfo_raw(li)), conform.conform_gbif(derived.gbif_raw(li)), proxies._stage(spark, sf, "merged")):
        assert 1 <= _optimized(plan).count("translate(cast(l_suppkey") <= 2  # a word of WFO's, of GBIF's
    keys = spark.createDataFrame([(0,), (7,), (1234567890,), (-15,), (None,)], "k long")
    both = keys.select(derived.cap_word(F.col("k")), derived.cap(derived.word(F.col("k")))).collect()
    assert all(a == b for a, b in both)
    assert [r[0] for r in both] == ["A", "N", "Eioulmnrsa", "-el", None]


def test_arrays_shuffle_the_links_once_and_slice_first(spark):
    """Ids and sources are collected in one exchange that the join with the taxa
    reuses; a rank slice collects no links of other ranks."""
    rows = [("a", "species", "2", "WFO"), ("a", "species", "1", "GBIF"), ("b", "form", None, "WFO"), (None, "form", "4", "WFO"), ("", "form", "5", None)]
    merged = spark.createDataFrame(rows, "name string, rank string, id string, data_source string")
    for a in pipeline.MERGED_ATTRIBUTES:
        merged = merged.withColumn(a, F.lit(None).cast("string"))
    taxa = pipeline.build_taxa(merged)
    out = taxa.arrays()
    plan = _plan(out)
    assert plan.count("Exchange hashpartitioning(__n") == 2 and "hashpartitioning(coalesce" not in plan  # the links' and the taxa's
    assert plan.count("ObjectHashAggregate") == 2
    found = {(r["name"], r["rank"]): (r["external_ids"], r["data_sources"]) for r in out.collect()}
    assert found == {("a", "species"): (["1", "2"], ["GBIF", "WFO"]), ("b", "form"): ([None], ["WFO"]), (None, "form"): (["4"], ["WFO"]), ("", "form"): (["5"], [None])}
    part = taxa.of_ranks(["species"])
    assert part.ids.count() == part.sources.count() == 2
    assert [(r["name"], r["external_ids"]) for r in part.arrays().collect()] == [("a", ["1", "2"])]
    moved = pipeline.LinkedTaxa(taxa.attrs, taxa.ids.withColumn("merged", F.lit(True)).where("external_id = '4'"), taxa.sources.where("name = 'a'"))
    found = {(r["name"], r["rank"]): (r["external_ids"], r["data_sources"]) for r in moved.arrays().collect()}
    assert found == {("a", "species"): (None, ["GBIF", "WFO"]), ("b", "form"): (None, None), (None, "form"): (["4"], None), ("", "form"): (None, None)}
