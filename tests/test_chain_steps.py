"""Steps of the chain that were made cheaper: same rows, less work in the plan."""

from pyspark.sql import functions as F

from taxaweave.operators.fill import fill_from_mode
from taxaweave.plans import derived, pipeline


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_remainders_are_looked_up_and_spelled_as_before(spark):
    keys = [None, 0, 1, 9, 10, 210, 211, 5060708, 2**62, -1, -10, -12345, -(2**62)]
    k = F.col("k")
    row = spark.createDataFrame([(x,) for x in keys], "k long").select(
        derived.word_of_remainder(k, 211, "aceae").alias("got"),
        F.concat(derived.cap_word(k % 211), F.lit("aceae")).alias("want"),
        derived.word_of_remainder(k, 97, capital=False).alias("got_low"),
        derived.word(k % 97).alias("want_low"),
    )
    for r in row.collect():
        assert (r.got, r.got_low) == (r.want, r.want_low)

    schema = (
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp"
    )
    raw = derived.wfo_raw(spark.createDataFrame([], schema)).select("family", "tribe")
    # the genus (its first letter and the rest) and the epithet are spelled, nothing else
    assert _plan(raw).count("translate(") <= 3


def test_coverage_exchanges_the_records_once_and_keeps_its_rows(spark):
    gbif = spark.createDataFrame(
        [("gbif-1", "a"), ("gbif-2", "b"), ("gbif-2", "b"), ("gbif-2", "c"), ("gbif-3", None), ("gbif-3", None), (None, "x"), ("other", "y")],
        "id string, name string",
    )
    wiz = spark.createDataFrame([("wiz-1", "a"), ("wiz-9", "z"), ("wiz-9", "z"), ("gbif-2", "b")], "id string, name string")
    links = spark.createDataFrame(
        [("n", "species", "gbif-1", False), ("n", "species", "gbif-1", True), ("n", "species", "wiz-1", False), ("n", "species", None, False)],
        "name string, rank string, external_id string, merged boolean",
    )
    final = pipeline.LinkedTaxa(None, links, None)
    out = pipeline.coverage_all({"gbif": (gbif, "gbif-", "GBIF"), "wiz": (wiz, "wiz-", "OrchidWiz")}, final)
    end = " source record missing from final dataset"
    key = lambda r: tuple(str(v) for v in r)
    want = [("gbif-2", "b", "GBIF" + end), ("gbif-2", "c", "GBIF" + end), ("gbif-3", None, "GBIF" + end), ("wiz-9", "z", "OrchidWiz" + end)]
    assert sorted(map(tuple, out.collect()), key=key) == want
    one = pipeline.coverage(gbif, final, "gbif-", "GBIF")
    assert sorted(map(tuple, one.collect()), key=key) == want[:3]
    for df in (out, one):
        assert _plan(df).index("Aggregate") < _plan(df).index("LeftAnti")  # what is missing is made distinct


def test_fill_from_mode_does_not_sort_the_rows(spark):
    rows = [(1, "g", "f"), (2, "g", None), (3, "g", "f"), (4, "g", "e"), (5, None, None), (6, "h", None), (7, "", None), (8, "", "x")]
    out = fill_from_mode(spark.createDataFrame(rows, "id int, genus string, family string"), "genus", ["family"])
    assert {r.id: r.filled_family for r in out.collect()} == {1: "f", 2: "f", 3: "f", 4: "e", 5: None, 6: None, 7: "x", 8: "x"}
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan and "BroadcastHashJoin" not in plan
