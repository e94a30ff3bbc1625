"""What the chain keeps on disk: links and taxa that no duplicate group holds stay out of
the dedupe's exchanges, a record that is an id and a source travels once."""

import os

import pytest
from pyspark.sql import functions as F

from taxaweave import session
from taxaweave.operators.marks import apart, marks
from taxaweave.plans import pipeline, proxies
from tests.test_scale import _star


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def _shuffled(spark, run) -> int:
    """Bytes of the shuffle files that ``run`` makes."""

    def files():
        it = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles().iterator()
        found = {}
        while it.hasNext():
            f = it.next()
            if f.getName().startswith("shuffle_"):
                found[f.getName()] = f.length()
        return found

    before = files()
    run()
    return sum(size for name, size in files().items() if name not in before)


def _merged(spark, n=600):
    """Taxa of three records each; every thirtieth shares its three names with a variety; nulls."""
    rows = []
    for k in range(n):
        rows += [(f"name {k}", "species", f"id-{k}-{j}", "WFO" if j else "GBIF", f"g{k}", "s", "i") for j in range(3)]
        if k % 30 == 0:
            rows += [(f"name {k} var.", "variety", f"var-{k}", "WFO", f"g{k}", "s", "i"), (f"name {k} var.", "variety", None, None, f"g{k}", "s", "i")]
            rows += [(f"name {k} var.", "variety", f"id-{k}-0", "GBIF", f"g{k}", "s", "i")]
    rows += [(None, "form", "null-1", "WFO", "gn", "s", "i"), ("", "form", "null-2", None, "gn", "s", "i"), (None, "form", None, "WFO", "gn", "s", "i"), ("lone", "form", None, None, None, None, None)]
    df = spark.createDataFrame(rows, "name string, rank string, id string, data_source string, generic_name string, specific_name string, infra_name string")
    for a in pipeline.MERGED_ATTRIBUTES:
        if a not in df.columns:
            df = df.withColumn(a, F.lit(None).cast("string"))
    return session.scratch_table(df.repartition(4, "id"), "merged")


def _rows(df):
    return sorted((tuple(map(str, r)) for r in df.collect()))


def test_apart_loses_no_row_of_a_key(spark):
    some = spark.range(0, 100_000, 7).select(F.when(F.col("id") > 0, F.col("id")).alias("k"))
    every = spark.range(100_000).select(F.when(F.col("id") > 5, F.col("id")).alias("k"))
    rest, met = apart(every, marks(some, ["k"]), ["k"])
    assert met.where("k is null").count() == 6 and met.join(some, "k").count() == every.join(some, "k").count()
    assert rest.join(some, "k").count() == 0 and met.count() + rest.count() == 100_000 and met.count() < 1.01 * some.count()
    rest, met = apart(every, marks(some.limit(0), ["k"]), ["k"])
    assert rest.count() == 100_000 and met.count() == 0


def test_dedupe_moves_the_links_of_groups_only(spark, no_broadcast):
    taxa = pipeline.build_taxa(_merged(spark, 6000))
    dedup = pipeline.deduplicate_taxa(taxa)
    every = _shuffled(spark, lambda: taxa.ids.repartition(8, "name").collect())
    rows = []
    assert _shuffled(spark, lambda: rows.extend(dedup.ids.collect())) < every / 2
    assert _shuffled(spark, lambda: rows.extend(dedup.sources.collect())) < every / 2
    assert _shuffled(spark, lambda: rows.extend(dedup.links.collect())) < every / 2
    assert _shuffled(spark, lambda: rows.extend(dedup.attrs.select("id").collect())) < every / 2


def test_arrays_of_links_are_those_of_ids_and_sources(spark):
    taxa = pipeline.build_taxa(_merged(spark))
    dedup = pipeline.deduplicate_taxa(taxa)
    for x in (taxa, dedup, dedup.of_ranks(["species", "form"]), pipeline.fill_taxa(dedup)):
        assert x.links is not None
        plain = pipeline.LinkedTaxa(x.attrs, x.ids, x.sources)
        assert _rows(x.arrays()) == _rows(plain.arrays()) and x.arrays().count() > 500
    out = {r["name"]: (r["external_ids"], r["data_sources"]) for r in dedup.arrays().where("rank <> 'form'").collect()}
    assert out["name 1"] == (["id-1-0", "id-1-1", "id-1-2"], ["GBIF", "WFO", "WFO"])
    [won] = [v for k, v in out.items() if k in ("name 30", "name 30 var.")]
    assert won[0] == ["id-30-0", "id-30-1", "id-30-2", "var-30", None]
    assert {r["name"]: r["external_ids"] for r in dedup.arrays().where("rank = 'form'").collect()}["lone"] == [None]


def test_fill_query_keeps_the_tables_that_it_still_reads(spark, tmp_path):
    sf = _star(spark, tmp_path / "in")
    root, before = session.local_fs_path(session.shared_dir(spark)), session.scratch_mark()
    was = set(os.listdir(root))
    out = proxies.REGISTRY["pipe_fill"][0](spark, sf)
    names = sorted(d.rsplit("-", 1)[0] for d in set(os.listdir(root)) - was if os.path.isdir(f"{root}/{d}"))
    assert names == ["dedupe-members", "filled", "merged"] and len(session._SCRATCH[before:]) == 3
    assert out.count() == proxies._stage(spark, sf, "filled").attrs.count() > 0
