"""End-to-end pipeline over the hand-written fixture rows (expected values
derived by hand from the source semantics)."""

from pyspark.sql import functions as F

from taxaweave.sources.tables import Table
from taxaweave.plans import conform, pipeline
from tests.fixtures import raw_frames


def _build(spark):
    wfo_raw, gbif_raw, (sn, inf, gen, cl) = raw_frames(spark)
    wfo = conform.conform_wfo(wfo_raw)
    gbif = conform.conform_gbif(gbif_raw)
    wiz = conform.conform_wiz(sn, inf, gen, cl)
    return wfo, gbif, wiz


def test_conform_wfo(spark):
    wfo, _, _ = _build(spark)
    rows = {r["id"]: r for r in wfo.collect()}
    assert sorted(rows) == ["wfo-0000000001", "wfo-0000000004", "wfo-0000000007", "wfo-0000000008", "wfo-0000000009"]
    assert rows["wfo-0000000001"]["ipni_id"] == "30000959-2"
    assert rows["wfo-0000000001"]["taxonomic_status"] == "accepted"
    assert rows["wfo-0000000001"]["data_source"] == "WFO"


def test_conform_gbif(spark):
    _, gbif, _ = _build(spark)
    rows = {r["id"]: r for r in gbif.collect()}
    assert sorted(rows) == ["gbif-1", "gbif-2", "gbif-3", "gbif-6", "gbif-7", "gbif-8"]
    assert rows["gbif-2"]["name"] == "Cattleya labiata subsp. alba"
    assert rows["gbif-3"]["name"] == "Cattleya labiata var. alba"
    assert rows["gbif-7"]["name"] == " x f. y"
    assert rows["gbif-1"]["parent_id"] is None


def test_conform_wiz(spark):
    _, _, wiz = _build(spark)
    rows = {r["id"]: r for r in wiz.collect()}
    assert sorted(rows) == ["wiz-100", "wiz-101", "wiz-102", "wiz-103", "wiz-infra-10-2", "wiz-infra-10-3"]
    assert rows["wiz-101"]["rank"] == "variety" and rows["wiz-101"]["parent_id"] == "wiz-100"
    assert rows["wiz-101"]["specific_name"] == "labiata" and rows["wiz-101"]["infra_name"] == "alba"
    assert rows["wiz-102"]["specific_name"] == "labiata v. rosea" and rows["wiz-102"]["infra_name"] is None
    assert rows["wiz-102"]["name"] == "Cattleya labiata var. rosea"
    assert rows["wiz-102"]["parent_id"] is None
    assert rows["wiz-103"]["name"] == "X. foo ssp. bar" and rows["wiz-103"]["rank"] == "subspecies"
    assert rows["wiz-infra-10-3"]["name"] == "Cattleya labiata ssp. alba"
    assert rows["wiz-infra-10-3"]["parent_id"] == "wiz-100"
    assert rows["wiz-infra-10-2"]["rank"] == "variety" and rows["wiz-infra-10-2"]["infra_name"] == "x"
    assert rows["wiz-100"]["section"] == "Cattleya" and rows["wiz-100"]["subfamily"] == "Epidendroideae"


def test_downstream(spark):
    wfo, gbif, wiz = _build(spark)
    res = pipeline.run_pipeline(wfo, gbif, wiz)
    assert res.merged.count() == 16
    w7 = res.merged.where(F.col("id") == "wfo-0000000007").first()
    assert w7["name"] == "Cattleya" and w7["section"] == "Hadrolaelia"
    taxa = res.taxa.arrays().cache()
    assert taxa.count() == 9
    assert taxa.select(F.explode("external_ids")).count() == 14
    assert sorted(r["id"] for r in taxa.collect()) == list(range(1, 10))
    assert pipeline.rank_slice(taxa, ["genus"]).count() == 0
    assert pipeline.rank_slice(taxa, ["species", "subspecies", "variety", "form"]).count() == 9

    dedup = res.deduplicated.arrays().cache()
    assert dedup.count() == 8
    winner = dedup.where((F.col("specific_name") == "labiata") & (F.col("infra_name") == "alba")).collect()
    assert len(winner) == 1 and winner[0]["rank"] == "subspecies"
    assert winner[0]["external_ids"] == ["gbif-2", "gbif-3", "wfo-0000000008", "wiz-101", "wiz-infra-10-3"]

    filled = {r["name"]: r for r in res.filled.arrays().collect()}
    assert len(filled) == 8
    dr = filled["Drosera regia"]
    assert dr["generic_name"] == "Drosera" and dr["order"] == "Caryophyllales"
    assert dr["class"] == "Magnoliopsida" and dr["phylum"] == "Tracheophyta" and dr["kingdom"] == "Plantae"
    x = filled["X. foo ssp. bar"]
    assert x["subfamily"] == "Epidendroideae" and x["tribe"] is None
    g7 = filled[" x f. y"]
    assert g7["phylum"] == "Tracheophyta" and g7["class"] is None

    assert pipeline.crosswalk_literal(res.taxa.attrs, res.merged).count() == 0
    cw = {r["external_id"] for r in pipeline.crosswalk_ids(res.filled, "wfo-").collect()}
    assert cw == {"wfo-0000000001", "wfo-0000000004", "wfo-0000000008"}
    assert {r["source_id"] for r in pipeline.coverage(wfo, res.filled, "wfo-", "WFO").collect()} == {
        "wfo-0000000007", "wfo-0000000009"}
    assert {r["source_id"] for r in pipeline.coverage(gbif, res.filled, "gbif-", "GBIF").collect()} == {"gbif-6"}
    assert pipeline.coverage(wiz, res.filled, "wiz-", "OrchidWiz").count() == 0


def test_write_outputs(spark):
    import tempfile

    wfo, gbif, wiz = _build(spark)
    out = tempfile.mkdtemp(prefix="tw-out-")
    pipeline.write_outputs(spark, wfo.limit(0), gbif, wiz, out)
    paths = pipeline.write_outputs(spark, wfo, gbif, wiz, out, reference_arrays=True, id_segments=2)
    read = lambda name: Table(spark, paths[name]).read()
    assert Table(spark, paths["taxa_filled"]).read(1).count() < 8  # the state before, still there
    assert read("taxa_filled").count() == 8
    missing = {(r["source_id"], r["error_message"].split(" ")[0]) for r in read("missing_records").collect()}
    assert missing == {("wfo-0000000007", "WFO"), ("wfo-0000000009", "WFO"), ("gbif-6", "GBIF")}
    assert {r["external_id"] for r in read("crosswalk_wfo").collect()} == {
        "wfo-0000000001", "wfo-0000000004", "wfo-0000000008"}
    arrays = {r["name"]: r for r in read("taxa_filled_arrays").collect()}
    alba = arrays["Cattleya labiata ssp. alba"]
    assert alba["external_ids"] == ["gbif-2", "gbif-3", "wfo-0000000008", "wiz-101", "wiz-infra-10-3"]
    segments = read("taxa_id_segments").where(f"taxon_id = {alba['id']}").orderBy("segment").collect()
    assert [r["external_ids"] for r in segments] == [alba["external_ids"][:2], alba["external_ids"][2:4], alba["external_ids"][4:]]
    assert sorted(alba["data_sources"]) == ["GBIF", "OrchidWiz", "WFO"]
