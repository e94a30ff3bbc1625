"""Hand-written source rows (FIXTURES.md section 2) and builders."""

from __future__ import annotations

from taxaweave.schemas import string_schema

WFO_COLS = [
    "taxonid", "parentnameusageid", "acceptednameusageid", "originalnameusageid", "scientificname",
    "specificepithet", "infraspecificepithet", "family", "subfamily", "tribe", "subtribe", "genus",
    "subgenus", "taxonrank", "taxonomicstatus", "nomenclaturalstatus", "scientificnameid", "tplid", "created",
]
GBIF_COLS = [
    "taxonID", "parentNameUsageID", "acceptedNameUsageID", "originalNameUsageID", "taxonRank", "genericName",
    "specificEpithet", "infraspecificEpithet", "canonicalName", "scientificName", "kingdom", "phylum", "class",
    "order", "family", "genus", "taxonomicStatus", "nomenclaturalStatus",
]


def _row(cols, **kw):
    return tuple(kw.get(c) for c in cols)


def wfo_rows():
    base = dict(genus="Cattleya", family="Orchidaceae", specificepithet="labiata",
                scientificnameid="urn:lsid:ipni.org:names:30000959-2")
    dros = dict(genus="Drosera", family="Droseraceae", specificepithet="regia")
    return [
        _row(WFO_COLS, taxonid="wfo-0000000001", scientificname="Cattleya labiata", taxonrank="species", taxonomicstatus="Accepted", created="2020-01-01", **base),
        _row(WFO_COLS, taxonid="wfo-1000000002", scientificname="Cattleya labiata", taxonrank="species", taxonomicstatus="Accepted", created="2024-01-01", **base),
        _row(WFO_COLS, taxonid="wfo-0000000003", scientificname="Drosera regia", taxonrank="species", taxonomicstatus="Accepted", created="2021-01-01", **dros),
        _row(WFO_COLS, taxonid="wfo-0000000004", scientificname="Drosera regia", taxonrank="species", taxonomicstatus="Accepted", created=None, **dros),
        _row(WFO_COLS, taxonid="wfo-0000000005", scientificname="Drosera alba", taxonrank="species", taxonomicstatus="accepted", created="2021-01-01"),
        _row(WFO_COLS, taxonid="wfo-0000000006", scientificname="  ", taxonrank="species", taxonomicstatus="Accepted", created="2021-01-01"),
        _row(WFO_COLS, taxonid="wfo-0000000007", scientificname="Cattleya sect. Hadrolaelia", taxonrank="section", taxonomicstatus="Accepted", created="2021-01-01", genus="Cattleya"),
        _row(WFO_COLS, taxonid="wfo-0000000008", scientificname="Cattleya labiata subsp. alba", taxonrank="subspecies", taxonomicstatus="Accepted", created="2021-01-01",
             genus="Cattleya", family="Orchidaceae", specificepithet="labiata", infraspecificepithet="alba"),
        _row(WFO_COLS, taxonid="wfo-0000000009", scientificname="Aus bus", taxonrank="unranked", taxonomicstatus="Accepted", created="2021-01-01"),
    ]


def gbif_rows():
    cat = dict(kingdom="Plantae", phylum="Tracheophyta", **{"class": "Liliopsida", "order": "Asparagales"}, family="Orchidaceae", genus="Cattleya")
    return [
        _row(GBIF_COLS, taxonID="1", taxonRank="species", genericName="Cattleya", specificEpithet="labiata", canonicalName="Cattleya labiata", taxonomicStatus="accepted", **cat),
        _row(GBIF_COLS, taxonID="2", taxonRank="subspecies", genericName="Cattleya", specificEpithet="labiata", infraspecificEpithet="alba", taxonomicStatus="accepted", **cat),
        _row(GBIF_COLS, taxonID="3", taxonRank="variety", genericName="Cattleya", specificEpithet="labiata", infraspecificEpithet="alba", taxonomicStatus="accepted", **cat),
        _row(GBIF_COLS, taxonID="4", taxonRank="species", genericName="Felis", specificEpithet="catus", canonicalName="Felis catus", taxonomicStatus="accepted", kingdom="Animalia"),
        _row(GBIF_COLS, taxonID="5", taxonRank="species", genericName="Cattleya", specificEpithet="autumnalis", canonicalName="Cattleya autumnalis", taxonomicStatus="SYNONYM", **cat),
        _row(GBIF_COLS, taxonID="6", taxonRank="genus", genericName="Cattleya", canonicalName="Cattleya", taxonomicStatus="ACCEPTED", **cat),
        _row(GBIF_COLS, taxonID="7", taxonRank="form", specificEpithet="x", infraspecificEpithet="y", taxonomicStatus="accepted", kingdom="Plantae"),
        _row(GBIF_COLS, taxonID="8", taxonRank="species", genericName="Drosera", specificEpithet="capensis", canonicalName="Drosera capensis", taxonomicStatus="accepted",
             kingdom="Plantae", phylum="Tracheophyta", **{"class": "Magnoliopsida", "order": "Caryophyllales"}, family="Droseraceae", genus="Drosera"),
    ]


def wiz_frames(spark):
    sn = spark.createDataFrame(
        [("100", "10", "C.", "labiata"), ("101", "10", "C.", "labiata var. alba"),
         ("102", "10", "C.", "labiata v. rosea"), ("103", "11", "X.", "foo subsp. bar")],
        string_schema(["SpName", "Species", "Genus", "Name"]),
    )
    inf = spark.createDataFrame(
        [("10", "C.", "labiata ssp. alba"), ("10", "C.", "labiata nothovar. x")],
        string_schema(["Species", "Genus", "Name"]),
    )
    gen = spark.createDataFrame(
        [("C.", "Cattleya", "Epidendroideae", "Epidendreae", "Laeliinae")],
        string_schema(["Genus", "Name", "Subfamily", "Tribe", "Subtribe"]),
    )
    cl = spark.createDataFrame([("10", "Cattleya", "Cattleya")], string_schema(["Species", "Subgenus", "Section"]))
    return sn, inf, gen, cl


def raw_frames(spark):
    wfo = spark.createDataFrame(wfo_rows(), string_schema(WFO_COLS))
    gbif = spark.createDataFrame(gbif_rows(), string_schema(GBIF_COLS))
    return wfo, gbif, wiz_frames(spark)
