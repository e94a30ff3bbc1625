"""Raw taxonomy-source tables derived by Spark from the star-schema tables.

The harmonisation pipeline needs three raw sources shaped like the WFO, GBIF
and OrchidWiz exports (all-text columns). For tests and benchmarks they are
computed from ``lineitem`` and ``part`` with plain column expressions, so their
size grows with the input: WFO-like and GBIF-like rows are one per line item,
OrchidWiz-like rows one per part. Names come from a digit-to-letter rule over
the keys, so the same name space appears in several sources and the merge,
dedupe and fill steps have real overlaps to resolve.

Every rule here is mirrored in the oracle SQL (``plans/oracle.py``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from taxaweave.functions.names import computed_once

DIGIT_LETTERS = "aeioulmnrs"  # rule: digit d -> DIGIT_LETTERS[d]


def word(k: Column) -> Column:
    """Lower-case pseudo-word spelled from the decimal digits of ``k``."""
    return F.translate(k.cast("string"), "0123456789", DIGIT_LETTERS)


def word_of_remainder(k: Column, m: int, suffix: str = "", capital: bool = True) -> Column:
    """``cap_word(k % m)`` (or ``word``) and a suffix, looked up in a literal table of the
    remainders -m+1 to m-1: ``translate`` looks up every digit as a string of its own."""
    spell = str.maketrans("0123456789", DIGIT_LETTERS)
    words = [str(r).translate(spell) for r in range(1 - m, m)]
    table = F.array(*[F.lit((w.capitalize() if capital else w) + suffix) for w in words])
    return F.get(table, (k % m).cast("int") + (m - 1))


def cap(w: Column) -> Column:
    """First letter upper-cased, the rest unchanged."""
    return F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 1 << 30))


def cap_word(k: Column) -> Column:
    """``cap(word(k))``, each digit spelled once."""
    digits = k.cast("string")
    first = F.translate(F.substring(digits, 1, 1), "0123456789", DIGIT_LETTERS.upper())
    return F.concat(first, F.translate(F.substring(digits, 2, 1 << 30), "0123456789", DIGIT_LETTERS))


def _rank_of(n: Column) -> Column:
    return (
        F.when(n == 1, "species").when(n == 2, "subspecies").when(n == 3, "variety")
        .when(n == 4, "form").when(n == 5, "genus").when(n == 6, "species").otherwise("unranked")
    )


def _marker(rank: Column) -> Column:
    return F.when(rank == "subspecies", " subsp. ").when(rank == "variety", " var. ").when(rank == "form", " f. ")


def _lineitem_base(lineitem: DataFrame) -> DataFrame:
    c = F.col
    base = lineitem.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus", "l_shipdate",
        _rank_of(c("l_linenumber")).alias("r"),
    )
    return computed_once(base, g=cap_word(c("l_partkey")), e=word(c("l_suppkey")), i=word_of_remainder(c("l_orderkey"), 97, capital=False))


def gbif_raw(lineitem: DataFrame) -> DataFrame:
    """GBIF-shaped rows: one per line item."""
    c = F.col
    b = _lineitem_base(lineitem)
    infra = F.when(c("r").isin("subspecies", "variety", "form"), F.concat(c("i"), F.lit("a")))
    specific = F.when(c("r") != "genus", F.concat(c("e"), F.lit("us")))
    canonical = F.when(c("l_suppkey") % 5 != 0, F.concat_ws(" ", c("g"), specific))
    return b.select(
        F.concat_ws("-", *[c(k).cast("string") for k in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]).alias("taxonID"),
        F.when(c("r") != "genus", c("l_partkey").cast("string")).alias("parentNameUsageID"),
        F.when(c("l_returnflag") == "R", c("l_suppkey").cast("string")).alias("acceptedNameUsageID"),
        F.when(c("l_linestatus") == "F", c("l_orderkey").cast("string")).alias("originalNameUsageID"),
        c("r").alias("taxonRank"),
        F.when(c("l_partkey") % 17 != 0, c("g")).alias("genericName"),
        specific.alias("specificEpithet"),
        infra.alias("infraspecificEpithet"),
        canonical.alias("canonicalName"),
        F.concat(F.concat_ws(" ", c("g"), specific), F.lit(" L.")).alias("scientificName"),
        F.when((c("l_returnflag") == "N") & (c("l_linestatus") == "O") & (c("l_tax") > 0.06), "Animalia").otherwise("Plantae").alias("kingdom"),
        F.when(c("l_partkey") % 11 != 0, "Tracheophyta").alias("phylum"),
        F.when(c("l_partkey") % 3 == 0, "Liliopsida").when(c("l_partkey") % 3 == 1, "Magnoliopsida").alias("class"),
        F.when(c("l_partkey") % 7 != 0, word_of_remainder(c("l_partkey"), 29, "ales")).alias("order"),
        F.when(c("l_partkey") % 13 != 0, word_of_remainder(c("l_partkey"), 211, "aceae")).alias("family"),
        c("g").alias("genus"),
        F.when(c("l_discount") > 0.08, "SYNONYM").when(c("l_discount") < 0.02, "ACCEPTED").otherwise("accepted").alias("taxonomicStatus"),
        F.when(c("l_tax") > 0.05, "Legitimate").alias("nomenclaturalStatus"),
    )


def wfo_raw(lineitem: DataFrame) -> DataFrame:
    """WFO-shaped rows: one per line item, several ids per scientific name."""
    c = F.col
    b = _lineitem_base(lineitem)
    r = F.when(c("l_linenumber") == 7, "section").otherwise(c("r"))
    infra = F.when(r.isin("subspecies", "variety", "form"), F.concat(c("i"), F.lit("a")))
    specific = F.when(~r.isin("genus", "section"), F.concat(c("e"), F.lit("us")))
    name = (
        F.when(r == "section", F.concat(c("g"), F.lit(" sect. "), cap(c("e"))))
        .when(r == "genus", c("g"))
        .otherwise(F.concat(c("g"), F.lit(" "), specific, F.coalesce(F.concat(_marker(r), infra), F.lit(""))))
    )
    name = F.when((c("l_orderkey") % 101) == 0, F.lit("  ")).otherwise(name)
    b = computed_once(b, name=name)
    return b.select(
        F.concat(
            F.lit("wfo-"),
            F.when(c("l_suppkey") % 3 == 0, F.lit("1000")).otherwise(F.lit("0000")),
            F.lpad(c("l_orderkey").cast("string"), 8, "0"),
            F.lit("-"),
            c("l_linenumber").cast("string"),
        ).alias("taxonid"),
        F.when(r != "genus", F.concat(F.lit("wfo-p"), c("l_partkey").cast("string"))).alias("parentnameusageid"),
        F.lit(None).cast("string").alias("acceptednameusageid"),
        F.when(c("l_returnflag") == "A", F.concat(F.lit("wfo-o"), c("l_orderkey").cast("string"))).alias("originalnameusageid"),
        c("name").alias("scientificname"),
        specific.alias("specificepithet"),
        infra.alias("infraspecificepithet"),
        F.when(c("l_partkey") % 13 != 0, word_of_remainder(c("l_partkey"), 211, "aceae")).alias("family"),
        F.when(c("l_partkey") % 4 != 0, word_of_remainder(c("l_partkey"), 53, "oideae")).alias("subfamily"),
        F.when(c("l_partkey") % 6 != 0, word_of_remainder(c("l_partkey"), 41, "eae")).alias("tribe"),
        F.when(c("l_partkey") % 5 != 0, word_of_remainder(c("l_partkey"), 37, "inae")).alias("subtribe"),
        c("g").alias("genus"),
        F.when(c("l_suppkey") % 9 == 0, cap(c("e"))).alias("subgenus"),
        r.alias("taxonrank"),
        F.when(c("l_returnflag") == "R", "Synonym").when(c("l_returnflag") == "N", "Accepted").otherwise(
            F.when(c("l_linestatus") == "F", "Accepted").otherwise("accepted")
        ).alias("taxonomicstatus"),
        F.when(c("l_tax") > 0.06, "Illegitimate").when(c("l_tax") > 0.03, "legitimate").alias("nomenclaturalstatus"),
        F.when(c("l_suppkey") % 2 == 0, F.concat(F.lit("urn:lsid:ipni.org:names:"), c("l_partkey").cast("string"), F.lit("-1")))
        .otherwise(F.concat(F.lit("ipni-"), c("l_partkey").cast("string"))).alias("scientificnameid"),
        F.when(c("l_partkey") % 8 == 0, F.concat(F.lit("kew-"), c("l_partkey").cast("string"))).alias("tplid"),
        F.when(c("l_partkey") % 10 != 0, F.date_format("l_shipdate", "yyyy-MM-dd")).alias("created"),
    )


def _part_base(part: DataFrame) -> DataFrame:
    c = F.col
    sp = F.floor(c("p_partkey") / 3).cast("long")
    base = part.select("p_partkey", "p_size", "p_type", "p_brand", sp.alias("sp"))
    return computed_once(
        base,
        gname=cap_word(c("sp")),
        gabbr=F.concat(F.upper(F.substring(word(c("sp")), 1, 2)), F.lit(".")),
        ep=F.concat(word(c("p_size")), F.lit("ea")),
    )


def wiz_species_names(part: DataFrame) -> DataFrame:
    """OrchidWiz SpeciesNames-shaped rows: one per part."""
    c = F.col
    b = _part_base(part)
    tail = (
        F.when(c("p_type") == "SMALL", F.lit(""))
        .when(c("p_type") == "MEDIUM", F.concat(F.lit(" var. "), word_of_remainder(c("p_partkey"), 13, capital=False)))
        .when(c("p_type") == "LARGE", F.concat(F.lit(" subsp. "), word_of_remainder(c("p_partkey"), 13, capital=False)))
        .when(c("p_type") == "PROMO", F.concat(F.lit(" v. "), word_of_remainder(c("p_partkey"), 13, capital=False)))
        .when(c("p_type") == "ECONOMY", F.concat(F.lit(" h.f. "), word_of_remainder(c("p_partkey"), 13, capital=False)))
        .otherwise(F.lit(" sp. "))
    )
    return computed_once(b, Name=F.concat(c("ep"), tail)).select(
        F.when(c("p_partkey") % 19 != 0, c("p_partkey").cast("string")).alias("SpName"),
        c("sp").cast("string").alias("Species"),
        F.when(c("p_partkey") % 23 != 0, c("gabbr")).alias("Genus"),
        "Name",
    )


def wiz_infras(part: DataFrame) -> DataFrame:
    """OrchidWiz Infras-shaped rows: one per part."""
    c = F.col
    b = _part_base(part)
    marker = (
        F.when(c("p_size") % 4 == 0, " ssp. ").when(c("p_size") % 4 == 1, " var. ")
        .when(c("p_size") % 4 == 2, " nothovar. ").otherwise(" forma ")
    )
    return computed_once(b, Name=F.concat(c("ep"), marker, word_of_remainder(c("p_partkey"), 7, "i", capital=False))).select(
        c("sp").cast("string").alias("Species"),
        c("gabbr").alias("Genus"),
        "Name",
    )


def wiz_genera(part: DataFrame) -> DataFrame:
    """OrchidWiz Genera-shaped rows: one per genus abbreviation (aggregated)."""
    c = F.col
    b = computed_once(
        _part_base(part),
        subfamily=word_of_remainder(c("sp"), 5, "oideae"),
        tribe=F.when(c("sp") % 3 != 0, word_of_remainder(c("sp"), 11, "eae")),
        subtribe=word_of_remainder(c("sp"), 17, "inae"),
    )
    return b.groupBy(c("gabbr").alias("Genus")).agg(
        F.min("gname").alias("Name"),
        F.max("subfamily").alias("Subfamily"),
        F.max("tribe").alias("Tribe"),
        F.max("subtribe").alias("Subtribe"),
    )


def wiz_classifications(part: DataFrame) -> DataFrame:
    """OrchidWiz Classifications-shaped rows: one per species id (aggregated)."""
    c = F.col
    b = computed_once(
        _part_base(part),
        subgenus=F.when(c("p_brand") != "Brand#1", word_of_remainder(c("sp"), 31, "ia")),
        section=word_of_remainder(c("sp"), 43, "ae"),
    )
    return b.groupBy(c("sp").cast("string").alias("Species")).agg(
        F.max("subgenus").alias("Subgenus"),
        F.min("section").alias("Section"),
    )


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    li = load(spark, sf_dir, "lineitem")
    part = load(spark, sf_dir, "part")
    return {
        "wfo": wfo_raw(li),
        "gbif": gbif_raw(li),
        "wiz_species_names": wiz_species_names(part),
        "wiz_infras": wiz_infras(part),
        "wiz_genera": wiz_genera(part),
        "wiz_classifications": wiz_classifications(part),
    }
