"""Ingest operators (A1-A19) run on the driver's tables.

Each query first writes a driver table out as delimited text into a fresh
folder below the shared checkpoint folder (a Spark job over the whole table),
then reads it back through the ingest operator under test. The oracle SQL
states what the read-back rows must be.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from taxaweave.plans.proxies import T as table
from taxaweave.plans.proxies import query
from taxaweave.session import scratch_path
from taxaweave.sources import ingest as I
from taxaweave.sources.tables import Table

c = F.col
_ABC = T.StructType([T.StructField(n, T.StringType(), True) for n in ("a", "b", "c")])

_PART_TEXT_SQL = (
    "SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, p_brand, p_type, CAST(p_size AS VARCHAR) AS p_size FROM part"
)


def _write_part_csv(spark: SparkSession, sf: str, sep: str = ",") -> str:
    path = scratch_path(spark, "part-csv")
    I.write_csv(table(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size"), path, sep=sep)
    return path


def _write_one(spark: SparkSession, df, path: str, sep: str = ",") -> None:
    """``df`` as one CSV file of that name (test-data setup)."""
    I.write_csv(df.coalesce(1), f"{path}.parts", sep=sep)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    parts = hadoop.Path(f"{path}.parts")
    fs = parts.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    own = next(st.getPath() for st in fs.listStatus(parts) if st.getPath().getName().startswith("part-"))
    fs.rename(own, hadoop.Path(path))
    fs.delete(parts, True)


def _rename_suffix(spark: SparkSession, folder: str, old: str, new: str) -> None:
    """Rename the written part files' suffix (test-data setup; metadata only)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(folder)
    fs = p.getFileSystem(conf)
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if name.endswith(old):
            fs.rename(st.getPath(), jvm.org.apache.hadoop.fs.Path(folder + "/" + name[: -len(old)] + new))


@query("scan_csv_text", _PART_TEXT_SQL)
def q_scan_csv(spark, sf):
    return I.read_delimited(spark, _write_part_csv(spark, sf))


@query("write_csv_header", "SELECT CAST(doc_id AS VARCHAR) AS doc_id, '  ' || text || ' \t' AS text, lang FROM documents")
def q_write_csv_header(spark, sf):
    path = scratch_path(spark, "docs-csv")
    padded = F.concat(F.lit("  "), "text", F.lit(" \t"))
    I.write_csv(table(spark, sf, "documents").select("doc_id", padded.alias("text"), "lang"), path)
    return I.read_delimited(spark, path, multiline=True)


@query(
    "scan_recursive_files",
    "SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, 'csv' AS suffix FROM customer "
    "UNION ALL SELECT CAST(n_nationkey AS VARCHAR), n_name, 'tsv' FROM nation",
)
def q_scan_recursive(spark, sf):
    root = scratch_path(spark, "tree")
    I.write_csv(table(spark, sf, "customer").select("c_custkey", "c_name"), f"{root}/a/Customer-Data")
    I.write_csv(table(spark, sf, "nation").select("n_nationkey", "n_name"), f"{root}/b/c/Nation List", sep="\t")
    _rename_suffix(spark, f"{root}/b/c/Nation List", ".csv", ".TSV")
    table(spark, sf, "region").write.mode("overwrite").json(f"{root}/junk")  # not delimited: must be ignored
    df = I.read_delimited(spark, root, with_path=True)
    return df.select(
        F.coalesce(c("c_custkey"), c("n_nationkey")).alias("id"),
        F.coalesce(c("c_name"), c("n_name")).alias("name"),
        F.lower(F.regexp_extract(c("source_file"), r"\.([^.]+)$", 1)).alias("suffix"),
    )


@query(
    "source_key_naming",
    "SELECT 'my_source_customer_data' AS source_key, count(*) AS n_rows FROM customer UNION ALL SELECT 'my_source_nation_list', count(*) FROM nation "
    "UNION ALL SELECT 'alone', count(*) FROM region",
)
def q_source_key(spark, sf):
    root = scratch_path(spark, "keys")
    for name, to in (("customer", "many/Customer-Data.csv"), ("nation", "many/Nation List.csv"), ("region", "one/Region.csv")):
        _write_one(spark, table(spark, sf, name), f"{root}/{to}")
    tables = I.read_sources(spark, "My-Source", f"{root}/many") | I.read_sources(spark, "Alone", f"{root}/one")
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(k).alias("source_key"), "n_rows") for k, df in tables.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "columns_by_header",
    "SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey, n_name, CASE WHEN n_nationkey % 3 = 2 THEN NULL ELSE CAST(n_regionkey AS VARCHAR) END AS n_regionkey FROM nation",
)
def q_columns_by_header(spark, sf):
    """Files with swapped and with missing columns, one of them tab-separated."""
    root = scratch_path(spark, "headers")
    n = table(spark, sf, "nation")
    part = lambda k: n.where(c("n_nationkey") % 3 == k)
    _write_one(spark, part(0).select("n_nationkey", "n_name", "n_regionkey"), f"{root}/a.csv")
    _write_one(spark, part(1).select("n_regionkey", "n_name", "n_nationkey"), f"{root}/sub/b.TSV", sep="\t")
    _write_one(spark, part(2).select("n_name", "n_nationkey"), f"{root}/c.csv")
    return I.read_delimited(spark, root).select("n_nationkey", "n_name", "n_regionkey")


@query("delimiter_by_suffix", "SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey, n_name, CAST(n_regionkey AS VARCHAR) AS n_regionkey FROM nation")
def q_delimiter(spark, sf):
    path = scratch_path(spark, "nation-tsv")
    I.write_csv(table(spark, sf, "nation"), path, sep="\t")
    _rename_suffix(spark, path, ".csv", ".tsv")
    return I.read_delimited(spark, path)


_NOTED_NAME_SQL = "CASE WHEN p_partkey % 4 = 0 THEN p_name || ', or; so' WHEN p_partkey % 4 = 1 THEN 'say \"it\"' ELSE p_name END"


@query("delimiter_from_lines", f"SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, {_NOTED_NAME_SQL} AS p_name, p_brand FROM part")
def q_delimiter_from_lines(spark, sf):
    """Delimiters that differ from the suffix's: tabs in a .txt, semicolons in a
    .csv, commas (some quoted) in a .tsv."""
    root = scratch_path(spark, "delimiters")
    noted = F.when(c("p_partkey") % 4 == 0, F.concat("p_name", F.lit(", or; so"))).when(c("p_partkey") % 4 == 1, F.lit('say "it"')).otherwise(c("p_name"))
    p = table(spark, sf, "part").select("p_partkey", noted.alias("p_name"), "p_brand", "p_size")
    for k, (name, sep) in enumerate((("tabs.txt", "\t"), ("semicolons.csv", ";"), ("commas.tsv", ","))):
        _write_one(spark, p.where(c("p_size") % 3 == k).drop("p_size"), f"{root}/{name}", sep=sep)
    return I.read_delimited(spark, root)


@query("decode_with_fallback", "SELECT CAST(doc_id AS VARCHAR) AS doc_id, text FROM documents")
def q_decode(spark, sf):
    root = scratch_path(spark, "encodings")
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    encodings = {"fr": "ISO-8859-1", "es": "UTF-16"}
    paths = []
    for lang, encoding in {None: None, **encodings}.items():
        own = docs.where(c("lang") == lang if lang else ~c("lang").isin(*encodings))
        # files of one encoding with swapped and with missing columns
        for k, columns in enumerate((["doc_id", "text"], ["lang", "text", "doc_id"])):
            paths.append(f"{root}/{lang or 'utf8'}{k}")
            I.write_csv(own.where(F.pmod(F.coalesce("doc_id", F.lit(0)), F.lit(2)) == k).select(columns), paths[-1], encoding=encoding)
    return I.read_with_fallback(spark, paths).select("doc_id", "text")


_ENCODED = ("UTF-8", "ISO-8859-1", I.WINDOWS, "UTF-16", "UTF-16LE", "UTF-16BE")
_ENCODED_NAME_SQL = (
    "CASE c_custkey % 6 WHEN 0 THEN 'é„日本”' WHEN 1 THEN 'é¿' WHEN 2 THEN '„Œuvre” €' WHEN 3 THEN 'é日' WHEN 4 THEN 'ÿ' ELSE 'Ж' END || c_name"
)


def _encoded_customers(spark, sf) -> tuple[str, list[str]]:
    """A file set per encoding, with characters that only it has."""
    root = scratch_path(spark, "encodings")
    cu = table(spark, sf, "customer").withColumn("name", F.expr(_ENCODED_NAME_SQL))
    paths = []
    for k, encoding in enumerate(_ENCODED):
        own = cu.where(c("c_custkey") % 6 == k).select(c("c_custkey").cast("string").alias("id"), "name")
        if encoding == I.WINDOWS:  # its bytes by way of Latin-1, as the writer knows no code pages
            own = own.withColumn("name", F.translate("name", I._C1_AS_WINDOWS, I._C1_AS_LATIN))
        paths.append(f"{root}/{k}")
        I.write_csv(own, paths[-1], encoding="ISO-8859-1" if encoding == I.WINDOWS else encoding)
    return root, paths


@query("encodings_by_bytes", f"SELECT CAST(c_custkey AS VARCHAR) AS id, {_ENCODED_NAME_SQL} AS name FROM customer")
def q_encodings(spark, sf):
    """UTF-8, Latin-1, windows-1252, and UTF-16 with a mark and without in both byte orders."""
    return I.read_with_fallback(spark, _encoded_customers(spark, sf)[1])


@query("encoded_lines", f"SELECT CAST(c_custkey AS VARCHAR) || ',' || {_ENCODED_NAME_SQL} AS value FROM customer")
def q_encoded_lines(spark, sf):
    lines = I.decode_lines(spark, _encoded_customers(spark, sf)[1])
    return lines.where("value <> 'id,name'").select("value")


def _lines_to_repair(spark, sf) -> str:
    """Lines that are malformed by characters before a quote, and short ones."""
    path = scratch_path(spark, "to-repair")
    quoted = F.concat(F.lit('"'), "p_name", F.lit(', quoted",'), "p_brand", F.lit(","), c("p_partkey").cast("string"))
    line = (
        F.when(c("p_size") % 11 == 0, F.concat("p_brand", F.lit(","), c("p_partkey").cast("string")))
        .when(c("p_size") % 5 == 0, F.concat(F.lit("\u0000"), quoted))
        .when(c("p_size") % 7 == 0, F.concat(F.lit(" \t"), quoted, F.lit("\u0000  ")))
        .otherwise(quoted)
    )
    table(spark, sf, "part").select(line.alias("value")).write.text(path)
    return path


@query("repair_and_reread", "SELECT p_name || ', quoted' AS a, p_brand AS b, CAST(p_partkey AS VARCHAR) AS c FROM part WHERE p_size % 11 <> 0")
def q_repair_reread(spark, sf):
    """Rescued rows equal the clean ones."""
    df = I.read_delimited(spark, _lines_to_repair(spark, sf), sep=",", header=False, schema=_ABC, repair=True)
    return I.split_quarantine(df)[0]


@query("repair_still_malformed", "SELECT p_brand || ',' || CAST(p_partkey AS VARCHAR) AS raw_line FROM part WHERE p_size % 11 = 0")
def q_repair_failed(spark, sf):
    df = I.read_delimited(spark, _lines_to_repair(spark, sf), sep=",", header=False, schema=_ABC, repair=True)
    return I.split_quarantine(df)[1]


_LINES_SQL = (
    "SELECT v AS value FROM (SELECT regexp_replace(regexp_replace(line, '^[ \\t\\r\\n\\f\\x0B]+', ''), '[ \\t\\r\\n\\f\\x0B]+$', '') AS v "
    "FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents) a) b WHERE length(v) > 0"
)


@query("repair_lines", _LINES_SQL)
def q_repair(spark, sf):
    path = scratch_path(spark, "dirty-lines")
    lines = table(spark, sf, "documents").select(F.explode(F.split("text", "\n")).alias("line"))
    dirty = F.concat(F.lit("\t\u0000"), F.regexp_replace("line", " ", "\u0000 "), F.lit("  \r"))
    lines.select(dirty.alias("value")).write.mode("overwrite").text(path)
    repaired = I.repair_lines(spark.read.text(path))
    return repaired.select("value")


def _malformed_lines(spark, sf) -> str:
    path = scratch_path(spark, "malformed")
    p = table(spark, sf, "part")
    line = (
        F.when(c("p_size") % 9 == 0, F.concat_ws(",", c("p_partkey").cast("string"), "p_name", "p_brand", F.lit("extra")))
        .when(c("p_size") % 11 == 0, F.concat_ws(",", c("p_partkey").cast("string"), "p_name"))
        .otherwise(F.concat_ws(",", c("p_partkey").cast("string"), "p_name", "p_brand"))
    )
    p.select(line.alias("value")).write.mode("overwrite").text(path)
    return path


@query(
    "drop_malformed",
    "SELECT CAST(p_partkey AS VARCHAR) AS a, p_name AS b, p_brand AS c FROM part WHERE p_size % 9 <> 0 AND p_size % 11 <> 0",
)
def q_drop_malformed(spark, sf):
    df = I.read_delimited(spark, _malformed_lines(spark, sf), sep=",", header=False, schema=_ABC, keep_corrupt=True)
    good, _bad = I.split_quarantine(df)
    return good


@query(
    "quarantine_malformed",
    "SELECT CASE WHEN p_size % 9 = 0 THEN concat_ws(',', CAST(p_partkey AS VARCHAR), p_name, p_brand, 'extra') "
    "ELSE concat_ws(',', CAST(p_partkey AS VARCHAR), p_name) END AS raw_line FROM part WHERE p_size % 9 = 0 OR p_size % 11 = 0",
)
def q_quarantine(spark, sf):
    df = I.read_delimited(spark, _malformed_lines(spark, sf), sep=",", header=False, schema=_ABC, keep_corrupt=True)
    _good, bad = I.split_quarantine(df)
    return bad


@query(
    "null_padding_read",
    "SELECT CAST(p_partkey AS VARCHAR) AS a, p_name AS b, CASE WHEN p_size % 9 <> 0 AND p_size % 11 = 0 THEN NULL ELSE p_brand END AS c FROM part",
)
def q_null_padding(spark, sf):
    return I.read_delimited(spark, _malformed_lines(spark, sf), sep=",", header=False, schema=_ABC)


@query("ingest_filter", _PART_TEXT_SQL + " WHERE p_type = 'SMALL'")
def q_ingest_filter(spark, sf):
    return I.apply_filter(I.read_delimited(spark, _write_part_csv(spark, sf)), "P_TYPE = 'SMALL'")


@query(
    "ingest_metrics",
    "SELECT count(*) AS original_rows, count(*) FILTER (WHERE p_type = 'SMALL') AS kept_rows, "
    "CAST(count(*) FILTER (WHERE p_type = 'SMALL') AS DOUBLE) * 100 / CAST(count(*) AS DOUBLE) AS kept_pct FROM part",
)
def q_ingest_metrics(spark, sf):
    return I.metrics_frame(I.read_delimited(spark, _write_part_csv(spark, sf)), "p_type = 'SMALL'")


@query("write_raw_overwrite", "SELECT count(*) AS written, count(*) AS found FROM part")
def q_write_raw(spark, sf):
    path = scratch_path(spark, "raw-part")
    written, found = I.write_and_count(table(spark, sf, "part"), path)
    return spark.createDataFrame([(written, found)], "written long, found long")


@query("post_load_count", "SELECT count(*) AS n_rows FROM part")
def q_post_load(spark, sf):
    path = scratch_path(spark, "raw-part")
    return I.write_raw(table(spark, sf, "part"), path).agg(F.count(F.lit(1)).alias("n_rows"))


@query("write_raw_append", _PART_TEXT_SQL)
def q_write_append(spark, sf):
    path = scratch_path(spark, "raw-append")
    p = table(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    I.write_raw(p.where(c("p_size") <= 25), path, mode="overwrite")
    return I.write_raw(p.where(c("p_size") > 25), path, mode="append")


def _family_tree(spark, sf) -> str:
    """``<Family>_wfo-<digits>/classification.csv`` per brand: folder names with
    blanks and plus signs, swapped columns, a file that lacks one, and a folder
    of another name."""
    root = scratch_path(spark, "families")
    p = table(spark, sf, "part").select("p_partkey", "p_name", "p_brand")
    brands = sorted(r["p_brand"] for r in p.select("p_brand").distinct().collect())  # a folder each
    for k, brand in enumerate(brands):
        own = p.where(c("p_brand") == brand)
        own = own.select("p_partkey") if brand == "Brand#1" else own.select(*(["p_partkey", "p_name"] if k % 2 else ["p_name", "p_partkey"]))
        folder = f"{brand.replace('#', ' + ')}_wfo-{brand.split('#')[1].zfill(10)}"
        _write_one(spark, own, f"{root}/{folder}/classification.csv")
    _write_one(spark, p.select("p_partkey"), f"{root}/junk/classification.csv")
    return root


@query(
    "union_family_folders",
    "SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, CASE WHEN p_brand = 'Brand#1' THEN NULL ELSE p_name END AS p_name, "
    "replace(p_brand, '#', ' + ') AS family_name, "
    "lpad(regexp_extract(p_brand, '([0-9]+)', 1), 10, '0') AS wfo_id FROM part",
)
def q_family_folders(spark, sf):
    return I.read_family_folders(spark, _family_tree(spark, sf))


@query("sanitize_headers", "SELECT CAST(p_partkey AS VARCHAR) AS part_key, p_name AS part_name_full, p_brand AS brandid FROM part")
def q_sanitize(spark, sf):
    path = scratch_path(spark, "messy-headers")
    messy = table(spark, sf, "part").select(c("p_partkey").alias("Part Key"), c("p_name").alias("Part Name (full)"), c("p_brand").alias("Brand-ID"))
    I.write_csv(messy, path)
    return I.sanitize_headers(I.read_delimited(spark, path))


@query("source_registry", _PART_TEXT_SQL + " WHERE CAST(p_size AS INTEGER) > 40")
def q_registry(spark, sf):
    reg = I.SourceRegistry([I.Source("part_text", _write_part_csv(spark, sf), "parts as text", filter="CAST(p_size AS INT) > 40")])
    return reg.read(spark, "part_text")


@query("materialize_table", "SELECT p_partkey, p_name FROM part")
def q_materialize(spark, sf):
    return I.materialize(table(spark, sf, "part").select("p_partkey", "p_name"), scratch_path(spark, "model"))


@query(
    "refresh_from_itself",
    "SELECT p_partkey, upper(p_name) AS p_name, p_size * 2 AS p_size FROM part UNION ALL SELECT o_orderkey, o_orderpriority, NULL FROM orders",
)
def q_refresh_from_itself(spark, sf):
    """A table refreshed from its own rows, then appended to by rows that lack a column."""
    path = scratch_path(spark, "model")
    own = I.materialize(table(spark, sf, "part").select("p_partkey", "p_name", "p_size"), path)
    I.materialize(own.select("p_partkey", F.upper("p_name").alias("p_name"), (c("p_size") * 2).alias("p_size")), path)
    more = table(spark, sf, "orders").select(c("o_orderpriority").alias("p_name"), c("o_orderkey").alias("p_partkey"))
    t = Table(spark, path)
    t.append(more, key="orders")
    t.append(more, key="orders")  # committed already: adds nothing
    return t.read()


@query("decode_lines", "SELECT CAST(c_custkey AS VARCHAR) || ';é' || c_name AS value FROM customer")
def q_decode_lines(spark, sf):
    root = scratch_path(spark, "latin-lines")
    cu = table(spark, sf, "customer")
    line = F.concat(c("c_custkey").cast("string"), F.lit(";é"), "c_name").alias("value")
    I.write_csv(cu.where("c_custkey % 2 = 0").select(line), f"{root}/latin1", header=False, encoding="ISO-8859-1")
    cu.where("c_custkey % 2 = 1").select(line).write.text(f"{root}/utf8")
    return I.decode_lines(spark, [f"{root}/latin1", f"{root}/utf8"]).select("value")


@query(
    "path_derived_columns",
    "SELECT DISTINCT replace(p_brand, '#', ' + ') AS family_name, lpad(regexp_extract(p_brand, '([0-9]+)', 1), 10, '0') AS wfo_id FROM part",
)
def q_path_columns(spark, sf):
    return I.read_family_folders(spark, _family_tree(spark, sf)).select("family_name", "wfo_id").distinct()
