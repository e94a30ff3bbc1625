"""Incremental raw-table loading with Structured Streaming (A12, re-aimed).

The chunked "first chunk creates the table, later chunks append, commit per
chunk" loader becomes a file-source stream: every run picks up the files that
arrived since the last run (``trigger(availableNow=True)``). The stream carries
file names only; each micro-batch is one load of its files
(:func:`taxaweave.sources.loads.load_files`): read in groups of one header line,
columns by name, good and malformed rows written in one pass, a ledger row per
file. The load's key is the stream's and the batch's number, so a batch that is
retried, before or after its commit, adds no row twice.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from taxaweave.plans.proxies import T as table
from taxaweave.plans.proxies import query
from taxaweave.session import scratch_path
from taxaweave.sources import ingest as I
from taxaweave.sources import loads as L
from taxaweave.sources.tables import read_text

#: What the binary-file source gives; contents are never read.
_FILES = "path string, modificationTime timestamp, length long, content binary"


def load_increment(
    spark: SparkSession,
    source_dir: str,
    target: str,
    checkpoint: str,
    sep: str | None = None,
    header: bool = True,
    schema: T.StructType | None = None,
    condition: str | None = None,
    max_files_per_trigger: int | None = None,
) -> int:
    """Appends every not-yet-loaded file under ``source_dir`` (folders below it
    included) to the table at ``target``; returns the number of micro-batches
    run. Safe to re-run. Without a ``schema`` columns go by each file's header
    line; a column new to the table is added, one that a file lacks is NULL."""
    reader = spark.readStream.format("binaryFile").schema(_FILES).option("recursiveFileLookup", "true").option("pathGlobFilter", I._glob_for(I.DELIMITED_SUFFIXES))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    run: list[int] = []

    def load(files: DataFrame, batch: int) -> None:
        run.append(batch)
        paths = [r["path"] for r in files.collect()]  # the names of a micro-batch's files
        if paths:
            stream = json.loads(read_text(spark, f"{checkpoint}/metadata"))["id"]
            L.load_files(spark, paths, target, f"{stream}-{batch}", sep, header, schema, condition)

    q = reader.load(source_dir).select("path").writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return len(run)


_PART = ("p_partkey", "p_name", "p_brand", "p_type", "p_size")
_PART_SCHEMA = T.StructType([T.StructField(n, T.StringType(), True) for n in _PART])


# names with doubled quotes and blanks at the ends, which a load must keep
_QUOTED_SQL = "CASE WHEN p_partkey % 3 = 0 THEN '  he said \"\"hi\"\", ' || p_name || ' ' ELSE p_name END"


@query(
    "incremental_ingest",
    f"SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, {_QUOTED_SQL} AS p_name, p_brand, p_type, CAST(p_size AS VARCHAR) AS p_size FROM part",
)
def q_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """Two arrivals of part files, three availableNow runs, one raw table."""
    root = scratch_path(spark, "incremental")
    quoted = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit('  he said ""hi"", '), F.col("p_name"), F.lit(" "))).otherwise(F.col("p_name"))
    p = table(spark, sf, "part").select("p_partkey", quoted.alias("p_name"), "p_brand", "p_type", "p_size")
    I.write_csv(p.where(F.col("p_size") <= 25), f"{root}/in/batch1")
    load_increment(spark, f"{root}/in", f"{root}/raw", f"{root}/ckpt")
    I.write_csv(p.where(F.col("p_size") > 25), f"{root}/in/batch2")
    load_increment(spark, f"{root}/in", f"{root}/raw", f"{root}/ckpt")
    load_increment(spark, f"{root}/in", f"{root}/raw", f"{root}/ckpt")  # no new files: no-op
    return L.kept_rows(spark, f"{root}/raw").select(*_PART)


@query(
    "incremental_by_header",
    "SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, CASE WHEN p_size % 3 = 1 THEN NULL ELSE p_name END AS p_name, p_brand, "
    "CASE WHEN p_size % 3 = 2 THEN p_type END AS p_type FROM part",
)
def q_incremental_by_header(spark: SparkSession, sf: str) -> DataFrame:
    """Three runs over files with swapped, missing and additional columns."""
    root = scratch_path(spark, "incremental")
    p = table(spark, sf, "part")
    headers = (["p_partkey", "p_name", "p_brand"], ["p_brand", "p_partkey"], ["p_type", "p_brand", "p_name", "p_partkey"])
    for k, columns in enumerate(headers):
        I.write_csv(p.where(F.col("p_size") % 3 == k).select(*columns), f"{root}/in/{k}")
        load_increment(spark, f"{root}/in", f"{root}/raw", f"{root}/ckpt")
    return L.kept_rows(spark, f"{root}/raw")


_LEDGER_LINES = "p_size % 9 = 0"


def _with_short_rows(spark: SparkSession, sf: str, root: str) -> DataFrame:
    whole = F.concat_ws(",", F.col("p_partkey").cast("string"), "p_name", "p_brand", "p_type", F.col("p_size").cast("string"))
    short = F.concat_ws(",", F.col("p_partkey").cast("string"), "p_name")
    return table(spark, sf, "part").select("p_brand", F.when(F.expr(_LEDGER_LINES), short).otherwise(whole).alias("value"))


@query(
    "incremental_quarantine",
    f"SELECT concat_ws(',', CAST(p_partkey AS VARCHAR), p_name) AS raw_line FROM part WHERE {_LEDGER_LINES}",
)
def q_incremental_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of two fields among rows of five: kept apart as raw lines."""
    root = scratch_path(spark, "incremental")
    _with_short_rows(spark, sf, root).select("value").write.text(f"{root}/in")
    load_increment(spark, f"{root}/in", f"{root}/raw", f"{root}/ckpt", header=False, schema=_PART_SCHEMA)
    return L.quarantined_lines(spark, f"{root}/raw").select("raw_line")


@query(
    "load_ledger",
    "SELECT replace(p_brand, '#', '') AS file, count(*) AS original_rows, count(*) FILTER (WHERE p_size % 9 <> 0 AND p_size > 10) AS kept_rows, "
    "count(*) FILTER (WHERE p_size % 9 = 0) AS quarantined_rows, count(*) FILTER (WHERE p_size % 9 <> 0 AND p_size <= 10) AS filtered_rows "
    "FROM part GROUP BY p_brand",
)
def q_load_ledger(spark: SparkSession, sf: str) -> DataFrame:
    """One file per brand, some lines malformed, some left out by the filter:
    figures by file as committed with the load."""
    root = scratch_path(spark, "incremental")
    lines = _with_short_rows(spark, sf, root).withColumn("brand", F.replace("p_brand", F.lit("#"), F.lit(""))).drop("p_brand")
    lines.repartition("brand").write.partitionBy("brand").text(f"{root}/in")
    load_increment(spark, f"{root}/in", f"{root}/raw", f"{root}/ckpt", header=False, schema=_PART_SCHEMA, condition="CAST(p_size AS INT) > 10")
    figures = ("original_rows", "kept_rows", "quarantined_rows", "filtered_rows")
    return L.ledger(spark, f"{root}/raw").select(F.regexp_extract("source_file", r"brand=([^/]*)/", 1).alias("file"), *figures)
