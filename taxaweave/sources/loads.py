"""Loading delimited files into a published table, with a ledger row per file
(A10, A12, A13).

A load reads its files in groups of one delimiter and header line, columns by
name, and writes every row once: kept rows, malformed rows (as raw lines), and
of the rows that the ingest filter leaves out only the file they come from. So
one write pass gives the table, the quarantine and the figures per file, which
are checked against each other before the load is committed.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from taxaweave.sources import ingest as I
from taxaweave.sources.tables import LOAD, Commit, Incomplete, Table

STATE, SOURCE = "_state", "_source_file"
KEPT, QUARANTINED, FILTERED = "kept", "quarantined", "filtered"
LEDGER = f"source_file string, original_rows long, kept_rows long, quarantined_rows long, filtered_rows long, {LOAD} string"


def with_states(rows: DataFrame, condition: str | Column | None) -> DataFrame:
    """Every row of a read with ``keep_corrupt`` and ``with_path``, marked as
    kept, quarantined or filtered. Quarantined rows hold their raw line, filtered
    ones nothing but their file."""
    wanted = F.lit(True) if condition is None else (F.expr(condition) if isinstance(condition, str) else condition)
    bad = F.col(I.CORRUPT_COL).isNotNull()
    state = F.when(bad, QUARANTINED).when(F.coalesce(wanted, F.lit(False)), KEPT).otherwise(FILTERED)
    marked = rows.withColumn(STATE, state)
    values = [c for c in rows.columns if c not in (I.CORRUPT_COL, "source_file")]
    return marked.select(
        *[F.when(F.col(STATE) == KEPT, F.col(f"`{c}`")).alias(c) for c in values],
        I.CORRUPT_COL,
        F.col("source_file").alias(SOURCE),
        STATE,
    )


def load_files(
    spark: SparkSession,
    paths: str | Sequence[str],
    target: str,
    key: str | None = None,
    sep: str | None = None,
    header: bool = True,
    schema: T.StructType | None = None,
    condition: str | None = None,
    repair: bool = False,
    uniform: bool = False,
) -> Commit:
    """Appends files to the table at ``target`` as one load; a ``key`` that is
    committed already loads nothing. Columns go by each file's header line (by
    position with a ``schema``); columns new to the table are added to it. The
    condition may name any column of the table or of the files. ``repair`` parses
    malformed lines once more before they are quarantined; ``uniform`` files have
    one delimiter and header line, which then are not compared."""
    table = Table(spark, target)
    listed = I.delimited_files(spark, paths)
    key = key or uuid.uuid4().hex
    rows = I.read_delimited(spark, listed, sep=sep, header=header, schema=schema, keep_corrupt=True, with_path=True, repair=repair, uniform=uniform)
    present = {c.lower() for c in rows.columns}
    known = [n for n in table.commit().schema.names if n.lower() not in present and n not in (STATE, SOURCE)]
    rows = rows.select("*", *[F.lit(None).cast("string").alias(n) for n in known])
    figures = f"{target}/ledger/{LOAD}={key}"

    def check(stored: DataFrame) -> None:
        """Figures by file from the stored load, which must add up to its rows."""
        files = spark.createDataFrame([(p,) for p in listed], "source_file string").select(I.plain_path(F.col("source_file")).alias("source_file"))
        states = [F.count_if(F.col(STATE) == s).alias(f"{s}_rows") for s in (KEPT, QUARANTINED, FILTERED)]
        own = stored.groupBy(F.col(SOURCE).alias("source_file")).agg(F.count(F.lit(1)).alias("original_rows"), *states)
        # a file without rows has a ledger row too
        files.join(own, "source_file", "full_outer").na.fill(0).write.mode("overwrite").parquet(figures)
        sums = spark.read.parquet(figures).agg(F.sum("original_rows").alias("rows"), F.count("*").alias("files")).first()
        want = (stored.count(), len(listed))
        if (sums["rows"], sums["files"]) != want:
            raise Incomplete(f"{figures}: {sums['rows']} rows of {sums['files']} files, not {want}")

    return table.append(with_states(rows, condition), key=key, partition_by=[STATE], check=check)


def kept_rows(spark: SparkSession, target: str) -> DataFrame:
    """The table's rows."""
    rows = Table(spark, target).read()
    return rows.where(F.col(STATE) == KEPT).drop(STATE, SOURCE, I.CORRUPT_COL)


def quarantined_lines(spark: SparkSession, target: str) -> DataFrame:
    """(source_file, raw_line) of malformed rows."""
    return Table(spark, target).read().where(F.col(STATE) == QUARANTINED).select(F.col(SOURCE).alias("source_file"), F.col(I.CORRUPT_COL).alias("raw_line"))


def ledger(spark: SparkSession, target: str) -> DataFrame:
    """A row per file and committed load."""
    keys = list(Table(spark, target).commit().rows)
    if not keys:
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).option("basePath", f"{target}/ledger").parquet(*[f"{target}/ledger/{LOAD}={k}" for k in keys])
