"""Distributed row numbering.

A global ``row_number() OVER (ORDER BY ...)`` puts every row into one task.
Instead the rows are range-partitioned on the sort keys, numbered inside each
partition, and shifted by what the earlier partitions hold. What meets in one
place is one row per partition.

Given a row ``key``, only the key and the sort keys pass through the range
exchange, and only the key and the position are written to scratch; the rows
themselves are joined to their number by the key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from taxaweave.session import scratch_table

_PID = "__pid"
_POS = "__pos"
_RUN = "__run"


def _sort_exprs(order: Sequence[Column | str]) -> list[Column]:
    return [F.col(f"`{c}`").asc_nulls_last() if isinstance(c, str) else c for c in order]


def _positions(df: DataFrame, sort: Sequence[Column], num_partitions: int | None) -> DataFrame:
    """``df`` with the range partition of each row and its place in it."""
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    laid = df.repartitionByRange(n, *sort).sortWithinPartitions(*sort)
    place = F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("long"), 33)
    return laid.withColumn(_PID, F.spark_partition_id()).withColumn(_POS, place)


def _joined_back(df: DataFrame, numbers: DataFrame, key: Sequence[str]) -> DataFrame:
    """Every row of ``df`` with the number of its key (NULL matches NULL)."""
    renamed = numbers.select(*[F.col(f"`{k}`").alias(f"__k{i}") for i, k in enumerate(key)], *[c for c in numbers.columns if c not in key])
    cond = F.lit(True)
    for i, k in enumerate(key):
        cond = cond & df[f"`{k}`"].eqNullSafe(renamed[f"__k{i}"])
    return df.join(renamed, cond).drop(*[f"__k{i}" for i in range(len(key))])


def dense_id(
    df: DataFrame,
    order: Sequence[Column | str],
    out: str = "id",
    num_partitions: int | None = None,
    key: Sequence[str] | None = None,
) -> DataFrame:
    """Number rows 1..n in the order given (E4); string keys sort ascending,
    NULLS LAST; pass ``Column`` sort orders for anything else.

    The order must be total (append unique tie-breakers), otherwise tied rows
    get an arbitrary but still gap-free numbering. ``key`` names columns that
    tell any two rows apart; without it whole rows are numbered, which suits
    narrow frames.

    Plan: one range exchange on the sort keys, a sort inside each partition, a
    written table of (key, partition, position) in the shared folder (fixes
    positions and cuts lineage, so a lost executor cannot renumber), one aggregate
    of per-partition counts (n_partitions rows), a broadcast of those offsets, and
    with a ``key`` one join of the rows with their numbers.
    """
    sort = _sort_exprs(order)
    kept = [F.col(f"`{c}`") for c in (key or df.columns)]
    stored = scratch_table(_positions(df, sort, num_partitions).select(*kept, _PID, _POS), "dense-id")
    counts = stored.groupBy(_PID).agg(F.count(F.lit(1)).alias("__n"))
    # At most n_partitions rows: a single-partition window is fine here.
    w = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(_PID, F.coalesce(F.sum("__n").over(w), F.lit(0)).alias("__off"))
    numbered = (
        stored.join(F.broadcast(offsets), _PID)
        .withColumn(out, (F.col("__off") + F.col(_POS) + 1).cast("long"))
        .drop(_PID, _POS, "__off")
    )
    return numbered if key is None else _joined_back(df, numbered, key)


def sequence_in_group(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column | str],
    out: str = "seq",
    num_partitions: int | None = None,
    key: Sequence[str] | None = None,
) -> DataFrame:
    """``row_number() OVER (PARTITION BY group ORDER BY order)`` without putting a
    whole group into one task (E2). NULL group keys form one group, as in SQL
    window partitions; ``key`` as for :func:`dense_id`.

    Rows are range-partitioned on (group, order), so a hot group lies in many
    partitions; its rows are numbered inside each. Of every partition a footer
    (its last group, how many rows of it, whether there is no other) tells the
    next ones how many rows of their first group came before: footers are added
    up over a row per partition and broadcast. No join or aggregate meets the
    group key.
    """
    keys = [F.col(f"`{g}`").asc_nulls_last() for g in group] + _sort_exprs(order)
    placed = _positions(df, keys, num_partitions)
    own = [f"__g{i}" for i in range(len(group))]
    placed = placed.select(*[F.col(f"`{c}`") for c in (key or df.columns)], *[F.col(f"`{g}`").alias(o) for g, o in zip(group, own)], _PID, _POS)
    inside = Window.partitionBy(_PID, *own).orderBy(_POS)
    stored = scratch_table(placed.withColumn(_RUN, F.row_number().over(inside).cast("long")), "sequence")

    of = F.struct(*own)
    footers = stored.groupBy(_PID).agg(
        F.min_by(of, _POS).alias("first"),
        F.max_by(of, _POS).alias("last"),
        F.max_by(_RUN, _POS).alias("rows"),
        (F.max(_POS) + 1 == F.max_by(_RUN, _POS)).alias("alone"),
    )
    # A row per partition: a chain of partitions that one group fills alone passes its rows on.
    by = Window.orderBy(_PID)
    footers = footers.withColumn("chain", F.sum(F.when(F.col("alone") & F.lag("last").over(by).eqNullSafe(F.col("first")), 0).otherwise(1)).over(by))
    upto = Window.partitionBy("chain").orderBy(_PID)
    footers = footers.withColumn("sum", F.sum("rows").over(upto))
    leads = footers.select(F.col(_PID).alias("__p"), F.lag("last").over(by).alias("__last"), F.lag("sum").over(by).alias("__before"))
    led = stored.join(F.broadcast(leads), F.col(_PID) == F.col("__p"))
    before = F.when(of.eqNullSafe(F.col("__last")), F.col("__before")).otherwise(0)
    numbered = led.withColumn(out, (F.col(_RUN) + before).cast("long")).drop(_PID, _POS, _RUN, "__p", "__last", "__before", *own)
    return numbered if key is None else _joined_back(df, numbered, key)
