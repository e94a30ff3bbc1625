"""Data-quality checks (L1-L23). Each returns the FAILING rows as a DataFrame:
zero rows means the check passes. Table-level checks return one row per
failure with the measured numbers. Row-level ones are predicates of
``rowchecks``, which also runs many of them in one scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from taxaweave.operators import rowchecks as R
from taxaweave.session import scratch_table


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def unique(df: DataFrame, col: str) -> DataFrame:
    """L1: values occurring more than once (NULLs ignored)."""
    return (
        df.where(_q(col).isNotNull())
        .groupBy(_q(col).alias(col))
        .agg(F.count(F.lit(1)).alias("n_records"))
        .where(F.col("n_records") > 1)
    )


def not_null(df: DataFrame, col: str) -> DataFrame:
    """L2: rows where the column is NULL."""
    return df.where(R.is_null(col))


def unique_combination(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """L3: column combinations occurring more than once (NULLs group together)."""
    return df.groupBy(*[_q(c).alias(c) for c in cols]).agg(F.count(F.lit(1)).alias("n_records")).where(
        F.col("n_records") > 1
    )


def accepted_values(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """L4: non-NULL values outside the list."""
    return df.where(R.outside_values(col, values))


def relationships(df: DataFrame, col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """Non-NULL keys without a parent row (anti join)."""
    p = parent.select(_q(parent_col).alias("__parent_key")).where(F.col("__parent_key").isNotNull())
    return df.where(_q(col).isNotNull()).join(p, _q(col) == F.col("__parent_key"), "left_anti")


def not_empty_string(df: DataFrame, col: str) -> DataFrame:
    """NULL or blank values."""
    return df.where(R.is_blank(col))


def expression_is_true(df: DataFrame, expr: str | Column, null_fails: bool = True) -> DataFrame:
    """Rows where the predicate is false (and, by default, NULL)."""
    return df.where(R.not_true(expr, null_fails))


def _count_pair(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row (n_left, n_right): two one-row aggregates stacked and summed."""
    zero = F.lit(0).cast("long")
    ca = a.agg(F.count(F.lit(1)).alias("n_left")).select("n_left", zero.alias("n_right"))
    cb = b.agg(F.count(F.lit(1)).alias("n_right")).select(zero.alias("n_left"), "n_right")
    return ca.unionByName(cb).agg(F.sum("n_left").alias("n_left"), F.sum("n_right").alias("n_right"))


def equal_rowcount(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row (n_left, n_right) when the counts differ."""
    return _count_pair(a, b).where(F.col("n_left") != F.col("n_right"))


def fewer_rows_than(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row when ``a`` does not have strictly fewer rows than ``b``."""
    return _count_pair(a, b).where(F.col("n_left") >= F.col("n_right"))


def accepted_range(df: DataFrame, col: str, min_value=None, max_value=None, inclusive: bool = True) -> DataFrame:
    """Non-NULL values outside [min, max] (or the open interval)."""
    return df.where(R.outside_range(col, min_value, max_value, inclusive))


def not_accepted_values(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """Rows whose value is in the forbidden list."""
    return df.where(R.among_values(col, values))


def not_null_proportion(df: DataFrame, col: str, at_least: float, at_most: float = 1.0) -> DataFrame:
    """One row (proportion) when the non-NULL share is outside [at_least, at_most]."""
    p = df.agg(
        (F.count(_q(col)).cast("double") / F.greatest(F.count(F.lit(1)), F.lit(1))).alias("not_null_proportion")
    )
    return p.where((F.col("not_null_proportion") < at_least) | (F.col("not_null_proportion") > at_most))


def recency(df: DataFrame, col: str, reference: Column, interval: str) -> DataFrame:
    """One row (latest) when the newest value is older than ``reference - interval``.

    The reference time is a parameter (e.g. ``F.current_timestamp()`` or a fixed
    literal) so the check is reproducible.
    """
    latest = df.agg(F.max(_q(col)).alias("latest"))
    threshold = reference - F.expr(f"INTERVAL {interval}")
    return latest.where(F.col("latest").isNull() | (F.col("latest") < threshold))


def _with_neighbour(
    df: DataFrame, partition_by: Sequence[str], order: Sequence[str], value: str, offset: int, out: str
) -> DataFrame:
    """``value`` of the row before (-1) or after (1) within each partition,
    without putting a partition into one task: one range exchange on
    (partition, order), the neighbour inside each range, and across its end
    only the first or last row of the next range (a row per range)."""
    keys = [_q(k) for k in (*partition_by, *order)]
    ranged = df.repartitionByRange(*[k.asc_nulls_first() for k in keys]).withColumn("__range", F.spark_partition_id())
    laid = scratch_table(ranged, "ranges")
    step = F.lag if offset < 0 else F.lead
    group = F.struct(*[_q(p).alias(f"p{i}") for i, p in enumerate(partition_by)])
    near = step(F.struct(group.alias("group"), _q(value).alias("value")))
    row = F.struct(*[k.alias(f"k{i}") for i, k in enumerate(keys)], group.alias("group"), _q(value).alias("value"))
    ends = laid.groupBy("__range").agg((F.max if offset < 0 else F.min)(row).alias("__end"))
    ends = ends.select(F.col("__range").alias("__r"), step("__end").over(Window.orderBy("__range")).alias("__end"))  # a row per range
    inside = laid.withColumn("__near", near.over(Window.partitionBy("__range").orderBy(*[k.asc_nulls_first() for k in keys])))
    joined = inside.join(F.broadcast(ends), F.col("__range") == F.col("__r"))
    there = F.coalesce("__near", F.struct(F.col("__end.group").alias("group"), F.col("__end.value").alias("value")))
    return joined.withColumn(out, F.when(there["group"].eqNullSafe(group), there["value"])).drop("__range", "__r", "__near", "__end")


def sequential_values(df: DataFrame, col: str, partition_by: Sequence[str], interval=1, order_by: Sequence[str] | None = None) -> DataFrame:
    """Rows whose value is not the previous value + ``interval`` within
    their partition (ordered by ``order_by``, default the value itself).
    The previous value comes from :func:`_with_neighbour`, so a partition
    holding a third of all rows is still spread over many tasks."""
    if not partition_by:
        raise ValueError("sequential_values needs partition_by columns")
    prev = _with_neighbour(df, partition_by, list(order_by or [col]), col, -1, "previous_value")
    return prev.where(F.col("previous_value").isNotNull() & (_q(col) != F.col("previous_value") + interval))


def cardinality_equality(a: DataFrame, col_a: str, b: DataFrame, col_b: str) -> DataFrame:
    """Values whose occurrence counts differ between the two tables."""
    ca = a.groupBy(_q(col_a).alias("value")).agg(F.count(F.lit(1)).alias("n_left"))
    cb = b.groupBy(_q(col_b).alias("value")).agg(F.count(F.lit(1)).alias("n_right"))
    j = ca.join(cb, ca["value"].eqNullSafe(cb["value"]), "full_outer").select(
        F.coalesce(ca["value"], cb["value"]).alias("value"),
        F.coalesce(F.col("n_left"), F.lit(0)).alias("n_left"),
        F.coalesce(F.col("n_right"), F.lit(0)).alias("n_right"),
    )
    return j.where(F.col("n_left") != F.col("n_right"))


def mutually_exclusive_ranges(df: DataFrame, lower: str, upper: str, partition_by: Sequence[str]) -> DataFrame:
    """Rows whose [lower, upper) range overlaps the next range of the same
    partition (ordered by lower, upper); the next range comes from
    :func:`_with_neighbour` (skew-safe)."""
    nxt = _with_neighbour(df, partition_by, [lower, upper], lower, 1, "next_lower")
    return nxt.where(F.col("next_lower").isNotNull() & (F.col("next_lower") < _q(upper)))


def equality(a: DataFrame, b: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Rows in one table but not the other, as bags (``which`` = side)."""
    cols = list(cols or a.columns)
    sa = a.select(*[_q(c) for c in cols])
    sb = b.select(*[_q(c) for c in cols])
    return sa.exceptAll(sb).withColumn("which", F.lit("left_only")).unionByName(
        sb.exceptAll(sa).withColumn("which", F.lit("right_only"))
    )


def single_word(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows where any of the name-part columns contains a space."""
    return df.where(R.several_words(cols))


def unknown_abbreviations(df: DataFrame, col: str, known: Sequence[str], pattern: str = r"(\b[A-Za-z]+\.)") -> DataFrame:
    """(row value, token) for every abbreviation-like token not in ``known``.

    Tokens are extracted JVM-side, exploded, and checked against the list
    (a literal IN list, no join).
    """
    tokens = df.select(_q(col).alias(col), F.explode(F.regexp_extract_all(_q(col), F.lit(pattern), 1)).alias("token"))
    return tokens.where(~F.col("token").isin(list(known)))


def period_only_below_species(df: DataFrame, name_col: str, rank_col: str, allowed_ranks: Sequence[str]) -> DataFrame:
    """Names containing a period whose rank is not in ``allowed_ranks``."""
    return df.where(R.period_above(name_col, rank_col, allowed_ranks))


def no_digits(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows with a digit in any of the columns."""
    return df.where(R.has_digit(cols))


def no_value(df: DataFrame, col: str, value: str = "unranked") -> DataFrame:
    """Rows carrying a forbidden marker value (e.g. ``unranked``)."""
    return df.where(R.among_values(col, [value]))
