"""Most-frequent-value lookups and hierarchical gap filling.

All modes of all lookup levels are computed in one pass: rows are collapsed to
distinct value combinations with a count, each combination is melted into
(level, level value, target, target value) tuples, the weights are summed,
and the best value per (level, level value, target) is picked as
``min(struct(-count, value))`` - most frequent, ties to the smallest value,
which is ``mode() WITHIN GROUP (ORDER BY value)`` of SQL.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxaweave.schemas import FILL_ORDER, fill_lookups
from taxaweave.session import scratch_table


def _q(c: str):
    return F.col(f"`{c}`")


def _path_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct combinations of ``columns`` with their row count (``__w``).

    A partial aggregate: a combination holding a third of all rows costs one
    row per map task in the shuffle.
    """
    return df.groupBy(*[_q(c) for c in columns]).agg(F.count(F.lit(1)).alias("__w"))


def _modes_from_paths(paths: DataFrame, lookups: Mapping[str, Sequence[str]]) -> DataFrame:
    tuples = [
        F.struct(
            F.lit(level).alias("level"), _q(level).cast("string").alias("key"),
            F.lit(t).alias("target"), _q(t).cast("string").alias("value"),
        )
        for level, targets in lookups.items()
        for t in targets
    ]
    melted = (
        paths.select(F.explode(F.array(*tuples)).alias("x"), "__w")
        .select("x.*", "__w")
        .where(F.col("key").isNotNull() & F.col("value").isNotNull())
    )
    counts = melted.groupBy("level", "key", "target", "value").agg(F.sum("__w").alias("n"))
    return counts.groupBy("level", "key", "target").agg(
        F.min(F.struct((-F.col("n")).alias("neg_n"), F.col("value").alias("v")))["v"].alias("best")
    )


def mode_table(df: DataFrame, lookups: Mapping[str, Sequence[str]]) -> DataFrame:
    """Long table (level, key, target, best) of modes.

    ``lookups`` maps a level column to the target columns whose mode is wanted
    among rows sharing that level's value. NULL keys and NULL values are
    ignored; a key whose target is always NULL has no row for it.

    Rows are first collapsed to their distinct combinations of the involved
    columns with a count; only those weighted combinations are melted and
    summed.
    """
    involved = sorted({*lookups.keys(), *[t for ts in lookups.values() for t in ts]})
    return _modes_from_paths(_path_counts(df, involved), lookups)


def mode_by_key(
    df: DataFrame, key: str, targets: Sequence[str], prefix: str = "best_", all_keys: bool = True
) -> DataFrame:
    """One row per non-NULL ``key`` with the mode of each target.

    ``all_keys=False`` omits keys whose targets are all NULL (they would carry
    only NULL modes), saving the distinct-keys pass and its join.
    """
    long = mode_table(df, {key: list(targets)})
    wide = long.groupBy(F.col("key").alias(key)).agg(
        *[F.max(F.when(F.col("target") == t, F.col("best"))).alias(f"{prefix}{t}") for t in targets]
    )
    if not all_keys:
        return wide
    # keys whose targets are all NULL still form a group in SQL
    keys = df.where(_q(key).isNotNull()).select(_q(key).cast("string").alias(key)).distinct()
    return keys.join(wide, key, "left")


def hierarchical_fill(
    df: DataFrame,
    order: Mapping[str, Sequence[str]] = FILL_ORDER,
    extra: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Fill NULLs of each column in ``order`` from the modes at related levels,
    trying the row's own value first, then each level in the listed order (K7).

    Single pass: lookups use the row's original values. Row count and every
    non-NULL value are preserved. ``extra`` maps a column to plain fallback
    columns of the same row (e.g. generic_name -> genus).

    Plan, the same at every size: every lookup depends only on a row's *path*
    (its values of the involved columns). So (1) collapse the rows to distinct
    paths with a count, (2) compute all modes from the weighted paths in one
    melt + aggregate, (3) fill the path table with one left join per level, and
    (4) join the rows back to their filled path ONCE (on the path as one struct).
    The paths and the mode table are written once to scratch (the modes by
    level, so that each join reads its own slice); join strategies are left to
    AQE's measured bytes.
    """
    lookups = fill_lookups(order)
    involved = sorted({*order.keys(), *lookups.keys(), *[t for ts in lookups.values() for t in ts]})
    paths = scratch_table(_path_counts(df, involved), "fill-paths")
    wide_cols = sorted({t for ts in lookups.values() for t in ts})
    wide = (
        _modes_from_paths(paths, lookups)
        .groupBy("level", "key")
        .agg(*[F.max(F.when(F.col("target") == t, F.col("best"))).alias(f"best_{t}") for t in wide_cols])
    )
    wide = scratch_table(wide.repartition("level", "key"), "fill-modes", partition_by=["level"])

    filled_paths = paths
    for level, targets in lookups.items():
        slice_ = wide.where(F.col("level") == level).select(
            F.col("key").alias(f"__k_{level}"),
            *[F.col(f"best_{t}").alias(f"__{level}__{t}") for t in targets],
        )
        filled_paths = filled_paths.join(
            slice_, _q(level).cast("string") == F.col(f"__k_{level}"), "left"
        ).drop(f"__k_{level}")
    path = F.struct(*[_q(c) for c in involved])
    filled_paths = filled_paths.select(
        path.alias("__path"),
        *[
            F.coalesce(_q(t), *[F.col(f"__{lv}__{t}").cast(df.schema[t].dataType) for lv in levels]).alias(f"__f_{t}")
            for t, levels in order.items()
        ],
    )

    # Equal structs have equal fields, NULLs included. The hash ahead of them is what
    # the join's sorts compare, and most columns travel only inside the struct.
    rows = df.select("*", path.alias("__row"))
    out = rows.join(filled_paths, (F.xxhash64("__row") == F.xxhash64("__path")) & (F.col("__row") == F.col("__path")), "left")
    filled = {t: F.col(f"__f_{t}") for t in order}
    for target, cols in (extra or {}).items():
        filled[target] = F.coalesce(_q(target), *[_q(c) for c in cols])
    return out.select(*[filled.get(c, _q(c)).alias(c) for c in df.columns])


def fill_from_mode(
    df: DataFrame,
    key: str,
    targets: Sequence[str],
    prefix: str = "filled_",
) -> DataFrame:
    """Add ``prefix+target = coalesce(target, mode of target for this key)``.

    The modes, one row per key, are hashed partition by partition, so the rows are
    streamed past them and not sorted."""
    modes = mode_by_key(df, key, targets, prefix="__best_", all_keys=False).withColumnRenamed(key, "__mkey")
    joined = df.join(modes.hint("shuffle_hash"), _q(key).cast("string") == F.col("__mkey"), "left")
    return joined.select(
        *[_q(c) for c in df.columns],
        *[F.coalesce(_q(t), F.col(f"__best_{t}")).alias(f"{prefix}{t}") for t in targets],
    )
