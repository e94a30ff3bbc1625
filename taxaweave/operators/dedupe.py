"""Preferred-row selection and near-duplicate resolution.

Both selections reduce a hot key map-side before the shuffle: "keep the first
row per key" is ``row_number() = 1`` (Spark inserts a partial
``WindowGroupLimit`` ahead of the exchange), and duplicate-group resolution is
one aggregate ``min(struct(order..., row...))`` with mixed sort directions
packed into ascending fields.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from taxaweave.functions.names import sortable_desc_text


@dataclass(frozen=True)
class Order:
    """One sort key: a column name or expression, direction and NULL placement.

    ``nulls_first=None`` means the SQL default of the direction in Spark/DuckDB
    (NULLS FIRST ascending, NULLS LAST descending).
    """

    col: Column | str
    descending: bool = False
    nulls_first: bool | None = None


def asc(col: Column | str, nulls_first: bool = True) -> Order:
    return Order(col, False, nulls_first)


def desc(col: Column | str, nulls_first: bool = False) -> Order:
    return Order(col, True, nulls_first)


def _as_order(o: Order | Column | str) -> Order:
    return o if isinstance(o, Order) else Order(o)


def _descending_value(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)):
        return -c
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return -F.unix_micros(c.cast("timestamp"))
    if isinstance(dtype, T.DateType):
        return -F.unix_date(c)
    if isinstance(dtype, T.BooleanType):
        return ~c
    if isinstance(dtype, T.StringType):
        return sortable_desc_text(c)
    raise TypeError(f"cannot order {dtype} descending inside an aggregate")


def ordering_struct(df: DataFrame, order: Sequence[Order | Column | str]) -> list[Column]:
    """Fields whose ascending struct order equals the requested ordering."""
    fields = []
    for i, raw in enumerate(order):
        o = _as_order(raw)
        c = F.col(o.col) if isinstance(o.col, str) else o.col
        dtype = df.select(c).schema.fields[0].dataType
        nulls_first = (not o.descending) if o.nulls_first is None else o.nulls_first
        fields.append(F.when(c.isNull(), F.lit(0 if nulls_first else 1)).otherwise(F.lit(1 if nulls_first else 0)).alias(f"n{i}"))
        fields.append((_descending_value(c, dtype) if o.descending else c).alias(f"v{i}"))
    return fields


def sort_orders(order: Sequence[Order | Column | str]) -> list[Column]:
    """Spark sort expressions for an ordering."""
    out = []
    for raw in order:
        o = _as_order(raw)
        c = F.col(o.col) if isinstance(o.col, str) else o.col
        nulls_first = (not o.descending) if o.nulls_first is None else o.nulls_first
        if o.descending:
            out.append(c.desc_nulls_first() if nulls_first else c.desc_nulls_last())
        else:
            out.append(c.asc_nulls_first() if nulls_first else c.asc_nulls_last())
    return out


def top1_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Order | Column | str],
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """The first row of every key under ``order``.

    ``row_number() OVER (PARTITION BY keys ORDER BY order) = 1``: Spark plans a
    partial ``WindowGroupLimit`` before the shuffle, so every map task keeps
    only its best row per key and a key holding a third of all rows costs one
    row per task in the exchange. The order should be total within a key
    (append a unique tie-breaker). NULL keys form one group, as in SQL.
    """
    columns = list(columns or df.columns)
    w = Window.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(*sort_orders(order))
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") == 1).select(*[F.col(f"`{c}`") for c in columns])


def rank_preference(col: Column | str, preferred: Sequence[str]) -> Column:
    """1..k for the listed values in order, k+1 for anything else (incl. NULL)."""
    c = F.col(col) if isinstance(col, str) else col
    expr = None
    for i, v in enumerate(preferred, start=1):
        expr = F.when(c == v, F.lit(i)) if expr is None else expr.when(c == v, F.lit(i))
    return F.lit(len(preferred) + 1) if expr is None else expr.otherwise(F.lit(len(preferred) + 1))


def duplicate_members(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Order | Column | str],
    columns: Sequence[str],
    require: Column | None = None,
) -> DataFrame:
    """Rows of duplicate groups with ``best``: the winner's ``columns`` (a struct).

    A duplicate group is a key occurring more than once with every key column
    non-NULL (NULL never equals NULL in the equality join of the source
    semantics). ``require`` restricts which rows can be duplicates at all.
    Winner and group size come from ONE aggregate, reduced map-side; only
    members of groups of two and more come back from the join.
    """
    eligible = F.lit(True)
    for k in keys:
        eligible = eligible & F.col(f"`{k}`").isNotNull()
    if require is not None:
        eligible = eligible & require
    candidates = df.where(eligible)
    payload = F.struct(*[F.col(f"`{c}`").alias(c) for c in columns])
    groups = (
        candidates.groupBy(*[F.col(f"`{k}`").alias(f"__k_{k}") for k in keys])
        .agg(F.count(F.lit(1)).alias("__n"), F.min(F.struct(*ordering_struct(candidates, order), payload.alias("row")))["row"].alias("best"))
        .where("__n > 1")
        .drop("__n")
    )
    cond = F.lit(True)
    for k in keys:
        cond = cond & (candidates[f"`{k}`"] == groups[f"__k_{k}"])
    return candidates.join(groups, cond).drop(*[f"__k_{k}" for k in keys])


def resolve_duplicates(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Order | Column | str],
    id_col: str,
    require: Column | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Collapse every duplicate group to its best row (K6: D3, C4, E3, C5, G3).

    Returns (rows, links): all rows but the losers, unchanged, and the ids that
    each winner takes over as (``winner``, ``member``) links, one per member of
    a group, the winner's own included. A link per row: nothing is collected
    per group. ``id_col`` must be unique.
    """
    members = duplicate_members(df, keys, order, [id_col], require)
    links = members.select(F.col("best")[id_col].alias("winner"), F.col(f"`{id_col}`").alias("member"))
    losers = links.where("winner <> member").select("member")
    return df.join(losers, df[f"`{id_col}`"] == losers["member"], "left_anti"), links
