"""Union, entity merge and collected ids."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxaweave.operators.numbering import sequence_in_group


def union_conform(frames: Sequence[DataFrame], columns: Sequence[str], cast: str | None = "string") -> DataFrame:
    """Stack frames by column name onto one column list.

    Columns a frame lacks become typed NULLs; extra columns are dropped. The
    union is a narrow operation (no shuffle).
    """
    out = None
    for df in frames:
        present = set(df.columns)
        cols = []
        for c in columns:
            col = F.col(f"`{c}`") if c in present else F.lit(None)
            cols.append((col.cast(cast) if cast else col).alias(c))
        part = df.select(*cols)
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError("union_conform needs at least one frame")
    return out


def merge_records(
    df: DataFrame,
    keys: Sequence[str],
    attributes: Sequence[str],
    id_col: str = "id",
    source_col: str = "data_source",
    ids_out: str = "external_ids",
    sources_out: str = "data_sources",
) -> DataFrame:
    """Merge the records of one key into one row (D1 + D2).

    Each attribute becomes its MAX (NULLs skipped). Ids and sources are
    collected as two aligned arrays ordered by (id, source); NULL ids are kept
    (a struct element survives ``collect_list`` even when its fields are NULL).
    One shuffle on the keys, with map-side partial aggregation.
    """
    pairs = F.sort_array(F.collect_list(F.struct(F.col(id_col).alias("i"), F.col(source_col).alias("s"))))
    agg = df.groupBy(*keys).agg(
        *[F.max(F.col(f"`{a}`")).alias(a) for a in attributes],
        pairs.alias("__pairs"),
    )
    return agg.select(
        *keys,
        *[F.col(f"`{a}`") for a in attributes],
        F.transform("__pairs", lambda x: x["i"]).alias(ids_out),
        F.transform("__pairs", lambda x: x["s"]).alias(sources_out),
    )


def collect_segments(
    df: DataFrame,
    keys: Sequence[str],
    values: Mapping[str, str],
    order: Sequence[Column | str],
    size: int = 1000,
    num_partitions: int | None = None,
) -> DataFrame:
    """The values of one key as aligned arrays of at most ``size`` elements (D2,
    C6 for keys of any number of records): (keys, ``segment`` from 0, an array per
    entry ``out name -> column`` of ``values``), in ``order`` within and over
    segments. NULL elements are kept.

    Positions come from the distributed numbering, so a key that holds a third of
    all records is numbered in many tasks and collected in many groups; only the
    keys, values and sort columns are exchanged. The order must be total, or
    tied records fall into either segment.
    """
    named = [F.col(f"`{v}`").alias(f"__v{i}") for i, v in enumerate(values.values())]
    by = [*keys, *[o for o in order if isinstance(o, str) and o not in keys]]
    # sort expressions may read any column, so none is pruned for them
    base = df.select(*([F.col(f"`{c}`") for c in by] if all(isinstance(o, str) for o in order) else df.columns), *named)
    placed = sequence_in_group(base, keys, order, out="__n", num_partitions=num_partitions)
    row = F.struct("__n", *[f"__v{i}" for i in range(len(values))])
    grouped = placed.groupBy(*keys, F.floor((F.col("__n") - 1) / size).cast("long").alias("segment")).agg(F.array_sort(F.collect_list(row)).alias("__rows"))
    return grouped.select(*keys, "segment", *[F.col("__rows")[f"__v{i}"].alias(out) for i, out in enumerate(values)])


def group_max(df: DataFrame, keys: Sequence[str], attributes: Sequence[str], where: Column | None = None) -> DataFrame:
    """Filter then MAX per key (D9, and D1 without the id arrays)."""
    if where is not None:
        df = df.where(where)
    return df.groupBy(*keys).agg(*[F.max(F.col(f"`{a}`")).alias(a) for a in attributes])


def duplicated_keys(df: DataFrame, keys: Sequence[str], count_out: str = "group_size", min_count: int = 2) -> DataFrame:
    """Keys that occur at least ``min_count`` times, with their count (D3).

    NULL is a group of its own here, as in SQL GROUP BY.
    """
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias(count_out))
        .where(F.col(count_out) >= min_count)
    )
