"""Join helpers: lookups, anti joins, unnesting.

No side is hinted: Catalyst and AQE pick broadcast or shuffle (with skew
splitting) from measured bytes, so a plan has the same form at every size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lookup_join(
    df: DataFrame,
    lookup: DataFrame,
    left_on: Sequence[Column | str] | Column | str,
    right_on: Sequence[Column | str] | Column | str,
    how: str = "left",
    cast_keys_to: str | None = None,
) -> DataFrame:
    """Left (or inner) join to a lookup table.

    ``cast_keys_to="string"`` compares the keys as text on both sides (the
    int-to-text key join). A lookup key that repeats fans the left row out, as
    in SQL.
    """
    lefts = [left_on] if not isinstance(left_on, (list, tuple)) else list(left_on)
    rights = [right_on] if not isinstance(right_on, (list, tuple)) else list(right_on)
    lk = [F.col(c) if isinstance(c, str) else c for c in lefts]
    rk = [lookup[c] if isinstance(c, str) else c for c in rights]
    if cast_keys_to:
        lk = [c.cast(cast_keys_to) for c in lk]
        rk = [c.cast(cast_keys_to) for c in rk]
    cond = None
    for a, b in zip(lk, rk):
        e = a == b
        cond = e if cond is None else (cond & e)
    return df.join(lookup, cond, how)


def missing_from(df: DataFrame, reference: DataFrame, df_key: str, ref_key: str) -> DataFrame:
    """Rows of ``df`` whose key does not occur in ``reference``."""
    ref = reference.select(F.col(ref_key).alias("__ref_key")).where(F.col("__ref_key").isNotNull())
    return df.join(ref, df[df_key] == ref["__ref_key"], "left_anti")


def first_match(
    df: DataFrame,
    candidates: DataFrame,
    keys: Sequence[str],
    value: str,
    out: str,
    candidate_keys: Sequence[str] | None = None,
) -> DataFrame:
    """For each row, the smallest ``value`` among candidate rows with the same
    keys, or NULL (C3: a correlated ``LIMIT 1`` lookup made deterministic).

    The candidates are reduced to one row per key with a partial aggregate
    before the join, so a hot key costs one row, not a fan-out.
    """
    candidate_keys = list(candidate_keys or keys)
    best = candidates.groupBy(*[F.col(c).alias(f"__k{i}") for i, c in enumerate(candidate_keys)]).agg(
        F.min(value).alias(out)
    )
    cond = None
    for i, k in enumerate(keys):
        e = df[k] == best[f"__k{i}"]
        cond = e if cond is None else (cond & e)
    joined = df.join(best, cond, "left")
    return joined.drop(*[f"__k{i}" for i in range(len(keys))])


def unnest(df: DataFrame, array_col: str, out: str, keep_empty: bool = False) -> DataFrame:
    """One row per element (C10/H9); ``keep_empty`` keeps rows with empty/NULL arrays."""
    fn = F.explode_outer if keep_empty else F.explode
    return df.withColumn(out, fn(F.col(array_col)))
