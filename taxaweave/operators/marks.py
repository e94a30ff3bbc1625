"""Keeping rows out of a join's exchange by a bitmap of the other side's keys.

The bitmap has a fixed size whatever the number of keys, so it can be broadcast.
It tells for sure that a row meets no key; the rows that may meet one go through
the join, which decides.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a bitmap (8 MB).
BITS = 1 << 26


def _slot(keys: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(BITS))


def marks(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(__bucket, __bits): the slots of the keys of all rows, as arrays of 64 words."""
    c = F.col
    words = (
        df.select(_slot(keys).alias("__slot"))
        .groupBy(F.shiftright("__slot", 6).alias("__word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(__slot & 63 AS int))")).alias("__w"))
    )
    buckets = words.groupBy(F.shiftright("__word", 6).alias("__bucket")).agg(
        F.map_from_entries(F.collect_list(F.struct(c("__word").bitwiseAND(63), "__w"))).alias("__m")
    )
    places = F.sequence(F.lit(0).cast("long"), F.lit(63).cast("long"))
    return buckets.select("__bucket", F.transform(places, lambda i: F.coalesce(c("__m")[i], F.lit(0).cast("long"))).alias("__bits"))


def apart(df: DataFrame, marked: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows that meet no marked key, all others) of ``df``; NULL keys as any value.
    Nothing is shuffled. The others are every row of a marked key and, by their
    slots, a few more."""
    slot = _slot(keys)
    word = F.get(F.col("__bits"), F.shiftright(slot, 6).bitwiseAND(63).cast("int"))
    met = (F.shiftright(slot, 12) == F.col("__bucket")) & (F.getbit(word, slot.bitwiseAND(63).cast("int")) == 1)
    bits = F.broadcast(marked)  # at most BITS bits
    return df.join(bits, met, "left_anti"), df.join(bits, met, "left_semi")
