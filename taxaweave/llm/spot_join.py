"""Near duplicates among SpotSigs fingerprints, in DataFrame expressions only.

Equal fingerprints are one set. Sets are partitioned by their length so that two
that may be ``least`` alike lie in one partition or in neighbouring ones. Inside
those, candidates share one of their rarest signatures: of a set of n, the first
n - ceil(least * n) + 1 by document frequency, of which two such sets always have
one in common. Candidates are compared by Jaccard likeness, those whose lengths
rule it out not at all.

Nulls: a null fingerprint is an empty one; empty ones are alike and no other is
like them. Rows of a null key are in a class of their own each. An empty table
gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxaweave.llm.common import written
from taxaweave.llm.graphs import components
from taxaweave.llm.spotsigs import likeness


def length_part(n: Column, least: float) -> Column:
    """Number of the length partition. Its bounds grow so that a set of a
    partition is shorter than ``least`` times any set two partitions on; they
    grow by a tenth at least, so that there are few."""
    bounds, at = [], 1
    while at < 1 << 31:
        bounds.append(at)
        at = int(at / min(least, 0.9)) + 1
    return F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: b <= n))


def alike(prints: DataFrame, least: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Of rows (key, print): pairs (a, b, likeness) of unlike sets that are
    ``least`` alike or more, and the membership (key, set)."""
    if not 0 < least <= 1:
        raise ValueError("least must be over 0 and at most 1")
    own = prints.select("key", F.coalesce("print", F.array().cast("array<int>")).alias("print")).withColumn("set", F.xxhash64("print"))
    members = written(own, "prints")
    sets = members.groupBy("set").agg(F.any_value("print").alias("print")).where(F.size("print") > 0)
    sets = written(sets.withColumn("n", F.size("print")).withColumn("part", length_part(F.col("n"), least)), "sets")
    spots = sets.select("set", "n", "part", F.explode("print").alias("spot"))
    often = spots.groupBy("spot").agg(F.count("*").alias("sets"))
    # a set's signatures are as many as its text has
    ordered = spots.join(often, "spot").groupBy("set", "n", "part").agg(F.array_sort(F.collect_list(F.struct("sets", "spot")))["spot"].alias("rare"))
    # a little less than least * n, lest rounding shorten the prefix
    kept = F.col("n") - F.ceil(F.lit(least) * F.col("n") - 1e-6).cast("int") + 1
    prefix = written(ordered.select("set", "n", "part", F.explode(F.slice("rare", F.lit(1), kept)).alias("spot")), "rare")
    a = prefix.select(F.col("set").alias("a"), F.col("n").alias("an"), "spot", F.explode(F.array("part", F.col("part") + 1)).alias("part"))
    b = prefix.select(F.col("set").alias("b"), F.col("n").alias("bn"), "spot", "part")
    shorter = (F.struct("an", "a") < F.struct("bn", "b")) & (F.col("an") >= F.lit(least - 1e-9) * F.col("bn"))
    met = a.join(b, ["spot", "part"]).where(shorter).select("a", "b").distinct()
    of = lambda name: sets.select(F.col("set").alias(name), F.col("print").alias(f"{name}_print"))
    near = likeness(F.col("a_print"), F.col("b_print"), least)
    pairs = met.join(of("a"), "a").join(of("b"), "b").select("a", "b", near.alias("likeness")).where(F.col("likeness") >= least)
    return pairs, members.select("key", "set")


def near_classes(prints: DataFrame, least: float = 0.8) -> DataFrame:
    """(key, class_key): the smallest key that likeness reaches, itself included."""
    pairs, members = alike(prints, least)
    roots = components(pairs.select("a", "b"))
    named = members.join(roots.withColumnRenamed("node", "set"), "set", "left").withColumn("root", F.coalesce("root", "set"))
    named = written(named.select("key", "root"), "classes")
    first = named.where("key is not null").groupBy("root").agg(F.min("key").alias("class_key"))
    return named.join(first, "root", "left").select("key", F.when(F.col("key").isNotNull(), F.col("class_key")).alias("class_key"))
