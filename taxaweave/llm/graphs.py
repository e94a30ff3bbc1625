"""Connected components by Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxaweave.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a long, b long, a <> b): all
    nodes that links reach from each other have the same one of them as root.

    Each round every node joins the node around it of the smallest hash, and
    that one's choice; the edges are then drawn between the chosen nodes. Hashes
    are as good as random, so whatever the shape, paths included, each round
    leaves a fraction of the nodes, and all rounds together cost little more
    than the first. The rounds' choices are chained at the end, the shortest
    first. Only whether edges are left comes to the driver.
    """
    steps: list[DataFrame] = []
    edges = written(edges.select("a", "b"), "edges")
    while not steps or edges.limit(1).count():
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        order = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("v"))
        near = both.groupBy("a").agg(F.min(order("b")).alias("m")).select(F.col("a").alias("node"), F.least(order("a"), F.col("m"))["v"].alias("to"))
        near = written(near, "choice")
        far = near.select(F.col("node").alias("via"), F.col("to").alias("root"))
        steps.append(written(near.join(far, F.col("to") == F.col("via")).select("node", "root"), "roots"))
        one, two = (steps[-1].select(F.col("node").alias(n), F.col("root").alias(r)) for n, r in (("a", "ra"), ("b", "rb")))
        drawn = edges.join(one, "a").join(two, "b").where("ra <> rb").select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b"))
        edges = written(drawn.distinct(), "edges")
    found = steps[-1]
    for step in reversed(steps[:-1]):
        last = found.select(F.col("node").alias("via"), F.col("root").alias("last"))
        found = written(step.join(last, F.col("root") == F.col("via"), "left").select("node", F.coalesce("last", "root").alias("root")), "roots")
    return found
