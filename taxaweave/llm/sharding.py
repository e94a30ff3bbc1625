"""Balanced label propagation over documents linked by equal texts.

Law ``rows``: shard sizes differ by one row at most. Linked documents start in
shards by hash; in each round every part of a group wishes to move to the shard
that holds most of the group, and as many may as quotas by pair of shards allow:
a shard's room plus what leaves it. Documents without a link fill what is left,
so no link is cut for balance alone. Groups of over a quarter of a shard (at most
a few for each shard) are placed first, in as few shards as they can be.

Copies of a text in one shard are alike, so the propagation works on (group,
shard, count) rows, at most one per shard and group; documents are told apart
only when they are dealt out, by their rank in the group.

Nulls: a null text has size 1 and crc32 0, and null texts are one group; a null
doc_id sorts first. Equal rows are dealt each. An empty table gives no rows.
Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from taxaweave.llm.common import query, ranked, table, written

SHARDS = 8
#: A group of over this part of a shard is placed before the propagation.
GIANT = 4


def quotas(wished: np.ndarray, held: np.ndarray, capacity: np.ndarray) -> np.ndarray:
    """How many may move from each shard to each: at most as many as wish to,
    and into a shard as many as its room and those that leave it allow."""
    grant = wished.copy()
    changed = True
    while changed:
        changed = False
        for k in range(len(held)):
            coming = int(grant[:, k].sum())
            over = held[k] + coming - grant[k].sum() - capacity[k]
            if over > 0 and coming:
                grant[:, k] = grant[:, k] * max(coming - over, 0) // coming
                changed = True
    return grant


def propagated(state: DataFrame, capacity: list[int]) -> DataFrame:
    """Moves documents of (group, shard, n) rows until none may move.
    Rows of a group: at most one per shard, before and after.

    Each round every part of a group wishes to move to the shard of the group's
    largest part. The wishes by pair of shards (a small matrix) give the quotas;
    documents swap places where both sides wish to. A shard that could let
    nobody in is closed: what is in it stays, others look elsewhere.
    """
    shards = len(capacity)
    closed: list[int] = []
    while True:
        of_group = Window.partitionBy("group")
        is_open = ~F.col("shard").isin(closed) if closed else F.lit(True)
        best = F.max(F.when(is_open, F.struct("n", F.xxhash64("group", "shard").alias("tie"), "shard"))).over(of_group)["shard"]
        wishes = written(state.withColumn("to", best).withColumn("move", is_open & (F.col("to") != F.col("shard"))), "wishes")
        held, wished = np.zeros(shards, np.int64), np.zeros((shards, shards), np.int64)
        for r in wishes.groupBy("shard", "to", "move").agg(F.sum("n").alias("n")).collect():  # a row per pair of shards
            held[r["shard"]] += r["n"]
            if r["move"]:
                wished[r["shard"], r["to"]] += r["n"]
        grant = quotas(wished, held, np.array(capacity, np.int64))
        shut = [k for k in range(shards) if wished[:, k].sum() and not grant[:, k].sum()]
        if not grant.any() and not shut:
            return state
        closed += shut
        if not grant.any():
            continue
        pair = (F.col("shard") * shards + F.col("to")).cast("int")
        lined = ranked(wishes.where("move").select("group", "shard", "to", "n", pair.alias("pair")), "pair", ["n", "group"], weight="n", before="ahead")
        quota = F.element_at(F.array(*[F.lit(int(q)).cast("long") for q in grant.ravel()]), F.col("pair") + 1)
        goes = F.greatest(F.lit(0).cast("long"), F.least(F.col("n"), quota - F.col("ahead")))
        granted = written(lined.withColumn("goes", goes).where("goes > 0").select("group", "shard", "to", "goes"), "granted")
        change = granted.select("group", "shard", (-F.col("goes")).alias("n")).unionByName(granted.select("group", F.col("to").alias("shard"), F.col("goes").alias("n")))
        state = written(state.unionByName(change).groupBy("group", "shard").agg(F.sum("n").alias("n")).where("n > 0"), "state")


def balanced_shards(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, group, shard, slot."""
    text = F.col("text")
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1
    base = written(
        docs.select("doc_id", size.alias("size"), F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("group"), F.coalesce(F.xxhash64("doc_id"), F.lit(0)).alias("order")),
        "sharding",
    )
    total = base.count()
    capacity = [total // shards + (k < total % shards) for k in range(shards)]
    start = base.groupBy("group", F.pmod(F.xxhash64("doc_id"), F.lit(shards)).cast("int").alias("shard")).agg(F.count("*").alias("n"))
    whole = F.sum("n").over(Window.partitionBy("group"))
    start = written(start.withColumn("all", whole).where("all > 1"), "state")
    giants, room = placed_first(start, capacity)
    others = start.where("all <= " + str(min(capacity) // GIANT)).drop("all")
    state = settled(propagated(others, room), room).unionByName(giants)
    held = {r["shard"]: r["n"] for r in state.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
    upto = Window.partitionBy("group").orderBy("shard")
    ends = state.withColumn("end", F.sum("n").over(upto)).groupBy("group").agg(F.sort_array(F.collect_list(F.struct("end", "shard"))).alias("ends"))  # <= shards entries
    joined = base.join(ends, "group", "left")
    linked = ranked(joined.where("ends is not null"), "group", ["doc_id"])
    linked = linked.withColumn("shard", F.filter("ends", lambda e: e["end"] > F.col("pos"))[0]["shard"])
    single = ranked(written(joined.where("ends is null").withColumn("one", F.lit(0)), "singles"), "one", ["order", "doc_id"])
    bounds, at = [], 0
    for k, c in enumerate(capacity):
        at += c - held.get(k, 0)
        bounds.append(at)
    nth = sum(((F.col("pos") >= b).cast("int") for b in bounds[:-1]), F.lit(0))
    cols = ["doc_id", "size", "text_crc32", "group"]
    dealt = written(linked.select(*cols, "shard").unionByName(single.select(*cols, nth.cast("int").alias("shard"))), "dealt")
    return ranked(dealt, "shard", ["doc_id"], at="slot")


def placed_first(start: DataFrame, capacity: list[int]) -> tuple[DataFrame, list[int]]:
    """Groups of over a ``GIANT``-th of a shard (there are at most GIANT times
    the shards) get their places before all others, each in one shard where it
    fits and else in as few as it can; returns them and the room that is left."""
    big = start.where("all > " + str(min(capacity) // GIANT)).groupBy("group").agg(F.max("all").alias("all")).collect()
    room, rows = list(capacity), []
    for r in sorted(big, key=lambda r: (-r["all"], r["group"])):
        n = r["all"]
        while n:
            fits = [k for k, free in enumerate(room) if free >= n]
            k = min(fits, key=lambda k: room[k]) if fits else max(range(len(room)), key=lambda k: room[k])
            take = min(n, room[k])
            rows.append((r["group"], k, take))
            room[k], n = room[k] - take, n - take
    return start.sparkSession.createDataFrame(rows, "group long, shard int, n long"), room


def settled(state: DataFrame, capacity: list[int]) -> DataFrame:
    """Linked documents beyond a shard's capacity (left there by the first deal)
    go to shards with room, whole rows as far as the cut allows."""
    held = {r["shard"]: r["n"] for r in state.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
    if all(held.get(k, 0) <= c for k, c in enumerate(capacity)):
        return state
    lined = ranked(state, "shard", ["n", "group"], weight="n", before="ahead")
    most = F.element_at(F.array(*[F.lit(c) for c in capacity]), F.col("shard") + 1)
    stays = F.greatest(F.lit(0).cast("long"), F.least(F.col("n"), most - F.col("ahead")))
    cut = written(lined.withColumn("stays", stays).select("group", "shard", "n", "stays"), "settled")
    over = ranked(cut.where("stays < n").select("group", F.lit(0).alias("one"), (F.col("n") - F.col("stays")).alias("n")), "one", ["n", "group"], weight="n", before="ahead")
    room, at, parts = [max(c - held.get(k, 0), 0) for k, c in enumerate(capacity)], 0, []
    for k, r in enumerate(room):
        lo, hi = F.greatest("ahead", F.lit(at)), F.least(F.col("ahead") + F.col("n"), F.lit(at + r))
        parts.append(F.struct(F.lit(k).alias("shard"), (hi - lo).cast("long").alias("n")))
        at += r
    spread = over.select("group", F.explode(F.array(*parts)).alias("p")).select("group", "p.shard", "p.n").where("n > 0")
    kept = cut.where("stays > 0").select("group", "shard", F.col("stays").alias("n"))
    return written(kept.unionByName(spread).groupBy("group", "shard").agg(F.sum("n").alias("n")), "state")


@query("op5_balanced_sharding")
def op5_balanced_sharding(spark, sf_dir):
    dealt = balanced_shards(table(spark, sf_dir, "documents"))
    return dealt.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
