"""N-gram Jaccard self-join of whole texts with a count-vector R-tree.

Two documents link when ``100 * overlap >= near * union`` of their distinct
word shingles. Documents of equal sets are one node (they link trivially).

0. Count: all shingles of the corpus are counted in fixed hash slots.
1. Deal: every set is cut into hash groups; two linked sets always have one of
   their keyed group contents in common (``ngram_sets.bucket_keys``; contents
   rare by those counts are keyed first, so common passages bring nothing
   together). Nodes that share a key are tied to the first of them, and the
   ties' components are the clusters: no linked pair lies across two of them.
2. Index: a cluster's nodes are points of counts by hash group in an R-tree;
   a synchronous traversal keeps the pairs whose summed coordinate minima allow
   the overlap. A cluster of over ``tile`` shingles is cut into tiles by set
   size and every two tiles whose sizes can link meet in a task of their own.
3. Verify: surviving pairs are compared exactly. A task returns a spanning
   forest of its links and per node the links' number, never the pairs.
4. The links' connected components give ``component_id``.

Shingles, sets and nodes are 64-bit hashes. Nulls: a null text has no words, so
an empty set, and links with nothing; a row of a null doc_id is returned with a
null component and no links. Equal rows are equal documents. An empty table
gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from taxaweave.llm.common import query, ranked, table, written
from taxaweave.llm.graphs import components
from taxaweave.llm.ngram_sets import SLOTS, bucket_keys, level, point, set_id, shingle_sets, slots
from taxaweave.llm.rtree import RTree, joined

#: Words of a shingle and per cent of overlap to union, unless told otherwise.
N_WORDS, NEAR = 5, 80
#: Shingles of a cluster that one tile holds, about.
TILE = 200_000
#: Rows that a task's slot counts take.
PARTS = 64
#: Sets whose keys a task remembers to have given already.
SEEN = 200_000
#: Texts that are hashed at a time: about so many bytes, so many rows at most.
CHUNK_BYTES, CHUNK_ROWS = 1 << 19, 512


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes | None]]]:
    """(rows, their texts) of a few rows at a time, few enough to be hashed at once."""
    for b in batches:
        size = pc.cumulative_sum(pc.fill_null(pc.binary_length(b.column(1)), 0).cast(pa.int64())).to_numpy() // CHUNK_BYTES
        cuts = [0, *(np.flatnonzero(np.diff(size)) + 1).tolist(), b.num_rows]
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            for at in range(lo, hi, CHUNK_ROWS):
                own = b.slice(at, min(CHUNK_ROWS, hi - at))
                yield own, own.column(1).to_pylist()


def shingled(docs: DataFrame, n_words: int) -> tuple[DataFrame, np.ndarray]:
    """(doc_id, hash, n, node): the text's hash, size and id of each document's
    set, 0 for the empty one; and how many shingles of the corpus fall into each hash slot, on a
    logarithmic scale. A task leaves its counts in ``PARTS`` rows."""
    width = SLOTS // PARTS

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SLOTS, np.int64)
        for own, texts in _parts(batches):
            sets = shingle_sets(texts, n_words)
            counts += np.bincount(slots(np.concatenate(sets)), minlength=SLOTS)
            n = pa.array([len(s) for s in sets], pa.int64())
            node = pa.array([set_id(s) if len(s) else 0 for s in sets], pa.int64())
            none = [pa.nulls(len(texts), t) for t in (pa.int32(), pa.binary())]
            yield pa.RecordBatch.from_arrays([own.column(0), own.column(2), n, node, *none], names=["doc_id", "hash", "n", "node", "part", "counts"])
        if counts.any():
            arrays = [pa.nulls(PARTS, pa.int64())] * 4 + [pa.array(range(PARTS), pa.int32()), pa.array([counts[k * width : (k + 1) * width].tobytes() for k in range(PARTS)], pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "hash", "n", "node", "part", "counts"])

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for part, counts in zip(*(c.to_pylist() for c in b.columns), strict=True):
                total[part] = total.get(part, 0) + np.frombuffer(counts, np.int64)
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.int32()), pa.array([t.tobytes() for t in total.values()], pa.binary())], names=["part", "counts"])

    done = written(_narrow(docs).mapInArrow(hashed, "doc_id long, hash long, n long, node long, part int, counts binary"), "shingles")
    parts = done.where("part is not null").select("part", "counts").repartition("part").mapInArrow(summed, "part int, counts binary").collect()  # PARTS rows of fixed size
    counts = np.zeros(SLOTS, np.int64)
    for r in parts:
        counts[r["part"] * width : (r["part"] + 1) * width] = np.frombuffer(r["counts"], np.int64)
    return done.where("part is null").select("doc_id", "hash", "n", "node"), level(counts)


def _narrow(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"), F.xxhash64("text").alias("hash"))


def keyed(docs: DataFrame, n_words: int, near: int, levels: np.ndarray) -> DataFrame:
    """node, key. A task gives the keys of equal sets once."""
    held = docs.sparkSession.sparkContext.broadcast(levels)  # SLOTS bytes

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for _, texts in _parts(batches):
            ids, made = [], []
            for s in shingle_sets(texts, n_words):
                node = set_id(s) if len(s) else 0
                if len(s) and node not in seen:
                    if len(seen) >= SEEN:
                        seen.clear()
                    seen.add(node)
                    made.append(bucket_keys(s, near, held.value))
                    ids.append(node)
            if made:
                by = np.repeat(np.array(ids, np.int64), [len(m) for m in made])
                yield pa.RecordBatch.from_arrays([pa.array(by), pa.array(np.concatenate(made).view(np.int64))], names=["node", "key"])

    return _narrow(docs).where("doc_id is not null").mapInArrow(keys, "node long, key long")


def clusters(keys: DataFrame) -> DataFrame:
    """(node, root) of nodes that share keys, directly or through others."""
    first = F.first("node").over(Window.partitionBy("key").orderBy("node").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    edges = keys.withColumn("a", first).where("a < node").select("a", F.col("node").alias("b")).distinct()
    return components(edges)


def tiles(nodes: DataFrame, tile: int, near: int) -> DataFrame:
    """Adds ``own`` (the node's tile) and ``left``, ``right``: the two tiles that
    meet in a task, one row for each. Nodes: root, node, n, rep."""
    cut = ranked(nodes, "root", ["n", "node"], weight="n").withColumn("own", F.floor(F.col("before") / tile)).drop("pos", "before")
    cut = written(cut, "tiles")
    sizes = cut.groupBy("root", "own").agg(F.min("n").alias("small"), F.max("n").alias("large"))
    many = sizes.groupBy("root").agg(F.max("own").alias("last")).where("last > 0").select("root")
    # one row per tile of a cluster of several: tiles ordered by size reach as
    # far to the right as their sizes can link
    sized = sizes.join(many, "root")
    after = sized.select("root", F.col("own").alias("right"), F.col("small").alias("their"))
    meet = sized.join(after, "root").where((F.col("right") >= F.col("own")) & (100 * F.col("large") >= near * F.col("their"))).select("root", F.col("own").alias("left"), "right")
    ends = F.explode(F.array_distinct(F.array("left", "right"))).alias("own")
    return cut.join(meet.select("root", "left", "right", ends), ["root", "own"], "left").withColumns({c: F.coalesce(c, F.col("own")) for c in ("left", "right")})


def verified(a: list[np.ndarray], b: list[np.ndarray] | None, near: int) -> Iterator[tuple[int, int]]:
    """Linked (i, j): within ``a``, or between ``a`` and ``b``."""
    left = RTree(np.array([point(s) for s in a]))
    right = left if b is None else RTree(np.array([point(s) for s in b]))
    b = a if b is None else b
    for i, j in joined(left, right, near):
        order = np.argsort(i, kind="stable")
        i, j = i[order], j[order]
        for x, at in zip(*np.unique(i, return_index=True), strict=True):
            others = j[at : np.searchsorted(i, x, "right")]
            sizes = np.array([len(b[y]) for y in others])
            flat = np.concatenate([b[y] for y in others])
            where = np.searchsorted(a[x], flat)
            met = a[x][np.minimum(where, len(a[x]) - 1)] == flat
            overlap = np.add.reduceat(met.astype(np.int64), np.concatenate([[0], np.cumsum(sizes)[:-1]]))
            for y in others[(100 + near) * overlap >= near * (sizes + len(a[x]))]:
                yield int(x), int(y)


def linked(met: DataFrame, n_words: int, near: int) -> DataFrame:
    """Rows (root, left, right, own, node, copies, text) dealt by task -> (a, b,
    links): forest edges, and per node (b null) the documents it links with."""

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
        out = []
        for (_, left, right), group in groupby(rows, key=lambda r: r[:3]):
            sides: dict[int, list] = {left: [], right: []}
            for _, _, _, own, node, copies, text in group:
                s = shingle_sets([text], n_words)[0]
                if set_id(s) == node:  # not a text of equal hash
                    sides[own].append((node, copies, s))
            sides = {k: list({r[0]: r for r in v}.values()) for k, v in sides.items()}
            a, b = sides[left], sides[right]
            above = {r[0]: r[0] for r in a + b}
            count = dict.fromkeys(above, 0)

            def root(x):
                while above[x] != x:
                    above[x] = above[above[x]]
                    x = above[x]
                return x

            for i, j in verified([r[2] for r in a], None if left == right else [r[2] for r in b], near):
                x, y = a[i], b[j]
                count[x[0]] += y[1]
                count[y[0]] += x[1]
                if root(x[0]) != root(y[0]):
                    above[root(x[0])] = root(y[0])
                    out.append((x[0], y[0], 0))
            out.extend((x, None, n) for x, n in count.items() if n)
            if len(out) > 5000:
                yield _edges(out)
                out = []
        if out:
            yield _edges(out)

    return met.mapInArrow(link, "a long, b long, links long")


def _edges(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=["a", "b", "links"])


def with_texts(met: DataFrame, docs: DataFrame) -> DataFrame:
    """The nodes' rows with a text of each: that of its smallest (doc_id, text
    hash), so that a doc_id of many texts brings each of them once."""
    texts = _narrow(docs).withColumnRenamed("doc_id", "rep")
    return met.join(texts, ["rep", "hash"]).select("root", "left", "right", "own", "node", "copies", "text")


def ngram_join(docs: DataFrame, n_words: int = N_WORDS, near: int = NEAR, tile: int = TILE) -> DataFrame:
    """doc_id, n_shingles, component_id, n_links (other documents linked)."""
    return grouped(docs, n_words, near, tile).select("doc_id", "n_shingles", "component_id", "n_links")


def grouped(docs: DataFrame, n_words: int = N_WORDS, near: int = NEAR, tile: int = TILE) -> DataFrame:
    """As :func:`ngram_join`, with each row's node and its component's root node,
    both null where it links with nothing."""
    sets, levels = shingled(docs, n_words)
    known = sets.where("doc_id is not null and n > 0")
    node = written(known.groupBy("node").agg(F.min(F.struct("doc_id", "hash")).alias("first"), F.min("n").alias("n"), F.count("*").alias("copies")), "nodes")
    node = node.select("node", F.col("first.doc_id").alias("rep"), F.col("first.hash").alias("hash"), "n", "copies")
    near_by = clusters(keyed(docs, n_words, near, levels))
    met = tiles(written(near_by.join(node, "node").select("root", "node", "n", "rep", "hash", "copies"), "clusters"), tile, near)
    dealt = with_texts(met, docs).repartition("root", "left", "right").sortWithinPartitions("root", "left", "right", "node")
    links = written(linked(dealt, n_words, near), "links")
    # the smallest doc_id of the component: of its nodes' smallest ones
    joined_ = components(links.where("b is not null"))
    small = joined_.join(node.select("node", "rep"), "node").groupBy("root").agg(F.min("rep").alias("component_id"))
    group = joined_.join(small, "root").select("node", "component_id", "root")
    number = links.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    facts = node.join(group, "node", "left").join(number, "node", "left").select(
        "node", F.coalesce("root", "node").alias("root"), F.coalesce("component_id", "rep").alias("component_id"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    facts = written(facts, "facts")  # so that a node of many copies is a skewed join that Spark can split
    own = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return (
        sets.select("doc_id", "n", F.when(F.col("doc_id").isNotNull() & (F.col("n") > 0), F.col("node")).alias("node"))
        .join(facts, "node", "left")
        .select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), own).alias("component_id"), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), "node", "root")
    )


def noded(docs: DataFrame, n_words: int) -> DataFrame:
    """``docs`` with the node of each text, 0 for the empty set."""
    schema = T.StructType([*docs.schema.fields, T.StructField("node", T.LongType())])
    names = docs.columns

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = pa.RecordBatch.from_arrays([pa.nulls(b.num_rows), b.column(names.index("text")).cast(pa.binary())], names=["none", "text"])
            node = [set_id(s) if len(s) else 0 for _, own in _parts([texts]) for s in shingle_sets(own, n_words)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(node, pa.int64())], names=[*names, "node"])

    return docs.mapInArrow(add, schema)


def one_of_each(docs: DataFrame, groups: DataFrame, n_words: int = N_WORDS, near: int = NEAR) -> DataFrame:
    """The documents without those that another one of their component stands
    for: the one of the smallest doc_id stays, of several of that id the one of
    the smallest text hash. Rows of null doc_id all stay, and of rows without
    words those that differ in doc_id or text.

    Texts move only if Spark shuffles them for the anti join, or where the
    narrow ``groups`` show that a doc_id repeats. Only the texts of those ids
    are hashed again, as each is decided on by its own node; ``groups`` without
    nodes are then made anew with ``n_words`` and ``near``.
    """
    gone = groups.where("component_id < doc_id").select("doc_id").distinct()
    twice = groups.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1")
    if not twice.limit(1).count():
        return docs.join(gone, "doc_id", "left_anti").select(docs.columns)
    if "node" not in groups.columns:
        groups = written(grouped(docs, n_words, near), "groups")
    ids = written(twice.select("doc_id"), "repeated")
    once = docs.join(ids, "doc_id", "left_anti").join(gone, "doc_id", "left_anti").select(docs.columns)
    several = noded(docs.join(ids, "doc_id", "left_semi").select(docs.columns), n_words)
    own = F.coalesce("node", F.lit(0)).alias("node")
    facts = groups.join(ids, "doc_id").select("doc_id", own, "component_id", "root").distinct()
    stay = written(facts.where("component_id = doc_id").select("doc_id", "node", "root"), "stay")
    several = several.join(stay, ["doc_id", "node"])
    alike = F.coalesce("root", F.xxhash64("text"))
    order = [F.xxhash64("text"), F.xxhash64(*docs.columns)]
    nth = F.row_number().over(Window.partitionBy("doc_id", F.col("root").isNull(), alike).orderBy(*order))
    return once.unionByName(several.withColumn("_nth", nth).where("_nth = 1").select(docs.columns))


_SHINGLES = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"

#: Brute force over the shingles' inverted index; small tables only.
ORACLE = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_SHINGLES} AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM w WHERE len(w) > 0)
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
),
e AS (SELECT x, y FROM o JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * o >= 90 * (p.n + q.n - o)),
r AS (
  SELECT doc_id AS x, doc_id AS y FROM n
  UNION
  SELECT r.x, e.y FROM r JOIN e ON e.x = r.y
),
c AS (SELECT x, min(y) AS m FROM r GROUP BY x),
l AS (SELECT x, count(*) AS l FROM e GROUP BY x)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(c.m, w.doc_id) AS component_id, coalesce(l.l, 0)::BIGINT AS n_links
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN c ON c.x = w.doc_id LEFT JOIN l ON l.x = w.doc_id
"""


@query("op1_ngram_jaccard_join", ORACLE)
def op1_ngram_jaccard_join(spark, sf_dir):
    return ngram_join(table(spark, sf_dir, "documents"), n_words=3, near=90)
