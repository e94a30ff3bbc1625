"""Toxicity by a bidirectional GRU with attention over words and characters.

The network (``gru``) is trained in numpy on the driver from a bounded sample of
labelled documents (``TRAIN_DOCS`` of at most ``TRAIN_BYTES``, those of the smallest
hashes of doc_id, of a repeated one the text of the smallest hash, held out ones never); tasks score all overlapping windows of every whole text.

Nulls: a null or empty text, or one without words, has score 0; a null doc_id is
scored and counts as not held out; labels of a null doc_id or null label teach
nothing, contradicting labels of one doc_id count as toxic. Without labelled
documents every score is 0. Input columns ``score`` and ``predicted`` are
replaced; all others are kept. Equal rows are scored each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from taxaweave.llm import gru
from taxaweave.llm.common import query, table

#: Labelled documents that the network learns from, at most; Adam steps.
TRAIN_DOCS = 2_500
#: Bytes of such a document that it learns from, at most.
TRAIN_BYTES = 1 << 20
STEPS = 300
THRESHOLD = 0.3
#: Bytes of text scored at a time.
CHUNK_BYTES = 1 << 19


def held_out() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", train_docs: int = TRAIN_DOCS, steps: int = STEPS) -> dict[str, np.ndarray] | None:
    """The network's parameters; None where there is nothing to learn from."""
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(label).alias("_y")).where(~held_out())
    some = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_docs)
    own = docs.select("doc_id", F.col("text").cast("binary").alias("text")).join(F.broadcast(some), "doc_id")
    # one text of a repeated doc_id: train_docs rows at most, of bounded length
    one = own.groupBy("doc_id", "_y").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    rows = one.select("doc_id", "_y", F.substring("text", 1, TRAIN_BYTES).alias("text")).collect()
    rows = sorted((r["doc_id"], bytes(r["text"] or b""), r["_y"]) for r in rows)
    if not rows:
        return None
    return gru.train([r[1] for r in rows], np.array([r[2] for r in rows]), steps)


def score(docs: DataFrame, model: dict[str, np.ndarray] | None, threshold: float = THRESHOLD) -> DataFrame:
    """Adds ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` on)."""
    docs = docs.drop("score", "predicted")
    if model is None:
        return docs.select("*", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    held = docs.sparkSession.sparkContext.broadcast(model)  # 1.2 MB
    names = docs.columns
    at = names.index("text")
    schema = T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(at).cast(pa.binary()).to_pylist()
            upto = np.cumsum([len(t or b"") for t in texts]) // CHUNK_BYTES
            cuts = [0, *(np.flatnonzero(np.diff(upto)) + 1).tolist(), len(texts)]
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                if hi > lo:
                    s = gru.scores(held.value, texts[lo:hi])
                    own = b.slice(lo, hi - lo)
                    yield pa.RecordBatch.from_arrays([*own.columns, pa.array(s), pa.array((s >= threshold).astype(np.int32))], names=[*names, "score", "predicted"])

    return docs.mapInArrow(add, schema)


@query("op2_toxicity")
def op2_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")
