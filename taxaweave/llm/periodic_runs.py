"""Periodic runs of words: stretches that repeat with a period.

A run is a stretch of consecutive words with smallest period q and a length of
at least ``max(min_length, 2 * q)`` that no neighbouring word extends. Runs are
found by Baier grouping and Lyndon roots (``lyndon``), exactly, in every whole
text; ``repetitive_parts`` first leaves out what no run can touch. Collapsing a
text keeps of every run its first period, and joins the kept words by a blank.

Nulls: a null text has no words (0 runs, an empty collapsed text), as a text
without words has. A null doc_id is an id like others. Every row is returned,
equal ones each. An empty table gives no rows. Input columns ``n_words``,
``runs`` and ``collapsed`` are replaced, all others are kept. A text is held
whole by one task: about 150 bytes for each word of its repetitive parts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from taxaweave.llm.common import cut_at_blanks, query, table
from taxaweave.llm.lyndon import runs_of_all

#: Shortest run, in words.
MIN_LENGTH = 12
#: Words searched at a time (one longer text by itself), and words numbered at most before a fresh start.
CHUNK_WORDS = 200_000
KEPT_WORDS = 500_000

RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])
_ARROW_RUN = pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])

#: From (doc_id, number of words) to the places that the words are taken from; None: as they are.
Rewrite = Callable[[int | None, int], np.ndarray | None]


class Numbers(dict):
    """word -> its number; ``words`` lists them."""

    def __init__(self):
        super().__init__()
        self.words: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        self.words.append(word)
        self[word] = n = len(self)
        return n

    def of(self, text: bytes) -> np.ndarray:
        # bytes.split() parts at ASCII white space, [\x20\x09-\x0D]
        parts = [np.fromiter(map(self.__getitem__, piece.split()), np.int32) for piece in cut_at_blanks(text)]
        return parts[0] if len(parts) == 1 else np.concatenate(parts)

    def text(self, numbers: np.ndarray) -> bytes:
        cuts = range(0, max(1, len(numbers)), CHUNK_WORDS)
        return b" ".join(b" ".join(map(self.words.__getitem__, numbers[at : at + CHUNK_WORDS].tolist())) for at in cuts)


def kept_words(n: int, runs: np.ndarray) -> np.ndarray:
    """Mask of the words that are in no run after its first period; ``runs`` rows (start, length, period)."""
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edges, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(edges[:-1]) == 0


def periodic_runs(docs: DataFrame, min_length: int = MIN_LENGTH, rewrite: Rewrite | None = None) -> DataFrame:
    """Adds ``n_words``, ``runs`` (by start, then period; word numbers from 0) and
    ``collapsed``. ``rewrite`` rearranges a document's words first. No shuffle."""
    docs = docs.drop("n_words", "runs", "collapsed")
    names = docs.columns
    at, by = names.index("text"), names.index("doc_id")
    schema = T.StructType(
        [*docs.schema.fields, T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(RUN)), T.StructField("collapsed", T.StringType())]
    )

    def found(rows: pa.RecordBatch, sequences: list[np.ndarray], numbers: Numbers) -> pa.RecordBatch:
        hits = runs_of_all(sequences, min_length)
        cuts = np.searchsorted(hits[:, 0], np.arange(len(sequences) + 1))
        texts = []
        for d, words in enumerate(sequences):
            own = hits[cuts[d] : cuts[d + 1], 1:]
            texts.append(numbers.text(words[kept_words(len(words), own)] if len(own) else words))
        lists = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.StructArray.from_arrays([pa.array(hits[:, k]) for k in (1, 2, 3)], fields=list(_ARROW_RUN)))
        more = [pa.array([len(s) for s in sequences], pa.int64()), lists, pa.array(texts, pa.binary()).cast(pa.string())]
        return pa.RecordBatch.from_arrays([*rows.columns, *more], names=[*names, "n_words", "runs", "collapsed"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = Numbers()
        for b in batches:
            lo, held, sequences = 0, 0, []
            texts, ids = b.column(at).cast(pa.binary()), b.column(by).to_pylist()
            for k in range(b.num_rows):
                words = numbers.of(texts[k].as_py() or b"")
                places = rewrite(ids[k], len(words)) if rewrite else None
                sequences.append(words if places is None else words[places])
                held += len(words)
                if held >= CHUNK_WORDS or k == b.num_rows - 1:
                    yield found(b.slice(lo, k + 1 - lo), sequences, numbers)
                    lo, held, sequences = k + 1, 0, []
                    if len(numbers) > KEPT_WORDS:
                        numbers = Numbers()

    return docs.mapInArrow(search, schema)


def some_periodic(doc_id: int | None, n: int) -> np.ndarray | None:
    """Rearranges a tenth of the documents, by the crc32 of the id, into a
    prefix and a period that repeats to the end."""
    if doc_id is None or not n:
        return None
    h = crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    places = np.arange(n)
    places[a:] = a + (places[a:] - a) % p
    return places


@query("op12_periodic_runs")
def op12_periodic_runs(spark, sf_dir):
    found = periodic_runs(table(spark, sf_dir, "documents").select("doc_id", "text"), rewrite=some_periodic)
    # the longest; of equal ones that of the smallest start, then period
    best = F.array_sort(F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("s"), r["period"].alias("p"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]))
    digest = found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.get(best, F.lit(0)).alias("best"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
    longest = {"start": "best.s", "length": "-best.l", "period": "best.p", "exponent_milli": "-1000 * best.l div best.p"}
    return digest.select("doc_id", "n_runs", *[F.expr(e).alias(n) for n, e in longest.items()], "runs_sha256", "collapsed_sha256")
