"""Best-fit packing of token pieces by minimum bin slack.

Which documents have which length does not matter for the packing, only how
many pieces of each length there are. The plan is therefore made over the
histogram of lengths (at most ``capacity`` rows, whatever the input): per bin a
bitset subset-sum finds the fullest feasible combination around the longest
piece left; the combination is taken as many times as the histogram allows and
removed. Spark then ranks the pieces of each length and deals each its place.

Nulls: a null text is an empty document (its end id alone); a null doc_id stays
null. Equal rows are packed each on its own. Other columns are ignored. An
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxaweave.llm.common import query, ranked, table, written
from taxaweave.llm.tokens import encoder, public_path

CAPACITY = 2048
END_ID = 0
#: Texts handed to a Python worker at a time.
BATCH_ROWS = 64

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Token pieces of every document: its ids and ``end_id``, cut only where a
    document is longer than ``capacity``. ``with_ids`` adds the ids."""
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for b in batches:
            out = []
            for lo in range(0, b.num_rows, BATCH_ROWS):
                part = b.slice(lo, BATCH_ROWS)
                for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    ids = enc.ids(text) + end
                    for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                        own = ids[at : at + 4 * capacity]
                        out.append((doc, k, at // 4, len(own) // 4, crc32(own), own if with_ids else None))
                if len(out) >= 10_000 or lo + BATCH_ROWS >= b.num_rows:
                    cols = list(zip(*out, strict=True))
                    arrays = [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=False)]
                    if with_ids:
                        arrays.append(pa.array([np.frombuffer(x, "<u4") for x in cols[5]], pa.list_(pa.int32())))
                    yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: len(arrays)])
                    out = []

    narrow = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary"))
    return narrow.mapInArrow(cut, PIECES + (", ids array<int>" if with_ids else ""))


def fullest(counts: np.ndarray, capacity: int) -> dict[int, int]:
    """length -> how many of them make the fullest bin that holds the longest
    piece left (the longest lengths are tried first, so fillers last)."""
    lengths = np.flatnonzero(counts)[::-1]
    longest = int(lengths[0])
    room = capacity - longest
    chosen = {longest: 1}
    reach, mask, steps = 1, (1 << (room + 1)) - 1, []
    for length in map(int, lengths[lengths <= room]):
        left = min(int(counts[length]) - (length == longest), room // length)
        chunk = 1
        while left > 0:  # multiplicities by doubling chunks
            n = min(chunk, left)
            more = reach | (reach << (n * length)) & mask
            if more != reach:
                steps.append((length, n, reach))
                reach = more
            left, chunk = left - n, chunk * 2
        if reach >> room & 1:
            break
    total = reach.bit_length() - 1
    for length, n, was in reversed(steps):
        if not was >> total & 1:
            total -= n * length
            chosen[length] = chosen.get(length, 0) + n
    return chosen


def bin_plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, per bin, first bin, offset, last rank + 1) rows: the
    pieces of ``length`` with ranks from ``first rank`` on go ``per bin`` at a
    time into bins from ``first bin`` on, starting at ``offset``."""
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        counts[length] = n
    used = np.zeros(capacity + 1, np.int64)
    rows, bins = [], 0
    while counts.any():
        chosen = fullest(counts, capacity)
        times = min(int(counts[length]) // n for length, n in chosen.items())
        offset = 0
        for length, n in chosen.items():
            rows.append((length, int(used[length]), n, bins, offset, int(used[length]) + n * times))
            used[length] += n * times
            counts[length] -= n * times
            offset += n * length
        bins += times
    return rows


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to a materialised table of pieces."""
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}  # <= capacity rows
    plan = np.array(sorted(bin_plan(histogram, capacity)), np.int64).reshape(-1, 6)
    if not len(plan):
        return cut.withColumn("sequence_id", F.lit(0).cast("long")).withColumn("offset", F.lit(0).cast("long"))
    stride = int(plan[:, 5].max()) + 1
    starts = plan[:, 0] * stride + plan[:, 1]
    names = [c for c in cut.columns]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length = b.column(names.index("length")).to_numpy()
            rank = b.column(len(names)).to_numpy()
            row = plan[np.searchsorted(starts, length * stride + rank, "right") - 1]
            nth, slot = np.divmod(rank - row[:, 1], row[:, 2])
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(row[:, 3] + nth), pa.array(row[:, 4] + slot * length)], names=[*names, "sequence_id", "offset"])

    order = ["doc_id", "piece"]
    placed = ranked(cut, "length", order, at="rank")
    schema = ", ".join(f"`{n}` {t}" for n, t in cut.dtypes) + ", sequence_id long, offset long"
    return placed.select(*names, "rank").mapInArrow(place, schema)


def best_fit(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset per piece."""
    return pack(written(pieces(docs, tokenizer, capacity, end_id), "pieces"), capacity)


def sequences(placed: DataFrame) -> DataFrame:
    """The packed sequences of pieces that carry ``ids``: sequence_id, ids,
    and per piece its doc_id, offset and length. A group holds at most one
    capacity of tokens."""
    by = placed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "length", "doc_id", "ids"))).alias("p"))
    return by.select(
        "sequence_id",
        F.flatten("p.ids").alias("ids"),
        F.transform("p", lambda x: F.struct(x["doc_id"].alias("doc_id"), x["offset"].alias("offset"), x["length"].alias("length"))).alias("parts"),
    )


@query("op6_best_fit_packing")
def op6_best_fit_packing(spark, sf_dir):
    return best_fit(table(spark, sf_dir, "documents"), public_path())
