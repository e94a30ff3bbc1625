"""Helpers shared by the text operators: scratch tables in the cluster's shared
folder and positions inside a sorted key without bringing a key together."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from taxaweave.session import scratch_made, shared_dir, shuffles_freed

#: Registered queries of this subpackage: name -> (function, DuckDB SQL or None).
QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


#: For bytes.translate: ASCII letters to lower case, other ASCII but digits to a space.
NORMAL = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


#: Very long texts are taken apart at blanks, about so many bytes at a time.
PIECE_BYTES = 4 << 20
_BLANK = re.compile(rb"[ \t-\r]")


def cut_at_blanks(text: bytes, size: int | None = None) -> list[bytes]:
    """The text in pieces that part no word (of ASCII white space between words)."""
    size = size or PIECE_BYTES
    out, lo = [], 0
    while len(text) - lo > size and (blank := _BLANK.search(text, lo + size)):
        out.append(text[lo : blank.start()])
        lo = blank.start()
    return [*out, text[lo:]]


def query(name: str, sql: str | None = None):
    def put(fn):
        QUERIES[name] = (fn, sql)
        return fn

    return put


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, scheme kept."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: cuts the lineage, is computed
    once, and survives the loss of executors. The shuffles behind it are deleted
    as soon as it is whole."""
    path = scratch(df.sparkSession, name)
    scratch_made(path)
    with shuffles_freed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ranked(df: DataFrame, key: str, order: list[str], weight: str | None = None, at: str = "pos", before: str = "before") -> DataFrame:
    """Adds ``at``: the 0-based position of each row inside its ``key`` in
    ``order``, and with ``weight`` also ``before``: the sum of the weights of
    the key's earlier rows. ``key`` must not be null.

    One range exchange on (key, order) cuts even a single key into many
    partitions. A task numbers its own rows and leaves one footer row; the
    footers (one per partition) carry the counts of a key that runs over a
    partition's end into the next ones. ``df`` should be narrow and cheap to
    scan (range bounds take a second pass over it).
    """
    spark = df.sparkSession
    schema = T.StructType(
        [T.StructField(f.name, f.dataType, True) for f in df.schema.fields]
        + [T.StructField(n, T.LongType(), True) for n in ("_pid", "_run", at, before, "_foot")]
    )
    names = df.columns

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid, run, last, n, w = TaskContext.get().partitionId(), 0, None, 0, 0
        kind = None
        for b in batches:
            if not b.num_rows:
                continue
            kind = b.schema
            keys = b.column(names.index(key))
            size = b.num_rows
            new = np.ones(size, bool)
            new[1:] = pc.not_equal(keys.slice(1), keys.slice(0, size - 1)).to_numpy(zero_copy_only=False)
            first = keys[0].as_py()
            new[0] = last is not None and first != last
            if last is None:
                last = first
            runs = np.cumsum(new)
            starts = np.flatnonzero(new)
            here = np.zeros(size, np.int64)
            here[starts] = starts
            here = np.maximum.accumulate(here)
            pos = np.arange(size) - here + np.where(runs == 0, n, 0)
            weights = np.ones(size, np.int64) if weight is None else b.column(names.index(weight)).to_numpy(zero_copy_only=False).astype(np.int64)
            total = np.concatenate([[0], np.cumsum(weights)])
            cum = total[:-1] - total[here] + np.where(runs == 0, w, 0)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, *map(pa.array, (np.full(size, pid), runs + run, pos, cum)), pa.nulls(size, pa.int64())],
                names=[*names, "_pid", "_run", at, before, "_foot"],
            )
            run, last = run + int(runs[-1]), keys[size - 1].as_py()
            n, w = int(pos[-1]) + 1, int(cum[-1] + weights[-1])
        if kind is not None:  # the key of the last run, its rows and its weight here
            foot = {f.name: pa.nulls(1, f.type) for f in kind} | {key: pa.array([last], kind.field(key).type)}
            more = [pa.array([x], pa.int64()) for x in (pid, run, n, w, 1)]
            yield pa.RecordBatch.from_arrays([*foot.values(), *more], names=[*foot, "_pid", "_run", at, before, "_foot"])

    cols = [key, *order]
    done = written(df.repartitionByRange(*cols).sortWithinPartitions(*cols).mapInArrow(number, schema), "ranked")
    feet = done.where("_foot = 1").select("_pid", "_run", key, at, before).orderBy("_pid").collect()  # one row per partition
    lead, carry = [], (None, 0, 0)
    for pid, run, last, n, w in feet:
        lead.append((pid, carry[0], carry[1], carry[2]))
        same = run == 0 and carry[0] is not None and carry[0] == last
        carry = (last, n + carry[1], w + carry[2]) if same else (last, n, w)
    leads = spark.createDataFrame(lead, T.StructType([T.StructField("_pid", T.LongType()), T.StructField("_key", df.schema[key].dataType), T.StructField("_n", T.LongType()), T.StructField("_w", T.LongType())]))
    on = done.where("_foot is null").join(F.broadcast(leads), "_pid")  # bounded by the number of partitions
    led = (F.col("_run") == 0) & F.col("_key").eqNullSafe(F.col(key))
    on = on.withColumn(at, F.col(at) + F.when(led, F.col("_n")).otherwise(0)).withColumn(before, F.col(before) + F.when(led, F.col("_w")).otherwise(0))
    return on.select(*names, at, *([before] if weight else []))
