"""Raw and model tables that change in one step.

A table is a folder. Every load writes a Parquet folder of its own
(``load=<key>``), and only then a small commit file that lists the loads that
make up the table, its schema and row counts. Readers take the newest commit, so
a load that fails half-way is never seen, a full refresh keeps the old rows
readable until the new ones are whole, and a table can be refreshed from
itself. A commit is a rename to the next number: of two writers who start from
the same commit one fails with :class:`Conflict`.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_COMMITS = "_commits"
LOAD = "load"


class Conflict(RuntimeError):
    """Another writer committed first."""


class Incomplete(RuntimeError):
    """A load holds another number of rows than was written."""


@dataclass(frozen=True)
class Commit:
    """One state of a table; ``rows`` by load key, in load order."""

    number: int = 0
    rows: dict[str, int] = field(default_factory=dict)
    schema: T.StructType = field(default_factory=T.StructType)
    partitions: tuple[str, ...] = ()


def _hadoop(spark: SparkSession, path: str):
    """(file context, file system, path, package) of the Hadoop API."""
    package = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = package.Path(path)
    fs = p.getFileSystem(conf)
    p = fs.makeQualified(p)
    return package.FileContext.getFileContext(p.toUri(), conf), fs, p, package


def read_text(spark: SparkSession, path: str) -> str:
    """A small file as text."""
    _, fs, file, _ = _hadoop(spark, path)
    stream = fs.open(file)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _merged(old: T.StructType, new: T.StructType) -> T.StructType:
    """Columns by name (of either case): the old ones, then new ones; a changed type fails."""
    types = {f.name.lower(): f.dataType for f in old}
    for f in new:
        if types.get(f.name.lower(), f.dataType) != f.dataType:
            raise TypeError(f"column {f.name} changes from {types[f.name.lower()].simpleString()} to {f.dataType.simpleString()}")
    more = [f for f in new if f.name.lower() not in types]
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in (*old, *more)])


class Table:
    """A published table at ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _numbers(self) -> list[int]:
        _, fs, folder, _ = _hadoop(self.spark, f"{self.path}/{_COMMITS}")
        names = [st.getPath().getName() for st in fs.listStatus(folder)] if fs.exists(folder) else []
        return sorted(int(n) for n in names if n.isdigit())

    def commit(self, number: int | None = None) -> Commit:
        """The newest state, or an older one by number (0 is the empty table)."""
        numbers = self._numbers()
        number = (numbers or [0])[-1] if number is None else number
        if number == 0:
            return Commit()
        state = json.loads(read_text(self.spark, f"{self.path}/{_COMMITS}/{number:010d}"))
        return Commit(number, state["rows"], T.StructType.fromJson(state["schema"]), tuple(state["partitions"]))

    def _put(self, state: Commit) -> None:
        """Writes ``state`` beside the commits and renames it to its number."""
        context, fs, target, package = _hadoop(self.spark, f"{self.path}/{_COMMITS}/{state.number:010d}")
        draft = package.Path(f"{self.path}/{_COMMITS}/.{uuid.uuid4().hex}")
        out = fs.create(draft, False)
        try:
            body = {"rows": state.rows, "schema": state.schema.jsonValue(), "partitions": list(state.partitions)}
            out.write(bytearray(json.dumps(body), "utf-8"))
        finally:
            out.close()
        options = self.spark.sparkContext._gateway.new_array(getattr(package, "Options$Rename"), 0)
        try:
            context.rename(fs.makeQualified(draft), target, options)  # never replaces
        except Exception as failed:
            fs.delete(draft, False)
            if fs.exists(target):
                raise Conflict(f"commit {state.number} of {self.path} exists") from failed
            raise

    def _load(self, df: DataFrame, key: str, partition_by: Sequence[str]) -> int:
        """Writes one load and counts it again from the stored files."""
        written = Observation("load")
        folder = f"{self.path}/{LOAD}={key}"
        writer = df.observe(written, F.count(F.lit(1)).alias("n")).write.mode("overwrite")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(folder)
        found = self._stored([key], df.schema, tuple(partition_by)).count()
        if found != written.get["n"]:
            raise Incomplete(f"{folder}: {written.get['n']} rows written, {found} stored")
        return found

    def refresh(self, df: DataFrame, partition_by: Sequence[str] = ()) -> Commit:
        """Replaces all rows by those of ``df``, which may read this table."""
        old = self.commit()
        key = uuid.uuid4().hex
        new = Commit(old.number + 1, {key: self._load(df, key, partition_by)}, _merged(T.StructType(), df.schema), tuple(partition_by))
        self._put(new)
        return new

    def append(
        self, df: DataFrame, key: str | None = None, partition_by: Sequence[str] = (), check: Callable[[DataFrame], None] | None = None
    ) -> Commit:
        """Adds the rows of ``df``, columns by name. A load of a ``key`` that is
        committed already adds nothing; an uncommitted one is written anew.
        ``check`` is given the stored load before it is committed."""
        old = self.commit()
        key = key or uuid.uuid4().hex
        if key in old.rows:
            return old
        if old.number and old.partitions != tuple(partition_by):
            raise ValueError(f"{self.path} is partitioned by {old.partitions}")
        schema = _merged(old.schema, df.schema)
        new = Commit(old.number + 1, old.rows | {key: self._load(df, key, partition_by)}, schema, tuple(partition_by))
        if check:
            check(self._stored([key], schema, new.partitions))
        self._put(new)
        return new

    def _stored(self, keys: Sequence[str], schema: T.StructType, partitions: tuple[str, ...]) -> DataFrame:
        if not keys:
            return self.spark.createDataFrame([], schema)
        # partition columns stand behind the others in a stored table
        files = T.StructType([*(f for f in schema if f.name not in partitions), T.StructField(LOAD, T.StringType()), *(f for f in schema if f.name in partitions)])
        reader = self.spark.read.schema(files).option("basePath", self.path)
        return reader.parquet(*[f"{self.path}/{LOAD}={k}" for k in keys]).select(*[F.col(f"`{n}`") for n in schema.names])

    def read(self, number: int | None = None, loads: Sequence[str] | None = None) -> DataFrame:
        """The rows of the newest commit, or of an older one, or of some loads;
        a column that a load lacks is NULL there."""
        state = self.commit(number)
        return self._stored(list(state.rows) if loads is None else list(loads), state.schema, state.partitions)

    def vacuum(self, keep: int = 1) -> list[str]:
        """Deletes the loads (also failed ones) that none of the newest ``keep``
        commits names, and older commits. Returns the keys of deleted loads."""
        numbers = self._numbers()
        kept = {key for n in numbers[-keep:] for key in self.commit(n).rows}
        _, fs, folder, package = _hadoop(self.spark, self.path)
        loads = [st.getPath() for st in fs.listStatus(folder) if st.getPath().getName().startswith(f"{LOAD}=")]
        old = [p for p in loads if p.getName().removeprefix(f"{LOAD}=") not in kept]
        for p in old:
            fs.delete(p, True)
        for n in numbers[:-keep]:
            fs.delete(package.Path(f"{self.path}/{_COMMITS}/{n:010d}"), False)
        return sorted(p.getName().removeprefix(f"{LOAD}=") for p in old)
