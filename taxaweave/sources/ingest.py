"""Robust delimited-file ingest (A1-A19) on Spark readers and writers.

The unit of parallelism is the input split, not a hand-made chunk: large
files are read by many tasks, small files are packed together. Of the data
only file names and header lines (a small row per file) reach the driver, to
read files of one form together and to match their columns by name.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from taxaweave.session import scratch_table
from taxaweave.sources.tables import Table

CORRUPT_COL = "_corrupt_record"

# FIXED VALUES: suffixes treated as delimited text, and the encoding tried
# after UTF-8 (Spark/Java spelling of latin-1).
DELIMITED_SUFFIXES = ("csv", "tsv", "txt")
FALLBACK_ENCODING = "ISO-8859-1"

# Whitespace stripped by line repair (Python ``str.strip`` on ASCII input).
_WS = "[ \\t\\r\\n\\f\\x0B]"


def _glob_for(suffixes: Sequence[str]) -> str:
    """Case-insensitive Hadoop glob such as ``*.{[cC][sS][vV],[tT][sS][vV]}``."""
    alts = ["".join(f"[{ch.lower()}{ch.upper()}]" if ch.isalpha() else ch for ch in s) for s in suffixes]
    return "*.{" + ",".join(alts) + "}"


# ---------------------------------------------------------------------------
# Discovery, naming, registry
# ---------------------------------------------------------------------------


def _status(spark: SparkSession, path: str) -> str:
    """``file``, ``folder`` (also for a pattern that matches) or ``missing``."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    p = hadoop.Path(path)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    if not found:
        return "missing"
    return "file" if len(found) == 1 and found[0].isFile() else "folder"


FILES = "path string, file_name string, stem string, suffix string, length long"


def list_files(spark: SparkSession, path: str, suffixes: Sequence[str] = DELIMITED_SUFFIXES) -> DataFrame:
    """Delimited files below ``path`` (recursive, suffix compared case-insensitively)
    as a DataFrame (path, file_name, stem, suffix, length) (A1). A path that is
    itself a file is listed whatever its suffix; a missing path lists nothing.

    Uses the binary-file source with only metadata columns selected, so file
    contents are not read; listing runs on the cluster.
    """
    status = _status(spark, path)
    if status == "missing":
        return spark.createDataFrame([], FILES)
    reader = spark.read.format("binaryFile")
    if status == "folder":
        reader = reader.option("recursiveFileLookup", "true").option("pathGlobFilter", _glob_for(suffixes))
    df = reader.load(path).select("path", "length")
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    return df.select(
        "path",
        name.alias("file_name"),
        F.regexp_extract(name, r"^(.*?)(\.[^.]*)?$", 1).alias("stem"),
        F.lower(F.regexp_extract(name, r"\.([^.]*)$", 1)).alias("suffix"),
        "length",
    )


def delimited_files(spark: SparkSession, paths: str | Sequence[str]) -> list[str]:
    """The files that ``paths`` (files, folders, patterns) stand for, each once:
    one job for all folders, none for files."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    found, folders = [], []
    for path in [paths] if isinstance(paths, str) else paths:
        status = _status(spark, path)
        if status == "file":
            p = hadoop.Path(path)
            found.append(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toString())
        elif status == "folder":
            folders.append(path)
    if folders:
        reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", _glob_for(DELIMITED_SUFFIXES))
        found += [r["path"] for r in reader.load(folders).select("path").collect()]  # file names
    return sorted(set(found))


def clean_key(name: Column | str) -> Column:
    """Table-name rule: lower-case, ``-`` and space become ``_`` (A2)."""
    c = F.col(name) if isinstance(name, str) else name
    return F.lower(F.translate(c, "- ", "__"))


def source_key(key: str, stem: Column | str, n_files: Column | int) -> Column:
    """``key`` for a single-file source, ``key_<stem>`` otherwise, cleaned (A2)."""
    stem_c = F.col(stem) if isinstance(stem, str) else stem
    n = F.lit(n_files) if isinstance(n_files, int) else n_files
    return clean_key(F.when(n == 1, F.lit(key)).otherwise(F.concat(F.lit(key + "_"), stem_c)))


def read_sources(spark: SparkSession, key: str, path: str, **options) -> dict[str, DataFrame]:
    """One table per file of a source, named by :func:`source_key` (A2): ``key``
    for a single file, ``key_<stem>`` for each of several."""
    files = list_files(spark, path)
    n = files.count()
    named = files.select("path", source_key(key, "stem", n).alias("table")).orderBy("table", "path").collect()  # a row per file
    tables: dict[str, DataFrame] = {}
    for r in named:
        own = read_delimited(spark, [r["path"]], **options)
        tables[r["table"]] = tables[r["table"]].unionByName(own, allowMissingColumns=True) if r["table"] in tables else own
    return tables


@dataclass(frozen=True)
class Source:
    """A named raw source: where it lives, its description, and reader options."""

    name: str
    path: str
    description: str = ""
    sep: str | None = None
    filter: str | None = None
    schema: T.StructType | None = None


class SourceRegistry:
    """Name -> Source (A18); ``read`` returns the raw all-text DataFrame."""

    def __init__(self, sources: Iterable[Source] = ()):
        self._sources = {s.name: s for s in sources}

    def add(self, source: Source) -> None:
        self._sources[source.name] = source

    def names(self) -> list[str]:
        return sorted(self._sources)

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        s = self._sources[name]
        df = read_delimited(spark, s.path, sep=s.sep, schema=s.schema)
        return df.where(F.expr(s.filter)) if s.filter else df

    def register_views(self, spark: SparkSession) -> None:
        for n in self._sources:
            self.read(spark, n).createOrReplaceTempView(n)


# ---------------------------------------------------------------------------
# reading
# ---------------------------------------------------------------------------


def _text_options(sep: str) -> dict:
    return {"sep": sep, "mode": "PERMISSIVE", "quote": '"', "escape": '"'}


def reader_options(sep: str = ",", header: bool = True, encoding: str | None = None, multiline: bool = False, corrupt: bool = False) -> dict:
    """The options of every delimited read, batch or stream."""
    options = {**_text_options(sep), "header": header, "inferSchema": False, "multiLine": multiline}
    if encoding:
        options["encoding"] = encoding
    if corrupt:
        options["columnNameOfCorruptRecord"] = CORRUPT_COL
    return options


def plain_path(encoded: Column) -> Column:
    """The metadata column's file path as readers take it: not URL-encoded."""
    return F.url_decode(F.replace(encoded, F.lit("+"), F.lit("%2B")))


#: Delimiters looked for (A5); a file's suffix breaks ties.
DELIMITERS = (",", "\t", ";", "|")


def _suffix_delimiter(path: str) -> str:
    return "\t" if path.lower().endswith(".tsv") else ","


def file_forms(spark: SparkSession, paths: Sequence[str], delimiters: Sequence[str] = DELIMITERS, encoded: bool = False) -> DataFrame:
    """(path, line, delimiter) per file: its first line, and the delimiter that
    cuts its lines most evenly (A5). One distributed scan of the text; lines of a
    file's first block are looked at.

    For each candidate the fields of every line are counted, outside of quotes,
    into a histogram per file. The share of lines with the most frequent number of
    two or more fields says how even a cut is; the greatest share wins if it is
    over a half, of equal shares the suffix's delimiter, then the one with more
    fields. Otherwise the suffix decides. Of ``encoded`` files ``line`` is the
    line's bytes in hex.
    """
    lines = spark.read.text(list(paths)).select(plain_path(F.col("_metadata.file_path")).alias("path"), F.col("_metadata.file_block_start").alias("at"), "value")
    return _forms(lines.where("at = 0").withColumn("n", F.monotonically_increasing_id()), delimiters, encoded)


#: Lines that show the form of files that are known to have one form.
HEAD_LINES = 1000


def _one_form(spark: SparkSession, path: str) -> str:
    """The delimiter of one file by its first lines; nothing else is read."""
    head = spark.createDataFrame([(path, r["value"], n) for n, r in enumerate(spark.read.text(path).head(HEAD_LINES))], "path string, value string, n long")
    found = _forms(head, DELIMITERS, False).first()
    return found["delimiter"] if found else _suffix_delimiter(path)


def _forms(lines: DataFrame, delimiters: Sequence[str], encoded: bool) -> DataFrame:
    """:func:`file_forms` of lines (path, value, n: their order)."""
    bare = F.regexp_replace("value", '"[^"]*"', "")
    cuts = F.array(*[(F.octet_length(bare) - F.octet_length(F.replace(bare, F.lit(d), F.lit("")))).alias(f"d{i}") for i, d in enumerate(delimiters)])
    line = F.hex(F.col("value").cast("binary")) if encoded else F.col("value")
    seen = lines.groupBy("path", F.when(F.trim("value") != "", cuts).alias("cuts")).agg(
        F.count(F.lit(1)).alias("lines"), F.min(F.struct("n", line.alias("line"))).alias("first")
    )
    by_file = seen.groupBy("path").agg(F.min("first")["line"].alias("line"))
    histogram = seen.where("cuts is not null").select("path", "lines", F.posexplode("cuts").alias("delimiter", "cut"))
    histogram = histogram.groupBy("path", "delimiter", "cut").agg(F.sum("lines").alias("lines"))
    most = F.max(F.when(F.col("cut") > 0, F.struct("lines", "cut")))
    even = histogram.groupBy("path", "delimiter").agg((F.coalesce(most["lines"], F.lit(0)) / F.sum("lines")).alias("share"), most["cut"].alias("cut"))
    usual = F.when(F.lower("path").endswith(".tsv"), F.lit("\t")).otherwise(F.lit(","))
    named = F.array(*[F.lit(d) for d in delimiters])[F.col("delimiter")]
    best = even.where("share > 0.5").groupBy("path").agg(F.max(F.struct("share", (named == usual).alias("usual"), "cut", (-F.col("delimiter")).alias("order"), named.alias("own")))["own"].alias("own"))
    joined = by_file.join(best, "path", "left")
    return joined.select("path", "line", F.coalesce("own", usual).alias("delimiter"))


def _file_forms(spark: SparkSession, paths: Sequence[str], sep: str | None, encoded: bool) -> list[tuple[str, str, str]]:
    """(path, first line, delimiter) per file, one small row each."""
    forms = file_forms(spark, paths, (sep,) if sep else DELIMITERS, encoded)
    return [(r["path"], (r["line"] or "").strip("\ufeff\r"), sep or r["delimiter"]) for r in forms.collect()]


def _own_header(spark: SparkSession, path: str, options: dict) -> tuple[str, str]:
    """(path, column names) as the reader sees them, for encodings and quoted
    headers whose first line does not end at the first line-end byte."""
    return path, "\n".join(spark.read.options(**options).csv(path).columns)


def _stacked(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def read_delimited(
    spark: SparkSession,
    paths: str | Sequence[str],
    sep: str | None = None,
    header: bool = True,
    encoding: str | None = None,
    multiline: bool = False,
    schema: T.StructType | None = None,
    keep_corrupt: bool = False,
    with_path: bool = False,
    repair: bool = False,
    uniform: bool = False,
) -> DataFrame:
    """Read delimited text with every column as text (A3).

    Folders are expanded to their delimited files. ``sep=None`` picks each file's
    delimiter by its lines (:func:`file_forms`, A5), where they do not tell by
    its suffix: tab for ``.tsv``, comma otherwise.
    Files are read together with those of the same delimiter and header line,
    and the groups stacked by column name (a column that a file lacks is NULL
    there). ``with_path`` adds the source file as ``source_file``. Short rows
    are padded with NULL and blank lines skipped (A6). With a ``schema`` columns
    go by position; with ``keep_corrupt=True`` malformed rows are flagged in
    ``_corrupt_record`` instead of being dropped silently (A7). ``repair`` parses
    the malformed lines once more, repaired (A8), under their own file's header:
    those that fit become rows, the others stay malformed. Comparing header lines
    and delimiters scans the text once before it is read; ``uniform`` vouches that
    all files have one of each, and then only the first file's first lines are
    looked at.
    """
    files = delimited_files(spark, paths)
    if not files:
        raise FileNotFoundError(f"no delimited files under {paths}")
    groups: dict[tuple[str, str], list[str]] = {}
    # a header is compared only where it names the columns and there are several files
    named = header and schema is None and len(files) > 1 and not uniform
    if uniform and not sep:
        sep = _one_form(spark, files[0])
    forms = _file_forms(spark, files, sep, bool(encoding)) if named or not sep else [(p, "", sep) for p in files]
    met = {path for path, _, _ in forms}
    forms += [(p, "", sep or _suffix_delimiter(p)) for p in files if p not in met]  # empty files
    if named and encoding and multiline:
        forms = [(*_own_header(spark, p, reader_options(d, header, encoding, multiline)), d) for p, _, d in forms]
    for path, line, own in forms:
        groups.setdefault((own, line if named else ""), []).append(path)
    keep_corrupt = keep_corrupt or repair
    if schema is not None and keep_corrupt and CORRUPT_COL not in schema.fieldNames():
        schema = T.StructType(list(schema.fields) + [T.StructField(CORRUPT_COL, T.StringType(), True)])
    parts = []
    for (own, _line), group in sorted(groups.items()):
        reader = spark.read.options(**reader_options(own, header, encoding, multiline, keep_corrupt))
        own_schema = schema
        if schema is None and keep_corrupt:  # the reader flags rows only where the schema has the column
            own_schema = T.StructType([T.StructField(c, T.StringType(), True) for c in (*reader.csv(group[0]).columns, CORRUPT_COL)])
        df = (reader.schema(own_schema) if own_schema is not None else reader).csv(group)
        if repair:
            df = _parsed_again(df, own, own_schema)
        parts.append(df.withColumn("source_file", plain_path(F.col("_metadata.file_path"))) if with_path else df)
    return _stacked(parts)


def _parsed_again(df: DataFrame, sep: str, schema: T.StructType) -> DataFrame:
    """Rows flagged as corrupt, repaired and parsed again; only those are (a
    conditional expression in the same scan). Lines without content go."""
    bad = F.col(CORRUPT_COL).isNotNull()
    line = repaired_line(F.col(CORRUPT_COL))
    ddl = ", ".join(f"`{f.name.replace('`', '``')}` string" for f in schema)
    parsed = F.when(bad, F.from_csv(line, ddl, {**_text_options(sep), "columnNameOfCorruptRecord": CORRUPT_COL}))
    tried = df.withColumn("__again", parsed).where(~bad | (F.length(line) > 0))
    fits = F.col("__again").isNotNull() & F.col("__again")[CORRUPT_COL].isNull()
    return tried.select(*[F.when(fits, F.col("__again")[c]).otherwise(F.col(f"`{c}`")).alias(c) for c in df.columns])


def split_quarantine(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantined raw lines) from a read with ``keep_corrupt``.

    The flagged rows are written once to scratch: Spark forbids queries that
    reference only the corrupt-record column of a CSV scan, and a cache would
    hold the whole raw input.
    """
    bad = F.col(CORRUPT_COL).isNotNull()
    flagged = scratch_table(df.withColumn("__bad", bad), "quarantine", partition_by=["__bad"])
    good = flagged.where("not __bad").drop(CORRUPT_COL, "__bad")
    return good, flagged.where("__bad").select(F.col(CORRUPT_COL).alias("raw_line"))


def apply_filter(df: DataFrame, condition: str | Column | None) -> DataFrame:
    """Ingest-time predicate (A9). Column names in a SQL string resolve
    case-insensitively; a bad predicate fails the job instead of loading
    unfiltered rows."""
    if condition is None:
        return df
    return df.where(F.expr(condition) if isinstance(condition, str) else condition)


def metrics_frame(df: DataFrame, condition: str | Column) -> DataFrame:
    """Original rows, kept rows and kept share as one aggregate row (A10)."""
    cond = F.expr(condition) if isinstance(condition, str) else condition
    m = df.agg(F.count(F.lit(1)).alias("original_rows"), F.count_if(F.coalesce(cond, F.lit(False))).alias("kept_rows"))
    return m.withColumn(
        "kept_pct",
        F.when(F.col("original_rows") > 0, F.col("kept_rows").cast("double") * 100 / F.col("original_rows").cast("double")),
    )


# ---------------------------------------------------------------------------
# Decoding and line repair
# ---------------------------------------------------------------------------


# Windows code page 1252 differs from Latin-1 in these characters only (Python's
# own codec is the rule); five of its bytes are not assigned.
WINDOWS = "windows-1252"
_C1 = {b: bytes([b]).decode("cp1252", "ignore") for b in range(0x80, 0xA0)}
_C1_ALL = "".join(map(chr, _C1))
_C1_UNASSIGNED = "".join(chr(b) for b, ch in _C1.items() if not ch)
_C1_AS_LATIN, _C1_AS_WINDOWS = "".join(chr(b) for b, ch in _C1.items() if ch), "".join(_C1.values())


def from_latin(text: Column, encoding: str) -> Column:
    """Text that was decoded as Latin-1, in the ``encoding`` it has (Spark's
    readers know no code pages)."""
    return F.translate(text, _C1_AS_LATIN, _C1_AS_WINDOWS) if encoding == WINDOWS else text


def file_encodings(spark: SparkSession, paths: str | Sequence[str], fallback: str = FALLBACK_ENCODING) -> DataFrame:
    """(path, encoding, multiline) per file (A4), from counts of bytes by class in
    one distributed pass (the text source keeps raw bytes):

    * UTF-16 by its byte-order mark; without one, where every tenth byte or more
      is zero, by the parity of the zeros' places in the file's first line: odd
      ones (of low bytes first) are UTF-16LE, even ones UTF-16BE;
    * UTF-8 when every line is valid UTF-8;
    * windows-1252 when there are bytes 0x80-0x9F, all of them assigned there;
    * else ``fallback``.

    ``multiline`` when a line's quotes do not balance (a quoted line break) or
    the file is UTF-16.
    """
    lines = spark.read.text(paths if isinstance(paths, str) else list(paths))
    raw = F.col("value").cast("binary")
    start = F.col("_metadata.file_block_start") == 0
    mark = F.when(start, F.hex(F.substring(raw, 1, 2)))
    without = lambda ch: F.octet_length("value") - F.octet_length(F.replace("value", F.lit(ch), F.lit("")))
    latin = F.when(~F.is_valid_utf8("value"), F.decode(raw, "ISO-8859-1"))
    held = lambda chars: F.coalesce(F.length(latin) - F.length(F.translate(latin, chars, "")), F.lit(0))
    per_line = lines.select(
        plain_path(F.col("_metadata.file_path")).alias("path"),
        F.is_valid_utf8("value").alias("ok"),
        F.coalesce(mark.isin("FFFE", "FEFF"), F.lit(False)).alias("marked"),
        (without('"') % 2 == 1).alias("open"),
        F.octet_length("value").alias("bytes"),
        without("\u0000").alias("zeros"),
        F.when(start, F.struct(F.monotonically_increasing_id().alias("n"), F.substring(raw, 1, 1000).alias("head"))).alias("first"),
        held(_C1_ALL).alias("c1"),
        held(_C1_UNASSIGNED).alias("unassigned"),
    )
    by = per_line.groupBy("path").agg(
        *[F.bool_and("ok").alias("utf8"), F.bool_or("marked").alias("marked"), F.bool_or("open").alias("open")],
        *[F.sum(c).alias(c) for c in ("bytes", "zeros", "c1", "unassigned")],
        F.min("first")["head"].alias("head"),
    )
    places = F.sequence(F.lit(0), F.octet_length("head") - 1)
    zeros_at = lambda odd: F.size(F.filter(places, lambda i: (i % 2 == odd) & (F.hex(F.substring("head", i + 1, F.lit(1))) == "00")))
    many_zeros = (F.col("zeros") > 0) & (F.col("zeros") * 10 >= F.col("bytes"))
    encoding = (
        F.when(F.col("marked"), "UTF-16")
        .when(many_zeros & (F.octet_length("head") > 1) & (zeros_at(1) >= zeros_at(0)), "UTF-16LE")
        .when(many_zeros, "UTF-16BE")
        .when(F.col("utf8"), "UTF-8")
        .when((F.col("c1") > 0) & (F.col("unassigned") == 0), WINDOWS)
        .otherwise(fallback)
    )
    found = by.select("path", encoding.alias("encoding"), "open")
    return found.select("path", "encoding", (F.col("open") | F.col("encoding").startswith("UTF-16")).alias("multiline"))


def _by_encoding(spark: SparkSession, paths: str | Sequence[str], fallback: str) -> dict[tuple[str, bool], list[str]]:
    """Files by (encoding, multiline); a row per file reaches the driver."""
    groups: dict[tuple[str, bool], list[str]] = {}
    for row in file_encodings(spark, paths, fallback).toLocalIterator():
        groups.setdefault((row["encoding"], row["multiline"]), []).append(row["path"])
    if not groups:
        raise FileNotFoundError(f"no files under {paths}")
    return dict(sorted(groups.items()))


def read_with_fallback(
    spark: SparkSession,
    paths: str | Sequence[str],
    sep: str | None = None,
    header: bool = True,
    fallback: str = FALLBACK_ENCODING,
) -> DataFrame:
    """Read delimited files, each decoded with its own detected encoding (A4).

    Files are grouped by encoding and by whether they need the multi-line
    reader (a whole file per task); all others are split into many tasks. Only
    a row per file reaches the driver. Unlike a first-success loop, no file
    loses its non-UTF-8 rows.
    """
    parts = []
    for (encoding, multiline), files in _by_encoding(spark, paths, fallback).items():
        df = read_delimited(spark, files, sep=sep, header=header, encoding=FALLBACK_ENCODING if encoding == WINDOWS else encoding, multiline=multiline)
        if encoding == WINDOWS:
            names = [c.translate(dict(zip(map(ord, _C1_AS_LATIN), _C1_AS_WINDOWS))) for c in df.columns]
            df = df.select(*[from_latin(F.col(f"`{c}`"), WINDOWS).alias(n) for c, n in zip(df.columns, names)])
        parts.append(df)
    return _stacked(parts)


def decode_lines(spark: SparkSession, paths: str | Sequence[str], fallback: str = FALLBACK_ENCODING) -> DataFrame:
    """Lines of text files as (path, value) with per-file decoding (A4, line
    form), by the same detection as :func:`read_with_fallback`. UTF-16 files are
    split at their own line feeds."""
    parts = []
    for (encoding, _), files in _by_encoding(spark, paths, fallback).items():
        wide = encoding.startswith("UTF-16")
        # a marked file's byte order shows in its first line only, so it is read both ways
        orders = ("UTF-16LE", "UTF-16BE") if encoding == "UTF-16" else (encoding,)
        for order in orders:
            reader = spark.read.option("encoding", order).option("lineSep", "\n") if wide else spark.read
            own = files if encoding != "UTF-16" else _with_mark(spark, files, "FFFE" if order == "UTF-16LE" else "FEFF")
            if not own:
                continue
            lines = reader.text(own).select(plain_path(F.col("_metadata.file_path")).alias("path"), F.col("value").cast("binary").alias("raw"))
            text = F.col("raw").cast("string") if encoding == "UTF-8" else F.decode("raw", FALLBACK_ENCODING if encoding == WINDOWS else order)
            text = from_latin(text, encoding)
            parts.append(lines.select("path", (F.regexp_replace(text, "^\ufeff|\r$", "") if wide else text).alias("value")))
    return _stacked(parts)


def _with_mark(spark: SparkSession, files: Sequence[str], mark: str) -> list[str]:
    """The files whose first two bytes are ``mark``."""
    first = spark.read.text(list(files)).where("_metadata.file_block_start = 0").where(F.startswith(F.hex(F.col("value").cast("binary")), F.lit(mark)))
    return [r["path"] for r in first.select(plain_path(F.col("_metadata.file_path")).alias("path")).distinct().collect()]


def repaired_line(line: Column) -> Column:
    """Without NUL and CR characters and white space at the ends."""
    line = F.translate(line, "\u0000\r", "")
    return F.regexp_replace(F.regexp_replace(line, f"^{_WS}+", ""), f"{_WS}+$", "")


def repair_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """Strip NUL and CR characters, trim surrounding whitespace, drop empty
    lines (A8)."""
    return lines.withColumn(col, repaired_line(F.col(col))).where(F.length(col) > 0)


# ---------------------------------------------------------------------------
# Folder trees and headers
# ---------------------------------------------------------------------------

FAMILY_FOLDER_PATTERN = r"([^/]+)_wfo-(\d+)/[^/]+$"


def read_family_folders(
    spark: SparkSession,
    root: str,
    file_glob: str = "classification.csv",
    pattern: str = FAMILY_FOLDER_PATTERN,
    sep: str = ",",
) -> DataFrame:
    """Concatenate the CSV files of the ``<Family>_wfo-<digits>`` folders under
    ``root``, columns by name, and add ``family_name`` and ``wfo_id`` from the
    folder name (A14, A15). Folders without the file and folders of another
    name are skipped."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", file_glob).load(root)
    matched = [r["path"] for r in files.select("path").where(F.col("path").rlike(pattern)).collect()]  # file names
    if not matched:
        raise FileNotFoundError(f"no {file_glob} in family folders under {root}")
    df = read_delimited(spark, matched, sep=sep, with_path=True)
    path = F.col("source_file")
    return df.select(
        *[F.col(f"`{c}`") for c in df.columns if c != "source_file"],
        F.regexp_extract(path, pattern, 1).alias("family_name"),
        F.regexp_extract(path, pattern, 2).alias("wfo_id"),
    )


_HEADER_CHARACTERS = frozenset("abcdefghijklmnopqrstuvwxyz0123456789_")


def sanitize_name(name: str) -> str:
    """A column name of lower-case ASCII letters, digits and underscores: blanks
    at the ends go, inner ones become underscores, all else is left out (A16)."""
    kept = []
    for ch in name.strip().lower():
        ch = "_" if ch == " " else ch
        if ch in _HEADER_CHARACTERS:
            kept.append(ch)
    return "".join(kept)


def sanitize_headers(df: DataFrame) -> DataFrame:
    """Rename every column with :func:`sanitize_name`; fail on collisions."""
    new = [sanitize_name(c) for c in df.columns]
    dupes = {n for n in new if new.count(n) > 1}
    if dupes:
        raise ValueError(f"sanitised column names collide: {sorted(dupes)}")
    return df.toDF(*new)


# ---------------------------------------------------------------------------
# writing
# ---------------------------------------------------------------------------


def as_text(df: DataFrame) -> DataFrame:
    """Every column cast to text (the raw layer's type)."""
    return df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])


def write_raw(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()) -> DataFrame:
    """Store rows as the all-text raw table at ``path`` (A11 overwrite, A12
    append, A19) and return a reader of it. Readers see the old table until the
    new rows are whole (:class:`taxaweave.sources.tables.Table`)."""
    table = Table(df.sparkSession, path)
    if mode not in ("overwrite", "append"):
        raise ValueError(f"mode {mode}")
    (table.refresh if mode == "overwrite" else table.append)(as_text(df), partition_by=partition_by)
    return table.read()


def write_and_count(df: DataFrame, path: str, mode: str = "overwrite") -> tuple[int, int]:
    """Write and verify: (rows written by this load, rows found after it).

    The written count is observed during the write itself and compared with the
    load's stored files before it is committed; a difference raises.
    """
    table = Table(df.sparkSession, path)
    before = sum(table.commit().rows.values()) if mode == "append" else 0
    state = (table.append if mode == "append" else table.refresh)(as_text(df))
    return sum(state.rows.values()) - before, table.read().count()


def write_csv(df: DataFrame, path: str, sep: str = ",", header: bool = True, encoding: str | None = None, mode: str = "overwrite") -> None:
    """CSV with a header row (A17), blanks kept; ``encoding`` writes another charset."""
    blanks = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    w = df.write.mode(mode).options(header=header, sep=sep, quote='"', escape='"', **blanks)
    if encoding:
        w = w.option("encoding", encoding)
    w.csv(path)


def materialize(df: DataFrame, path: str) -> DataFrame:
    """Full-refresh a model table and return a reader of it (A19): the new rows
    are written beside the old ones, counted, and then published in one step, so
    ``df`` may read the table itself."""
    table = Table(df.sparkSession, path)
    table.refresh(df)
    return table.read()
