"""Token files: independent zstandard frames with a trailing seek table.

A file is a valid zstandard stream. Each document has frames of its own (a long
one several of at most ``FRAME_IDS`` ids), so a reader decompresses only what it
was asked for. Behind the frames stand two skippable frames:

* documents: per document its id, its first frame, its number of ids (``<qIQ``),
  preceded by the number of documents, the bytes an id takes and how many of the
  documents, the first ones, have no id (``<IBI``);
* seek table, in the public seekable layout: per frame the compressed size, the
  decompressed size and the low half of the content's xxh64 (``<III``), then the
  number of frames, a descriptor byte and the closing magic (``<IBI``).

Every frame also carries zstandard's own checksum.

Nulls: a null text is an empty document (end id alone); a null doc_id sorts
first and is kept as null. Equal rows are written each. The rows of one doc_id,
or of none, that are more than a file is planned for are dealt to several files
by the hash of their text; equal rows stay together. Other columns are ignored.
An empty table gives no files and no rows.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from taxaweave.llm.common import query, scratch, table
from taxaweave.llm.tokens import encoder, public_path

END_ID = 2
FRAME_IDS = 1 << 16
#: Documents and bytes of text that a file is planned for.
FILE_DOCS = 8_192
FILE_BYTES = 64 << 20

# Fixed values of the zstandard formats.
SKIPPABLE = 0x184D2A5E
SKIPPABLE_DOCS = 0x184D2A50
SEEKABLE = 0x8F92EAB1
HAS_CHECKSUMS = 0x80


def frames(ids: bytes, width: int, level: int = 3) -> tuple[bytes, list[tuple[int, int, int]]]:
    """Compressed frames of one document's little-endian uint32 ids, and their
    seek table entries. ``width`` is 2 where every id of the vocabulary fits."""
    data = np.frombuffer(ids, "<u4").astype("<u2").tobytes() if width == 2 else ids
    press = zstandard.ZstdCompressor(level=level, write_checksum=True)
    out, entries = [], []
    for at in range(0, max(len(data), 1), FRAME_IDS * width):
        raw = data[at : at + FRAME_IDS * width]
        done = press.compress(raw)
        out.append(done)
        entries.append((len(done), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
    return b"".join(out), entries


class Writer:
    """Writes one file; rows come in ascending doc_id order, those without an id first."""

    def __init__(self, sink, width: int):
        self.sink, self.width, self.entries, self.docs, self.without = sink, width, [], [], 0

    def put(self, doc_id: int | None, n_ids: int, body: bytes, entries: Iterable[tuple[int, int, int]]) -> None:
        self.without += doc_id is None
        self.docs.append(struct.pack("<qIQ", doc_id or 0, len(self.entries), n_ids))
        self.entries.extend(entries)
        self.sink.write(body)

    def close(self) -> None:
        docs = struct.pack("<IBI", len(self.docs), self.width, self.without) + b"".join(self.docs)
        table_ = b"".join(struct.pack("<III", *e) for e in self.entries) + struct.pack("<IBI", len(self.entries), HAS_CHECKSUMS, SEEKABLE)
        self.sink.write(struct.pack("<II", SKIPPABLE_DOCS, len(docs)) + docs)
        self.sink.write(struct.pack("<II", SKIPPABLE, len(table_)) + table_)
        self.sink.close()


class Reader:
    """Random access to one file: only the frames asked for are read."""

    def __init__(self, source):
        self.source = source
        size = source.size()
        n, flags, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEKABLE or not flags & HAS_CHECKSUMS:
            raise ValueError("no seek table with checksums")
        tail = size - 9 - 12 * n
        self.table = np.frombuffer(self._at(tail, 12 * n), "<u4").reshape(n, 3).astype(np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.table[:, 0])])
        head = int(self.starts[-1])
        docs = self._at(head, tail - 8 - head)
        if struct.unpack_from("<I", docs)[0] != SKIPPABLE_DOCS:
            raise ValueError("no document table")
        count, self.width, self.without = struct.unpack_from("<IBI", docs, 8)
        rows = np.frombuffer(docs, np.dtype([("doc", "<i8"), ("frame", "<u4"), ("n", "<u8")]), count, 17)
        self.docs, self.first, self.n_ids = rows["doc"], rows["frame"].astype(np.int64), rows["n"].astype(np.int64)

    def _at(self, offset: int, size: int) -> bytes:
        self.source.seek(int(offset))
        data = self.source.read(int(size))
        if len(data) != size:
            raise ValueError("file cut short")
        return data

    def ids(self, k: int) -> np.ndarray:
        """Ids of the k-th document as little-endian uint32."""
        end = self.first[k + 1] if k + 1 < len(self.first) else len(self.table)
        data = self._at(self.starts[self.first[k]], self.starts[end] - self.starts[self.first[k]])
        out, at = [], 0
        press = zstandard.ZstdDecompressor()
        for size, length, check in self.table[self.first[k] : end]:
            raw = press.decompress(data[at : at + size], max_output_size=int(length)) if length else b""
            if len(raw) != length or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != check:
                raise ValueError("frame fails its checksum")
            out.append(raw)
            at += int(size)
        return np.frombuffer(b"".join(out), "<u2" if self.width == 2 else "<u4").astype("<u4")

    def find(self, doc_id: int) -> range:
        lo, hi = (np.searchsorted(self.docs[self.without :], doc_id, side) + self.without for side in ("left", "right"))
        return range(int(lo), int(hi))

    def doc_id(self, k: int) -> int | None:
        return None if k < self.without else int(self.docs[k])


def open_store(path: str):
    """File system and path of a URI: the shared folder may be a mounted
    folder (file:) or any store that pyarrow knows."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if ":" in path.split("/")[0] else f"file://{path}")


class Plan:
    """Which file a row goes to: ranges of doc_ids in ascending order, and inside
    the range of a doc_id (or of none) of too many rows the hash of the text."""

    def __init__(self, cuts: list[int], several: dict[int | None, int]):
        ends = set(cuts)
        for doc, parts in several.items():
            if doc is not None and parts > 1:
                ends |= {doc, doc - 1} if doc > -(1 << 63) else {doc}
        self.cuts = np.array(sorted(ends), np.int64)  # a range reaches from behind a cut to the next
        self.parts = np.ones(len(self.cuts) + 2, np.int64)  # range 0: no id
        for doc, parts in several.items():
            self.parts[self._range(doc)] = parts
        self.first = np.concatenate([[0], np.cumsum(self.parts)])
        self.files = int(self.first[-1])

    def _range(self, doc: int | None) -> int:
        return 0 if doc is None else 1 + int(np.searchsorted(self.cuts, doc, "left"))

    def file(self, doc: int | None, text_hash: int) -> int:
        at = self._range(doc)
        return int(self.first[at] + text_hash % self.parts[at])


def planned(narrow: DataFrame, file_docs: int, file_bytes: int) -> Plan:
    """From counts, bytes and quantiles; as many rows as files reach the driver."""
    size = F.octet_length("text").cast("long")
    seen = narrow.agg(F.count("*").alias("n"), F.sum(size).alias("bytes")).first()
    files = max(1, -(-seen["n"] // file_docs), -(-(seen["bytes"] or 0) // file_bytes))
    if files == 1:
        return Plan([], {})
    quantiles = F.percentile_approx("doc_id", [k / files for k in range(1, files)], 10 * files).alias("c")
    per_file = max(1, seen["n"] // files)
    often = narrow.groupBy("doc_id").agg(F.count("*").alias("n")).where(F.col("n") > per_file)
    return Plan(narrow.agg(quantiles).first()["c"] or [], {r["doc_id"]: -(-r["n"] // per_file) for r in often.collect()})


def write_files(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID, file_docs: int = FILE_DOCS, file_bytes: int = FILE_BYTES
) -> DataFrame:
    """Encodes every document and writes files in ascending doc_id order under
    ``folder``; returns the manifest (file_no, path, docs, ids, start): one row
    per file, ``start`` being the ids of all files before it.

    Ranges of doc_ids are planned from the id column and the texts' lengths, so
    texts are encoded once and only compressed frames are shuffled, to one
    partition per file. A file gets a fresh name in each attempt and counts only
    when its attempt's manifest row does; a retried or doubled task leaves a
    stray file, never a broken one.
    """
    spark = docs.sparkSession
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    plan = planned(narrow, file_docs, file_bytes)
    from tokenizers import Tokenizer

    width = 2 if Tokenizer.from_file(tokenizer).get_vocab_size() <= 1 << 16 and end_id < 1 << 16 else 4
    end = np.array([end_id], "<u4").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                ids = part.column(0).to_pylist()
                out = []
                for doc, text in zip(ids, part.column(1).to_pylist(), strict=True):
                    own = enc.ids(text) + end
                    body, entries = frames(own, width)
                    out.append((plan.file(doc, crc32(text or b"")), doc, len(own) // 4, body, np.array(entries, "<u4").tobytes()))
                kinds = (pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=["file_no", "doc_id", "n", "body", "entries"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_store(folder)
        now, writer, docs_, ids_, name = None, None, 0, 0, ""

        def done():
            writer.close()
            return pa.RecordBatch.from_pydict({"file_no": pa.array([now], pa.int32()), "path": [f"{folder}/{name}"], "docs": [docs_], "ids": [ids_]})

        for b in batches:
            for no, doc, count, body, entries in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if no != now:
                    if writer:
                        yield done()
                    now, docs_, ids_, name = no, 0, 0, f"{no:06d}-{uuid.uuid4().hex[:8]}.ids.zst"
                    store.create_dir(root, recursive=True)
                    writer = Writer(store.open_output_stream(f"{root}/{name}", compression=None), width)
                writer.put(doc, count, body, np.frombuffer(entries, "<u4").reshape(-1, 3).tolist())
                docs_, ids_ = docs_ + 1, ids_ + count
        if writer:
            yield done()

    encoded = narrow.mapInArrow(encode, "file_no int, doc_id long, n long, body binary, entries binary")
    dealt = encoded.repartition(plan.files, "file_no").sortWithinPartitions("file_no", F.col("doc_id").asc_nulls_first())
    manifest = dealt.mapInArrow(write, "file_no int, path string, docs long, ids long").collect()  # one small row per file
    rows, start = [], 0
    for r in sorted(manifest, key=lambda r: r["file_no"]):
        rows.append((r["file_no"], r["path"], r["docs"], r["ids"], start))
        start += r["ids"]
    return spark.createDataFrame(rows, "file_no int, path string, docs long, ids long, start long")


def read_files(manifest: DataFrame, with_ids: bool = False, only: list[int] | None = None) -> DataFrame:
    """Documents of the files: doc_id, start, n_tokens, ids_crc32 and, with
    ``with_ids``, ids. ``only``: just these doc_ids, by the seek table."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                store, inner = open_store(path)
                with store.open_input_file(inner) as source:
                    r = Reader(source)
                    first = start + np.concatenate([[0], np.cumsum(r.n_ids)])
                    rows = range(len(r.docs)) if only is None else [k for d in only for k in r.find(d)]
                    out = []
                    for at, k in enumerate(rows):
                        ids = r.ids(k)
                        out.append((r.doc_id(k), int(first[k]), len(ids), crc32(ids.tobytes()), ids if with_ids else None))
                        if len(out) == 512 or at == len(rows) - 1:
                            cols = list(zip(*out, strict=True))
                            arrays = [pa.array(c, pa.int64()) for c in cols[:4]] + ([pa.array(cols[4], pa.list_(pa.int32()))] if with_ids else [])
                            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"][: len(arrays)])
                            out = []

    spread = manifest.select("path", "start", "file_no").repartition(max(1, manifest.count()), "file_no").select("path", "start")
    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if with_ids else ""))


@query("op4_token_files")
def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "token-files")
    return read_files(write_files(table(spark, sf_dir, "documents"), folder, public_path()))
