"""Benchmark decontamination with an Aho-Corasick automaton.

Texts are normalised to lower-case words (A-Z only) parted by one space; the
automaton holds every window of ``window`` consecutive words of the benchmark
items (an item of fewer words is one window) and scans a text once. Matches are
mapped to word numbers and to code point offsets of the original text.

The automaton's size is bounded: a benchmark of more than ``automaton_words``
words is dealt into groups of items, each with an automaton and a pass of its
own over the documents; the marks of earlier passes travel with the row.

Nulls: a null text has no words; a null item text or item id is no item. An
empty benchmark marks nothing, an empty table gives no rows, equal rows are
marked each on their own. Columns of the input with the name of an added one
are replaced by it; all others are kept.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from taxaweave.llm.common import NORMAL, query, table

WINDOW = 10
#: Words of benchmark items one automaton holds at most, about (some 4 kB each).
AUTOMATON_WORDS = 50_000

_AUTOMATA: dict[str, object] = {}


def words(data: bytes | None) -> list[bytes]:
    return (data or b"").translate(NORMAL).split()


def windows(item_words: list[bytes], window: int) -> list[list[bytes]]:
    if len(item_words) <= window:
        return [item_words] if item_words else []
    return [item_words[i : i + window] for i in range(len(item_words) - window + 1)]


def automaton(items: list[tuple[str, bytes]], window: int):
    """Maps each window, spaces around it, to (its words, the items that have it)."""
    import ahocorasick

    held: dict[bytes, tuple[int, set[str]]] = {}
    for item, text in items:
        for w in windows(words(text), window):
            held.setdefault(b" " + b" ".join(w) + b" ", (len(w), set()))[1].add(item)
    auto = ahocorasick.Automaton()
    for pattern, (n, ids) in held.items():
        auto.add_word(pattern.decode("latin-1"), (len(pattern), n, sorted(ids)))
    if held:
        auto.make_automaton()
    return auto if held else None


def scan(auto, parts: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
    """Merged (first word, last word + 1) runs of hit words, and the items met."""
    text = b" " + b" ".join(parts) + b" "
    runs: list[tuple[int, int]] = []
    items: set[str] = set()
    at, seen = 0, 0  # words begun before byte ``at``
    found = sorted((end - size + 1, n, ids) for end, (size, n, ids) in auto.iter(text.decode("latin-1")))
    for start, n, ids in found:
        seen += text.count(b" ", at, start)
        at = start
        runs.append((seen, seen + n))
        items.update(ids)
    return merged(runs), items


def merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for lo, hi in sorted(runs):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def spans(data: bytes, runs: list[tuple[int, int]]) -> list[dict[str, int]]:
    """Code point offsets in the original text of runs of words."""
    if not runs:
        return []
    raw = np.frombuffer(data, np.uint8)
    word = np.frombuffer(data.translate(NORMAL), np.uint8) != 32
    edge = np.diff(np.concatenate([[0], word.view(np.int8), [0]]))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    chars = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    return [{"start": int(chars[starts[lo]]), "end": int(chars[ends[hi - 1]])} for lo, hi in runs]


SPAN = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
ADDED = ["n_words", "hit_runs", "item_ids", "hit_spans"]


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, automaton_words: int = AUTOMATON_WORDS) -> DataFrame:
    """Adds ``n_words``, ``hit_runs`` (word numbers), ``item_ids`` (as sorted
    strings) and ``hit_spans`` (code points of the original) to every row."""
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("binary").alias("text")).where("item is not null and text is not null")
    size = F.size(F.split(F.decode("text", "UTF-8"), r"[^\x{80}-\x{10FFFF}0-9A-Za-z]+"))
    total = items.agg(F.sum(size)).first()[0] or 0
    groups = -(-total // automaton_words) or 1
    out = docs.drop(*ADDED)
    kept = [F.col(f"`{c}`") for c in out.columns]
    out = out.select(*kept, F.lit(0).cast("long").alias("n_words"), F.array().cast("array<array<int>>").alias("hit_runs"), F.array().cast("array<string>").alias("item_ids"), F.array().cast(T.ArrayType(SPAN)).alias("hit_spans"))
    for g in range(groups):
        own = items if groups == 1 else items.where(F.pmod(F.xxhash64("item"), F.lit(groups)) == g)
        rows = [(r["item"], bytes(r["text"])) for r in own.collect()]  # about automaton_words words
        out = _marked(out, spark.sparkContext.broadcast(rows), window, last=g == groups - 1)
    return out


def _marked(docs: DataFrame, items, window: int, last: bool) -> DataFrame:
    names = docs.columns
    text_at = names.index("text")
    key = uuid.uuid4().hex

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _AUTOMATA:
            _AUTOMATA.clear()
            _AUTOMATA[key] = automaton(items.value, window)
        auto = _AUTOMATA[key]
        for whole in batches:
            for lo in range(0, whole.num_rows, 512):
                b = whole.slice(lo, 512)
                n, runs, ids, at = [], [], [], []
                old = zip(b.column(text_at).cast(pa.binary()).to_pylist(), b.column(len(names) - 3).to_pylist(), b.column(len(names) - 2).to_pylist(), strict=True)
                for data, was, met in old:
                    parts = words(data)
                    hit, found = scan(auto, parts) if auto is not None and parts else ([], set())
                    hit = merged([*map(tuple, was), *hit])
                    n.append(len(parts))
                    runs.append([list(x) for x in hit])
                    ids.append(sorted(found.union(met)))
                    at.append(spans(data, hit) if last else [])
                kinds = [b.schema.field(k).type for k in range(len(names) - 4, len(names))]
                made = [pa.array(v, k) for v, k in zip((n, runs, ids, at), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([*b.columns[:-4], *made], schema=b.schema)

    return docs.mapInArrow(mark, docs.schema)



WORDS_SQL = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLE = f"""
WITH d AS (SELECT doc_id, {WORDS_SQL} AS w FROM documents),
b AS (SELECT item_id, {WORDS_SQL} AS w FROM benchmark WHERE item_id IS NOT NULL),
bw AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS s
  FROM (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)
),
dw AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS s
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)
),
m AS (SELECT doc_id, i, dw.n, item_id FROM dw JOIN bw USING (n, s)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM m) GROUP BY doc_id),
it AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM m) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)
"""


@query("op8_benchmark_decontamination", ORACLE)
def op8_benchmark_decontamination(spark, sf_dir):
    marked = decontaminate(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("hit_runs", F.lit(0).cast("long"), lambda n, r: n + r[1] - r[0])
    return marked.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )
