"""Language identification by segmentation-marginalised unigram pieces.

Words are runs of letters in lower case. A language's piece probabilities
(``pieces``) are trained by expectation maximisation on the counts of all its
words; a text's likelihood is the product of its words', each summed over all
cuts into pieces, and the score is the posterior of the best language under the
languages' shares of the training documents.

Counts cover every training document: tasks count words by language, Spark
adds them up, and each round of training spreads the distinct words over the
cluster and sums expected counts by piece. Only a number per (language, piece)
reaches the driver, pieces x languages at most whatever the input.

Nulls: a null text, or one without letters, is ``und`` with score 0; a null lang
teaches nothing; a null doc_id counts as not held out. Equal scores go to the
first language in order. Every row is returned, equal ones each; an empty table
gives no rows, and without training rows every language is ``und``. Input
columns ``lang_pred`` and ``score`` are replaced, all others are kept.
"""

from __future__ import annotations

import string
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from taxaweave.llm import pieces
from taxaweave.llm.common import query, table, written
from taxaweave.llm.toxicity import held_out

ROUNDS = 2
UNKNOWN = "und"
#: Distinct tokens that a task keeps, and twice the tokens it looks up, at a time; characters of a text taken at a time.
KEPT = 600_000
PART = 1 << 20
_LETTERS = regex.compile(r"\p{L}+")
_BLANK = regex.compile(r"\s")


@dataclass
class Languages:
    names: list[str]
    p: np.ndarray  # piece x language
    prior: np.ndarray  # log share of the training documents
    path: str  # of the vocabulary


def tokens_of(text: str) -> Iterator[list[str]]:
    """The text in lower case, split at white space; a very long one in parts."""
    lo = 0
    while len(text) - lo > PART and (blank := _BLANK.search(text, lo + PART)):
        yield text[lo : blank.start()].lower().split()
        lo = blank.start()
    yield text[lo:].lower().split()


def words_of(token: str) -> list[str]:
    """Runs of letters of a token without white space, in lower case already."""
    core = token.strip(string.punctuation)
    return [core] if core.isalpha() else _LETTERS.findall(core)


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, n) over all texts; word is null for the number of documents."""
    docs = docs.select("lang", F.col("text"))

    def flush(counts: dict[str, Counter], n_docs: Counter) -> Iterator[pa.RecordBatch]:
        for lang, tokens in counts.items():
            words: Counter = Counter()
            for token, n in tokens.items():
                for word in words_of(token):
                    words[word] += n
            yield pa.RecordBatch.from_pydict(
                {"lang": pa.array([lang] * (len(words) + 1)), "word": pa.array([None, *words], pa.string()), "n": pa.array([n_docs[lang], *words.values()], pa.int64())}
            )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = {}
        n_docs: Counter = Counter()
        for b in batches:
            texts = b.column(1)
            for k, lang in enumerate(b.column(0).to_pylist()):
                own = counts.setdefault(lang, Counter())
                n_docs[lang] += 1
                for tokens in tokens_of(texts[k].as_py() or ""):
                    own.update(tokens)
                if len(own) > KEPT:
                    yield from flush(counts, n_docs)
                    counts, n_docs = {}, Counter()
            if sum(map(len, counts.values())) > KEPT:
                yield from flush(counts, n_docs)
                counts, n_docs = {}, Counter()
        yield from flush(counts, n_docs)

    return docs.mapInArrow(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, path: str | None = None, rounds: int = ROUNDS) -> Languages | None:
    """Trains on every row of a non-null lang; None where there is none."""
    path = path or pieces.public_pieces()
    n_pieces = len(pieces.vocabulary(path))
    counts = written(word_counts(docs.where(F.col("lang").isNotNull())), "words")
    per = {r["lang"]: r["n"] for r in counts.where("word is null").collect()}  # a row per language
    if not per:
        return None
    names = sorted(per)
    prior = np.log(np.array([per[n] for n in names]) / sum(per.values()))
    place = {n: k for k, n in enumerate(names)}
    words = counts.where("word is not null")
    p = np.full((n_pieces, len(names)), 1 / n_pieces)
    for _ in range(rounds):
        held = docs.sparkSession.sparkContext.broadcast(p)  # pieces x languages

        def expect(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            own = pieces.vocabulary(path)
            total = np.zeros(held.value.shape)
            for b in batches:
                data, model, times = [], [], []
                for lang, word, n in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    for part in pieces.parts(word):
                        data.append(part)
                        model.append(place[lang])
                        times.append(n)
                if data:
                    total += pieces.expected_counts(data, np.array(model), np.array(times, float), own, held.value)
            key = np.flatnonzero(total.ravel())
            for lo in range(0, len(key), 1 << 16):
                k = key[lo : lo + (1 << 16)]
                yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(total.ravel()[k])], names=["key", "n"])

        summed = words.mapInArrow(expect, "key long, n double").groupBy("key").agg(F.sum("n").alias("n")).toArrow()
        seen = np.zeros(p.size)
        seen[summed["key"].to_numpy()] = summed["n"].to_numpy()
        p = pieces.probabilities(seen.reshape(p.shape))
    return Languages(names, p, prior, path)


def identify(docs: DataFrame, model: Languages | None) -> DataFrame:
    """Adds ``lang_pred`` and ``score``, the posterior of that language. No shuffle."""
    docs = docs.drop("lang_pred", "score")
    if model is None:
        return docs.select("*", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    held = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns
    at = names.index("text")
    schema = T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        known = Tokens(m)
        for b in batches:
            sums = np.zeros((b.num_rows, len(m.names) + 1))
            texts, of, places, size = b.column(at), [], [], 0
            for k in range(b.num_rows):
                for tokens in tokens_of(texts[k].as_py() or ""):
                    of.append(k)
                    places.append(known.places(tokens))
                    size += len(tokens)
                    if size > KEPT // 2:
                        known.add(sums, of, places)
                        of, places, size = [], [], 0
            known.add(sums, of, places)
            yield _chosen(b, names, sums, m)

    return docs.mapInArrow(predict, schema)


class Tokens(dict):
    """token -> its row: the log likelihoods of its words, and their number."""

    def __init__(self, model: Languages):
        super().__init__()
        self.model, self.own = model, pieces.vocabulary(model.path)
        self.rows, self.new = np.zeros((0, len(model.names) + 1)), []

    def __missing__(self, token: str) -> int:
        self.new.append(token)
        self[token] = place = len(self)
        return place

    def places(self, tokens: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, tokens), np.int64, len(tokens))

    def add(self, sums: np.ndarray, of: list[int], places: list[np.ndarray]) -> None:
        """Adds to the rows ``of`` of ``sums`` those of the tokens at ``places``."""
        self.rows = np.concatenate([self.rows, self._scored(self.new)])
        for k, own in zip(of, places, strict=True):
            sums[k] += self.rows[own].sum(axis=0)
        self.new = []
        if len(self) > KEPT:
            self.clear()
            self.rows = self.rows[:0]

    def _scored(self, tokens: list[str]) -> np.ndarray:
        words = list(map(words_of, tokens))
        distinct: dict[bytes, int] = {}
        parts = [[distinct.setdefault(p, len(distinct)) for word in own for p in pieces.parts(word)] for own in words]
        out = np.zeros((len(tokens), len(self.model.names) + 1))
        out[:, -1] = sizes = np.array(list(map(len, words)), np.int64)
        if distinct:
            logs = pieces.log_likelihoods(list(distinct), self.own, self.model.p)
            some = np.flatnonzero(sizes)
            starts = np.cumsum([0, *map(len, parts)])[:-1][some]
            out[some, :-1] = np.add.reduceat(logs[[p for own in parts for p in own]], starts)
        return out


def _chosen(b: pa.RecordBatch, names: list[str], sums: np.ndarray, m: Languages) -> pa.RecordBatch:
    logs = sums[:, :-1] + m.prior
    best = logs.argmax(axis=1)
    score = 1 / np.exp(logs - logs.max(axis=1, keepdims=True)).sum(axis=1)
    some = sums[:, -1] > 0
    langs = [m.names[k] if s else UNKNOWN for k, s in zip(best.tolist(), some.tolist(), strict=True)]
    return pa.RecordBatch.from_arrays([*b.columns, pa.array(langs, pa.string()), pa.array(np.where(some, score, 0.0))], names=[*names, "lang_pred", "score"])


@query("op13_language_id")
def op13_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = fit(docs.where(~held_out()))
    return identify(docs.drop("lang"), model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
