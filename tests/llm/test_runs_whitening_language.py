import hashlib
import itertools
import math
import random
import re
from zlib import crc32

import numpy as np
import pytest

from taxaweave.llm import language, lyndon, periodic_runs, pieces, slicing, whitening
from tests.llm.cases import documents, empty, frame

SMALL = "/root/testdata/sf0.01"


# --- periodic runs ---------------------------------------------------------


def brute_lyndon(w):
    n = len(w)
    return [next((j for j in range(i + 1, n) if w[j:] < w[i:]), n) - i for i in range(n)]


def brute_runs(w, least):
    found = []
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if (n := j - i + q) >= max(least, 2 * q) and j > i and not any(all(w[i + t] == w[i + t + d] for t in range(n - d)) for d in range(1, q)):
                found.append((i, n, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def test_lyndon_arrays_and_runs_against_brute_force():
    r = random.Random(1)
    for _ in range(400):
        w = [r.randint(1, r.randint(1, 4)) for _ in range(r.randint(1, 40))]
        if r.random() < 0.5:
            w = w[:3] + w[: r.randint(1, max(1, len(w) // 3))] * r.randint(2, 5) + w[-4:]
        assert lyndon.lyndon_array([0, *w])[1:] == brute_lyndon(w)
        v = [r.randint(1, 2) for _ in range(r.randint(0, 30))]
        for least in (2, 5, 8, 12):
            want = [(k, *x) for k, s in enumerate((w, v)) for x in brute_runs(s, least)]
            for search in (lyndon.runs, lyndon.runs_of_all):  # with and without leaving out parts
                assert [tuple(x) for x in search([np.array(w), np.array(v, int)], least).tolist()] == want
    assert len(lyndon.runs_of_all([])) == len(lyndon.runs([np.array([], int)])) == 0


def test_parts_left_out_hold_no_run():
    r = random.Random(2)
    for _ in range(200):  # exact squares, the shortest runs of their period
        q = r.randint(6, 30)
        unit = [r.randint(1, 50) for _ in range(q)]
        w = np.array([r.randint(60, 90) for _ in range(20)] + unit + unit + [r.randint(60, 90) for _ in range(20)])
        assert [tuple(x) for x in lyndon.runs_of_all([w], 12)[:, 1:].tolist()] == brute_runs(w.tolist(), 12)


def words_after_rewriting(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and w:
        n, g = len(w), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    return w


def test_run_digests_against_brute_force(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(periodic_runs, "CHUNK_WORDS", 500)
    monkeypatch.setattr(periodic_runs, "KEPT_WORDS", 300)
    texts = [(d, t) for d, t, *_ in documents()]
    texts += [(5000 + k, " ".join(["ab cd", "x\ty\n z"][k % 2].split(" ") * (4 + k))) for k in range(30)] + [(7000, "a " * 12), (7001, "a " * 11), (7001, "a " * 11)]
    frame(spark, [(d, t, None, None, 0) for d, t in texts]).write.parquet(f"{tmp_path}/documents.parquet")
    out = periodic_runs.op12_periodic_runs(spark, str(tmp_path)).collect()
    want = []
    for d, text in texts:
        w = words_after_rewriting(d, text)
        ids = {}
        runs = brute_runs([ids.setdefault(x, len(ids)) for x in w], 12) if len(w) < 1000 else None
        if runs is None:
            continue
        dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=None)
        lines = "".join("%d,%d,%d\n" % x for x in runs)
        kept = " ".join(x for i, x in enumerate(w) if i not in dropped)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        want.append((d, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2], sha(lines), sha(kept)))
    assert sum(x[1] > 0 for x in want) > 10
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in out if r["doc_id"] != 1006)
    assert len(out) == len(texts)


def test_runs_keep_columns_and_pieces_of_long_texts(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "b c " * 9, 7, "x"), (2, None, 8, "y")], "doc_id long, text string, n_words int, other string")
    rows = periodic_runs.periodic_runs(docs).orderBy("doc_id").collect()
    assert rows[0].asDict(True) == {"doc_id": 1, "text": "b c " * 9, "other": "x", "n_words": 18, "runs": [{"start": 0, "length": 18, "period": 2}], "collapsed": "b c"}
    assert (rows[1]["n_words"], rows[1]["runs"], rows[1]["collapsed"]) == (0, [], "")
    assert periodic_runs.periodic_runs(empty(spark)).count() == 0
    monkeypatch.setattr("taxaweave.llm.common.PIECE_BYTES", 10)
    numbers = periodic_runs.Numbers()
    text = " ".join(f"w{k % 7}" for k in range(100)).encode()
    assert numbers.text(numbers.of(text)) == text


# --- whitening -------------------------------------------------------------


def _symmetric(values, r):
    q = np.linalg.qr(r.standard_normal((len(values), len(values))))[0]
    a = (q * values) @ q.T
    return (a + a.T) / 2


def test_inertia_counts():
    r = np.random.default_rng(0)
    for _ in range(200):
        d = r.integers(1, 9)
        a = r.integers(-2, 3, (d, d)).astype(float)
        a += a.T
        s = r.integers(-4, 5) + 0.01 + r.random() / 2
        assert slicing.below(a, s) == (np.linalg.eigvalsh(a) < s).sum()


@pytest.mark.parametrize(
    "values",
    [
        np.linspace(1, 2, 64),
        np.ones(20),
        np.r_[np.ones(5), np.full(10, 0.5), np.linspace(0, 0.4, 30)],  # ties
        np.r_[1, 1 - 1e-7, 1 - 2e-7, 1 - 1e-10, 0.5, 0.5 + 1e-12, np.linspace(0, 0.1, 20)],  # close
        np.r_[1e6, 1e3, 1, 1e-3, np.zeros(20)],
        np.array([3.0]),
        np.zeros(5),
    ],
)
def test_slicing_finds_the_leading_eigenpairs(values):
    a = _symmetric(values, np.random.default_rng(1))
    e, x = slicing.leading(a, 16)
    top = max(np.abs(values).max(), 1e-300)
    assert np.abs(e - np.sort(values)[::-1][:16]).max() <= 1e-13 * top
    assert np.abs(x.T @ x - np.eye(len(e))).max() < 1e-13 and np.abs(a @ x - x * e).max() <= 1e-12 * top


def _embeddings(n, d, seed=5):
    r = np.random.default_rng(seed)
    rows = [(k, (r.standard_normal(d) * np.linspace(2, 0.2, d)).tolist()) for k in range(n)]
    rows += [(n + k, rows[0][1]) for k in range(n // 2)]  # a third of all rows
    return rows + [(9000, None), (9001, [1.0, None] + [0.0] * (d - 2)), (9002, [float("nan")] * d), (9003, [float("inf")] + [0.0] * (d - 1)), (9004, [])]


def test_whitening_against_numpy(spark, tmp_path):
    rows = _embeddings(200, 24)
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5).write.parquet(f"{tmp_path}/embeddings.parquet")
    out = whitening.op11_embedding_whitening(spark, str(tmp_path)).toPandas().sort_values(["vec_id", "component"])
    x = np.array([np.floor(64 * np.float32(v).astype(float)).astype(int) + 1_000_000 for k, v in rows if k < 9000])
    fitted = np.unique(x, axis=0)
    n, sums = len(fitted), fitted.sum(axis=0)
    c = (n * fitted - sums) / n
    e, u = np.linalg.eigh(c.T @ c / n)
    e, u = e[::-1][:16], u[:, ::-1][:, :16]
    want = (n * x - sums) / n @ u / np.sqrt(e)
    got = out["whitened"].to_numpy().reshape(-1, 16)
    assert np.abs(np.abs(got) - np.abs(want)).max() < 1e-9
    sign = np.sign(got * want)
    assert (sign == sign[0]).all()
    assert out["component"].tolist() == list(range(1, 17)) * len(x) and set(out["n"]) == {n}
    assert out["deviation"].to_numpy().reshape(-1, 16).T.tolist() == [((n * x - sums) ** 2).sum(axis=1).tolist()] * 16
    assert np.allclose(out["explained"].to_numpy()[:16], e / (c * c).sum() * n, rtol=1e-9)
    z = (n * fitted - sums) / n @ u / np.sqrt(e)
    assert 0 < out["identity_error"].iloc[0] < 1e-9 and np.abs(z.T @ z / n - np.eye(16)).max() < 1e-9


def test_whitening_of_odd_tables(spark, tmp_path):
    schema = "vec_id long, embedding array<float>, whitened string, other int"
    none = spark.createDataFrame([], schema)
    same = spark.createDataFrame([(1, [1.0, 2.0], "a", 1), (2, [1.0, 2.0], "b", 2)], schema)
    for name, df in (("none", none), ("same", same)):
        assert whitening.fit(df) is None
        df.write.parquet(f"{tmp_path}/{name}/embeddings.parquet")
        assert whitening.op11_embedding_whitening(spark, f"{tmp_path}/{name}").count() == 0
    two = same.union(spark.createDataFrame([(3, [3.0, 1.0], "c", 3), (None, None, "d", 4)], schema))
    model = whitening.fit(two)
    rows = whitening.whiten(two, model).orderBy("vec_id").collect()
    assert model.n == 2 and len(model.values) == 1 and [r["vec_id"] for r in rows] == [1, 2, 3] and [r["other"] for r in rows] == [1, 2, 3]
    assert sorted(round(r["whitened"][0], 9) for r in rows) in ([-1, -1, 1], [-1, 1, 1])
    mixed = two.union(spark.createDataFrame([(4, [1.0], "e", 5)], schema))
    with pytest.raises(ValueError, match="lengths"):
        whitening.fit(mixed)


def test_wide_vectors_keep_exact_sums(spark):
    rows = [(k, [float((-1) ** k * 2**30 + k), float(k)]) for k in range(40)]
    model = whitening.fit(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    x = [[64 * int(a) + 1_000_000, 64 * int(b) + 1_000_000] for _, (a, b) in rows]
    assert model.sums == [sum(v[0] for v in x), sum(v[1] for v in x)]
    out = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), model).orderBy("vec_id").collect()
    exact = [sum((40 * a - s) ** 2 for a, s in zip(v, model.sums, strict=True)) for v in x]
    assert [r["deviation"] for r in out] == [e if e < 1 << 63 else None for e in exact]


# --- languages -------------------------------------------------------------


def segmentations(word, own):
    """All cuts of a word into pieces."""
    for cuts in itertools.product((0, 1), repeat=len(word) - 1):
        at = [0, *(k + 1 for k, c in enumerate(cuts) if c), len(word)]
        parts = [word[a:b] for a, b in itertools.pairwise(at)]
        if all(p in own for p in parts):
            yield [own[p] for p in parts]


def test_forward_and_expected_counts_against_all_segmentations():
    own = pieces.vocabulary(pieces.public_pieces())
    assert all(bytes([b]) in own for b in range(256))
    r = np.random.default_rng(0)
    p = r.random((len(own), 2))
    p /= p.sum(axis=0)
    words = [b" the", b" with", b" est", b"x", " né".encode(), b" thing"]
    logs = pieces.log_likelihoods(words, own, p)
    model, times = np.array([0, 1, 0, 1, 0, 1]), np.array([3.0, 1, 2, 5, 1, 4])
    counts = np.zeros(p.shape)
    for k, w in enumerate(words):
        cuts = list(segmentations(w, own))
        sums = [sum(math.prod(p[i, m] for i in c) for c in cuts) for m in (0, 1)]
        assert np.allclose(logs[k], np.log(sums))
        for c in cuts:
            for i in c:
                counts[i, model[k]] += times[k] * math.prod(p[j, model[k]] for j in c) / sums[model[k]]
    assert np.allclose(pieces.expected_counts(words, model, times, own, p), counts)


def test_long_words_are_scored_in_parts():
    assert pieces.parts("word") == [b" word"]
    for word in ("x" * 100, "é" * 50, "字" * 33, "a𝒳" * 20):
        got = pieces.parts(word)
        assert b"".join(got).decode() == " " + word and max(map(len, got)) <= pieces.LONGEST + 1
    own = pieces.vocabulary(pieces.public_pieces())
    p = pieces.probabilities(np.zeros((len(own), 1)))
    assert np.isfinite(pieces.log_likelihoods([bytes(range(200, 232))] + pieces.parts("字" * 40), own, p)).all()


def test_languages_of_held_out_documents(spark):
    out = language.op13_language_id(spark, SMALL).toPandas()
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "lang").toPandas()
    both = out.merge(docs, on="doc_id")
    assert len(out) == len(docs) and out["score"].between(0, 1).all()
    assert (both["held_out"] == both["doc_id"].map(lambda d: crc32(str(d).encode()) % 4 == 2)).all()
    own = both[both["held_out"]]
    assert (own["lang_pred"] == own["lang"]).mean() > 0.97


def test_word_counts_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(language, "PART", 50)
    rows = [
        (1, "der Hund und die Katze " * 9, "de"), (2, "the dog and the cat, the cat " * 9, "en"), (3, None, "en"), (4, "", "de"),
        (5, "12 ½ ² -- __ %%%", None), (6, "the cat and", None), (None, "DER HUND", None), (6, "the cat and", None), (7, "und die", None),
    ]
    docs = spark.createDataFrame([(*r, "old", "x") for r in rows], "doc_id long, text string, lang string, score string, other string")
    counts = {(r["lang"], r["word"]): r["n"] for r in language.word_counts(docs.where("lang is not null")).collect()}
    assert counts["en", "the"] == 27 and counts["en", "cat"] == 18 and counts["de", "hund"] == 9 and counts["en", None] == 2 and counts["de", None] == 2
    out = language.identify(docs, language.fit(docs)).collect()
    assert len(out) == len(rows) and all(r["other"] == "x" for r in out)
    said = [(r["doc_id"], r["lang_pred"]) for r in out]
    assert sorted(map(str, said)) == sorted(map(str, [(1, "de"), (2, "en"), (3, "und"), (4, "und"), (5, "und"), (6, "en"), (None, "de"), (6, "en"), (7, "de")]))
    assert all((r["score"] == 0) == (r["lang_pred"] == "und") for r in out)
    none = language.fit(docs.where("lang is null"))
    assert none is None and {r["lang_pred"] for r in language.identify(docs, none).collect()} == {"und"}
    model = language.fit(docs)
    assert language.identify(docs.limit(0), model).count() == 0
