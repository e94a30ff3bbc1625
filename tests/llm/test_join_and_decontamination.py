import re

import numpy as np
import pytest

from taxaweave.llm import decontamination, ngram_join, ngram_sets, rtree
from tests.llm.cases import empty, frame

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def brute(rows, k, near):
    sets = []
    for _, text in rows:
        w = WORDS.findall(lower(text))
        sets.append({tuple(w[i : i + k]) for i in range(max(len(w) - k + 1, 1))} if w else set())
    links = [set() for _ in rows]
    for i, (a, _) in enumerate(rows):
        for j, (b, _) in enumerate(rows):
            both = len(sets[i] & sets[j])
            if i != j and a is not None and b is not None and sets[i] and 100 * both >= near * len(sets[i] | sets[j]):
                links[i].add(j)
    out = []
    for i, (doc, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            new = links[todo.pop()] - seen
            seen |= new
            todo += new
        out.append((doc, len(sets[i]), None if doc is None else min(rows[j][0] for j in seen), len(links[i])))
    return sorted(out, key=str)


@pytest.mark.parametrize("k,near,tile", [(3, 90, 200_000), (5, 80, 200_000), (5, 80, 150)])
def test_ngram_join_is_brute_force(spark, k, near, tile):
    docs = frame(spark)
    got = sorted(map(tuple, ngram_join.ngram_join(docs, k, near, tile).collect()), key=str)
    assert got == brute([(r["doc_id"], r["text"]) for r in docs.collect()], k, near)


def test_ngram_join_of_nothing(spark):
    assert ngram_join.ngram_join(empty(spark)).collect() == []
    assert len(ngram_join.ngram_join(frame(spark, [(None, None, None, None, None)])).collect()) == 1


def test_one_of_each_keeps_columns_and_null_ids(spark):
    docs = frame(spark)
    kept = ngram_join.one_of_each(docs, ngram_join.ngram_join(docs))
    ids = [r["doc_id"] for r in kept.collect()]
    assert kept.columns == docs.columns and None in ids and len(ids) == len(set(ids))
    assert 1008 not in ids and 0 in ids


def test_texts_of_one_id_are_dealt_once_each(spark, monkeypatch):
    words = [f"w{k}" for k in range(200)]
    rows = [(5, " ".join([*words[:k], "changed", *words[k + 1 :]]), None, None, 0) for k in range(0, 180, 3)]
    rows += [(6, "other words than those " * 3, None, None, 0), (5, "other words than those " * 3, None, None, 0)]
    dealt, plain = [], ngram_join.with_texts

    def counted(met, docs):
        out = plain(met, docs)
        dealt.append((met.count(), out.count()))
        return out

    monkeypatch.setattr(ngram_join, "with_texts", counted)
    got = sorted(map(tuple, ngram_join.ngram_join(frame(spark, rows)).collect()), key=str)
    assert dealt[0][0] == dealt[0][1] >= 60
    assert got == brute([(d, t) for d, t, *_ in rows], 5, 80)


def test_linked_sets_share_a_key():
    r = np.random.default_rng(5)
    levels = r.integers(0, 40, ngram_sets.SLOTS).astype(np.uint8)
    for near in (80, 90):
        for n in [*range(4, 60), 100, 313, 1000]:
            a = np.unique(r.integers(0, 1 << 63, n).astype(np.uint64) * np.uint64(2))
            lose = r.integers(0, n * (100 - near) // near + 1)
            b = np.sort(np.concatenate([r.permutation(a)[lose:], r.integers(0, 1 << 63, r.integers(0, 3)).astype(np.uint64)]))
            both = len(np.intersect1d(a, b))
            if 100 * both >= near * (len(a) + len(b) - both) and len(a) != both:
                assert len(np.intersect1d(ngram_sets.bucket_keys(a, near, levels), ngram_sets.bucket_keys(b, near, levels)))


def test_linked_sets_of_low_thresholds_share_a_key():
    r = np.random.default_rng(6)
    levels = r.integers(0, 40, ngram_sets.SLOTS).astype(np.uint8)
    for near in (30, 50, 60, 66):
        for n in [*range(4, 60), 100, 313]:
            a = np.unique(r.integers(0, 1 << 63, n).astype(np.uint64))
            b = np.sort(r.permutation(a)[: -(-near * len(a) // 100)])
            assert len(np.intersect1d(ngram_sets.bucket_keys(a, near, levels), ngram_sets.bucket_keys(b, near, levels))), (near, n)


def test_rtree_finds_all_pairs_within_the_bound():
    r = np.random.default_rng(1)
    base = r.poisson(3, (12, ngram_sets.GROUPS))
    a = np.maximum(base[r.integers(0, 12, 300)] + r.integers(-1, 2, (300, ngram_sets.GROUPS)) * (r.random((300, ngram_sets.GROUPS)) < 0.1), 0)
    b = a[::3] + (r.random((100, ngram_sets.GROUPS)) < 0.05)
    ok = lambda x, y: 190 * np.minimum(x, y).sum() >= 90 * (x.sum() + y.sum())
    want = {(i, j) for i in range(300) for j in range(100) if ok(a[i], b[j])}
    got = [(int(x), int(y)) for i, j in rtree.joined(rtree.RTree(a), rtree.RTree(b)) for x, y in zip(i, j, strict=True)]
    assert set(got) == want and len(got) == len(want)
    t = rtree.RTree(a)
    got = [frozenset((int(x), int(y))) for i, j in rtree.joined(t, t) for x, y in zip(i, j, strict=True)]
    assert set(got) == {frozenset((i, j)) for i in range(300) for j in range(i) if ok(a[i], a[j])} and len(got) == len(set(got))


def test_hot_group_of_near_copies_and_a_common_passage(spark):
    import random

    r = random.Random(2)
    words = [f"w{k}" for k in range(3000)]
    base, passage = r.choices(words, k=120), r.choices(words, k=60)
    rows = []
    for i in range(150):  # near copies: one changed word each
        own = list(base)
        own[r.randrange(120)] = f"x{i}"
        rows.append((i, " ".join(own)))
    rows += [(1000 + i, " ".join(passage + r.choices(words, k=80))) for i in range(150)]
    docs = frame(spark, [(i, t, None, None, 0) for i, t in rows], parts=8)
    out = {x["doc_id"]: x for x in ngram_join.ngram_join(docs, tile=4000).collect()}
    want = {x[0]: x for x in brute(rows, 5, 80)}
    assert {k: tuple(v) for k, v in out.items()} == want
    assert all(out[1000 + i]["n_links"] == 0 for i in range(150))


BENCH = "item_id long, text string"


def test_decontamination_marks_words_and_spans(spark):
    item = " ".join(f"q{k}" for k in range(14))
    bench = frame(spark, [(7, item.upper()), (8, "short item here"), (9, None), (None, "no id at all"), (10, " "), (7, "short item here")], BENCH, 2)
    text = "Früh, q1; q2 q3-q4 q5 q6 q7 q8 q9 q10 later SHORT item... here!"
    docs = frame(spark, [(1, text, "x"), (2, None, "x"), (3, "", "x"), (4, "q1 q2 q3", "x"), (5, text, "x"), (5, text, "x")], "doc_id long, text string, n_words string")
    rows = {r["doc_id"]: r for r in decontamination.decontaminate(docs, bench).collect()}
    r = rows[1]
    assert (r["n_words"], r["hit_runs"], r["item_ids"]) == (15, [[1, 11], [12, 15]], ["7", "8"])
    assert [text[s["start"] : s["end"]] for s in r["hit_spans"]] == ["q1; q2 q3-q4 q5 q6 q7 q8 q9 q10", "SHORT item... here"]
    assert rows[2]["n_words"] == 0 and not rows[4]["hit_runs"] and rows[5]["hit_runs"] == r["hit_runs"]


def test_decontamination_in_passes_equals_one(spark):
    docs = frame(spark).select("doc_id", "text")
    bench = docs.where("doc_id % 9 = 0").select(docs.doc_id.alias("item_id"), "text")
    one = decontamination.decontaminate(docs, bench)
    some = decontamination.decontaminate(docs, bench, automaton_words=300)
    assert sorted(map(str, one.collect())) == sorted(map(str, some.collect()))
    assert decontamination.decontaminate(empty(spark), bench).count() == 0
    none = decontamination.decontaminate(docs, empty(spark, BENCH))
    assert none.where("size(hit_runs) > 0").count() == 0 and none.count() == docs.count()


def test_components_of_paths_stars_and_rings(spark):
    from taxaweave.llm.graphs import components

    path = [(k, k + 1) for k in range(0, 400)]
    star = [(1000, 1000 + k) for k in range(1, 200)]
    ring = [(2000 + k, 2000 + (k + 1) % 30) for k in range(30)]
    edges = spark.createDataFrame(path + star + ring + [(5001, 5000), (5001, 5000)], "a long, b long")
    out = {r["node"]: r["root"] for r in components(edges).collect()}
    groups = [range(401), range(1000, 1200), range(2000, 2030), (5000, 5001)]
    assert sorted(out) == sorted(n for g in groups for n in g)
    roots = [{out[n] for n in g} for g in groups]
    assert all(len(r) == 1 for r in roots) and len(set.union(*roots)) == 4
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
