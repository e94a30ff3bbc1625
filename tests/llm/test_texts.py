import hashlib
import re
import textwrap
from collections import Counter, defaultdict
from html.parser import HTMLParser
from zlib import crc32

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from taxaweave.llm import chat_format, gru, html_text, licence_texts, licences, sharding, spot_join, spotsigs, toxicity
from taxaweave.llm.html_render import parse, render
from tests.llm.cases import documents, empty, frame

SMALL = "/root/testdata/sf0.01"
LARGER = "/root/testdata/sf0.1"  # a hundredth has too few toxic labels to learn from


def test_gradients_are_right(monkeypatch):
    monkeypatch.setattr(gru, "F32", np.float64)
    p = {k: v if k == "row" else v.astype(float) for k, v in gru.start().items()}
    x = gru.Windows([b"some words repeat some words " * 20, b"few words", b"", b"x"])
    weight = np.arange(1, len(x.doc) + 1.0)
    _, kept = gru.forward(p, x, keep=True)
    for name, g in gru.backward(p, x, kept, weight).items():
        at = np.unravel_index(np.argmax(np.abs(g)), g.shape)
        sides = []
        for step in (1e-4, -1e-4):
            q = dict(p) | {name: p[name].copy()}
            q[name][at] += step
            sides.append((gru.forward(q, x) * weight).sum())
        assert g[at] == pytest.approx((sides[0] - sides[1]) / 2e-4, rel=1e-4, abs=1e-8)


def test_windows_cover_every_word():
    for n in (1, 47, 48, 49, 80, 81, 500):
        x = gru.Windows([b"", " ".join(f"w{k}" for k in range(n)).encode()])
        seen = {int(x.word[i]) for row, m in zip(x.idx, x.mask, strict=True) for i in row[m]}
        assert seen == set(x.word.tolist()) and set(x.doc) == {1}


def test_very_long_texts_are_scored_in_parts(monkeypatch):
    monkeypatch.setattr(gru, "LONG_BYTES", 6000)
    monkeypatch.setattr(gru, "OVERLAP_BYTES", 500)
    text = " ".join(f"word{k}" for k in range(3000)).encode()
    parts = gru.pieces(text)
    assert len(parts) > 4 and all(len(x) <= 6000 for x in parts)
    assert set(b" ".join(parts).split()) == set(text.split()) and gru.pieces(b"x" * 20000)[0] == b"x" * 6000
    p = gru.start()
    one, two, none = gru.scores(p, [text, b"short text", None])
    assert two == pytest.approx(gru.scores(p, [b"short text"])[0]) and none == 0
    monkeypatch.setattr(gru, "LONG_BYTES", 1 << 20)
    assert one == pytest.approx(gru.scores(p, [text])[0], rel=0.05)


def test_toxicity_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{LARGER}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{LARGER}/labels.parquet")
    model = toxicity.fit(docs, labels)
    some = docs.join(labels.select("doc_id"), "doc_id").where("doc_id % 3 = 0")
    out = toxicity.score(some, model).withColumn("held", toxicity.held_out()).join(labels, "doc_id").toPandas()
    assert {r.doc_id for r in out.itertuples() if r.held} == {d for d in out.doc_id if crc32(str(d).encode()) % 4 == 2}
    own = out[out.held]
    bad, fine = own[own.toxic == 1], own[own.toxic == 0]
    assert len(bad) > 25 and bad.predicted.mean() > 0.8 and fine.predicted.mean() < 0.03
    assert out.score.between(0, 1).all()


def test_training_takes_one_bounded_text_of_a_repeated_id(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(gru, "train", lambda texts, labels, steps: seen.append((texts, labels.tolist())))
    monkeypatch.setattr(toxicity, "TRAIN_BYTES", 20)
    free = [d for d in range(60) if crc32(str(d).encode()) % 4 != 2][:3]
    rows = [(free[0], f"text {k} of one id") for k in range(40)] + [(free[1], "x" * 500), (free[2], None)]
    docs = frame(spark, [(d, t, None, None, 0) for d, t in rows])
    labels = spark.createDataFrame([(d, 0, k % 2) for k, d in enumerate(free)], "doc_id long, quality int, toxic int")
    for parts in (1, 7):
        toxicity.fit(docs.repartition(parts), labels)
    texts, y = seen[0]
    assert seen[0] == seen[1] and len(texts) == 3 and y == [0, 1, 0]
    assert texts[0].startswith(b"text ") and texts[1] == b"x" * 20 and texts[2] == b""


def test_toxicity_of_odd_rows(spark):
    docs = frame(spark).withColumn("score", F.lit("mine"))
    model = gru.start()
    out = toxicity.score(docs, model)
    assert out.columns == [*[c for c in docs.columns if c != "score"], "score", "predicted"]
    rows = {r["doc_id"]: r for r in out.collect()}
    assert all(rows[d]["score"] == 0 for d in (1000, 1001, 1002, 1005)) and 0 <= rows[1006]["score"] <= 1
    assert toxicity.score(empty(spark), model).count() == 0
    assert toxicity.fit(docs, empty(spark, "doc_id long, toxic int")) is None
    assert toxicity.score(docs, None).agg(F.max("score")).first()[0] == 0


def _check_shards(rows, copies):
    n = Counter(r["shard"] for r in rows)
    assert sum(n.values()) == len(rows) and max(n.values()) - min(n.get(k, 0) for k in range(8)) <= 1
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    homes = defaultdict(set)
    for r in rows:
        homes[r["group"]].add(r["shard"])
    for g, shards in homes.items():
        assert len(shards) <= -(-copies[g] // (len(rows) // 8)) + 1


def test_shards_are_even_and_keep_groups(spark):
    rows = sharding.balanced_shards(frame(spark)).collect()
    want = sorted(str((d, len((t or "").encode()) + 1, crc32((t or "").encode()))) for d, t, *_ in documents())
    assert sorted(str((r["doc_id"], r["size"], r["text_crc32"])) for r in rows) == want
    copies = Counter(r["group"] for r in rows)
    _check_shards(rows, copies)
    homes = defaultdict(set)
    for r in rows:
        homes[r["group"]].add(r["shard"])
    assert sum(len(s) > 1 for s in homes.values()) == 0


def test_a_group_of_a_third_of_all_rows(spark):
    rows = [(i, "same" if i % 3 == 0 else f"own {i // 2}", None, None, 0) for i in range(600)]
    out = sharding.balanced_shards(frame(spark, rows)).collect()
    copies = Counter(r["group"] for r in out)
    _check_shards(out, copies)
    big = copies.most_common(1)[0][0]
    assert len({r["shard"] for r in out if r["group"] == big}) <= 4
    assert sharding.balanced_shards(empty(spark)).count() == 0


def spots(text):
    """Brute force: anchors and chains by plain loops."""
    words = [w for w in re.split(r"[^\w]+|_", text.lower()) if w]
    stop = set(spotsigs.ANCHORS)
    out, last = set(), None
    for i, w in enumerate(words):
        if w in stop:
            out.add((w, *[x for x in words[i + 1 :] if x not in stop][: spotsigs.CHAIN]))
            last = i
        elif last is None or i - last > spotsigs.FAR:
            out.add(("", w))
    return out or ({("whole", text)} if text else set())


def test_fingerprints_against_brute_force(spark):
    rows = {d: t or "" for d, t, *_ in documents()}
    order = sorted(rows, key=lambda d: (d is not None, d))
    out = {r["doc_id"]: r for r in spotsigs.op7_columns(spotsigs.fingerprints(frame(spark))).collect()}
    assert sorted(out, key=str) == sorted(rows, key=str)
    like = lambda a, b: 1.0 if not a and not b else len(a & b) / len(a | b)
    for k, d in enumerate(order):
        text, after = rows[d], rows[order[(k + 1) % len(order)]]
        cut = len(text) // 4
        edited = text[: len(text) - cut] + after[:cut]
        r = out[d]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert r["near_edited"] == pytest.approx(like(spots(text), spots(edited))) and r["near_next"] == pytest.approx(like(spots(text), spots(after)))
    prints = defaultdict(set)
    for d, r in out.items():
        prints[rows[d]].add(r["fingerprint"])
    assert all(len(p) == 1 for p in prints.values())
    assert spotsigs.fingerprints(empty(spark)).count() == 0
    one = spotsigs.fingerprints(frame(spark, [(5, "the only one here", None, None, 0)])).collect()
    assert len(one) == 1 and one[0]["print"] == one[0]["next_print"]


def test_fingerprints_without_repeated_ids(spark):
    """The path of tables in which an id occurs once, and its one exchange of the texts."""
    seen, rows = set(), []
    for d, t, *_ in documents(120, seed=9):
        if d not in seen:
            seen.add(d)
            rows.append((d, t, None, None, 0))
    docs = frame(spark, rows)
    assert [f.name for f in spotsigs.keyed(docs).schema] == ["key", "text"] and spotsigs.keyed(docs).schema["key"].dataType.typeName() == "long"
    out = {r["doc_id"]: r for r in spotsigs.op7_columns(spotsigs.fingerprints(docs)).collect()}
    texts = {d: t or "" for d, t, *_ in rows}
    order = sorted(texts, key=lambda d: (d is not None, d))
    assert len(out) == len(rows) > 100 and None in out
    like = lambda a, b: 1.0 if not a and not b else len(a & b) / len(a | b)
    for k, d in enumerate(order):
        text, after = texts[d], texts[order[(k + 1) % len(order)]]
        cut = len(text) // 4
        edited = text[: len(text) - cut] + after[:cut]
        r = out[d]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert r["near_edited"] == pytest.approx(like(spots(text), spots(edited))) and r["near_next"] == pytest.approx(like(spots(text), spots(after)))
    at = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spotsigs.fingerprints(docs)
        joined.collect()
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", at)
    assert "ReusedExchange" in plan


def test_fingerprints_of_every_row(spark):
    texts = [(None, f"the row {k} has no id of its own and is one of many") for k in range(9)] + [(4, f"one id for the text {k}") for k in range(5)]
    texts += [(4, "one id for the text 0"), (None, None), (spotsigs.NO_ID, "the least id there is"), (5, "the last")]
    rows = [(d, t, None, None, 0) for d, t in texts]
    out = spotsigs.fingerprints(frame(spark, rows)).select("doc_id", "n_chars", "edited").collect()
    hashed = {r["text"]: r["h"] for r in frame(spark, rows).select(F.coalesce("text", F.lit("")).alias("text")).select("text", F.xxhash64("text").alias("h")).collect()}
    order = sorted({(d, t or "") for d, t in texts}, key=lambda r: (r[0] is not None, r[0] or 0, hashed[r[1]]))
    after = {r: order[(k + 1) % len(order)][1] for k, r in enumerate(order)}
    want = [(d, len(t), t[: len(t) - len(t) // 4] + after[d, t][: len(t) // 4]) for d, t in ((d, t or "") for d, t in texts)]
    assert sorted(map(str, map(tuple, out))) == sorted(map(str, want))


def test_likeness_prunes_by_length(spark):
    df = spark.createDataFrame([([1, 2, 3, 4], [1, 2]), ([], []), ([1], [])], "a array<int>, b array<int>")
    plain = [r[0] for r in df.select(spotsigs.likeness(F.col("a"), F.col("b"))).collect()]
    pruned = [r[0] for r in df.select(spotsigs.likeness(F.col("a"), F.col("b"), 0.6)).collect()]
    assert plain == [0.5, 1.0, 0.0] and pruned == [0.0, 1.0, 0.0]


@pytest.mark.parametrize("least", [0.8, 0.5, 1.0])
def test_near_duplicates_are_brute_force(spark, least):
    import random

    r = random.Random(4)
    prints = []
    for k in range(150):
        base = sorted(r.sample(range(-400, 400), r.choice([1, 2, 5, 20, 60])))
        prints.append((k * 10, base))
        for j in range(r.randint(0, 3)):  # near and exact copies
            drop, add = r.choice([(0, 0), (1, 0), (1, 1), (len(base) // 5, 0), (len(base) // 4, 1)])
            prints.append((k * 10 + 1 + j, sorted(set(r.sample(base, max(1, len(base) - drop)) + r.sample(range(1000, 1100), add)))))
    prints += [(5000, []), (5001, None), (None, prints[0][1]), (5002, prints[0][1])]
    df = spark.createDataFrame(prints, "key long, print array<int>").repartition(5)
    sets = {k: frozenset(p or []) for k, p in prints if k is not None}
    like = lambda a, b: 1.0 if not a and not b else len(a & b) / len(a | b)
    want = {frozenset((a, b)) for a in set(sets.values()) for b in set(sets.values()) if a != b and like(a, b) >= least}
    pairs, members = spot_join.alike(df, least)
    of = {row["set"]: sets[row["key"]] for row in members.where("key is not null").collect()}
    got = [frozenset((of[x["a"]], of[x["b"]])) for x in pairs.collect()]
    assert len(got) == len(set(got)) and set(got) == want and (least == 1.0 or len(want) > 20)
    assert "Python" not in pairs._jdf.queryExecution().executedPlan().toString() and "Arrow" not in pairs._jdf.queryExecution().executedPlan().toString()
    above = {k: k for k in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                if like(sets[a], sets[b]) >= least and above[b] < above[a]:
                    above[a], changed = above[b], True
    classes = spot_join.near_classes(df, least).collect()
    assert sorted(map(str, map(tuple, classes))) == sorted(map(str, [*above.items(), (None, None)]))


def test_near_duplicates_of_nothing(spark):
    none = spark.createDataFrame([], "key long, print array<int>")
    assert spot_join.near_classes(none).count() == 0
    with pytest.raises(ValueError):
        spot_join.alike(none, 0)


def test_forward_pass_and_pooling_against_plain_loops(monkeypatch):
    monkeypatch.setattr(gru, "F32", np.float64)
    p = {k: v if k == "row" else v.astype(float) for k, v in gru.start(3).items()}
    x = gru.Windows([b"some plain words to score, and some more of them " * 12, b"two words", b"one"])
    sig = lambda v: 1 / (1 + np.exp(-v))
    h_, size = gru.HIDDEN, x.size
    first = x.ends - size
    want = []
    for row, mask in zip(x.idx, x.mask, strict=True):
        states = []
        for way, places in ((0, row[mask]), (1, row[mask][::-1])):
            h, own = np.zeros(h_), []
            for i in places:
                chars = p["char"][x.trigram[first[i] : x.ends[i]]].mean(axis=0)
                a = np.concatenate([p["word"][p["row"][x.word[i]]], chars]) @ p["w"][way] + p["b"][way][0]
                g = h @ p["u"][way]
                z, r = sig(a[:h_] + g[:h_]), sig(a[h_ : 2 * h_] + g[h_ : 2 * h_])
                c = np.tanh(a[2 * h_ :] + r * g[2 * h_ :])
                h = z * h + (1 - z) * c
                own.append(h)
            states.append(own if way == 0 else own[::-1])
        both = np.array([np.concatenate(s) for s in zip(*states, strict=True)])
        e = np.exp(np.tanh(both @ p["a"] + p["ab"]) @ p["v"])
        want.append((e / e.sum()) @ both @ p["o"] + p["ob"][0])
    got = gru.forward(p, x)
    assert len(got) > 3 and np.allclose(got, want)
    doc, _ = gru.pooled(got, x.doc, 4)
    for d in range(3):
        mine = got[x.doc == d]
        assert doc[d] == pytest.approx((np.exp(mine) / np.exp(mine).sum() * mine).sum())
    assert doc[3] == -30


def test_cut_groups_against_the_fewest_possible(spark):
    """Groups of copies that fit whole shards: none is cut where none need be."""
    rows, k = [], 0
    for size in (3, 3, 2, 2, 2, 2, 2):
        rows += [(k + j, f"group of {size} at {k}", None, None, 0) for j in range(size)]
        k += size
    rows += [(k + j, f"single {j}", None, None, 0) for j in range(24)]
    out = sharding.balanced_shards(frame(spark, rows), 4).collect()
    shards = defaultdict(set)
    for r in out:
        shards[r["text_crc32"]].add(r["shard"])
    held = Counter(r["shard"] for r in out)
    assert max(held.values()) - min(held.values()) <= 1 and sum(len(s) - 1 for s in shards.values()) == 0


def test_licences_of_planted_lines(spark):
    lines = [f"Some plain prose number {k}, of and in the text, with no meaning at all." for k in range(300)]
    rows = [(k, f"{line}\nmore of it {k} for this work") for k, line in enumerate(lines)]
    rows += [(500, "x\nReleased under the MIT License.\ny"), (501, "Licensed under CC BY-NC 4.0."), (502, "All rights reserved."), (503, None), (504, ""), (500, "Licensed under the Apache License, Version 2.0.")]
    docs = spark.createDataFrame([(d, t, "z") for d, t in rows], "doc_id long, text string, family string").repartition(3)
    found = licences.scan(docs, *licences.fit(docs)).collect()
    assert {(r["doc_id"], r["paragraph"], r["family"]) for r in found if r["family"] != "unknown"} == {(500, 1, "mit"), (501, 0, "cc-by-nc"), (502, 0, "proprietary"), (500, 0, "apache")}
    nothing = empty(spark, "doc_id long, text string")
    assert licences.scan(nothing, *licences.fit(nothing)).count() == 0


def test_licences_learn_from_every_paragraph(spark):
    """``unknown`` is learnt and calibrated on all paragraphs: none is left to a sample."""
    prose = [f"word{k} of and in the text, plain {j}" for k in range(7) for j in range(5)]
    rows = [(k, "\n".join([*prose, "", " . "])) for k in range(1000)] + [(None, prose[0]), (1, prose[0]), (5, None), (2000, BSD), (2001, "MIT License")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    far = licences.unlike(docs, licences.vocabulary(spark)).collect()
    assert sum(r["learn"] + r["calibrate"] for r in far) == 1000 * len(prose) + 2  # no blank line, none of a licence
    assert len({tuple(r["terms"]) for r in far}) == len(far) < 10 and all(min(r["learn"], r["calibrate"]) > 10_000 for r in far if r["learn"] > 20_000)
    halves = spark.createDataFrame([(0.9, 1), (0.25, 9), (0.1, 990)], "p double, n long")
    assert [licences.exceeded(halves, share) for share in (0.0, 0.0005, 0.001, 0.01, 1.0)] == [0.9, 0.9, 0.25, 0.1, 0.0]


GPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version."""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:"""
MIT = """MIT License

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights"""


def test_licences_over_line_ends(spark):
    rows = [(k, f"Some plain prose number {k}, of and in the text,\nwith no meaning at all.\nmore of it for this work") for k in range(300)]
    narrow = re.sub(r"(\w+ \w+ \w+) ", r"\1\n", BSD.replace("\n", " "))
    rows += [(500, GPL), (501, BSD), (502, MIT), (503, f"plain words before\n{narrow}"), (504, " * " + GPL.replace("\n", "\n * "))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = defaultdict(dict)
    for r in licences.scan(docs, *licences.fit(docs)).collect():
        assert r["paragraph"] not in found[r["doc_id"]]
        found[r["doc_id"]][r["paragraph"]] = r["family"]
    named = {d: {f for f in own.values() if f != "unknown"} for d, own in found.items()}
    assert {d: f for d, f in named.items() if f} == {500: {"gpl"}, 501: {"bsd"}, 502: {"mit"}, 503: {"bsd"}, 504: {"gpl"}}
    assert [found[d].get(k) for d, k in ((500, 0), (501, 0), (502, 0), (502, 2), (503, 1), (504, 0))] == ["gpl", "bsd", "mit", "mit", "bsd", "gpl"]


def wrapped(text, width):
    return "\n".join(line for part in text.split("\n") for line in (textwrap.wrap(part, width) or [""]))


# Whole notices as projects bear them; each must be found under its own family and no other of the GNU ones.
GNU = """This {what} is free software: you can redistribute it and/or modify it under the terms of the GNU {name} as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.

This {what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the GNU {name} for more details.

You should have received a copy of the GNU {name} along with this {what}.  If not, see <https://www.gnu.org/licenses/>."""
NOTICES = [
    ("mit", 'Copyright (c) 2020 A. Person\n\nThe above copyright notice and this permission notice (including the next paragraph) shall be included in all copies or substantial portions of the Software.\n\nTHE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.'),
    ("bsd", '3. Neither the name of the University nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n\nTHIS SOFTWARE IS PROVIDED BY THE REGENTS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.'),
    ("isc", "Copyright 2019 B. Person\n\nPermission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("gpl", GNU.format(what="program", name="General Public License")),
    ("lgpl", GNU.format(what="library", name="Lesser General Public License")),
    ("lgpl", GNU.format(what="program", name="Lesser General Public License")),
    ("agpl", GNU.format(what="program", name="Affero General Public License")),
    ("apache", "Copyright 2021 C. Person\n\nLicensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc-by-nd", "This work is licensed under the Creative Commons Attribution-NoDerivatives 4.0 International License."),
    ("cc-by-nc-sa", "Licensed under CC BY-NC-SA 4.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain.\n\nAnyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("mit", "# SPDX-License-Identifier: MIT"),
    ("lgpl", "// SPDX-License-Identifier: LGPL-2.1-or-later"),
]


def test_whole_notices_at_any_width(spark):
    widths = (40, 60, 74, 10_000)
    rows = [(k, f"Some plain prose number {k}, of and in the text,\nwith no meaning at all.\nmore of it for this work") for k in range(300)]
    planted = {1000 + k: (family, wrapped(text, w)) for k, (w, (family, text)) in enumerate((w, n) for w in widths for n in NOTICES)}
    rows += [(d, "words before it\n\n" + text + "\n\nwords behind it") for d, (_, text) in planted.items()] + [(None, "MIT License"), (None, "MIT License")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found, versions, nameless = defaultdict(set), defaultdict(set), []
    for r in licences.scan(docs, *licences.fit(docs)).collect():
        if r["doc_id"] is None:
            nameless.append(r["family"])
        elif r["family"] != "unknown":
            found[r["doc_id"]].add(r["family"])
            versions[r["doc_id"]].add(r["version"])
    assert nameless == ["mit", "mit"] and not any(d < 1000 for d in found)
    missed = {(d, family, tuple(found[d])) for d, (family, _) in planted.items() if family not in found[d]}
    wrong = {(d, family, tuple(found[d])) for d, (family, _) in planted.items() if found[d] - {family}}
    assert len(missed) <= len(planted) // 10 and len(wrong) <= len(planted) // 20, (missed, wrong)
    assert not [d for d, (family, _) in planted.items() if family in ("lgpl", "agpl") and "gpl" in found[d]], (missed, wrong)
    named = {"mpl": "2.0", "cc-by-sa": "4.0", "apache": "2.0"}
    assert all(named[f] in versions[d] for d, (f, _) in planted.items() if f in named and f in found[d])


def held_by(own, text):
    """The shares by plain loops."""
    pairs = lambda w: {f"{a} {b}" for a, b in zip(w, [*w[1:], "$"])}
    split = lambda x: [w for w in re.split(r"[^a-z0-9]+", x.lower()) if w]
    a, b = pairs(split(own)), pairs(split(text))
    k = len(a & b)
    return (k / min(len(a), len(b)) if k >= 4 else k / len(b) if k >= 2 else 0.0), k


def test_template_comparison_by_plain_loops(spark):
    texts = [t for own in licence_texts.templates().values() for t in own]
    owns = [texts[3], texts[20][:60], " ".join(texts[30].split()[5:20]), "of the above copyright notice", "plain words"]
    lists = [licences.bigrams(licences.words(F.lit(t))) for t in texts]
    rows = spark.createDataFrame([(t,) for t in owns], "line string").select("line", licences.contained(F.array_distinct(licences.bigrams(licences.words(F.col("line")))), F.array(*map(F.array_distinct, lists))).alias("like"))
    for r in rows.collect():
        assert tuple(r["like"]) == max(held_by(r["line"], t) for t in texts)


PAGE = """<title>t</title><p>Hello <b>big</b>   world<p>two<br>lines &amp; more&nbsp;x<ul><li>a<li>b<ol start=3><li>c<li>d</ol></ul>
<table><tr><th>Name<th>N<tr><td>long name<td>1<tr><td rowspan=2>r<td>x<tr><td>y</table>after<blockquote><p>q1<p>q2</blockquote><pre>
 a  b
   c</pre><div hidden>no</div><span style="display: none">no</span><details><summary>S</summary>no</details><script>"</p>"</script>end"""
SHOWN = """Hello big world

two
lines & more x

- a
- b
  3. c
  4. d

Name       N
long name  1
r          x
           y

after

> q1
>
> q2

 a  b
   c

S
end"""


def test_html_layout():
    assert render(parse(PAGE)) == SHOWN
    assert render(parse("<div>" * 30_000 + "deep" + "</div>" * 30_000)) == "deep"
    assert [render(parse(x)) for x in ("", "<", "a<b", "a < b &lt; c </i> <!-- x", "<table>out<td>in</table>")] == ["", "<", "a", "a < b < c", "out\n\nin"]


class _Words(HTMLParser):
    def __init__(self):
        super().__init__()
        self.out, self.skip = [], 0

    def handle_starttag(self, tag, attrs):
        self.skip += tag in ("script", "style", "head")
        self.out.append("" if tag in ("a", "b") else " ")

    def handle_endtag(self, tag):
        self.skip -= tag in ("script", "style", "head")
        self.out.append("" if tag in ("a", "b") else " ")

    def handle_data(self, data):
        self.out.append("" if self.skip else data)


def test_html_loses_no_word_of_the_pages(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    for r in html_text.rendered(pages).collect():
        w = _Words()
        w.feed(r["html"])
        w.close()
        assert re.sub(r"(?m)^\s*- ", "", r["text"]).split() == "".join(w.out).split()
        assert r["n_chars"] == len(r["text"])


def test_deep_lists_and_wide_spans_stay_in_proportion():
    import time

    for page in ("".join(f"<ul><li>item{k}" for k in range(20_000)), "".join(f"<blockquote>item{k}" for k in range(5_000))):
        began = time.process_time()
        text = render(parse(page))
        assert len(text) < 10 * len(page) and time.process_time() - began < 5
        assert re.findall(r"item\d+", text) == re.findall(r"item\d+", page)
    wide = "<table>" + "<tr><td colspan=1000>a<td>b" * 500 + "</table>"
    assert set(render(parse(wide)).split("\n")) == {"a  b"}
    assert render(parse("<table><tr><td colspan=2>x<td>y<tr><td>long one<td>z<td>w</table>")) == "x            y\nlong one  z  w"


def test_html_of_odd_rows(spark):
    pages = spark.createDataFrame([(1, None, "mine"), (2, "", "mine"), (3, "<p>x", "mine"), (3, "<p>x", "mine")], "page_id long, html string, text string")
    assert sorted((r["page_id"], r["text"]) for r in html_text.rendered(pages).collect()) == [(1, ""), (2, ""), (3, "x"), (3, "x")]
    assert html_text.rendered(pages.limit(0)).count() == 0


TALK = "conv_id long, turn long, role string, text string, segment string"


def test_chat_perspectives(spark):
    rows = [
        (1, 0, "system", "be kind", "x"), (1, 1, "ann", "hi", "x"), (1, 2, "bob", "yo <|end|>", "x"), (1, 3, "ann", None, "x"), (1, 3, "ann", None, "x"),
        (2, 0, "system", "alone", "x"), (None, 0, None, "who", "x"), (None, None, "ann", "first", "x"),
    ]
    rows += [(3, k, f"s{k % 3}", "long " * (k % 50), "x") for k in range(700)]
    talk = frame(spark, rows, TALK)
    out = defaultdict(list)
    for r in chat_format.rotated(talk).collect():
        out[r["conv_id"], r["perspective"]].append(r)
    assert set(out) == {(1, "ann"), (1, "bob"), (None, "unknown"), (None, "ann"), (3, "s0"), (3, "s1"), (3, "s2")}
    for (_, me), parts in out.items():
        parts.sort(key=lambda r: r["nth"])
        assert [r["nth"] for r in parts] == list(range(len(parts)))
        whole = "".join(r["segment"] for r in parts)
        for r in parts:
            assert whole[r["start"] : r["start"] + len(r["segment"])] == r["segment"]
            mine = whole[r["mask_start"] : r["mask_end"]]
            assert (r["chat_role"] == "assistant") == (r["speaker"] == me) == mine.endswith("<|end|>\n")
    ann = "".join(r["segment"] for r in out[1, "ann"])
    assert ann == "<|system|>\nbe kind<|end|>\n<|assistant|>\nhi<|end|>\n<|user name=bob|>\nyo <\\|end|><|end|>\n" + "<|assistant|>\n<|end|>\n" * 2
    assert chat_format.rotated(empty(spark, TALK)).count() == 0


def test_oracles_on_the_smallest_tables(spark):
    from taxaweave.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    db = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    for name, (fn, sql) in QUERIES.items():
        if sql:
            got, want = fn(spark, sf).toPandas(), db.sql(sql).df()
            cols = sorted(want.columns)
            assert sorted(got.columns) == cols
            order = lambda d: d[cols].astype(str).sort_values(cols).reset_index(drop=True)
            assert order(got).equals(order(want)), name
