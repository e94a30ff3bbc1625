import io
import random
from collections import defaultdict
from zlib import crc32

import numpy as np
import pytest

from taxaweave.llm import packing, token_files
from taxaweave.llm.common import scratch
from taxaweave.llm.tokens import Encoder, public_path
from tests.llm.cases import documents, empty, frame


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_path())
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def test_words_in_turn_equal_whole_texts(library):
    e = Encoder(public_path(), kept=500)
    r = random.Random(9)
    signs = ["a", "B", "'s", "'S", "İ", "é", "é", " ", " ", "\x1c", ".", ",", "..", "1", "２", "ß", "Σ", " ", "\n", "ς", "가", "!", "%", "’", "​", "x,", "Z.", "<|", "<|endoftext|>", "<|ENDOFTEXT|>"]
    texts = ["".join(r.choices(signs, k=r.randint(0, 12))) for _ in range(4000)] + [t or "" for _, t, *_ in documents()]
    for t in texts:
        assert np.frombuffer(e.ids(t.encode()), "<u4").tolist() == library(t), t


def test_very_long_texts_go_piece_by_piece(monkeypatch):
    from taxaweave.llm import common, ngram_sets

    texts = [" ".join(f"w{k}\tx,\n" for k in range(400)).encode(), b"", b"one", b" ", b"y" * 900]
    e = Encoder(public_path())
    want = [e.ids(t) for t in texts], ngram_sets.shingle_sets(texts, 3), ngram_sets.word_hashes(texts)[1].tolist()
    monkeypatch.setattr(common, "PIECE_BYTES", 100)
    assert len(common.cut_at_blanks(texts[0])) > 20 and b"".join(common.cut_at_blanks(texts[0])) == texts[0]
    assert [e.ids(t) for t in texts] == want[0] and ngram_sets.word_hashes(texts)[1].tolist() == want[2]
    assert all(np.array_equal(a, b) for a, b in zip(ngram_sets.shingle_sets(texts, 3), want[1], strict=True))


def test_packing_is_whole_and_tight(spark, library):
    docs = frame(spark)
    cut = packing.pieces(docs, public_path(), with_ids=True).cache()
    placed = packing.pack(cut)
    rows = placed.collect()
    want = sorted(str((d, crc32(np.array(library(t) + [0], "<u4").tobytes()))) for d, t, *_ in documents())
    whole = defaultdict(list)
    for r in rows:
        whole[r["doc_id"]].append(r)
        assert r["length"] == len(r["ids"]) and crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"]
    got = []
    for doc, ps in whole.items():
        ps.sort(key=lambda r: r["piece"])
        copies = sum(p["piece"] == 0 for p in ps)
        assert len({p["piece"] for p in ps}) * copies == len(ps)
        ids = sum((p["ids"] for p in ps[::copies]), [])
        assert [p["start"] for p in ps[::copies]] == np.cumsum([0, *(p["length"] for p in ps[::copies])])[:-1].tolist()
        if doc is not None:
            got += [str((doc, crc32(np.array(ids, "<u4").tobytes())))] * copies
    assert sorted(got) == [w for w in want if not w.startswith("(None")]
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in bins.values():
        parts.sort()
        assert [o for o, _ in parts] == np.cumsum([0, *(n for _, n in parts)])[:-1].tolist()
        assert sum(n for _, n in parts) <= 2048
    assert len(bins) == -(-sum(r["length"] for r in rows) // 2048)  # no bin to spare here
    seqs = packing.sequences(placed).collect()
    assert sum(len(s["ids"]) for s in seqs) == sum(r["length"] for r in rows)


def test_bin_plan_against_lower_bound_and_capacity():
    r = np.random.default_rng(4)
    for sizes in (r.integers(1, 2049, 5000), r.integers(600, 1100, 3000), np.full(1000, 700), np.array([1, 2048])):
        hist = {int(k): int(n) for k, n in zip(*np.unique(sizes, return_counts=True), strict=True)}
        load, used = defaultdict(int), defaultdict(int)
        for length, lo, per, first, offset, hi in packing.bin_plan(hist):
            assert lo == used[length] and (hi - lo) % per == 0
            used[length] = hi
            for k in range((hi - lo) // per):
                assert load[first + k] == offset
                load[first + k] += per * length
        assert dict(used) == hist and max(load.values()) <= 2048
        if len(hist) > 1000:
            assert len(load) <= -(-sizes.sum() // 2048) * 1.01 + 1


def test_fullest_bins_against_all_subsets():
    r = np.random.default_rng(2)
    for _ in range(150):
        capacity = int(r.integers(5, 60))
        pieces = r.integers(1, capacity + 1, int(r.integers(1, 11)))
        counts = np.bincount(pieces, minlength=capacity + 1)
        chosen = packing.fullest(counts, capacity)
        longest = int(pieces.max())
        rest = list(pieces)
        rest.remove(longest)
        sums = {0}
        for p in rest:  # every subset
            sums |= {s + int(p) for s in sums}
        best = longest + max(s for s in sums if s <= capacity - longest)
        assert sum(length * n for length, n in chosen.items()) == best
        assert chosen[longest] >= 1 and all(0 < n <= counts[length] for length, n in chosen.items())


def test_packing_of_nothing(spark):
    assert packing.best_fit(empty(spark), public_path()).count() == 0


def test_token_files_round_trip(spark, library):
    folder = scratch(spark, "files")
    manifest = token_files.write_files(frame(spark), folder, public_path(), file_docs=20)
    assert manifest.count() > 2
    rows = token_files.read_files(manifest, with_ids=True).collect()
    got = sorted(str((r["doc_id"], list(r["ids"]))) for r in rows)
    assert got == sorted(str((d, library(t) + [2])) for d, t, *_ in documents())
    at = 0
    for r in sorted(rows, key=lambda r: r["start"]):
        assert r["start"] == at and r["n_tokens"] == len(r["ids"]) and r["ids_crc32"] == crc32(np.array(r["ids"], "<u4").tobytes())
        at += r["n_tokens"]
    ids = [r["doc_id"] for r in sorted(rows, key=lambda r: r["start"]) if r["doc_id"] is not None]
    assert ids == sorted(ids)
    some = token_files.read_files(manifest, only=[1006, 3, 77777]).collect()
    assert {r["doc_id"] for r in some} == {3, 1006}


def test_rows_of_one_or_no_id_are_cut_into_files(spark, library):
    rows = [(None, f"text {k} of no id") for k in range(1000)] + [(7, f"one id {k}") for k in range(500)]
    rows += [(k, f"own id {k}") for k in range(-150, 150) if k != 7] + [(-(1 << 63), "the least id"), (9, None), (9, "")]
    docs = frame(spark, [(d, t, None, None, 0) for d, t in rows])
    manifest = token_files.write_files(docs, scratch(spark, "files"), public_path(), file_docs=100)
    files = manifest.collect()
    assert sum(r["docs"] for r in files) == len(rows) and max(r["docs"] for r in files) < 200
    out = token_files.read_files(manifest, with_ids=True).collect()
    assert sorted(str((r["doc_id"], list(r["ids"]))) for r in out) == sorted(str((d, library(t) + [2])) for d, t in rows)
    ids = [r["doc_id"] for r in sorted(out, key=lambda r: r["start"])]
    assert ids[:1000] == [None] * 1000 and ids[1000] == -(1 << 63) and ids[1000:] == sorted(ids[1000:])
    some = token_files.read_files(manifest, only=[7, -(1 << 63), 0]).groupBy("doc_id").count().collect()
    assert {r["doc_id"]: r["count"] for r in some} == {7: 500, -(1 << 63): 1, 0: 1}
    small = token_files.write_files(docs, scratch(spark, "files"), public_path(), file_bytes=2000)
    assert small.count() > 8  # cut by bytes


def test_token_files_of_nothing(spark):
    assert token_files.read_files(token_files.write_files(empty(spark), scratch(spark, "files"), public_path())).count() == 0


class _File(io.BytesIO):
    def size(self):
        return len(self.getbuffer())


class _Sink(io.BytesIO):
    def close(self):
        pass


def test_frames_are_independent_and_checked():
    import zstandard

    sink = _Sink()
    w = token_files.Writer(sink, 2)
    all_ids = [np.arange(n, dtype="<u4") % 50_000 for n in (1, 0, 200_000, 5)]
    for k, ids in enumerate(all_ids):
        w.put(k * 10, len(ids), *token_files.frames(ids.tobytes(), 2))
    w.close()
    data = sink.getvalue()
    r = token_files.Reader(_File(data))
    assert [r.ids(k).tolist() for k in (3, 2, 1, 0)] == [x.tolist() for x in all_ids[::-1]]
    stream = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True)
    assert len(stream.read()) == 2 * sum(map(len, all_ids))  # a plain zstandard stream too
    bad = bytearray(data)
    bad[int(r.starts[2]) + 40] ^= 255
    with pytest.raises(Exception):
        token_files.Reader(_File(bytes(bad))).ids(2)
    assert token_files.Reader(_File(bytes(bad))).ids(3).tolist() == all_ids[3].tolist()
