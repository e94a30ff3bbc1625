"""A bidirectional gated recurrent network with attention pooling, in numpy.

Input of a word: a trained vector of the word (hashed table) beside the mean of
trained vectors of its character trigrams (hashed table). A window of words
runs through two GRUs, attention pools their states, a linear layer gives the
window's logit. A document's logit is the mean of its windows' logits weighted
by their softmax: a smooth maximum.
"""

from __future__ import annotations

import numpy as np

from taxaweave.llm.common import NORMAL
from taxaweave.llm.ngram_sets import mix, word_hashes

WINDOW, STRIDE = 48, 32
WORDS, WORD_DIM = 1 << 14, 16
TRIGRAMS, CHAR_DIM = 1 << 12, 8
HIDDEN, ATTENTION = 8, 8
#: Texts of more bytes are scored in parts; bytes by which the parts overlap.
LONG_BYTES, OVERLAP_BYTES = 4 << 20, 4 << 10
#: Words in fewer training texts share one vector: alone they could only be learnt by heart.
MIN_TEXTS = 4
#: Decay of all parameters per step, as a share of the rate.
DECAY = 0.02
#: Share of words hidden from each training step.
DROPPED = 0.3
F32 = np.float32


class Windows:
    """All overlapping windows of some texts: ``word`` and ``trigrams`` describe
    the distinct words, ``idx`` (windows x WINDOW) says which word stands where
    (padding: the last row), ``doc`` whose window it is."""

    def __init__(self, texts: list[bytes | None]):
        clean = [(t or b"").translate(NORMAL) for t in texts]
        hashes, counts = word_hashes(clean)
        distinct, first, where = np.unique(hashes, return_index=True, return_inverse=True)
        self.n_words = counts
        self.word = (distinct % np.uint64(WORDS)).astype(np.int64)
        self._trigrams(clean, first)
        starts, sizes, doc, at = [], [], [], 0
        for d, n in enumerate(counts.tolist()):
            if n:
                own = list(range(0, max(n - WINDOW, 0) + 1, STRIDE))
                if own[-1] + WINDOW < n:
                    own.append(n - WINDOW)
                starts.extend(at + x for x in own)
                sizes.extend([min(n, WINDOW)] * len(own))
                doc.extend([d] * len(own))
            at += n
        self.doc, self.sizes = np.array(doc, np.int64), np.array(sizes, np.int64)
        padded = np.concatenate([where, np.zeros(WINDOW, where.dtype)])
        place = np.arange(WINDOW)
        self.idx = padded[np.array(starts, np.int64)[:, None] + place] if starts else np.zeros((0, WINDOW), np.int64)
        self.mask = place < self.sizes[:, None]

    def _trigrams(self, clean: list[bytes], first: np.ndarray) -> None:
        raw = np.frombuffer(b" ".join(clean) + b" ", np.uint8)
        word = raw != 32
        edge = np.diff(np.concatenate([[0], word.view(np.int8)]))
        starts, ends = np.flatnonzero(edge == 1)[first], np.flatnonzero(edge == -1)[first]
        # of " word " there are as many trigrams as letters
        size = ends - starts
        self.ends = np.cumsum(size)
        at = np.repeat(starts - (self.ends - size), size) + np.arange(int(size.sum()))
        wide = np.concatenate([[32], raw]).astype(np.uint64)  # shifted by one
        code = wide[at] << np.uint64(16) | wide[at + 1] << np.uint64(8) | wide[at + 2]
        self.trigram = (mix(code) % np.uint64(TRIGRAMS)).astype(np.int64)
        self.size = size


def start(seed: int = 7) -> dict[str, np.ndarray]:
    r = np.random.default_rng(seed)
    wide = WORD_DIM + CHAR_DIM
    p = {
        "word": r.normal(0, 0.03, (WORDS, WORD_DIM)),
        "char": r.normal(0, 0.03, (TRIGRAMS, CHAR_DIM)),
        "w": r.normal(0, wide**-0.5, (2, wide, 3 * HIDDEN)),
        "b": np.zeros((2, 1, 3 * HIDDEN)),
        "u": r.normal(0, HIDDEN**-0.5, (2, HIDDEN, 3 * HIDDEN)),
        "a": r.normal(0, 0.3, (2 * HIDDEN, ATTENTION)),
        "ab": np.zeros(ATTENTION),
        "v": r.normal(0, 0.3, ATTENTION),
        "o": r.normal(0, 0.3, 2 * HIDDEN),
        "ob": np.full(1, -2.0),
    }
    return {k: v.astype(F32) for k, v in p.items()} | {"row": np.arange(WORDS)}


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def inputs(p: dict, x: Windows) -> np.ndarray:
    sums = np.add.reduceat(p["char"][x.trigram], x.ends - x.size, axis=0) / x.size[:, None].astype(F32)
    return np.concatenate([p["word"][p["row"][x.word]], sums], axis=1)


def forward(p: dict, x: Windows, rows: slice = slice(None), vectors: np.ndarray | None = None, keep: bool = False):
    """Logits of the windows ``rows``; with ``keep`` also what backward needs."""
    vectors = inputs(p, x) if vectors is None else vectors
    drive = vectors @ p["w"] + p["b"]  # 2 x words x 3H
    idx, mask = x.idx[rows], x.mask[rows]
    n, steps = idx.shape
    partial = not mask.all()
    h = np.zeros((2, n, HIDDEN), F32)
    states = np.empty((steps, 2, n, HIDDEN), F32)
    tape = []
    for t in range(steps):
        back = steps - 1 - t
        a = np.stack([drive[0][idx[:, t]], drive[1][idx[:, back]]])
        g = h @ p["u"]
        zr = _sigmoid(a[..., : 2 * HIDDEN] + g[..., : 2 * HIDDEN])
        z, r = zr[..., :HIDDEN], zr[..., HIDDEN:]
        c = np.tanh(a[..., 2 * HIDDEN :] + r * g[..., 2 * HIDDEN :])
        new = c + z * (h - c)
        if partial:
            m = np.stack([mask[:, t], mask[:, back]])[..., None]
            new = np.where(m, new, h)
        if keep:
            tape.append((h, z, r, c, g[..., 2 * HIDDEN :], m if partial else None))
        h = new
        states[t] = h
    both = np.concatenate([states[:, 0], states[::-1, 1]], axis=2)  # steps x n x 2H
    hid = np.tanh(both @ p["a"] + p["ab"])
    score = np.where(mask.T, hid @ p["v"], F32(-1e9))
    weight = np.exp(score - score.max(axis=0))
    weight /= weight.sum(axis=0)
    context = np.einsum("tn,tnh->nh", weight, both)
    logit = context @ p["o"] + p["ob"][0]
    return (logit, (vectors, idx, tape, both, hid, weight, context)) if keep else logit


def backward(p: dict, x: Windows, kept: tuple, dlogit: np.ndarray) -> dict[str, np.ndarray]:
    vectors, idx, tape, both, hid, weight, context = kept
    steps, n = weight.shape
    g = {"o": context.T @ dlogit, "ob": dlogit.sum(keepdims=True)}
    dcontext = dlogit[:, None] * p["o"]
    dweight = np.einsum("nh,tnh->tn", dcontext, both)
    dboth = weight[..., None] * dcontext
    dscore = weight * (dweight - (weight * dweight).sum(axis=0))
    g["v"] = np.einsum("tn,tnk->k", dscore, hid)
    dhid = dscore[..., None] * p["v"] * (1 - hid * hid)
    g["a"] = np.einsum("tnh,tnk->hk", both, dhid)
    g["ab"] = dhid.sum(axis=(0, 1))
    dboth = dboth + dhid @ p["a"].T
    dstate = np.stack([dboth[..., :HIDDEN], dboth[::-1, :, HIDDEN:]], axis=1)  # steps x 2 x n x H
    ddrive = np.zeros((2, len(vectors), 3 * HIDDEN), F32)
    g["u"] = np.zeros_like(p["u"])
    dh = np.zeros((2, n, HIDDEN), F32)
    turned = p["u"].transpose(0, 2, 1)
    for t in reversed(range(steps)):
        h, z, r, c, gc, m = tape[t]
        dh = dh + dstate[t]
        through = 0 if m is None else np.where(m, 0, dh)
        dnew = dh if m is None else np.where(m, dh, 0)
        dc = dnew * (1 - z) * (1 - c * c)
        dz = dnew * (h - c) * z * (1 - z)
        dr = dc * gc * r * (1 - r)
        da = np.concatenate([dz, dr, dc], axis=2)
        dg = np.concatenate([dz, dr, dc * r], axis=2)
        g["u"] += h.transpose(0, 2, 1) @ dg
        np.add.at(ddrive[0], idx[:, t], da[0])
        np.add.at(ddrive[1], idx[:, steps - 1 - t], da[1])
        dh = through + dnew * z + dg @ turned
    g["b"] = ddrive.sum(axis=1, keepdims=True)
    g["w"] = vectors.T @ ddrive
    dvectors = (ddrive @ p["w"].transpose(0, 2, 1)).sum(axis=0)
    g["word"], g["char"] = np.zeros_like(p["word"]), np.zeros_like(p["char"])
    np.add.at(g["word"], p["row"][x.word], dvectors[:, :WORD_DIM])
    np.add.at(g["char"], x.trigram, np.repeat(dvectors[:, WORD_DIM:] / x.size[:, None].astype(F32), x.size, axis=0))
    return g


def pooled(logit: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per document the softmax-weighted mean of its windows' logits (0 windows:
    minus 30), and each window's weight."""
    top = np.full(n, -np.inf)
    np.maximum.at(top, doc, logit)
    e = np.exp(logit - top[doc])
    weight = e / np.bincount(doc, e, n)[doc]
    out = np.bincount(doc, weight * logit, n)
    out[np.isinf(top)] = -30
    return out, weight


def train(texts: list[bytes], labels: np.ndarray, steps: int, batch: int = 24, rate: float = 0.02, seed: int = 7) -> dict[str, np.ndarray]:
    """Adam on the documents' cross entropy, texts whole."""
    p = start(seed)
    r = np.random.default_rng(seed)
    m, v = ({k: np.zeros_like(x) for k, x in p.items()} for _ in range(2))
    seen = np.zeros(WORDS, np.int64)
    for text in texts:
        seen[np.unique(Windows([text]).word)] += 1
    p["row"] = np.where(seen >= MIN_TEXTS, np.arange(WORDS), 0)
    order: list[int] = []
    for step in range(1, steps + 1):
        if len(order) < batch:
            order += r.permutation(len(texts)).tolist()
        rows, order = order[:batch], order[batch:]
        x = Windows([texts[i] for i in rows])
        if not len(x.doc):
            continue
        x.mask &= r.random(x.mask.shape) >= DROPPED
        y = labels[rows].astype(float)
        logit, kept = forward(p, x, keep=True)
        doc, weight = pooled(logit.astype(float), x.doc, len(rows))
        slope = (_sigmoid(doc) - y) / len(rows)
        dlogit = (slope[x.doc] * weight * (1 + logit - doc[x.doc])).astype(F32)
        slow = rate * min(1, 2 * (1 - step / (steps + 1)))
        for k, grad in backward(p, x, kept, dlogit).items():
            m[k] += F32(0.1) * (grad - m[k])
            v[k] += F32(0.01) * (grad * grad - v[k])
            p[k] *= F32(1 - slow * DECAY)
            p[k] -= F32(slow) * (m[k] / F32(1 - 0.9**step)) / (np.sqrt(v[k] / F32(1 - 0.99**step)) + F32(1e-6))
    return p


def logits(p: dict, x: Windows, windows_at_once: int = 2048) -> np.ndarray:
    vectors = inputs(p, x)
    return np.concatenate([forward(p, x, slice(at, at + windows_at_once), vectors) for at in range(0, len(x.doc), windows_at_once)]).astype(float)


def pieces(text: bytes) -> list[bytes]:
    """A very long text in parts that overlap, cut at blanks where there are any."""
    out, lo = [], 0
    while len(text) - lo > LONG_BYTES:
        cut = text.rfind(b" ", lo + LONG_BYTES // 2, lo + LONG_BYTES)
        cut = cut if cut > 0 else lo + LONG_BYTES
        out.append(text[lo:cut])
        back = text.find(b" ", cut - OVERLAP_BYTES, cut)
        lo = back if back > 0 else cut
    return [*out, text[lo:]]


def scores(p: dict, texts: list[bytes | None]) -> np.ndarray:
    """Probability of label 1 of each whole text; a text without words has 0.
    A text of over ``LONG_BYTES`` is run part by part, its windows pooled as one."""
    out = np.zeros(len(texts))
    long = [k for k, t in enumerate(texts) if t and len(t) > LONG_BYTES]
    for k in long:
        own = [logits(p, x) for x in (Windows([t]) for t in pieces(texts[k])) if len(x.doc)]
        if own:
            every = np.concatenate(own)
            out[k] = _sigmoid(pooled(every, np.zeros(len(every), np.int64), 1)[0])[0]
    x = Windows([None if k in long else t for k, t in enumerate(texts)])
    if len(x.doc):
        doc, _ = pooled(logits(p, x), x.doc, len(texts))
        out = np.where(x.n_words > 0, _sigmoid(doc), out)
    return out
