"""Shingle sets of texts, their count vectors and their bucket keys, as numpy
arrays over many texts at once. Helpers of ``ngram_join``.

Shingles stand as 64-bit hashes. A pair is linked when ``100 * overlap >=
near * union``, so two linked sets differ (symmetric difference) in at most
``smaller * (100 - near) / near`` shingles.
"""

from __future__ import annotations

import numpy as np

from taxaweave.llm.common import cut_at_blanks

U = np.uint64
#: Coordinates of a point: shingles are counted in so many hash groups.
GROUPS = 64
#: Slots of the corpus-wide count of shingles.
SLOTS = 1 << 18
#: Size classes: a class ends where the sizes have grown by this factor.
CLASS_GROWTH = 1.5

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_ODD = U(0x9E3779B97F4A7C15)
_INVERSE = U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_POWERS = [np.ones(1, U), np.ones(1, U)]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64 bits (splitmix64's finaliser)."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


_BYTES = mix(np.arange(1, 257, dtype=U))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        size = 1 << n.bit_length()
        for k, base in enumerate((_ODD, _INVERSE)):
            steps = np.full(size, base, U)
            steps[0] = 1
            _POWERS[k] = np.multiply.accumulate(steps)
    return _POWERS[0], _POWERS[1]


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of ``texts`` in order, and the number of words of
    each text. Very long texts are hashed piece by piece."""
    pieces = [cut_at_blanks(t) for t in texts]
    if all(len(p) == 1 for p in pieces):
        return _hashed(texts)
    parts = [_hashed(p[:1]) if len(p) == 1 else tuple(map(np.concatenate, zip(*(_hashed([x]) for x in p), strict=True))) for p in pieces]
    return np.concatenate([h for h, _ in parts]), np.array([int(c.sum()) for _, c in parts], np.int64)


def _hashed(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """As above. A word's hash is a polynomial in its bytes, read off prefix sums."""
    data = b"\n".join(texts) + b"\n"
    raw = np.frombuffer(data.translate(_LOWER), np.uint8)
    ends_at = np.cumsum([len(t) + 1 for t in texts])
    space = _SPACE[raw]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if not space[0]:
        edge = np.concatenate([[0], edge])
    starts, ends = edge[0::2], edge[1::2]
    power, inverse = _powers(len(raw))
    total = np.empty(len(raw) + 1, U)
    total[0] = 0
    np.cumsum(_BYTES[raw] * power[: len(raw)], out=total[1:])
    hashes = mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(U))
    upto = np.searchsorted(starts, ends_at)
    return hashes, np.diff(np.concatenate([[0], upto]))


def shingle_sets(texts: list[bytes | None], n_words: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text: of every ``n_words``
    words, of all words where there are fewer, of nothing where there are none."""
    hashes, counts = word_hashes([t or b"" for t in texts])
    padded = np.concatenate([hashes, np.zeros(n_words, U)])
    chained = padded
    for k in range(1, n_words):
        chained = mix(chained[:-1] * U(2 * k + 1) + padded[k : len(chained) - 1 + k])
    out, at = [], 0
    for n in counts.tolist():
        if n >= n_words:
            own = np.sort(chained[at : at + n - n_words + 1])
            keep = np.empty(len(own), bool)
            keep[0] = True
            np.not_equal(own[1:], own[:-1], out=keep[1:])
            out.append(own[keep])
        elif n:
            whole = hashes[at : at + 1]
            for k in range(1, n):
                whole = mix(whole * U(2 * k + 1) + hashes[at + k : at + k + 1])
            out.append(mix(whole + U(n)))
        else:
            out.append(np.zeros(0, U))
        at += n
    return out


def set_id(s: np.ndarray) -> int:
    """One id for equal sets (of their content and size)."""
    return int(mix(np.array([int(np.sum(mix(s ^ U(0x5851F42D4C957F2D)))) + len(s) & (1 << 64) - 1], U))[0].view(np.int64))


def point(s: np.ndarray) -> np.ndarray:
    """Counts of the set's shingles by hash group."""
    return np.bincount((s & U(GROUPS - 1)).astype(np.int64), minlength=GROUPS)


def size_class(n: int, least: int) -> tuple[int, int]:
    """(first, last) size of the class of size ``n``."""
    lo = least
    while True:
        hi = int(lo * CLASS_GROWTH)
        if n <= hi:
            return lo, hi
        lo = hi + 1


def level(counts: np.ndarray) -> np.ndarray:
    """Slot counts on a fine logarithmic scale, a byte each."""
    return np.minimum(4 * np.log2(counts + 1.0), 255).astype(np.uint8)


def slots(s: np.ndarray) -> np.ndarray:
    return (s & U(SLOTS - 1)).astype(np.int64)


def bucket_keys(s: np.ndarray, near: int, levels: np.ndarray) -> np.ndarray:
    """Bucket keys such that any two different linked sets share one.

    In the smaller set's size class at most ``k = last * (100 - near) / near``
    shingles differ. Both sets are cut by hash into ``m = 2 * (k + 1)`` groups;
    each differing shingle spoils one group, so at least ``m - k`` group
    contents are equal in both. By the prefix principle it is enough to key
    each set by its first ``k + 1`` contents in any common order. The order is
    by the count of the content's rarest shingle in the corpus (``levels`` by
    slot), so that what many documents share comes last, then by falling size.
    A set is keyed in its own class and in all below that a smaller partner
    may be in.
    """
    n = len(s)
    least = -(-near // (100 - near))  # smaller sets link with equal ones only
    if n < least:
        return np.zeros(0, U)
    lo, hi = size_class(n, least)
    classes = [(lo, hi)]
    while lo > least and near * n <= 100 * (lo - 1):
        lo, hi = size_class(lo - 1, least)
        classes.append((lo, hi))
    upto = np.concatenate([np.zeros(1, U), np.cumsum(mix(s), dtype=U)])
    rare = np.append(levels[slots(s)], np.uint8(255))
    out = []
    for lo, hi in classes:
        k = hi * (100 - near) // near
        m = 2 * (k + 1)
        group = ((s >> U(32)) * U(m)) >> U(32)
        count = np.bincount(group.astype(np.int64), minlength=m)
        ends = np.cumsum(count)
        keys = mix(upto[ends] - upto[ends - count] + mix(np.arange(m, dtype=U) + U(lo << 32)))
        common = np.where(count > 0, np.minimum.reduceat(rare, ends - count), 255)
        out.append(keys[np.lexsort((keys, -count, common))[: k + 1]])
    return np.unique(np.concatenate(out)) if len(out) > 1 else out[0]
