"""Runs (maximal repetitions) of integer sequences by Lyndon roots.

``lyndon_array`` is phase one of Baier's suffix sorter: suffixes start in
groups by their first symbol; groups are taken from the highest down, each
suffix of a group is linked to the nearest suffix to its left in a lower group,
and the linked ones move, by the number of links, to new groups right above
their old ones, whose context grows by as many copies of the group's. When a
group is taken its context is the longest Lyndon word at each of its suffixes.

``runs`` takes the Lyndon arrays under an order and its reverse. Every run has a
Lyndon root among them, and is that root extended to both sides by longest
common extensions (LCE), here exact ones over the dictionary of basic factors.
"""

from __future__ import annotations

import numpy as np


def lyndon_array(rank: list[int]) -> list[int]:
    """Length of the longest Lyndon word at each position. ``rank`` starts with
    0; a 0 parts two sequences (its own entry is 0). Linear time."""
    n, top = len(rank), max(rank)
    members: list[list[int]] = [[] for _ in range(top + 1)]
    for i, r in enumerate(rank):
        members[r].append(i)
    group = list(rank)
    context = [1] * (top + 1)
    below = list(range(-1, top))
    above = list(range(1, top + 2))
    left = list(range(n))  # itself until its group is taken, then a suffix to the left
    out = [0] * n
    g = top
    while g:
        size = context[g]
        linked: list[int] = []
        links: list[int] = []
        last = -1
        for i in members[g]:
            if group[i] != g:
                continue
            out[i] = size
            p = i - 1
            while (q := left[p]) != p:
                p = q
            left[i] = p
            if p == last:
                links[-1] += 1
            else:
                last = p
                linked.append(p)
                links.append(1)
        by_links = zip(links, linked, strict=True)
        if len(linked) > 1:
            by_links = sorted(by_links, key=lambda x: -x[0])
        made: dict[tuple[int, int], int] = {}
        for n_links, p in by_links:
            old = group[p]
            if not old:
                continue
            new = made.get((n_links, old))
            if new is None:
                new = made[n_links, old] = len(members)
                members.append([p])
                context.append(context[old] + n_links * size)
                below.append(old)
                above.append(above[old])
                below[above[old]] = new
                above[old] = new
            else:
                members[new].append(p)
            group[p] = new
        g = below[g]
    return out


class Extensions:
    """Longest common extensions: names of all factors of length 1, 2, 4, ...,
    up to the length at which no factor occurs twice."""

    def __init__(self, symbols: np.ndarray):
        self.n = len(symbols)
        names = np.unique(symbols, return_inverse=True)[1].astype(np.int64)
        self.names = [names.astype(np.int32)]
        while (size := 1 << len(self.names)) <= self.n:
            half = size >> 1
            pairs = names[: self.n - size + 1] * (names.max() + 1) + names[half : self.n - half + 1]
            found, names = np.unique(pairs, return_inverse=True)
            if len(found) == len(pairs):
                break
            names = names.astype(np.int64)
            self.names.append(names.astype(np.int32))

    def right(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How far the sequences from ``a`` and from ``b`` > ``a`` on agree."""
        a, b = a.copy(), b.copy()
        start = a.copy()
        for k in range(len(self.names) - 1, -1, -1):
            names = self.names[k]
            fits = np.flatnonzero(b < len(names))
            same = fits[names[a[fits]] == names[b[fits]]]
            a[same] += 1 << k
            b[same] += 1 << k
        return a - start

    def left(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How far the sequences that end before ``a`` and before ``b`` > ``a`` agree."""
        a, b = a.copy(), b.copy()
        start = a.copy()
        for k in range(len(self.names) - 1, -1, -1):
            names, size = self.names[k], 1 << k
            fits = np.flatnonzero(a >= size)
            same = fits[names[a[fits] - size] == names[b[fits] - size]]
            a[same] -= size
            b[same] -= size
        return start - a


def runs(sequences: list[np.ndarray], min_length: int = 2) -> np.ndarray:
    """Rows (sequence, start, length, period) of all runs of ``min_length`` or
    more and of twice their period or more, in that order."""
    lengths = np.array([len(s) for s in sequences], np.int64)
    if not lengths.sum():
        return np.empty((0, 4), np.int64)
    starts = np.concatenate([[0], np.cumsum(lengths + 1)])[:-1] + 1  # a separator before each
    n = int(lengths.sum() + len(lengths))
    rank = np.zeros(n, np.int64)
    inside = np.ones(n, bool)
    inside[starts - 1] = False
    rank[inside] = np.unique(np.concatenate(sequences), return_inverse=True)[1] + 1
    symbols = np.where(inside, rank, rank.max() + 1 + np.arange(n))  # separators differ from all others
    lce = Extensions(symbols)
    found = []
    for order in (rank, np.where(inside, rank.max() + 1 - rank, 0)):
        period = np.array(lyndon_array(order.tolist()), np.int64)
        at = np.flatnonzero(period > 0)
        at = at[at + period[at] < n]
        p = period[at]
        back = lce.left(at, at + p)
        length = back + p + lce.right(at, at + p)
        keep = (length >= 2 * p) & (length >= min_length)
        found.append(np.stack([at[keep] - back[keep], length[keep], p[keep]], axis=1))
    rows = np.unique(np.concatenate(found), axis=0)
    of = np.searchsorted(starts, rows[:, 0], side="right") - 1
    rows = np.column_stack([of, rows[:, 0] - starts[of], rows[:, 1:]])
    return rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]


#: Multipliers of the hash of a few consecutive symbols.
_STEP, _DOC = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def repetitive_parts(symbols: np.ndarray, ends: np.ndarray, min_length: int) -> list[tuple[int, int]]:
    """Stretches [from, to) that hold every run of ``min_length`` or more; all
    else is in none. ``ends`` are the ends of the sequences laid side by side.

    With k = min_length // 3, take the places at which a k-gram starts that its
    sequence holds twice. A run of length L and period q has such places from its
    start to its (L-q-k)-th word and from its q-th to its (L-k)-th: it begins and
    ends with one, and leaves at most k - 1 others between them, as L >= 2q.
    Equal hashes of unlike k-grams only add places.
    """
    k = max(1, min_length // 3)
    n = len(symbols)
    if n < k:
        return []
    of = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
    h = of[: n - k + 1].astype(np.uint64) * _DOC
    for j in range(k):
        h = (h ^ symbols[j : n - k + 1 + j].astype(np.uint64)) * _STEP
        h ^= h >> np.uint64(29)
    whole = np.flatnonzero(of[: n - k + 1] == of[k - 1 :])
    h = h[whole]
    ordered = np.sort(h)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return []
    places = whole[twice[np.minimum(np.searchsorted(twice, h), len(twice) - 1)] == h]
    new = np.flatnonzero((np.diff(places) > k) | (of[places[1:]] != of[places[:-1]])) + 1
    first, last = places[np.concatenate([[0], new])], places[np.concatenate([new - 1, [len(places) - 1]])] + k
    keep = last - first >= min_length
    return list(zip(first[keep].tolist(), last[keep].tolist(), strict=True))


def runs_of_all(sequences: list[np.ndarray], min_length: int = 12) -> np.ndarray:
    """As ``runs``, searching only the parts that repeat something."""
    ends = np.cumsum([len(s) for s in sequences])
    if not len(ends) or not ends[-1]:
        return np.empty((0, 4), np.int64)
    symbols = np.concatenate(sequences)
    parts = repetitive_parts(symbols, ends, min_length)
    rows = runs([symbols[a:b] for a, b in parts], min_length)
    at = np.array([a for a, _ in parts], np.int64)[rows[:, 0]] + rows[:, 1] if len(rows) else rows[:, 1]
    of = np.searchsorted(ends, at, side="right")
    rows = np.column_stack([of, at - (ends[of] - np.array([len(s) for s in sequences])[of]), rows[:, 2:]])
    return rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]
