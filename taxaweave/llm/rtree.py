"""A small packed R-tree over count vectors, held by one task.

Points are counts by hash group. The overlap of two sets is at most the sum,
over the groups, of the smaller count; for two subtrees the sum of the smaller
of their largest counts bounds every pair below.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

FANOUT = 16
#: Pairs of entries compared at a time.
CHUNK = 1 << 15


class RTree:
    def __init__(self, points: np.ndarray):
        """Bulk load: halve by the widest coordinate until a node is full."""
        self.points = points
        order = np.concatenate(list(self._leaves(np.arange(len(points))))) if len(points) else np.arange(0)
        self.order = order
        size = points.sum(axis=1)
        top, small, large = points[order], size[order], size[order]
        self.levels = [(top, small, large)]
        while len(top) > 1:
            at = np.arange(0, len(top), FANOUT)
            top, small, large = (f.reduceat(x, at, axis=0) for f, x in ((np.maximum, top), (np.minimum, small), (np.maximum, large)))
            self.levels.append((top, small, large))

    def _leaves(self, rows: np.ndarray) -> Iterator[np.ndarray]:
        if len(rows) <= FANOUT:
            yield rows
            return
        own = self.points[rows]
        by = own[:, int(np.argmax(own.max(axis=0) - own.min(axis=0)))]
        rows = rows[np.argsort(by, kind="stable")]
        half = -(-len(rows) // (2 * FANOUT)) * FANOUT
        yield from self._leaves(rows[:half])
        yield from self._leaves(rows[half:])


def joined(a: RTree, b: RTree, near: int = 90) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row pairs (of a, of b) whose bound allows ``near`` per cent of overlap to
    union. With ``a is b`` each unordered pair comes once."""
    same = a is b
    if not len(a.points) or not len(b.points) or same and len(a.points) == 1:
        return
    depth = max(len(a.levels), len(b.levels)) - 1
    stack = [(depth, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while stack:
        level, i, j = stack.pop()
        la, lb = min(level, len(a.levels) - 1), min(level, len(b.levels) - 1)
        (ta, sa, ga), (tb, sb, gb) = a.levels[la], b.levels[lb]
        fit = (100 * ga[i] >= near * sb[j]) & (100 * gb[j] >= near * sa[i])
        i, j = i[fit], j[fit]
        fit = (100 + near) * np.minimum(ta[i], tb[j]).sum(axis=1) >= near * (sa[i] + sb[j])
        i, j = i[fit], j[fit]
        if not len(i):
            continue
        if level == 0:
            yield a.order[i], b.order[j]
            continue
        # children; a tree of fewer levels waits at its root
        na, nb = (FANOUT if level == la else 1), (FANOUT if level == lb else 1)
        ci = (i[:, None, None] * na + np.arange(na)[None, :, None]).repeat(nb, axis=2).ravel() if na > 1 else i.repeat(nb)
        cj = (j[:, None, None] * nb + np.arange(nb)[None, None, :]).repeat(na, axis=1).ravel() if nb > 1 else j.repeat(na)
        below_a, below_b = len(a.levels[min(level - 1, len(a.levels) - 1)][0]), len(b.levels[min(level - 1, len(b.levels) - 1)][0])
        ok = (ci < below_a) & (cj < below_b)
        if same:
            ok &= (ci < cj) if level == 1 else (ci <= cj)
        ci, cj = ci[ok], cj[ok]
        stack.extend((level - 1, ci[at : at + CHUNK], cj[at : at + CHUNK]) for at in range(0, len(ci), CHUNK))
