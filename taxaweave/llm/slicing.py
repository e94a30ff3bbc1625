"""Leading eigenpairs of a symmetric matrix by spectrum slicing.

The inertia of A - sI, read off a pivoted LDL' factorisation, counts the
eigenvalues below s. Counts bisect an interval until it holds one of the wanted
eigenvalues alone; Rayleigh quotient iteration then converges to it cubically,
and two more counts close to the result certify its number. Eigenvalues that
no bisection parts are taken as a group: inverse iteration spans its subspace,
in which the group is sliced again, relative to its own spread.
"""

from __future__ import annotations

import numpy as np

EPS = np.finfo(float).eps
#: Bunch and Kaufman's growth constant, (1 + sqrt(17)) / 8.
_ALPHA = (1 + 17**0.5) / 8
#: An interval this narrow, against the norm, whose eigenvalues are several is a group.
GROUP = 1e-9


def below(a: np.ndarray, shift: float) -> int:
    """How many eigenvalues of ``a`` are less than ``shift``: the negative ones
    of D in P(A - shift)P' = LDL', with 1x1 and 2x2 pivots (Bunch and Kaufman)."""
    m = a - shift * np.eye(len(a))
    tiny = EPS * max(np.abs(m).max(initial=0), 1e-300)
    count = 0
    while (n := len(m)) > 0:
        column = np.abs(m[1:, 0])
        r = 1 + int(column.argmax()) if n > 1 else 0
        most = column[r - 1] if n > 1 else 0.0
        size = 1
        if abs(m[0, 0]) < _ALPHA * most:
            row = np.abs(m[r])
            row[r] = 0
            if abs(m[0, 0]) * row.max() < _ALPHA * most * most:
                if abs(m[r, r]) >= _ALPHA * row.max():
                    swap, to = r, 0
                else:
                    size, swap, to = 2, r, 1
                if swap != to:
                    m[[swap, to]] = m[[to, swap]]
                    m[:, [swap, to]] = m[:, [to, swap]]
        if size == 1:
            d = m[0, 0]
            if abs(d) <= tiny:  # an eigenvalue at the shift: not less than it
                d = tiny
            count += d < 0
            c = m[1:, 0]
            m = m[1:, 1:] - np.outer(c, c / d)
        else:  # such a block has one eigenvalue of either sign
            count += 1
            c = m[2:, :2]
            m = m[2:, 2:] - c @ np.linalg.solve(m[:2, :2], c.T)
    return count


def _quotient_iteration(a: np.ndarray, x: np.ndarray, shift: float, steps: int = 12) -> tuple[float, np.ndarray]:
    """Rayleigh quotient iteration; the first solves keep the shift."""
    norm = np.abs(a).sum(axis=1).max()
    e = shift
    for step in range(steps):
        try:
            x = np.linalg.solve(a - e * np.eye(len(a)), x)
        except np.linalg.LinAlgError:  # e is an eigenvalue to the last bit
            x = np.linalg.solve(a - (e + 4 * EPS * norm) * np.eye(len(a)), x)
        x /= np.linalg.norm(x)
        quotient = x @ a @ x
        left = np.linalg.norm(a @ x - quotient * x)
        if step > 1:
            e = quotient
        if step > 2 and left <= 16 * EPS * norm:
            break
    return quotient, x


def _group(a: np.ndarray, shift: float, m: int, known: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``m`` eigenpairs about ``shift``, orthogonal to the ``known`` ones."""
    norm = np.abs(a).sum(axis=1).max()
    x = np.random.default_rng(seed).standard_normal((len(a), m))
    for _ in range(4):
        x -= known @ (known.T @ x)
        x = np.linalg.qr(x)[0]
        x = np.linalg.solve(a - (shift + GROUP * norm / 7) * np.eye(len(a)), x)
    x -= known @ (known.T @ x)
    x = np.linalg.qr(x)[0]
    inner = x.T @ (a @ x) - shift * np.eye(m)
    inner = (inner + inner.T) / 2
    if np.abs(inner).max() <= 64 * EPS * norm:
        return shift + np.diag(inner), x  # equal to double precision: any basis is one
    values, own = leading(inner, m)
    return shift + values, x @ own


def _orthogonal(x: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Unit columns without their last traces of the ``known`` ones and of each other."""
    for j in range(x.shape[1]):
        for _ in range(2):
            x[:, j] -= known @ (known.T @ x[:, j])
            x[:, j] /= np.linalg.norm(x[:, j])
        known = np.column_stack([known, x[:, j]])
    return known


def leading(a: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of ``a``, falling, and unit eigenvectors (columns)."""
    d = len(a)
    k = min(k, d)
    norm = np.abs(a).sum(axis=1).max(initial=0)
    if not norm:
        return np.zeros(k), np.eye(d)[:, :k]
    counts: dict[float, int] = {-1.0371 * norm: 0, 1.1933 * norm: d}  # uneven, so that no middle is a likely eigenvalue

    def count(s: float) -> int:
        if s not in counts:
            counts[s] = below(a, s)
        return counts[s]

    values, vectors = np.zeros(0), np.zeros((d, 0))
    while len(values) < k:
        number = d - len(values) - 1  # of the wanted one, from 0 and from below
        hi = min(s for s, c in counts.items() if c > number)
        lo = max(s for s, c in counts.items() if c <= number and s < hi)
        found = None
        while found is None:
            if count(lo) == number and count(hi) == number + 1:
                start = np.random.default_rng(number).standard_normal(d)
                start -= vectors @ (vectors.T @ start)
                e, x = _quotient_iteration(a, start, (lo + hi) / 2)
                converged = np.linalg.norm(a @ x - e * x) <= 256 * EPS * norm
                if converged and (lo < e < hi or hi - lo <= 64 * EPS * norm):
                    found = np.array([e]), x[:, None]
                    break
            if hi - lo <= GROUP * norm:
                while count(lo - GROUP * norm) < count(lo):  # a group is not cut
                    lo -= GROUP * norm
                several = number + 1 - count(lo)
                if several > 1:
                    e, x = _group(a, (lo + hi) / 2, several, vectors, number)
                    order = np.argsort(-e, kind="stable")
                    # the group's upper members may be known already
                    found = e[order], x[:, order]
                    break
            middle = (lo + hi) / 2
            if not lo < middle < hi:
                raise ArithmeticError("an eigenvalue could not be isolated")
            if count(middle) <= number:
                lo = middle
            else:
                hi = middle
        near = max(GROUP * norm, 4 * EPS * norm)
        top, bottom = found[0][0] + near, found[0][-1] - near
        if not (count(bottom) <= number - len(found[0]) + 1 and count(top) >= number + 1):
            raise ArithmeticError("inertia counts do not certify an eigenvalue's number")
        values, vectors = np.concatenate([values, found[0]]), _orthogonal(found[1], vectors)
    return values[:k], vectors[:, :k]
