"""Unigram piece models whose word probability sums over all segmentations.

A word (UTF-8 bytes, lower case, after a blank) is cut into pieces of a fixed
public vocabulary, which holds every single byte. The forward algorithm sums the
product of piece probabilities over all cuts; forward and backward sums together
give the expected count of each piece (``expected``), the E-step of training.
"""

from __future__ import annotations

import base64

import numpy as np

#: Longest word in bytes; a longer one is scored part by part. Keeps a product
#: of the least probabilities (``FLOOR`` / pieces, once a byte) above 1e-290.
LONGEST = 32
#: Share of probability dealt evenly to all pieces.
FLOOR = 1e-3
#: Words cut at a time.
BLOCK = 20_000


def public_pieces(name: str = "byte_bpe_multi_50k.tiktoken") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


_PRIME, _SHIFT = np.uint64(0x9E3779B97F4A7C15), np.uint64(32)
_BITS = 18
_DROPPED = np.uint64(64 - _BITS)


def _next_hash(h: np.ndarray, byte: np.ndarray) -> np.ndarray:
    """64-bit hashes of strings one byte longer."""
    h = (h ^ (byte.astype(np.uint64) + np.uint64(1))) * _PRIME
    return h ^ (h >> _SHIFT)


class Vocabulary(dict):
    """piece -> number. ``by_length`` has, for looking up many strings at once,
    the sorted hashes of the pieces of one length, their numbers, and by leading
    bits of a hash whether there is one at all."""

    def __init__(self, pieces: list[bytes]):
        super().__init__((piece, n) for n, piece in enumerate(pieces))
        by: dict[int, list[bytes]] = {}
        for piece in self:
            by.setdefault(len(piece), []).append(piece)
        self.by_length = {}
        for length, own in by.items():
            table, h = np.frombuffer(b"".join(own), np.uint8).reshape(-1, length), np.zeros(len(own), np.uint64)
            for k in range(length):
                h = _next_hash(h, table[:, k])
            order = np.argsort(h)
            if len(np.unique(h)) < len(h):
                raise ValueError("two pieces have one hash")
            some = np.zeros(1 << _BITS, bool)
            some[h >> _DROPPED] = True
            self.by_length[length] = h[order], np.array([self[p] for p in own], np.int32)[order], some

    def find(self, length: int, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places of ``h`` that are the hash of a piece, the pieces' numbers)."""
        if length not in self.by_length:
            return np.empty(0, np.int64), np.empty(0, np.int32)
        known, numbers, some = self.by_length[length]
        rows = np.flatnonzero(some[h >> _DROPPED])
        place = np.minimum(np.searchsorted(known, h[rows]), len(known) - 1)
        same = known[place] == h[rows]
        return rows[same], numbers[place[same]]


_VOCABULARIES: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    """Read once per worker."""
    if path not in _VOCABULARIES:
        with open(path, "rb") as lines:
            _VOCABULARIES[path] = Vocabulary([base64.b64decode(line.split()[0]) for line in lines])
    return _VOCABULARIES[path]


def parts(word: str) -> list[bytes]:
    """The word as byte strings of at most ``LONGEST``, a blank before the first."""
    data = word.encode("utf-8", "replace")
    if len(data) <= LONGEST:
        return [b" " + data]
    out, own = [], b" "
    for ch in word:
        c = ch.encode("utf-8", "replace")
        if len(own) + len(c) > LONGEST:
            out.append(own)
            own = b""
        own += c
    return [*out, own]


class Cuts:
    """All pieces of words of one length: (start, end) -> (rows, piece numbers)."""

    def __init__(self, words: list[bytes], pieces: Vocabulary):
        self.length = m = len(words[0])
        self.n = len(words)
        self.at: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}  # by start, then end
        letters = np.frombuffer(b"".join(words), np.uint8).reshape(self.n, m).T.copy()
        for start in range(m):
            h = np.zeros(self.n, np.uint64)
            for end in range(start + 1, m + 1):
                h = _next_hash(h, letters[end - 1])
                rows, ids = pieces.find(end - start, h)
                if len(rows):
                    self.at[start, end] = rows, ids

    def forward(self, p: np.ndarray) -> list[np.ndarray]:
        """Sums of all cuts of every prefix, a column for each model. ``p``: piece x model."""
        sums = [np.zeros((self.n, p.shape[1])) for _ in range(self.length + 1)]
        sums[0][:] = 1
        for (start, end), (rows, ids) in self.at.items():
            sums[end][rows] += sums[start][rows] * p[ids]
        return sums

    def expected(self, p: np.ndarray, model: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(piece * models + model, expected count) of words seen ``times`` under their ``model``."""
        n_models = p.shape[1]
        q = p.ravel()
        ahead = [np.zeros(self.n) for _ in range(self.length + 1)]
        behind = [np.zeros(self.n) for _ in range(self.length + 1)]
        ahead[0][:] = behind[-1][:] = 1
        keys = {cut: ids.astype(np.int64) * n_models + model[rows] for cut, (rows, ids) in self.at.items()}
        for cut, (rows, _) in self.at.items():
            ahead[cut[1]][rows] += ahead[cut[0]][rows] * q[keys[cut]]
        for cut, (rows, _) in sorted(self.at.items(), key=lambda x: -x[0][0]):
            behind[cut[0]][rows] += behind[cut[1]][rows] * q[keys[cut]]
        share = times / ahead[-1]
        counts = [ahead[a][rows] * q[keys[a, b]] * behind[b][rows] * share[rows] for (a, b), (rows, _) in self.at.items()]
        return np.concatenate(list(keys.values())), np.concatenate(counts)


def _by_length(words: list[bytes]):
    """(places, words) of one length, ``BLOCK`` at a time."""
    order: dict[int, list[int]] = {}
    for k, w in enumerate(words):
        order.setdefault(len(w), []).append(k)
    for places in order.values():
        for lo in range(0, len(places), BLOCK):
            own = places[lo : lo + BLOCK]
            yield np.array(own), [words[k] for k in own]


def log_likelihoods(words: list[bytes], pieces: Vocabulary, p: np.ndarray) -> np.ndarray:
    """log of the summed probability of every word under every model."""
    out = np.zeros((len(words), p.shape[1]))
    for places, own in _by_length(words):
        out[places] = np.log(Cuts(own, pieces).forward(p)[-1])
    return out


def expected_counts(words: list[bytes], model: np.ndarray, times: np.ndarray, pieces: Vocabulary, p: np.ndarray) -> np.ndarray:
    """Expected piece counts, piece x model."""
    total = np.zeros(p.size)
    for places, own in _by_length(words):
        keys, counts = Cuts(own, pieces).expected(p, model[places], times[places])
        total += np.bincount(keys, counts, p.size)
    return total.reshape(p.shape)


def probabilities(counts: np.ndarray) -> np.ndarray:
    """Piece probabilities by column; a column without counts is even."""
    total = counts.sum(axis=0)
    shares = np.where(total > 0, counts / np.maximum(total, 1e-300), 1 / len(counts))
    return (1 - FLOOR) * shares + FLOOR / len(counts)
