"""Names as arrays of code points: Jaro similarity of whole batches of pairs, and bounds that are cheaper than it."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

#: Cells (pairs times letters) that one step takes.
CELLS = 1 << 22
#: Letters are counted in so many classes (code point modulo this).
CLASSES = 64


class Names(NamedTuple):
    """Code points (name, place), 0 beyond the end; and lengths."""

    letters: np.ndarray
    length: np.ndarray

    def take(self, at) -> Names:
        length = self.length[at]
        return Names(self.letters[at][:, : max(1, length.max(initial=0))], length)


def coded(names: list[str]) -> Names:
    length = np.array([len(x) for x in names], np.int64)
    letters = np.zeros((len(names), max(1, length.max(initial=0))), np.uint32)
    flat = np.frombuffer("".join(names).encode("utf-32-le", "surrogatepass"), np.uint32)
    letters[np.arange(letters.shape[1])[None] < length[:, None]] = flat
    return Names(letters, length)


def _similarity(p: Names, q: Names) -> np.ndarray:
    n, rows = len(p.length), np.arange(len(p.length))
    reach = np.maximum(np.maximum(p.length, q.length) // 2 - 1, 0)
    place = np.arange(q.letters.shape[1])[None]
    free = place < q.length[:, None]
    mine = np.zeros((n, max(1, min(p.letters.shape[1], q.letters.shape[1]))), np.uint32)
    m = np.zeros(n, np.int64)
    for i in range(p.letters.shape[1]):  # each letter of p takes the first free equal one of q within reach, in all pairs at once
        fits = free & (q.letters == p.letters[:, i, None]) & (np.abs(place - i) <= reach[:, None]) & (i < p.length)[:, None]
        first = fits.argmax(1)
        hit = np.flatnonzero(fits[rows, first])
        free[hit, first[hit]] = False
        mine[hit, m[hit]] = p.letters[hit, i]
        m[hit] += 1
    theirs, k = np.zeros_like(mine), np.zeros(n, np.int64)
    taken = (place < q.length[:, None]) & ~free
    for j in range(q.letters.shape[1]):
        hit = np.flatnonzero(taken[:, j])
        theirs[hit, k[hit]] = q.letters[hit, j]
        k[hit] += 1
    moved = (mine != theirs).sum(1) // 2
    some = np.maximum(m, 1)
    out = (m / np.maximum(p.length, 1) + m / np.maximum(q.length, 1) + (m - moved) / some) / 3
    out = np.where(m > 0, out, 0.0)
    return np.where((p.length == 0) | (q.length == 0), (p.length == q.length).astype(float), out)


def similarity(p: Names, q: Names) -> np.ndarray:
    """Jaro similarity of the i-th name of p with the i-th of q; long names in steps of their own."""
    out = np.zeros(len(p.length))
    longest = np.maximum(p.length, q.length)
    order, i = np.argsort(longest, kind="stable"), 0
    while i < len(order):
        width = np.maximum(longest[order[i:]], 1) * np.arange(1, len(order) - i + 1)
        j = i + max(1, int(np.searchsorted(width, CELLS, "right")))
        at = order[i:j]
        out[at] = _similarity(p.take(at), q.take(at))
        i = j
    return out


def counts(names: Names) -> np.ndarray:
    """How often letters of each class stand in each name."""
    out = np.zeros((len(names.length), CLASSES), np.int32)
    row, col = np.nonzero(np.arange(names.letters.shape[1])[None] < names.length[:, None])
    np.add.at(out, (row, names.letters[row, col] % CLASSES), 1)
    return out


def bound(shared: np.ndarray, p_length, q_shortest: np.ndarray, q_longest: np.ndarray) -> np.ndarray:
    """The most that similarity can be if a name of p_length shares so many letters with one of q_shortest to q_longest letters."""
    m = np.minimum(np.minimum(shared, p_length), q_longest)
    some = (m / np.maximum(p_length, 1) + np.minimum(1.0, m / np.maximum(q_shortest, 1)) + 1) / 3 + 1e-12
    return np.where((p_length == 0) | (q_shortest == 0), 1.0, np.where(m > 0, some, 0.0))
