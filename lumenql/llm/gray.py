"""Gray-order hierarchical index over 64-bit fingerprints, in numpy.

Fingerprints are sorted by their rank in the reflected Gray code, which puts values
that differ in few bits next to each other. Consecutive fingerprints form leaves, and
consecutive leaves form upper nodes. A node holds the bits that all its members share
(``mask``) and their values (``pattern``). Two nodes are compared from the top: a level
adds the differences in the bits that only now became shared, and a pair of nodes whose
accumulated differences exceed the radius is dropped with everything below it.
"""

from __future__ import annotations

import numpy as np

FANOUT = 8
#: Pairs of nodes that are expanded at once; bounds the memory of a join.
BLOCK = 1 << 17


def gray_rank(values: np.ndarray) -> np.ndarray:
    """Position of each value in the Gray code sequence (prefix exclusive-or)."""
    rank = values.astype(np.uint64, copy=True)
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class Levels:
    """The index of fingerprints that lie in runs; only members of a run are compared.

    ``values`` must be sorted by run, then by Gray rank. Level 0 has the single
    fingerprints, the last level one node for each run.
    """

    def __init__(self, values: np.ndarray, run: np.ndarray):
        self.values = values
        starts = np.arange(len(values))
        self.first = [starts]
        self.mask = [np.full(len(values), ~np.uint64(0))]
        self.pattern = [values]
        runs = [run]
        while len(starts):
            key = runs[-1]
            new_run = np.r_[True, key[1:] != key[:-1]]
            if new_run.all():
                break
            begin = np.flatnonzero(new_run)
            offset = np.arange(len(key)) - np.repeat(begin, np.diff(np.r_[begin, len(key)]))
            starts = np.flatnonzero(offset % FANOUT == 0)
            low, high = self.pattern[-1] & self.mask[-1], self.pattern[-1] | ~self.mask[-1]
            mask = ~(np.bitwise_and.reduceat(low, starts) ^ np.bitwise_or.reduceat(high, starts))
            self.first.append(starts)
            self.mask.append(mask)
            self.pattern.append(low[starts] & mask)
            runs.append(key[starts])
        self.size = [np.diff(np.r_[s, len(self.mask[max(k - 1, 0)])]) for k, s in enumerate(self.first)]

    def leaves_from(self, level: int) -> np.ndarray:
        """Index of the first fingerprint below each node of a level."""
        out = self.first[level]
        for k in range(level - 1, 0, -1):
            out = self.first[k][out]
        return out


def _union(label: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
    """Merge the sets of ``left`` and ``right``; every label ends at its set's smallest index."""
    while True:
        a, b = label[left], label[right]
        differ = a != b
        if not differ.any():
            return
        left, right, a, b = left[differ], right[differ], a[differ], b[differ]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label[:] = up


def link(values: np.ndarray, run: np.ndarray, radius: int) -> np.ndarray:
    """Label each fingerprint with the first index of its linked set within its run.

    Fingerprints of a run link at ``radius`` or fewer differing bits, transitively.
    No pair list is kept: links go straight into a union, and pairs of nodes whose
    members already are one set are skipped.
    """
    label = np.arange(len(values))
    if len(values) < 2:
        return label
    near = np.flatnonzero((run[1:] == run[:-1]) & (np.bitwise_count(values[1:] ^ values[:-1]) <= radius))
    _union(label, near, near + 1)
    levels = Levels(values, run)
    top = len(levels.first) - 1
    roots = np.arange(len(levels.first[top]))
    zero = np.zeros(len(roots), dtype=np.int64)
    stack = [(top, roots, roots, zero)]
    edge = [levels.leaves_from(k) for k in range(top + 1)]
    while stack:
        level, a, b, gone = stack.pop()
        if level == 0:
            hit = a != b
            _union(label, a[hit], b[hit])
            continue
        low, high = (f.reduceat(label, edge[level]) for f in (np.minimum, np.maximum))
        whole = low == high
        live = ~(whole[a] & whole[b] & (low[a] == low[b]))
        a, b, gone = a[live], b[live], gone[live]
        if not len(a):
            continue
        shared = levels.mask[level][a] & levels.mask[level][b]
        fan = levels.size[level][a] * levels.size[level][b]
        ends = np.cumsum(fan)
        cut = 0
        while cut < len(a):  # expand in blocks of bounded size
            base = ends[cut - 1] if cut else 0
            stop = max(cut + 1, int(np.searchsorted(ends, base + BLOCK, side="right")))
            part = slice(cut, stop)
            n = fan[part]
            of = np.repeat(np.arange(cut, stop), n)
            k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            width = levels.size[level][b[of]]
            x = levels.first[level][a[of]] + k // width
            y = levels.first[level][b[of]] + k % width
            keep = x <= y
            x, y, of = x[keep], y[keep], of[keep]
            below = levels.mask[level - 1][x] & levels.mask[level - 1][y]
            fresh = (levels.pattern[level - 1][x] ^ levels.pattern[level - 1][y]) & below & ~shared[of]
            total = gone[of] + np.bitwise_count(fresh)
            keep = total <= radius
            if keep.any():
                stack.append((level - 1, x[keep], y[keep], total[keep]))
            cut = stop
    return label
