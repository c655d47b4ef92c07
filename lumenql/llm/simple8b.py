"""Simple-8b word-aligned coding of token ids, vectorised in both directions.

A 64-bit word has a selector in its top four bits and 60 bits of payload. Selectors 1 to
14 hold a number of ids of one width; selector 15 holds a run of 120 zeros; selector 0 is
the escape: the word that follows is one raw id of more than 60 bits.
"""

from __future__ import annotations

import numpy as np

ESCAPE, ZEROS = 0, 15
#: Ids and bits of each selector from 1 to 14.
COUNT = np.array([1, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1, 120])
WIDTH = np.array([64, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60, 0])
_TOP = np.uint64(60)
_PAYLOAD = np.uint64((1 << 60) - 1)


def pack(ids: np.ndarray) -> np.ndarray:
    """Encode unsigned ids as 64-bit words, greedily: each word takes as many ids as fit."""
    return pack_rows(ids, np.array([len(ids)]))[0]


_SMALL = np.array([k.bit_length() for k in range(1 << 16)], dtype=np.int8)


def _widths(ids: np.ndarray) -> np.ndarray:
    """Bits of each id."""
    if not len(ids) or ids.max() < 1 << 16:
        return _SMALL[ids]
    width = np.zeros(len(ids), dtype=np.int8)
    for bit in range(int(ids.max()).bit_length()):
        width += ids >= np.uint64(1 << bit)
    return width


def pack_rows(ids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Encode rows of ids so that each starts a word of its own: the words, and each row's first word.

    Where a selector's run fits is found for all places at once; only the walk from word
    to word is a loop.
    """
    n = len(ids)
    width = _widths(ids)
    ids = np.ascontiguousarray(ids, dtype=np.uint64)
    ends = np.cumsum(lengths)
    left = np.minimum(np.repeat(ends, lengths) - np.arange(n), 127).astype(np.int8)
    choice = np.full(n, ESCAPE, dtype=np.int8)
    # A run that fits a selector also fits all that hold fewer, wider ids, so the last one that fits holds most.
    # widest[k] is the greatest width among the ``have`` ids from place k; no selector holds over twice the ids of the one before.
    widest, have = width, 1
    for selector in [*range(14, 0, -1), ZEROS]:
        count, most = int(COUNT[selector]), int(WIDTH[selector])
        if count > n:
            break
        if count > have:
            widest, have = np.maximum(widest[: n - count + 1], widest[count - have :]), count
        fits = (widest <= most) & (left[: len(widest)] >= count)
        if not fits.any():
            break
        choice[: len(widest)][fits] = selector
    step = COUNT[choice].tolist()
    starts, at = [], 0
    while at < n:
        starts.append(at)
        at += step[at]
    start = np.array(starts, dtype=np.int64)
    selector = choice[start] if n else np.zeros(0, dtype=np.int64)
    length = np.where(selector == ESCAPE, 2, 1)
    place = np.cumsum(length) - length
    out = np.zeros(int(length.sum()), dtype=np.uint64)
    out[place] = selector.astype(np.uint64) << _TOP
    escaped = selector == ESCAPE
    out[place[escaped] + 1] = ids[start[escaped]]
    for s in range(1, 15):
        own = np.flatnonzero(selector == s)
        first, word = start[own], out[place[own]]
        for k in range(int(COUNT[s])):
            word |= ids[first + k] << np.uint64(k * int(WIDTH[s]))
        out[place[own]] = word
    row = np.searchsorted(start, ends - lengths)
    return out, np.r_[place, len(out)][row]


def unpack(words: np.ndarray) -> np.ndarray:
    """Decode words to ids, one selector at a time over all of its words."""
    words = np.ascontiguousarray(words, dtype=np.uint64)
    selector = (words >> _TOP).astype(np.int64)
    raw = np.zeros(len(words), dtype=bool)
    zero = np.flatnonzero(selector == ESCAPE)
    last = -1
    for k in zero.tolist():  # a raw word after an escape may look like one itself
        if k != last:
            raw[k + 1] = True
            last = k + 1
    head = np.flatnonzero(~raw)
    s = selector[head]
    count = COUNT[s]
    begin = np.cumsum(count) - count
    out = np.zeros(int(count.sum()), dtype=np.uint64)
    out[begin[s == ESCAPE]] = words[head[s == ESCAPE] + 1]
    for kind in range(1, 15):
        own = np.flatnonzero(s == kind)
        if len(own):
            shift = (np.arange(COUNT[kind]) * WIDTH[kind]).astype(np.uint64)
            value = (words[head[own]][:, None] & _PAYLOAD) >> shift & np.uint64((1 << int(WIDTH[kind])) - 1)
            out[begin[own][:, None] + np.arange(COUNT[kind])] = value
    return out
