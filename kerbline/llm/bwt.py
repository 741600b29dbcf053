"""Repeated strings of at least a given length in one bounded block, by interval expansion on a Burrows-Wheeler transform."""

from __future__ import annotations

import numpy as np

SEPARATOR = 0
_START = 8


def suffix_array(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of all suffixes by prefix doubling from eight bytes on, and the first eight bytes in that order."""
    n = len(text)
    padded = np.zeros(n + _START, np.uint8)
    padded[:n] = text
    first = np.zeros(n, np.uint64)
    for k in range(_START):
        first = (first << np.uint64(8)) | padded[k : k + n]
    order = np.argsort(first)
    rank = _ranks(first[order], order)
    open_ = np.arange(n)
    length = _START
    while True:
        # Only ranks that several suffixes share are sorted further.
        shared = rank[order[open_]]
        same = np.zeros(len(open_), bool)
        if len(open_) > 1:
            same[1:] = shared[1:] == shared[:-1]
            same[:-1] |= same[1:]
        open_ = open_[same]
        if not len(open_):
            return order, first[order]
        members = order[open_]
        after = members + length
        beyond = np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        mine = rank[members]
        by = np.argsort(mine * (n + 1) + beyond)
        members, mine, beyond = members[by], mine[by], beyond[by]
        order[open_] = members
        fresh = np.ones(len(members), bool)
        fresh[1:] = (mine[1:] != mine[:-1]) | (beyond[1:] != beyond[:-1])
        # A rank is the place of its first suffix, so new ranks stay between their neighbours'.
        rank[members] = open_[np.maximum.accumulate(np.where(fresh, np.arange(len(members)), 0))]
        length *= 2


def _ranks(keys: np.ndarray, order: np.ndarray) -> np.ndarray:
    fresh = np.ones(len(keys), bool)
    fresh[1:] = keys[1:] != keys[:-1]
    rank = np.empty(len(keys), np.int64)
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(len(keys)), 0))
    return rank


def repeated(text: np.ndarray, least: int) -> np.ndarray:
    """Places where a string of ``least`` bytes starts that also starts elsewhere. SEPARATOR bytes end strings.

    Common prefixes of neighbouring suffixes are found by increasing value. Those under eight come from the sorted first
    bytes. From then on the intervals of strings of length v whose right border has value v - 1 are extended by each
    byte before them; a border that the extended interval reaches first has value v. Borders that have no value when
    v reaches ``least`` part suffixes that share ``least`` bytes.
    """
    if len(text) <= least:
        return np.zeros(0, np.int64)
    if text[-1] != SEPARATOR:
        text = np.append(text, np.uint8(SEPARATOR))
    n = len(text)
    order, keys = suffix_array(text)
    before = text[order - 1]
    step = np.empty(n, np.int64)
    step[np.argsort(before, kind="stable")] = np.arange(n)
    value = np.full(n + 1, -1, np.int32)
    value[0] = value[n] = 0
    differ = keys[1:] ^ keys[:-1]
    borders = np.flatnonzero(differ) + 1
    top = np.zeros(len(borders), np.int32)
    rest = differ[borders - 1]
    for k in range(1, _START):
        top += (rest >> np.uint64(64 - 8 * k) == 0).astype(np.int32)
    value[borders] = top
    edges = np.concatenate([[0], borders, [n]])
    chosen = np.flatnonzero(value[edges[1:]] == _START - 1)
    low, high = edges[chosen], edges[chosen + 1] - 1
    for v in range(_START, least):
        if not len(low):
            break
        widths = high - low + 1
        ends = np.cumsum(widths)
        places = np.arange(ends[-1]) + np.repeat(low - ends + widths, widths)
        byte = before[places]
        kept = byte != SEPARATOR
        places, key = places[kept], (np.repeat(np.arange(len(low)), widths) * 256 + byte)[kept]
        # Sorting the place along with the key is a stable sort of values, several times as fast as one of indices.
        both = np.sort((key << 31) | places)
        key, reached = both >> 31, step[both & ((1 << 31) - 1)]
        last = np.ones(len(key), bool)
        last[:-1] = key[1:] != key[:-1]
        first = np.ones(len(key), bool)
        first[1:] = last[:-1]
        low, high = reached[first], reached[last]
        new = value[high + 1] < 0
        low, high = low[new], high[new]
        value[high + 1] = v
    pairs = np.flatnonzero(value[1:n] < 0) + 1
    found = np.zeros(n, bool)
    found[order[pairs]] = True
    found[order[pairs - 1]] = True
    # A place too near its separator only shares the separator and what follows.
    ends = np.flatnonzero(text == SEPARATOR)
    place = np.flatnonzero(found)
    at = np.searchsorted(ends, place)
    limit = np.where(at < len(ends), ends[np.minimum(at, len(ends) - 1)] if len(ends) else n, n)
    return place[place + least <= limit]
