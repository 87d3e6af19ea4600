"""Suffix arrays in numpy: Larsson-Sadakane refinement, Kasai's common prefixes, merging."""

from __future__ import annotations

import numpy as np

#: Positions that Kasai's pass goes through side by side.
LANES = 4096


#: Bytes that the first grouping looks at.
LEADING = 7


def _leading(data: np.ndarray) -> np.ndarray:
    """The first bytes from each position as one number; nine bits a byte, zero after the end."""
    padded = np.concatenate([data.astype(np.uint64) + np.uint64(1), np.zeros(LEADING, dtype=np.uint64)])
    key = np.zeros(len(data), dtype=np.uint64)
    for k in range(LEADING):
        key = (key << np.uint64(9)) | padded[k : k + len(data)]
    return key


def suffix_array(data: np.ndarray) -> np.ndarray:
    """Start positions in the order of the bytes from there to the end.

    Positions are put into groups by their first seven bytes. Then each group that is not yet
    a single position is refined by the group of the position h further on, and h doubles. A
    group's number is the place of its first member, so finished groups are left alone.
    """
    n = len(data)
    if not n:
        return np.zeros(0, dtype=np.int64)
    key = _leading(data)
    order = np.argsort(key, kind="stable")
    new = np.ones(n, dtype=bool)
    new[1:] = key[order[1:]] != key[order[:-1]]
    group = np.empty(n, dtype=np.int64)
    group[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    h = LEADING
    while True:
        heads = np.flatnonzero(new)
        sizes = np.diff(np.append(heads, n))
        open_ = np.repeat(sizes > 1, sizes)
        places = np.flatnonzero(open_)
        if not len(places):
            break
        at = order[places]
        ahead = -at - 1  # past the end: the shorter suffix comes first
        inside = at + h < n
        ahead[inside] = group[at[inside] + h]
        first = group[at]
        sort = np.lexsort((ahead, first))
        at, ahead, first = at[sort], ahead[sort], first[sort]
        order[places] = at
        split = np.ones(len(at), dtype=bool)
        split[1:] = (first[1:] != first[:-1]) | (ahead[1:] != ahead[:-1])
        new[places] = split
        group[at] = np.maximum.accumulate(np.where(split, places, 0))
        h *= 2
    return order


def common_prefixes(data: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """For each place of a suffix array the bytes shared with the place before, ``most`` at most.

    Kasai's pass over positions: the next position shares at least one byte less than this
    one. The positions are cut into stretches that take their steps side by side.
    """
    n = len(data)
    shared = np.zeros(n, dtype=np.int64)
    if n < 2:
        return shared
    place = np.empty(n, dtype=np.int64)
    place[order] = np.arange(n)
    before = np.full(n, -1, dtype=np.int64)
    before[order[1:]] = order[:-1]
    length = -(-n // min(LANES, n))
    lane = np.arange(0, n, length)
    k = np.zeros(len(lane), dtype=np.int64)
    padded = np.concatenate([data, np.zeros(1, dtype=np.uint8)])
    for step in range(length):
        at = lane + step
        alive = at < n
        at, k = at[alive], np.maximum(k[alive] - 1, 0)
        lane = lane[alive]
        other = before[at]
        k[other < 0] = 0
        going = np.flatnonzero((other >= 0) & (k < most))
        while len(going):
            a, b = at[going] + k[going], other[going] + k[going]
            going = going[(a < n) & (b < n) & (padded[np.minimum(a, n)] == padded[np.minimum(b, n)])]
            k[going] += 1
            going = going[k[going] < most]
        shared[place[at]] = k
    return shared


def owned_strings(data: np.ndarray, starts: np.ndarray, owners: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(strings, least owner of each, string of each start): the strings of ``width`` bytes
    at ``starts``, distinct and sorted, by one suffix array over ``data``."""
    order = suffix_array(data)
    shared = common_prefixes(data, order, width)
    number = np.full(len(data), -1, dtype=np.int64)
    number[starts] = np.arange(len(starts))
    group = np.cumsum(shared < width)
    which = number[order]
    wanted = which >= 0
    which, group = which[wanted], group[wanted]
    head = np.ones(len(group), dtype=bool)
    head[1:] = group[1:] != group[:-1]
    least = np.minimum.reduceat(owners[which], np.flatnonzero(head)) if len(which) else owners[:0]
    string_of = np.empty(len(starts), dtype=np.int64)
    string_of[which] = np.cumsum(head) - 1
    first = starts[which[head]]
    strings = data[first[:, None] + np.arange(width)] if len(first) else np.zeros((0, width), dtype=np.uint8)
    return np.ascontiguousarray(strings).view(f"S{width}").ravel(), least, string_of


def merged(strings: np.ndarray, least: np.ndarray, more: np.ndarray, more_least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two sorted lists of strings with owners as one; equal strings keep the lesser owner.

    Each string of the second list finds its place in the first by binary search.
    """
    if not len(strings) or not len(more):
        return (more, more_least) if len(more) else (strings, least)
    place = np.searchsorted(strings, more)
    met = place < len(strings)
    met[met] = strings[place[met]] == more[met]
    least = least.copy()
    least[place[met]] = np.minimum(least[place[met]], more_least[met])
    return np.insert(strings, place[~met], more[~met]), np.insert(least, place[~met], more_least[~met])
