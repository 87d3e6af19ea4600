"""Hashes of words and byte runs of many texts at once, in numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: The bytes that part words, and odd multipliers.
BLANK_BYTES = [0x20, *range(0x09, 0x0E)]
BASE = np.uint64(0x9E3779B97F4A7C15)
MULTIPLIERS = np.array([0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3], dtype=np.uint64)

_BLANK = np.zeros(256, dtype=bool)
_BLANK[BLANK_BYTES] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_VALUES = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_INVERSE = np.uint64(pow(int(BASE), -1, 2**64))
_powers: list[np.ndarray] = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def mixed(h: np.ndarray) -> np.ndarray:
    """The bits of each number spread over all 64."""
    h = (h ^ (h >> np.uint64(30))) * MULTIPLIERS[0]
    h = (h ^ (h >> np.uint64(27))) * MULTIPLIERS[1]
    return h ^ (h >> np.uint64(31))


def power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers 0 to n - 1 of the base and of its inverse, modulo 2**64."""
    if len(_powers[0]) < n:
        size = max(n, 1 << 16)
        for i, base in enumerate((BASE, _INVERSE)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _powers[i] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


def joined_bytes(texts: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in a row, a newline after each; and where each starts, and the end.

    A null text counts as empty.
    """
    column = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    parts = [b"" if t is None else t for t in column.cast(pa.large_binary()).to_pylist()]
    starts = np.zeros(len(parts) + 1, dtype=np.int64)
    np.cumsum([len(p) + 1 for p in parts], out=starts[1:])
    return np.frombuffer(b"\n".join([*parts, b""]), dtype=np.uint8), starts


def word_hashes(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word in order, number of its text): A-Z lower-cased, parted by blanks."""
    blank = _BLANK[data]
    edge = np.flatnonzero(np.diff(blank, prepend=True))
    first, last = edge[0::2], edge[1::2]
    if not len(first):
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    powers, inverse = power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_VALUES[_LOWER[data]] * powers[: len(data)], out=sums[1:])
    hashes = mixed((sums[last] - sums[first]) * inverse[first] + (last - first).astype(np.uint64) * MULTIPLIERS[2])
    return hashes, np.searchsorted(starts, first, side="right") - 1


def shingle_sets(texts: pa.ChunkedArray | pa.Array, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(shingles, text of each, where each text's shingles start): distinct, sorted within a text.

    A shingle is 64 bits for ``size`` words in a row, or for all words of a text with fewer.
    """
    data, starts = joined_bytes(texts)
    words, owner = word_hashes(data, starts)
    n_texts = len(starts) - 1
    count = np.bincount(owner, minlength=n_texts)
    begin = np.concatenate([[0], np.cumsum(count)])
    multipliers = MULTIPLIERS if size <= len(MULTIPLIERS) else mixed(np.arange(1, size + 1, dtype=np.uint64)) | np.uint64(1)
    runs = np.zeros(max(0, len(words) - size + 1), dtype=np.uint64)
    for k in range(size):
        runs += words[k : k + len(runs)] * multipliers[k]
    whole = owner[: len(runs)] == owner[size - 1 :] if len(runs) else np.zeros(0, dtype=bool)
    values, texts_of = [mixed(runs[whole])], [owner[: len(runs)][whole]]
    for text in np.flatnonzero((count > 0) & (count < size)):
        own = words[begin[text] : begin[text + 1]]
        values.append(mixed((own * multipliers[: len(own)]).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(own))))
        texts_of.append(np.array([text]))
    value, text_of = np.concatenate(values), np.concatenate(texts_of)
    order = np.lexsort((value, text_of))
    value, text_of = value[order], text_of[order]
    new = np.ones(len(value), dtype=bool)
    new[1:] = (value[1:] != value[:-1]) | (text_of[1:] != text_of[:-1])
    value, text_of = value[new], text_of[new]
    return value, text_of, np.searchsorted(text_of, np.arange(n_texts + 1))
