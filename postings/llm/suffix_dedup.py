"""Repeated byte strings across documents, found with suffix arrays and removed."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, text_bytes, text_of
from .exchange import SUFFIX_BITS, bucket_bits, counts_of_shard, dealt, key_counts, replies_to, shard_count
from .hashes import MULTIPLIERS, _VALUES, mixed, power_tables
from .suffix_arrays import merged, owned_strings

WIDTH = 50
#: Bytes of the runs whose least hash stands for a string of ``WIDTH`` bytes.
GRAM = 24
#: Most strings in one stretch of text that is sent on.
STRETCH = 255
#: Bytes of text in a shard, and under one suffix array.
SHARD_TEXT = 2_000_000
#: Bits that the number of a bucket of stretches has beyond that of a bucket of keys.
TEXT_BITS = 4
#: Stretches copied or compared at a time.
AT_ONCE = 8192
#: A document without a key counts as later than all others.
LAST = np.iinfo(np.int64).max
#: Keys that a byte of text has, about: it sizes the buckets before keys are made.
KEYS_A_BYTE = 0.07


@dataclass
class Texts:
    """The texts of a shard in a fixed order, their bytes in a row."""

    rows: np.ndarray
    ids: np.ndarray
    data: np.ndarray
    starts: np.ndarray


def texts_of(rows: pa.Table) -> Texts:
    """A shard's texts by key, then bytes: the same order each time the shard is read."""
    ids = rows.column("id").fill_null(LAST).to_numpy()
    bodies = rows.column("text").cast(pa.large_binary()).to_pylist()
    order = np.array(sorted(range(len(bodies)), key=lambda i: (ids[i], bodies[i])), dtype=np.int64)
    parts = [bodies[i] for i in order]
    starts = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
    return Texts(order, ids[order], np.frombuffer(b"".join(parts), dtype=np.uint8), starts)


def run_hashes(data: np.ndarray, length: int) -> np.ndarray:
    """64 bits for the ``length`` bytes from each position."""
    h, size = _VALUES[data], 1
    while size * 2 <= length:
        base = np.uint64(pow(int(MULTIPLIERS[1]), size, 2**64))
        h, size = h[: max(0, len(h) - size)] * base + h[size:], size * 2
    if size < length:  # two runs that overlap cover what is asked for
        h = h[: max(0, len(h) - length + size)] * MULTIPLIERS[3] + h[length - size :]
    return mixed(h)


def least_hashes(data: np.ndarray, width: int, gram: int) -> np.ndarray:
    """For each position the least hash of the runs of ``gram`` bytes in the ``width`` bytes from there."""
    h = run_hashes(data, gram)
    window, size = width - gram + 1, 1
    while size * 2 <= window:
        h = np.minimum(h[: max(0, len(h) - size)], h[size:])
        size *= 2
    rest = window - size
    return np.minimum(h[: max(0, len(h) - rest)], h[rest:]) if rest else h


@dataclass
class Stretches:
    """Stretches of texts whose strings all have the same least hash."""

    key: np.ndarray
    text: np.ndarray
    at: np.ndarray
    strings: np.ndarray


def stretches_of(texts: Texts, bits: int) -> Stretches:
    """The stretches of all texts; every string of ``WIDTH`` bytes within a text is in one."""
    least = least_hashes(texts.data, WIDTH, GRAM) >> np.uint64(64 - SUFFIX_BITS - bits)
    if not len(least):
        none = np.zeros(0, dtype=np.int64)
        return Stretches(none.astype(np.uint64), none, none, none)
    ends = np.zeros(len(texts.data) + 1, dtype=np.int32)
    lengths = np.diff(texts.starts)
    np.add.at(ends, np.maximum(texts.starts[1:] - WIDTH + 1, texts.starts[:-1])[lengths > 0], 1)
    np.add.at(ends, texts.starts[1:][lengths > 0], -1)
    inside = np.cumsum(ends[:-1])[: len(least)] == 0
    change = np.ones(len(least), dtype=bool)
    change[1:] = (least[1:] != least[:-1]) | (inside[1:] != inside[:-1])
    begin = np.flatnonzero(change)
    strings = np.diff(np.append(begin, len(least)))
    begin, strings = begin[inside[begin]], strings[inside[begin]]
    pieces = -(-strings // STRETCH)
    number = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    at = np.repeat(begin, pieces) + number * STRETCH
    strings = np.minimum(np.repeat(strings, pieces) - number * STRETCH, STRETCH)
    return Stretches(least[at], np.searchsorted(texts.starts, at, side="right") - 1, at, strings)


def gathered(data: np.ndarray, at: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of stretches of ``data`` in a row, and where each starts, and the end.

    Some thousands of stretches are copied at a time, as their places take more room than they.
    """
    starts = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    out = np.empty(starts[-1], dtype=data.dtype)
    for a in range(0, len(at), AT_ONCE):
        b = min(a + AT_ONCE, len(at))
        first = starts[a]
        place = np.arange(first, starts[b]) - np.repeat(starts[a:b] - at[a:b], lengths[a:b])
        out[first : starts[b]] = data[place]
    return out, starts


def alike(data: np.ndarray, starts: np.ndarray, key: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """For each stretch the one of the least owner with the same key and bytes.

    Stretches are brought together by a hash and then held against each other byte by byte.
    """
    lengths = np.diff(starts)
    powers, inverse = power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_VALUES[data] * powers[: len(data)], out=sums[1:])
    hashes = (sums[starts[1:]] - sums[starts[:-1]]) * inverse[starts[:-1]]
    del sums
    hashes = mixed(hashes + key * MULTIPLIERS[2] + lengths.astype(np.uint64))
    order = np.lexsort((owner, hashes))
    head = np.ones(len(order), dtype=bool)
    head[1:] = hashes[order[1:]] != hashes[order[:-1]]
    first = np.empty(len(order), dtype=np.int64)
    first[order] = order[np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))]
    others = np.flatnonzero(first != np.arange(len(first)))
    others = others[(lengths[others] == lengths[first[others]]) & (key[others] == key[first[others]])]
    found = np.arange(len(first))
    for a in range(0, len(others), AT_ONCE):
        some = others[a : a + AT_ONCE]
        mine, cut = gathered(data, starts[some], lengths[some])
        theirs, _ = gathered(data, starts[first[some]], lengths[some])
        same = np.add.reduceat(mine != theirs, cut[:-1], dtype=np.int64) == 0
        found[some[same]] = first[some[same]]
    return found


def in_two(data: np.ndarray, starts: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Whether each stretch has a string that, by its hash, a stretch of another owner has too."""
    strings = np.diff(starts) - WIDTH + 1
    begin = np.arange(strings.sum()) + np.repeat(np.arange(len(strings)) * (WIDTH - 1), strings)
    hashes, own = run_hashes(data, WIDTH)[begin], np.repeat(owner, strings)
    order = np.argsort(hashes)
    head = np.flatnonzero(np.diff(hashes[order], prepend=~hashes[order[:1]]))
    two = np.minimum.reduceat(own[order], head) != np.maximum.reduceat(own[order], head)
    shared = np.zeros(len(hashes), dtype=bool)
    shared[order] = np.repeat(two, np.diff(np.append(head, len(hashes))))
    return np.logical_or.reduceat(shared, np.cumsum(strings) - strings)


_COLUMNS = (("key", np.uint64), ("owner", np.int64), ("text", np.int32), ("at", np.int64), ("strings", np.uint8))


def _packed(**arrays: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(b"".join(np.ascontiguousarray(arrays[name], dtype=kind).tobytes() for name, kind in _COLUMNS) + arrays["data"].tobytes())


def _unpacked(blob: bytes, n: int) -> dict[str, np.ndarray]:
    raw, at, out = zstandard.ZstdDecompressor().decompress(blob), 0, {}
    for name, kind in _COLUMNS:
        out[name] = np.frombuffer(raw, dtype=kind, count=n, offset=at)
        at += out[name].nbytes
    out["data"] = np.frombuffer(raw, dtype=np.uint8, offset=at)
    return out


def _spans(shard: int, text: np.ndarray, start: np.ndarray, end: np.ndarray) -> dict:
    order = np.lexsort((start, text))
    spans = np.stack([text[order], start[order], end[order]], axis=1).astype("<i8")
    return {"shard": shard, "spans": zstandard.ZstdCompressor(level=1).compress(spans.tobytes()), "n": len(spans)}


_SENT = pa.schema([("bucket", pa.int64()), ("shard", pa.int64()), ("n", pa.int64()), ("blob", pa.binary())])
_FOUND = pa.schema([("shard", pa.int64()), ("n", pa.int64()), ("spans", pa.binary())])


def _judged(sent: list[dict]) -> list[dict]:
    """What a bucket's stretches say about each shard's texts: spans to remove."""
    parts = [_unpacked(s["blob"], s["n"]) for s in sent]
    key, owner, text, at, strings, data = (np.concatenate([p[c] for p in parts]) for c in ("key", "owner", "text", "at", "strings", "data"))
    shard = np.repeat([s["shard"] for s in sent], [s["n"] for s in sent])
    strings = strings.astype(np.int64)
    lengths = strings + WIDTH - 1
    starts = np.concatenate([[0], np.cumsum(lengths)])
    like = alike(data, starts, key, owner)
    ends = at + lengths
    out = [(shard[m], text[m], at[m], ends[m]) for m in [owner > owner[like]]]
    # of stretches with the same bytes one is left; those whose key has others must be looked into
    left = np.flatnonzero(like == np.arange(len(like)))
    _, of_key, many = np.unique(key[left], return_inverse=True, return_counts=True)
    left = left[many[of_key] > 1]
    if len(left):
        left = left[in_two(*gathered(data, starts[left], lengths[left]), owner[left])]
    if len(left):
        removed = np.zeros(starts[-1], dtype=bool)
        blocks, at_block = [], np.cumsum(lengths[left]) // SHARD_TEXT
        for block in np.unique(at_block):
            own = left[at_block == block]
            body, cut = gathered(data, starts[own], lengths[own])
            begin = np.arange(strings[own].sum()) - np.repeat(np.cumsum(strings[own]) - strings[own] - cut[:-1], strings[own])
            begin_at = np.arange(strings[own].sum()) - np.repeat(np.cumsum(strings[own]) - strings[own] - starts[own], strings[own])
            blocks.append((begin_at, np.repeat(owner[own], strings[own]), *owned_strings(body, begin, np.repeat(owner[own], strings[own]), WIDTH)))
        known, least = blocks[0][2], blocks[0][3]
        for b in blocks[1:]:
            known, least = merged(known, least, b[2], b[3])
        for begin_at, own, names, _, which in blocks:
            first = least[np.searchsorted(known, names)] if len(blocks) > 1 else least
            removed[begin_at] = first[which] < own
        # runs of removed strings, for each stretch of the least owner that has these bytes
        same = np.flatnonzero((owner == owner[like]) & np.isin(like, left))
        steps = strings[same]
        flat, cut = gathered(removed, starts[like[same]], steps)
        fresh = np.zeros(len(flat) + 1, dtype=bool)
        fresh[cut] = True
        edge = flat.copy()
        edge[1:] &= ~flat[:-1] | fresh[1:-1]
        first = np.flatnonzero(edge)
        stop = flat.copy()
        stop[:-1] &= ~flat[1:] | fresh[1:-1]
        last = np.flatnonzero(stop)
        which = np.searchsorted(cut, first, side="right") - 1
        rows = same[which]
        out.append((shard[rows], text[rows], at[rows] + first - cut[which], at[rows] + last - cut[which] + WIDTH))
    shard, text, start, end = (np.concatenate([o[i] for o in out]) for i in range(4))
    return [_spans(int(s), text[shard == s], start[shard == s], end[shard == s]) for s in np.unique(shard)]


def repeated_spans(rows: DataFrame, bits: int) -> DataFrame:
    """(shard, n, spans): spans of each shard's texts that stand in texts with lesser keys."""

    def keys_of(part: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        found = stretches_of(texts_of(part), bits)
        pairs = np.lexsort((found.text, found.key))
        key, text = found.key[pairs], found.text[pairs]
        new = np.ones(len(key), dtype=bool)
        new[1:] = (key[1:] != key[:-1]) | (text[1:] != text[:-1])
        return np.unique(key[new], return_counts=True)

    def send(part: pa.Table, replies: pa.Table) -> pa.Table:
        if not part.num_rows:
            return _SENT.empty_table()
        shard = part.column("shard")[0].as_py()
        texts = texts_of(part)
        found = stretches_of(texts, bits)
        keys = np.unique(found.key)
        use = counts_of_shard(replies)[np.searchsorted(keys, found.key)] > 1 if len(keys) else np.zeros(0, dtype=bool)
        key, text, at, strings = found.key[use], found.text[use], found.at[use], found.strings[use]
        if not len(key):
            return _SENT.empty_table()
        data, starts = gathered(texts.data, at, strings + WIDTH - 1)
        owner = texts.ids[text]
        at = at - texts.starts[text]
        like = alike(data, starts, key, owner)
        known = owner > owner[like]
        out = []
        if known.any():  # a lesser text of this shard has these bytes
            spans = _spans(shard, text[known], at[known], (at + strings + WIDTH - 1)[known])
            out.append({"bucket": -1 - shard, "shard": shard, "n": spans["n"], "blob": spans["spans"]})
        bucket = (key >> np.uint64(SUFFIX_BITS - TEXT_BITS)).astype(np.int64)
        ask = np.flatnonzero(~known)
        ask = ask[np.argsort(bucket[ask], kind="stable")]
        present, begin = np.unique(bucket[ask], return_index=True)
        for b, own in zip(present.tolist(), np.split(ask, begin[1:]), strict=True):
            body, _ = gathered(data, starts[own], strings[own] + WIDTH - 1)
            out.append({"bucket": b, "shard": shard, "n": len(own), "blob": _packed(key=key[own], owner=owner[own], text=text[own], at=at[own], strings=strings[own], data=body)})
        return pa.Table.from_pylist(out, schema=_SENT)

    def judge(sent: pa.Table) -> pa.Table:
        if sent.column("bucket")[0].as_py() < 0:
            return pa.table({"shard": sent.column("shard"), "n": sent.column("n"), "spans": sent.column("blob")})
        return pa.Table.from_pylist(_judged(sent.to_pylist()), schema=_FOUND)

    replies = key_counts(rows, keys_of, bits)
    sent = rows.groupBy("shard").cogroup(replies_to(replies).groupBy("shard")).applyInArrow(send, "bucket long, shard long, n long, blob binary")
    return sent.groupBy("bucket").applyInArrow(judge, "shard long, n long, spans binary")


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", with_texts: bool = True) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256, spans, kept) for each row of ``docs``.

    Texts are UTF-8 bytes. Each byte goes that is part of a string of 50 bytes which also stands
    in a text with a lesser key; strings lie within one text and are judged as the texts
    were given. ``spans`` are the maximal removed runs as (start, end), ``kept`` the bytes left; without
    ``with_texts`` these two are left out.

    A null text counts as empty; a text of fewer than 50 bytes keeps all. Rows with the same key
    don't count as earlier than each other, so they never remove each other's bytes. A null key
    counts as greater than all others, two null keys as the same. Other columns are not read.

    Strings are found in three steps. A string's key is the least hash of its runs of 24
    bytes; keys are counted over all shards, and only stretches whose key stands in two
    texts go on. They are brought together by key, where a suffix array over each block of
    stretches, with common prefixes, shows equal strings, and blocks are merged by
    binary search. The spans go back to the shards.
    """
    total, _ = text_bytes(docs, text)
    bits = bucket_bits(int(total * KEYS_A_BYTE))
    named = docs.select(F.col(key).cast("long").alias("id"), text_of(text).alias("text"))
    rows = dealt(named, shard_count(total, SHARD_TEXT), F.col("id"), F.col("text"))

    def apply(part: pa.Table, found: pa.Table) -> pa.Table:
        names = ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.binary()]
        n = len(names) if with_texts else len(names) - 2
        if not part.num_rows:
            return pa.table([pa.array([], k) for k in kinds[:n]], names=names[:n])
        texts = texts_of(part)
        change = np.zeros(len(texts.data) + 1, dtype=np.int32)
        for blob in found.column("spans").to_pylist():
            spans = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), dtype="<i8").reshape(-1, 3)
            np.add.at(change, texts.starts[spans[:, 0]] + spans[:, 1], 1)
            np.add.at(change, texts.starts[spans[:, 0]] + spans[:, 2], -1)
        gone = np.cumsum(change[:-1]) > 0
        out = []
        for i, (a, b) in enumerate(zip(texts.starts.tolist(), texts.starts[1:].tolist(), strict=False)):
            own = gone[a:b]
            edge = np.flatnonzero(np.diff(own.astype(np.int8), prepend=0, append=0))
            left = texts.data[a:b][~own].tobytes()
            spans = [{"start": s, "end": e} for s, e in edge.reshape(-1, 2).tolist()] if with_texts else None
            out.append((None if texts.ids[i] == LAST else int(texts.ids[i]), b - a, int(own.sum()), len(edge) // 2, hashlib.sha256(left).hexdigest(), spans, left)[:n])
        return pa.table([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=False)], names=names[:n])

    schema = "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    schema += ", spans array<struct<start:long,end:long>>, kept binary" if with_texts else ""
    return rows.groupBy("shard").cogroup(repeated_spans(rows, bits).groupBy("shard")).applyInArrow(apply, schema)


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: what is removed from each, and a digest of what is left."""
    found = remove_repeats(table(spark, sf_dir, "documents"), with_texts=False)
    return found.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")
