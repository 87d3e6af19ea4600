"""Alignment of two tokenizations of each text: common token ends by galloping intersection."""

from __future__ import annotations

import hashlib
import re
import uuid
from array import array
from bisect import bisect_left
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

#: Places of the two vocabularies; a parameter, never part of the repository.
BYTE_BPE = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_BPE = "/opt/tokenizers/piece_bpe_32k.model"
#: Code points of text a task holds before it hands over a batch.
CHUNK_CHARS = 400_000
#: Code points of the units of A whose ids a task remembers, and units it encodes at a time.
CACHE_CHARS, UNITS_AT_ONCE = 3_000_000, 2_000
#: Statistics of id pairs up to so many bytes are broadcast; beyond, they meet documents by a salted shuffle.
BROADCAST_BYTES = 64_000_000
PAIR_BYTES = 48
SALTS = 16
#: Parts that A encodes each by itself: none of its pre-tokens holds a blank behind another sign, so a text is
#: cut ahead of a blank that stands behind none. What any Unicode version takes for a blank cuts nothing behind it.
UNIT = r"\s*+[^ \t-\r]++(?:(?<=[\s\u180e])\s++[^ \t-\r]*+)*+|\s++"
B_BITS = 16
_BLANKS = " \t\n\v\f\r"
#: Of so many values of a list one gallops from the place of the one before, the others from its place.
STRIDE = 16

PAIR = pa.struct([("a", pa.int32()), ("b", pa.int32()), ("links", pa.int64())])
ARROW = pa.schema(
    [("rid", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups", pa.large_string()), ("pairs", pa.list_(PAIR))]
)
SCHEMA = "rid long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<struct<a:int,b:int,links:long>>"


def byte_level_table() -> dict[str, int]:
    """The byte each character of a byte-level BPE entry stands for: printable Latin-1 bytes as
    themselves, the other bytes in order as the characters from U+0100 on."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


@dataclass
class Vocabularies:
    """Both models as bytes, read by the driver; workers build their encoders once."""

    byte_bpe: bytes
    piece_bpe: bytes

    @staticmethod
    def read(byte_bpe: str = BYTE_BPE, piece_bpe: str = PIECE_BPE) -> Vocabularies:
        with open(byte_bpe, "rb") as a, open(piece_bpe, "rb") as b:
            return Vocabularies(a.read(), b.read())

    def encoders(self) -> Encoders:
        key = hashlib.sha256(self.byte_bpe + self.piece_bpe).hexdigest()
        if key not in _BUILT:
            _BUILT[key] = Encoders(self)
        return _BUILT[key]


_BUILT: dict[str, Encoders] = {}


class Encoders:
    """Encoder A (byte-level BPE, no special tokens) and B (sentencepiece), with each id's bytes."""

    def __init__(self, vocab: Vocabularies):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(vocab.byte_bpe.decode())
        self.a.encode_special_tokens = True
        decode = byte_level_table()
        entries = self.a.get_vocab(with_added_tokens=False)
        self.a_bytes = [b""] * (max(entries.values()) + 1)
        for entry, i in entries.items():
            self.a_bytes[i] = bytes(decode[c] for c in entry)
        self.b = sentencepiece.SentencePieceProcessor(model_proto=vocab.piece_bpe)
        self.b_bytes = [self._piece_bytes(i) for i in range(self.b.get_piece_size())]
        self.a_len = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_len = np.array([len(x) for x in self.b_bytes], np.int64)
        self._unit = re.compile(UNIT)
        self._known: dict[str, bytes] = {}
        self._chars = 0
        self._batch = getattr(self.a, "encode_batch_fast", self.a.encode_batch)

    def _piece_bytes(self, i: int) -> bytes:
        if self.b.is_control(i) or self.b.is_unknown(i):
            return b""
        piece = self.b.id_to_piece(i)
        if self.b.is_byte(i):
            return bytes([int(re.fullmatch(r"<0x([0-9A-Fa-f]{2})>", piece).group(1), 16)])
        return piece.replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[list[int]]]:
        """Ids of space + text by A, each different unit encoded once, and of the text by B."""
        units = [self._unit.findall(" " + t) for t in texts]
        if self._chars > CACHE_CHARS:
            self._known.clear()
            self._chars = 0
        new = list(set(chain.from_iterable(units)).difference(self._known))
        self._learn(new)
        a = [np.frombuffer(b"".join(map(self._known.__getitem__, u)), np.int32) for u in units]
        return a, self.b.encode(texts)

    def _learn(self, units: list[str]) -> None:
        """Remember the ids of units by A, many encoded as one text where that cuts between any two."""
        apart = [u for u in units if u[0] not in _BLANKS or u[-1].isspace() or u[-1] == "\u180e"]
        beside = list(set(units).difference(apart))
        for at in range(0, len(beside), UNITS_AT_ONCE):
            part = beside[at : at + UNITS_AT_ONCE]
            ids = np.array(self._batch(["".join(part)], add_special_tokens=False)[0].ids, np.int32)
            want = np.cumsum([len(u.encode()) for u in part])
            ends = np.cumsum(self.a_len[ids])
            cuts = np.searchsorted(ends, want)
            if ends[-1] != want[-1] or not np.array_equal(ends[cuts], want):
                apart += part  # an entry is missing for some byte
                continue
            for unit, x, y in zip(part, [0, *(cuts + 1).tolist()], (cuts + 1).tolist(), strict=False):
                self._known[unit] = ids[x:y].tobytes()
        for unit, e in zip(apart, self._batch(apart, add_special_tokens=False), strict=True):
            self._known[unit] = array("i", e.ids).tobytes()
        self._chars += sum(map(len, units))


def galloping_common(short: Sequence[int] | np.ndarray, long: Sequence[int] | np.ndarray) -> list[int]:
    """Values of both strictly increasing lists: each of the shorter is found in the longer by
    exponential steps from a place before it, then binary search inside the last step.

    The first of every ``STRIDE`` values gallops from the place of the one before; the values up
    to the next gallop from its place, all at once.
    """
    short, long = np.asarray(short, np.int64), np.asarray(long, np.int64)
    if not len(short) or not len(long):
        return []
    heads, starts, at, n = short[::STRIDE].tolist(), [], 0, len(long)
    held = long.tolist() if len(heads) * 16 > n else long
    for x in heads:
        step = 1
        while at + step < n and held[at + step] < x:
            step <<= 1
        at = bisect_left(held, x, at + (step >> 1), min(at + step + 1, n))
        starts.append(at)
    low = np.repeat(np.array(starts, np.int64), STRIDE)[: len(short)]
    step = 1
    high = np.minimum(low + 1, n)  # the value's place is from low to high
    open_ = np.flatnonzero((high < n) & (long[np.minimum(high, n - 1)] < short))
    while len(open_):
        low[open_] = high[open_] + 1
        step <<= 1
        high[open_] = np.minimum(high[open_] + step, n)
        open_ = open_[(high[open_] < n) & (long[np.minimum(high[open_], n - 1)] < short[open_])]
    open_ = np.flatnonzero(low < high)
    while len(open_):
        middle = (low[open_] + high[open_]) >> 1
        less = long[middle] < short[open_]
        low[open_] = np.where(less, middle + 1, low[open_])
        high[open_] = np.where(less, high[open_], middle)
        open_ = open_[low[open_] < high[open_]]
    return short[(low < n) & (long[np.minimum(low, n - 1)] == short)].tolist()


@dataclass
class Alignment:
    """One text's alignment: counts, the groups as text, and its linked id pairs with their links."""

    n_a: int
    n_b: int
    n_groups: int
    n_links: int
    groups: str
    pairs: np.ndarray  # (A id << B_BITS) | B id, ascending
    links: np.ndarray


def _joined(ids: np.ndarray, ends: np.ndarray) -> str:
    """Each id in decimal digits with its separator behind it; the last separator is left out."""
    width = len(str(int(ids.max())))
    shown = np.empty((len(ids), width + 1), np.uint8)
    shown[:, width] = ends
    rest = ids.astype(np.int32)
    used = np.ones((len(ids), width + 1), bool)
    for column in range(width - 1, -1, -1):
        if column < width - 1:
            used[:, column] = rest > 0
        whole = rest // 10
        shown[:, column] = rest - whole * 10 + ord("0")
        rest = whole
    return shown[used].tobytes()[:-1].decode("ascii")


def align(a_ids: Sequence[int] | np.ndarray, b_ids: Sequence[int], enc: Encoders, whole: bytes) -> Alignment | None:
    """Groups and links of one text's two encodings, or None if either does not spell ``whole``."""
    if not whole or not len(a_ids) or not len(b_ids):
        return None
    a_arr, b_arr = np.asarray(a_ids, np.int64), np.asarray(b_ids, np.int64)
    a_end, b_end = np.cumsum(enc.a_len[a_arr]), np.cumsum(enc.b_len[b_arr])
    if a_end[-1] != len(whole) or b_end[-1] != len(whole):
        return None
    if b"".join(map(enc.a_bytes.__getitem__, a_arr.tolist())) != whole or b"".join(map(enc.b_bytes.__getitem__, b_ids)) != whole:
        return None
    common = galloping_common(a_end, b_end) if len(a_end) <= len(b_end) else galloping_common(b_end, a_end)
    cuts = np.asarray(common, np.int64)
    # a token's group: the first common end at or after its end
    a_group, b_group = np.searchsorted(cuts, a_end), np.searchsorted(cuts, b_end)
    groups = len(cuts)
    na = np.bincount(a_group, minlength=groups)
    nb = np.bincount(b_group, minlength=groups)
    # links: every A occurrence with every B occurrence of its group, counted by id pair
    b_start = np.concatenate([[0], np.cumsum(nb)])
    width = nb[a_group]
    a_rep = np.repeat(np.arange(len(a_ids)), width)
    offset = np.arange(len(a_rep)) - np.repeat(np.cumsum(width) - width, width)
    b_idx = b_start[a_group[a_rep]] + offset
    keys, links = np.unique((a_arr[a_rep] << B_BITS) | b_arr[b_idx], return_counts=True)
    # the groups as text: a ids by commas, a bar, b ids by commas; groups parted by semicolons
    places = np.empty(len(a_ids) + len(b_ids), np.int64)
    places[: len(a_ids)] = np.arange(len(a_ids)) + b_start[a_group]
    places[len(a_ids) :] = np.arange(len(b_ids)) + np.cumsum(na)[b_group]
    ids, ends = np.empty(len(places), np.int64), np.empty(len(places), np.uint8)
    ids[places] = np.concatenate([a_arr, b_arr])
    a_sep = np.where(np.append(a_group[1:] != a_group[:-1], True), ord("|"), ord(","))
    b_sep = np.where(np.append(b_group[1:] != b_group[:-1], True), ord(";"), ord(","))
    ends[places] = np.concatenate([a_sep, b_sep])
    text = _joined(ids, ends)
    return Alignment(len(a_ids), len(b_ids), groups, int(np.dot(na, nb)), text, keys, links.astype(np.int64))


def aligned(docs: DataFrame, vocab: Vocabularies, key: str = "doc_id", text: str = "text", digest: bool = False) -> DataFrame:
    """One row for each row of ``docs``: rid, doc_id, n_a, n_b, n_groups, n_links, groups, pairs.

    A text is encoded as space + text by A and as text by B (which puts a space first), no
    special tokens. ``groups`` is ``a1,a2|b1;a3|b2,b3`` in order; ``pairs`` the distinct
    (A id, B id) pairs linked in the text with their number of occurrence links. A null or empty
    text, or one that either encoding does not spell exactly, has no tokens: zeros, ``groups``
    empty, no pairs. ``rid`` numbers the rows; other columns, whatever their names, stay behind.
    With ``digest``, ``groups`` holds the lowercase hex sha256 of that text instead ('' stays '').
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = vocab.encoders()
        empty = Alignment(0, 0, 0, 0, "", np.zeros(0, np.int64), np.zeros(0, np.int64))

        def done(rows: list[tuple[int, int | None, str]]) -> pa.RecordBatch:
            a, b = enc.encode([t for _, _, t in rows])
            found = [(align(ai, bi, enc, (" " + t).encode()) if t else None) or empty for (_, _, t), ai, bi in zip(rows, a, b, strict=True)]
            keys = np.concatenate([f.pairs for f in found])
            offsets = np.concatenate([[0], np.cumsum([len(f.pairs) for f in found])]).astype(np.int32)
            pairs = pa.StructArray.from_arrays(
                [pa.array((keys >> B_BITS).astype(np.int32)), pa.array((keys & ((1 << B_BITS) - 1)).astype(np.int32)), pa.array(np.concatenate([f.links for f in found]))], fields=list(PAIR)
            )
            groups = [hashlib.sha256(f.groups.encode()).hexdigest() if f.groups else "" for f in found] if digest else [f.groups for f in found]
            columns = [
                pa.array([r for r, _, _ in rows], pa.int64()), pa.array([k for _, k, _ in rows], pa.int64()),
                *(pa.array([getattr(f, n) for f in found], pa.int64()) for n in ("n_a", "n_b", "n_groups", "n_links")),
                pa.array(groups, pa.large_string()), pa.ListArray.from_arrays(pa.array(offsets), pairs),
            ]
            return pa.RecordBatch.from_arrays(columns, schema=ARROW)

        rows: list[tuple[int, int | None, str]] = []
        chars = 0
        for batch in batches:
            for rid, k, t in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rows.append((rid, k, t or ""))
                chars += len(rows[-1][2]) + 100
                if chars > CHUNK_CHARS:
                    yield done(rows)
                    rows, chars = [], 0
        if rows:
            yield done(rows)

    numbered = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return numbered.mapInArrow(run, SCHEMA)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet under ``spark.checkpoint.dir`` and read back: lineage cut,
    computed once (a checkpoint would compute it a second time to write it)."""
    spark = df.sparkSession
    folder = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        from .common import kept

        kept(spark.range(0))  # sets a local folder on a local master, raises elsewhere
        folder = spark.sparkContext.getCheckpointDir()
    path = f"{folder}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.parquet(path)


def alignment_counts(docs: DataFrame, vocab: Vocabularies, key: str = "doc_id", text: str = "text", digest: bool = False) -> DataFrame:
    """Each row's alignment with corpus-wide counts of its id pairs.

    An id pair's count is the number of rows (documents) whose text links it. Adds to
    ``aligned``'s columns n_best (links whose pair count is the highest of any pair with their A
    id, ties included) and count_sum (pair counts summed over links). Counts are partial sums
    before their shuffle, so a pair in every text sends one row a task. The statistics meet
    the documents by broadcast when their measured size allows it, else by a join salted
    ``SALTS`` ways.
    """
    per_doc = written(aligned(docs, vocab, key, text, digest), "alignment")
    pairs = per_doc.select("rid", F.explode("pairs").alias("p")).select("rid", "p.a", "p.b", "p.links")
    counts = pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n_docs"))
    top = counts.groupBy("a").agg(F.max("n_docs").alias("top"))
    stats = written(counts.join(top, "a").select("a", "b", "n_docs", (F.col("n_docs") == F.col("top")).alias("best")), "alignment-pairs")
    if stats.count() * PAIR_BYTES <= BROADCAST_BYTES:
        linked = pairs.join(F.broadcast(stats), ["a", "b"])
    else:
        salted = stats.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        linked = pairs.withColumn("salt", F.pmod(F.xxhash64("rid"), F.lit(SALTS)).cast("int")).join(salted, ["a", "b", "salt"])
    sums = linked.groupBy("rid").agg(
        F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("n_best"),
        F.sum(F.col("links") * F.col("n_docs")).alias("count_sum"),
    )
    out = per_doc.drop("pairs").join(sums, "rid", "left")
    return out.select("*").fillna(0, ["n_best", "count_sum"])


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignment of both encodings of all documents, with corpus-wide pair counts."""
    out = alignment_counts(table(spark, sf_dir, "documents"), Vocabularies.read(), digest=True)
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", F.col("groups").alias("groups_sha256"))
