"""Near duplicates: an exact Jaccard join on word shingles, in size-banded tiles."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import kept, table, text_bytes, text_of
from .components import components
from .exchange import SUFFIX_BITS, bucket_bits, counts_of_shard, dealt, key_counts, replies_to, shard_count
from .hashes import shingle_sets

#: Bytes of shingle sets in one tile, or in either side of a tile of two cells.
TILE_BYTES = 8_000_000
#: Bits of a set's signature.
SIGNATURE_BITS = 1024
#: Sets whose signatures are held against one set's at a time.
BLOCK = 4096
#: Words that a byte of text has, about: it sizes the buckets before shingles are made.
SHINGLES_A_BYTE = 0.2


def signatures(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A row of bits for each set: for each shingle the bit of its hash."""
    bits = np.zeros((len(starts) - 1, SIGNATURE_BITS // 64), dtype=np.uint64)
    owner = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    place = (values % np.uint64(SIGNATURE_BITS)).astype(np.int64)
    np.bitwise_or.at(bits, (owner, place >> 6), np.uint64(1) << (place & 63).astype(np.uint64))
    return bits


def linked_roots(values: np.ndarray, starts: np.ndarray, percent: int) -> np.ndarray:
    """For each set the first set that it reaches by links, among sets of sorted shingles.

    Sets link when 100 |A and B| >= percent |A or B|. Each set is held once against those not
    yet in its component: first by size, then by signature (a bit that one set has and the
    other lacks is a shingle that they do not share), then by the shingles themselves.
    """
    n = len(starts) - 1
    size = np.diff(starts)
    bits = signatures(values, starts)
    root = np.full(n, -1)
    open_ = np.arange(n)
    for first in range(n):
        if root[first] >= 0:
            continue
        root[first] = first
        open_ = open_[root[open_] < 0]
        waiting = [first]
        while waiting and len(open_):
            pivot = waiting.pop()
            own = values[starts[pivot] : starts[pivot + 1]]
            found = []
            for at in range(0, len(open_), BLOCK):
                other = open_[at : at + BLOCK]
                small, large = np.minimum(size[other], len(own)), np.maximum(size[other], len(own))
                other = other[100 * small >= percent * large]
                need = -(-percent * (size[other] + len(own)) // (100 + percent))
                lack = np.bitwise_count(bits[pivot] & ~bits[other]).sum(axis=1)
                extra = np.bitwise_count(bits[other] & ~bits[pivot]).sum(axis=1)
                bound = np.minimum(len(own) - lack.astype(np.int64), size[other] - extra.astype(np.int64))
                other, need = other[bound >= need], need[bound >= need]
                if not len(other):
                    continue
                lengths = size[other]
                ends = np.cumsum(lengths)
                place = np.arange(ends[-1]) - np.repeat(ends - lengths, lengths) + np.repeat(starts[other], lengths)
                theirs = values[place]
                at_own = np.minimum(np.searchsorted(own, theirs), len(own) - 1)
                shared = np.add.reduceat((own[at_own] == theirs).astype(np.int64), ends - lengths)
                found.append(other[shared >= need])
            if found:
                new = np.concatenate(found)
                root[new] = first
                waiting.extend(new.tolist())
                open_ = open_[root[open_] < 0]
    return root


def _shingle_rows(dealt_rows: DataFrame, size: int, percent: int, bits: int) -> DataFrame:
    """(id, n_shingles, shingles, tokens): each text's set, where others may be like it.

    Shingles are put in one order for all texts, the rarest first. Two sets that link share
    one of the first n - ceil(percent n / 100) + 1 of either; ``tokens`` has those of them
    that more than one text has. A text without tokens links with nothing, and its set
    is left out.
    """
    drop = np.uint64(64 - SUFFIX_BITS - bits)

    def keys_of(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        values, _, _ = shingle_sets(rows.column("text"), size)
        return np.unique(values >> drop, return_counts=True)

    def sets(rows: pa.Table, replies: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return pa.table({"id": pa.array([], pa.int64()), "n_shingles": pa.array([], pa.int64()), "shingles": pa.array([], pa.binary()), "tokens": pa.array([], pa.list_(pa.int64()))})
        values, owner, starts = shingle_sets(rows.column("text"), size)
        counts = counts_of_shard(replies)
        keys = np.unique(values >> drop)
        texts = counts[np.searchsorted(keys, values >> drop)] if len(values) else np.zeros(0, dtype=np.uint32)
        order = np.lexsort((values, texts, owner))
        n = np.diff(starts)
        prefix = n - -(-percent * n // 100) + 1
        rank = np.arange(len(values)) - np.repeat(starts[:-1], n)
        use = (rank < np.repeat(prefix, n)) & (texts[order] > 1)
        token, token_of = values[order][use].astype(np.int64), owner[use]
        cut = np.searchsorted(token_of, np.arange(len(n) + 1))
        has = np.diff(cut) > 0
        raw = values.astype("<u8")
        return pa.table(
            {
                "id": rows.column("id"),
                "n_shingles": pa.array(n, pa.int64()),
                "shingles": pa.array([raw[a:b].tobytes() if h else None for a, b, h in zip(starts, starts[1:], has, strict=False)], pa.binary()),
                "tokens": pa.array([token[a:b] if h else None for a, b, h in zip(cut, cut[1:], has, strict=False)], pa.list_(pa.int64())),
            }
        )

    replies = key_counts(dealt_rows, keys_of, bits)
    return dealt_rows.groupBy("shard").cogroup(replies_to(replies).groupBy("shard")).applyInArrow(sets, "id long, n_shingles long, shingles binary, tokens array<bigint>")


def _tiles(sets: DataFrame, rough: DataFrame, percent: int, tile_bytes: int) -> DataFrame:
    """(tile..., id, shingles): the sets dealt to tiles so that every pair that can link meets.

    ``rough`` puts sets into components by shared tokens. A component that fits is one tile. A
    larger one is cut into cells by band of size (sets that link are in the same band or in
    neighbouring ones) and, within a band, by hash into parts that fit; each pair of cells of
    the same or neighbouring bands is a tile.
    """
    ratio = float(np.log(100 / percent)) if percent < 100 else 1e-9
    rows = sets.join(rough.withColumnRenamed("node", "id"), "id", "left").select(
        "id", "shingles", F.coalesce("component", "id").alias("component"), F.octet_length("shingles").alias("bytes"), F.floor(F.log(F.col("n_shingles").cast("double")) / ratio).alias("band")
    )
    cells = rows.groupBy("component", "band").agg(F.sum("bytes").alias("band_bytes"), F.count(F.lit(1)).alias("n"))
    whole = cells.groupBy("component").agg(F.sum("band_bytes").alias("whole"), F.sum("n").alias("members"))
    one = whole.filter((F.col("whole") <= tile_bytes) & (F.col("members") > 1)).select("component")
    many = whole.filter(F.col("whole") > tile_bytes).select("component")
    plain = rows.join(one, "component").select("component", F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("a_part"), F.lit(0).cast("long").alias("b"), F.lit(0).cast("long").alias("b_part"), "id", "shingles")
    parts = cells.join(many, "component").select("component", "band", F.ceil(F.col("band_bytes") / tile_bytes).cast("long").alias("parts"))
    beside = parts.select("component", F.explode(F.array(F.col("band") - 1, "band", F.col("band") + 1)).alias("band"), F.struct(F.col("band").alias("other"), F.col("parts").alias("n")).alias("cell"))
    near = beside.groupBy("component", "band").agg(F.collect_list("cell").alias("near")).join(parts, ["component", "band"])
    placed = rows.join(near, ["component", "band"]).withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")))
    mine = F.struct(F.col("band").alias("band"), F.col("part").alias("part"))
    cell = F.col("cell")
    split = (
        placed.select("*", F.explode("near").alias("c"))
        .select("component", "id", "shingles", mine.alias("mine"), F.explode(F.transform(F.sequence(F.lit(0).cast("long"), F.col("c.n") - 1), lambda p: F.struct(F.col("c.other").alias("band"), p.alias("part")))).alias("cell"))
        .select("component", F.least("mine", cell).alias("low"), F.greatest("mine", cell).alias("high"), "id", "shingles")
        .select("component", F.col("low.band").alias("a"), F.col("low.part").alias("a_part"), F.col("high.band").alias("b"), F.col("high.part").alias("b_part"), "id", "shingles")
    )
    return plain.union(split)


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text", tile_bytes: int = TILE_BYTES) -> DataFrame:
    """(id, n_shingles, component): for each row its set's size and its group's least key.

    A text's set is its distinct runs of ``size`` words, or all its words where there are
    fewer; words are lower-cased (A-Z) and parted by blanks. Texts link when
    100 |A and B| >= percent |A or B|, and groups are what links connect.

    Null and empty texts, and those of blanks only, have no set, link with nothing and are
    their own group. Rows with the same key are one node. Rows with a null key have a set size
    and a null group. Keys are integers. Other columns are not read.
    """
    total, _ = text_bytes(docs, text)
    named = docs.select(F.col(key).cast("long").alias("id"), text_of(text).alias("text"))
    rows = dealt(named, shard_count(total), F.col("id"), F.col("text"))
    every = kept(_shingle_rows(rows, size, percent, bucket_bits(int(total * SHINGLES_A_BYTE))))
    held = every.filter(F.col("tokens").isNotNull() & F.col("id").isNotNull())
    # equal sets: one of them stands for all
    same = held.select("id", F.xxhash64("shingles").alias("h1"), F.crc32("shingles").alias("h2"), "n_shingles")
    stands = same.groupBy("h1", "h2", "n_shingles").agg(F.min("id").alias("first"))
    copies = kept(same.join(stands, ["h1", "h2", "n_shingles"]).filter("id <> first").select(F.col("id").alias("u"), F.col("first").alias("v")).distinct())
    sets = held.join(copies.select(F.col("u").alias("id")), "id", "left_anti")
    tokens = sets.select("id", F.explode("tokens").alias("token"))
    meets = tokens.groupBy("token").agg(F.min("id").alias("v"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    rough = components(tokens.join(meets, "token").select(F.col("id").alias("u"), "v"))

    def links(tile: pa.Table) -> pa.Table:
        ids = tile.column("id").to_numpy()
        order = np.argsort(ids, kind="stable")
        parts = tile.column("shingles").take(pa.array(order)).to_pylist()
        starts = np.concatenate([[0], np.cumsum([len(p) // 8 for p in parts])])
        root = linked_roots(np.frombuffer(b"".join(parts), dtype="<u8"), starts, percent)
        ids = ids[order]
        return pa.table({"u": pa.array(ids, pa.int64()), "v": pa.array(ids[root], pa.int64())})

    tiles = _tiles(sets.select("id", "n_shingles", "shingles"), rough, percent, tile_bytes)
    found = tiles.groupBy("component", "a", "a_part", "b", "b_part").applyInArrow(links, "u long, v long").filter("u <> v")
    groups = components(found.union(copies)).withColumnRenamed("node", "id")
    return every.select("id", "n_shingles").join(groups, "id", "left").select("id", "n_shingles", F.coalesce("component", "id").alias("component"))


def keep_one(docs: DataFrame, size: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each group of near duplicates: the one with the least key.

    See ``near_duplicates``. Rows with a null key all stay, and rows with the same key share their fate.
    Other columns pass through.
    """
    groups = near_duplicates(docs, size, percent, key, text)
    others = groups.filter("id <> component").select(F.col("id").alias("__other")).distinct()
    rows = docs.select(F.struct("*").alias("row"))
    return rows.join(others, F.col("row")[key].cast("long") == F.col("__other"), "left_anti").select(*[F.col("row")[c].alias(c) for c in docs.columns])


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their set's size and their component at 4 words and 85 in 100."""
    found = near_duplicates(table(spark, sf_dir, "documents"), size=4, percent=85)
    return found.select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"))
