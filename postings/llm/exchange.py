"""Counts of keys over all shards of a table, brought back to the shards.

Each shard sends its distinct keys, sorted and packed, to buckets of the key space. A bucket
merges what the shards sent by binary search and answers each shard with the counts of its keys,
in the order in which they came. A key that every row has costs one entry a shard.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHARD_BYTES = 4_000_000
#: A bucket's keys are its number and so many bits more.
SUFFIX_BITS = 32
REPLY_SCHEMA = "shard long, bucket long, counts binary, distinct long, total long"


def shard_count(total_bytes: int, shard_bytes: int = SHARD_BYTES) -> int:
    return max(64, total_bytes // shard_bytes)


def dealt(rows: DataFrame, shards: int, *by: Column) -> DataFrame:
    """``rows`` with a ``shard`` number from the hash of ``by``, a shard's rows together."""
    return rows.withColumn("shard", F.pmod(F.xxhash64(*by), F.lit(shards))).repartition(max(16, shards // 4), "shard")


def bucket_bits(total_keys: int) -> int:
    """Bits of the bucket number: about 2**20 keys a bucket, and few chance meetings of keys."""
    return int(np.clip(np.ceil(np.log2(max(total_keys, 1))) - 20, 6, 16))


def key_counts(dealt_rows: DataFrame, keys_of: Callable[[pa.Table], tuple[np.ndarray, np.ndarray]], bits: int, whole: bool = False) -> DataFrame:
    """(shard, bucket, counts, ...): for each shard and bucket the counts of its keys over all shards.

    ``keys_of`` gives a shard's distinct keys, sorted numbers below 2**(bits + 32), or of 64
    bits if ``whole``, and how often the shard counts each. Counts are 32-bit and in the order
    of the keys. Each bucket has a row more, of shard -1, with how many of its keys have a
    count and the sum of the counts.
    """
    shift, kind = np.uint64(64 - bits if whole else SUFFIX_BITS), np.uint64 if whole else np.uint32

    def send(rows: pa.Table) -> pa.Table:
        shard = rows.column("shard")[0].as_py()
        keys, counts = keys_of(rows)
        bucket = (keys >> shift).astype(np.int64)
        present = np.unique(bucket)
        cut = np.append(np.searchsorted(bucket, present), len(keys))
        suffix, counts = keys.astype(kind), counts.astype(np.uint32)
        return pa.table(
            {
                "bucket": pa.array(present, pa.int64()),
                "shard": pa.array(np.full(len(present), shard), pa.int64()),
                "keys": pa.array([suffix[a:b].tobytes() for a, b in zip(cut, cut[1:], strict=False)], pa.binary()),
                "n": pa.array([packed(counts[a:b]) for a, b in zip(cut, cut[1:], strict=False)], pa.binary()),
            }
        )

    def answer(sent: pa.Table) -> pa.Table:
        runs = [np.frombuffer(k, dtype=kind) for k in sent.column("keys").to_pylist()]
        merged = np.unique(np.concatenate(runs))
        total = np.zeros(len(merged), dtype=np.int64)
        places = [np.searchsorted(merged, run) for run in runs]
        for place, n in zip(places, sent.column("n").to_pylist(), strict=True):
            total[place] += unpacked(n)
        n, bucket = len(places), sent.column("bucket")[0].as_py()
        counts = np.minimum(total, 2**32 - 1).astype(np.uint32)
        return pa.table(
            {
                "shard": pa.array([*sent.column("shard").to_pylist(), -1], pa.int64()),
                "bucket": pa.array([bucket] * (n + 1), pa.int64()),
                "counts": pa.array([*(packed(counts[p]) for p in places), None], pa.binary()),
                "distinct": pa.array([None] * n + [int((total > 0).sum())], pa.int64()),
                "total": pa.array([None] * n + [int(total.sum())], pa.int64()),
            }
        )

    sent = dealt_rows.groupBy("shard").applyInArrow(send, "bucket long, shard long, keys binary, n binary")
    return sent.groupBy("bucket").applyInArrow(answer, REPLY_SCHEMA)


def replies_to(replies: DataFrame) -> DataFrame:
    """The rows for shards, without the sums."""
    return replies.filter("shard >= 0").select("shard", "bucket", "counts")


def packed(counts: np.ndarray) -> bytes:
    """Counts as bytes: a byte each, with the ones that do not fit behind a mark."""
    small = np.minimum(counts, 255).astype(np.uint8)
    return small.tobytes() + counts[small == 255].astype(np.uint32).tobytes()


def unpacked(data: bytes) -> np.ndarray:
    """What ``packed`` was given. Of n counts, the m marked ones have four bytes each at the end."""
    raw = np.frombuffer(data, dtype=np.uint8)
    n = len(raw)
    if (raw == 255).any():
        marks = np.cumsum(raw == 255)
        # n counts of which marks[n - 1] are marked: n + 4 * marks[n - 1] bytes in all
        n = int(np.flatnonzero(np.arange(1, len(raw) + 1) + 4 * marks == len(raw))[0]) + 1
    counts = raw[:n].astype(np.uint32)
    counts[counts == 255] = np.frombuffer(data[n:], dtype=np.uint32)
    return counts


def counts_of_shard(replies: pa.Table) -> np.ndarray:
    """The counts of a shard's keys, in their order."""
    order = np.argsort(replies.column("bucket").to_numpy())
    parts = replies.column("counts").to_pylist()
    return np.concatenate([unpacked(parts[i]) for i in order]) if len(order) else np.zeros(0, dtype=np.uint32)
