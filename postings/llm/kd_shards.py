"""Shards by a k-d tree over text-derived metadata, split at distributed weighted medians."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import kept, table, text_of

DIGIT_BITS = 12
KEY_BITS = 60
TIE_BITS = 30


@dataclass
class Node:
    """A region of the tree: its share of the leaves, and, once split, where."""

    leaves: int
    first_leaf: int
    dim: int = -1
    at: int = 0
    low: Node | None = None
    high: Node | None = None

    def place(self, keys: list[Column]) -> Column:
        """Leaf number of a row, from its keys."""
        if self.low is None:
            return F.lit(self.first_leaf)
        return F.when(keys[self.dim] <= self.at, self.low.place(keys)).otherwise(self.high.place(keys))


def ordered_keys(dims: list[Column], ranges: list[tuple[float, float]], tie: Column) -> list[Column]:
    """Each dimension as a whole number: its place in its range, then 30 bits of ``tie``.

    Rows with equal dimensions and ties get equal keys, so no split parts them; rows with
    equal dimensions only can be parted, so a crowded value does not spoil the balance.
    """
    spread = 2 ** (KEY_BITS - TIE_BITS) - 1
    tie = F.pmod(tie, F.lit(2**TIE_BITS))
    keys = []
    for dim, (low, high) in zip(dims, ranges, strict=True):
        place = F.lit(0) if high <= low else (dim - low) / (high - low) * spread
        keys.append(F.coalesce(F.floor(place).cast("long"), F.lit(0)) * 2**TIE_BITS + tie)
    return keys


def weighted_medians(rows: DataFrame, region: Column, keys: list[str], weight: str, dims: dict[int, int], shares: dict[int, float]) -> dict[int, int]:
    """For each region the smallest key at or below which its share of the weight lies.

    Digit by digit: each pass sums the weights by (region, next digit) where the higher digits
    are those found so far. The driver sees at most 4096 sums a region and pass.
    """
    found = {r: 0 for r in dims}
    before = {r: 0 for r in dims}
    target: dict[int, float] = {}
    pick = F.coalesce(*[F.when(F.col("region") == r, F.col(keys[d])) for r, d in dims.items()])
    placed = rows.select(region.alias("region"), *keys, weight).select("region", pick.alias("key"), weight)
    for shift in range(KEY_BITS - DIGIT_BITS, -1, -DIGIT_BITS):
        higher = F.coalesce(*[F.when(F.col("region") == r, F.lit(v)) for r, v in found.items()])
        sums = (
            placed.filter(F.shiftright("key", shift + DIGIT_BITS) == higher)
            .groupBy("region", F.pmod(F.shiftright("key", shift), F.lit(2**DIGIT_BITS)).alias("digit"))
            .agg(F.sum(weight).alias("weight"))
            .collect()
        )
        for r in dims:
            own = sorted((s.digit, s.weight) for s in sums if s.region == r)
            target.setdefault(r, shares[r] * sum(w for _, w in own))
            below = before[r]
            for digit, w in own:
                if below + w >= target[r] or digit == own[-1][0]:
                    break
                below += w
            # with the last digit, the nearer of the two sides of the row group on the border
            if not shift and own and digit != own[0][0] and target[r] - below < below + w - target[r]:
                digit -= 1
            before[r] = below
            found[r] = found[r] * 2**DIGIT_BITS + (digit if own else 0)
    return found


def grow(rows: DataFrame, keys: list[str], weight: str, leaves: int) -> Node:
    """The tree: level by level, every region that has more than one leaf is split at the
    weighted median of the dimension in which it is widest."""
    root = Node(leaves, 0)
    active = [root]
    while active := [n for n in active if n.leaves > 1]:
        region = F.lit(None).cast("int")
        place = root.place([F.col(k) for k in keys])
        for i, node in enumerate(active):
            region = F.when(place == node.first_leaf, F.lit(i)).otherwise(region)
        inside = rows.filter(region.isNotNull())
        widths = {
            r.region: [r[f"high_{k}"] - r[f"low_{k}"] for k in keys]
            for r in inside.groupBy(region.alias("region"))
            .agg(*[F.min(F.shiftright(k, TIE_BITS)).alias(f"low_{k}") for k in keys], *[F.max(F.shiftright(k, TIE_BITS)).alias(f"high_{k}") for k in keys])
            .collect()
        }
        dims = {i: max(range(len(keys)), key=lambda d, w=w: (w[d], -d)) for i, w in widths.items()}
        shares = {i: (active[i].leaves // 2) / active[i].leaves for i in dims}
        splits = weighted_medians(inside, region, keys, weight, dims, shares) if dims else {}
        following = []
        for i, node in enumerate(active):
            half = node.leaves // 2
            node.dim, node.at = dims.get(i, 0), splits.get(i, 0)
            node.low, node.high = Node(half, node.first_leaf), Node(node.leaves - half, node.first_leaf + half)
            following += [node.low, node.high]
        active = following
    return root


def shard_by_bytes(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Rows of ``docs`` as (key, size, text_crc32, shard, slot) in shards of near equal bytes.

    A row's size is the UTF-8 bytes of its text plus 1. The tree's dimensions are the text's
    size, its bytes a character and its line count, all on a log scale, so equal texts fall
    into the same shard. Give the number of shards, or the bytes a shard should have.
    ``slot`` numbers a shard's rows without gaps, from 0.

    Null and empty texts have size 1. Rows with a null or repeated key are rows like any
    other. An empty table gives an empty result. Extra columns are not read.
    """
    body = text_of(text)
    bytes_, chars = F.octet_length(body).cast("long"), F.char_length(body)
    lines = F.length(body) - F.length(F.translate(body, "\n", ""))
    narrow = kept(
        docs.select(
            F.col(key),
            (bytes_ + 1).alias("size"),
            F.crc32(body.cast("binary")).alias("text_crc32"),
            F.log2(bytes_ + 1).alias("d0"),
            F.log2((bytes_ + 1) / (chars + 1)).alias("d1"),
            F.log2(lines + 1).alias("d2"),
            F.xxhash64(body).alias("tie"),
        )
    )
    dims = ["d0", "d1", "d2"]
    bounds = narrow.agg(F.sum("size").alias("total"), F.count("size").alias("rows"), *[f(d).alias(f"{d}_{f.__name__}") for d in dims for f in (F.min, F.max)]).first()
    leaves = shards or max(1, round((bounds.total or 0) / target_bytes))
    ranges = [(bounds[f"{d}_min"] or 0.0, bounds[f"{d}_max"] or 0.0) for d in dims]
    keys = [f"k{i}" for i in range(len(dims))]
    rows = narrow.select(key, "size", "text_crc32", "tie", *[k.alias(n) for k, n in zip(ordered_keys([F.col(d) for d in dims], ranges, F.col("tie")), keys, strict=True)])
    tree = grow(rows, keys, "size", leaves)
    placed = rows.select(key, "size", "text_crc32", tree.place([F.col(k) for k in keys]).cast("int").alias("shard"), "tie")
    return numbered(placed, key, max(32, bounds.rows // 50_000)).drop("tie", "part")


def numbered(placed: DataFrame, key: str, parts: int) -> DataFrame:
    """``slot``: a number for each row of a shard, from 0 without gaps.

    A shard is numbered in parts of bounded size, each from the sum of the parts before it.
    """
    placed = placed.withColumn("part", F.pmod(F.xxhash64(F.col(key), F.col("tie")), F.lit(parts)).cast("int"))
    starts = (
        placed.groupBy("shard", "part")
        .count()
        .select("shard", "part", (F.sum("count").over(Window.partitionBy("shard").orderBy("part")) - F.col("count")).alias("start"))
    )
    place = F.row_number().over(Window.partitionBy("shard", "part").orderBy(key, "tie")) - 1
    return placed.withColumn("place", place).join(starts, ["shard", "part"]).withColumn("slot", F.col("start") + F.col("place")).drop("start", "place")


def op9_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 7 of near equal bytes."""
    return shard_by_bytes(table(spark, sf_dir, "documents"), shards=8).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
