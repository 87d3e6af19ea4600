"""Benchmark items inside documents, by MinHash containment search and exact shingle counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import kept, let, row_ids, table, text_of, words_of

SHINGLE_WORDS = 5
#: Least share of an item's shingles that a document must have, in hundredths.
CONTAINMENT = 80
#: Tables of up to so many bytes are broadcast; larger ones are joined by shuffle.
BROADCAST_BYTES = 4_000_000


def shingle_hashes(words: Column, size: int) -> Column:
    """64 bits for each run of ``size`` words, in order and with repeats.

    They are made from the words' hashes, so that no run of words is put together.
    """

    def runs(h: Column) -> Column:
        whole = lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(size)])
        return F.when(F.size(h) < size, F.array().cast("array<bigint>")).otherwise(F.transform(F.sequence(F.lit(0), F.size(h) - size), whole))

    return let(F.transform(words, lambda w: F.xxhash64(w)), runs)


def shingles_of(words: Column, size: int) -> Column:
    """The distinct runs of ``size`` words, the words parted by one space."""
    runs = lambda w: F.transform(F.sequence(F.lit(1), F.size(w) - size + 1), lambda i: F.array_join(F.slice(w, i, size), " "))
    return let(words, lambda w: F.when(F.size(w) < size, F.array().cast("array<string>")).otherwise(F.array_distinct(runs(w))))


def small(df: DataFrame, row_bytes: Column | int = 24) -> DataFrame:
    """``df`` written and measured: with a broadcast hint if it has few bytes."""
    df = kept(df)
    total = df.agg(F.sum(row_bytes if isinstance(row_bytes, Column) else F.lit(row_bytes))).first()[0]
    return F.broadcast(df) if (total or 0) <= BROADCAST_BYTES else df


def sketches(items: DataFrame, size: int, containment: int) -> DataFrame:
    """(item, class, hash): the bottom of each item's MinHash order, so much that no match is lost.

    Of an item's n shingles, a document with enough of them misses at most n - ceil(c n). Of
    the n - ceil(c n) + 1 with the least hashes it has at least one. Items of n to 2 n
    shingles form a class.
    """
    hashes = F.array_sort(F.array_distinct(shingle_hashes(F.col("words"), size)))
    n = F.size("hashes")
    return (
        items.select("item", hashes.alias("hashes"))
        .filter(n > 0)
        .select("item", F.floor(F.log2(n)).cast("int").alias("class"), F.explode(F.slice("hashes", 1, n - F.ceil(n * containment / 100).cast("int") + 1)).alias("hash"))
    )


def candidates(docs: DataFrame, items: DataFrame, size: int, containment: int) -> DataFrame:
    """(r1, r2, item): documents that have a shingle of an item's sketch.

    Each class has a ceiling, the greatest hash in its sketches; a document is searched with
    its hashes below the ceiling only. Classes of large items have low ceilings.
    """
    index = small(sketches(items, size, containment))
    ceilings = {r["class"]: r.ceiling for r in index.groupBy("class").agg(F.max("hash").alias("ceiling")).collect()}
    if not ceilings:
        return docs.join(items.select("item"), F.lit(False)).select("r1", "r2", "item")
    probes = docs.select("r1", "r2", F.filter(shingle_hashes(words_of(F.col("text")), size), lambda h: h <= max(ceilings.values())).alias("hashes"))
    allowed = reduce(lambda a, b: a | b, [(F.col("class") == c) & (F.col("hash") <= ceiling) for c, ceiling in ceilings.items()])
    return probes.select("r1", "r2", F.explode("hashes").alias("hash")).join(index, "hash").filter(allowed).select("r1", "r2", "item").distinct()


def contaminated(docs: DataFrame, benchmark: DataFrame, containment: int = CONTAINMENT) -> DataFrame:
    """(r1, r2, key, item, n_shingles, n_shared): each document with each item it contains.

    ``docs`` has (r1, r2, key, text), ``benchmark`` has (item, text). An item's shingles are
    its distinct runs of five words, or all its words if there are fewer. A document contains
    it if it has at least ``containment`` hundredths of them, by their texts. Words are
    lower-cased (A-Z) and parted by blanks. Items without words are contained nowhere.
    """
    items = benchmark.select("item", words_of(F.col("text")).alias("words")).filter(F.size("words") > 0)
    items = kept(items.withColumn("size", F.least(F.size("words"), F.lit(SHINGLE_WORDS))))
    found = []
    for size in sorted(r.size for r in items.select("size").distinct().collect()):
        of_size = items.filter(F.col("size") == size)
        found.append(candidates(docs, of_size, size, containment))
    if not found:
        return docs.select("r1", "r2", "key", F.lit(None).cast(items.schema["item"].dataType).alias("item"), F.lit(0).alias("n_shingles"), F.lit(0).alias("n_shared")).limit(0)
    pairs = small(reduce(DataFrame.union, found).groupBy("r1", "r2").agg(F.collect_set("item").alias("items")), 40 + 8 * F.size("items"))
    of_item = F.when(F.col("size") == SHINGLE_WORDS, shingles_of(F.col("words"), SHINGLE_WORDS)).otherwise(F.array(F.array_join("words", " ")))
    shingles = small(items.select("item", of_item.alias("shingles")), 24 + F.octet_length(F.array_join("shingles", "12345678")))
    plain = F.concat(F.lit(" "), F.array_join(words_of(F.col("text")), " "), F.lit(" "))
    shared = F.filter("shingles", lambda s: F.contains(F.col("plain"), F.concat(F.lit(" "), s, F.lit(" "))))
    return (
        docs.join(pairs, ["r1", "r2"])
        .select("r1", "r2", "key", plain.alias("plain"), F.explode("items").alias("item"))
        .join(shingles, "item")
        .select("r1", "r2", "key", "item", F.size("shingles").alias("n_shingles"), F.size(shared).alias("n_shared"))
        .filter(F.col("n_shared") * 100 >= F.col("n_shingles") * containment)
    )


def keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(*row_ids(F.col(key), text_of(text)), F.col(key).alias("key"), text_of(text).alias("text"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """``docs`` without those that contain a benchmark item.

    See ``contaminated``. Null texts count as empty and stay, null keys are keys like any other, rows
    with the same key and text share their fate. Other columns pass through. Null or empty
    items are contained nowhere; items with the same key count each on its own.
    """
    items = benchmark.select(F.col(item_key).alias("item"), text_of(item_text).alias("text"))
    hit = small(contaminated(keyed(docs, key, text), items).select("r1", "r2").distinct())
    rows = docs.select(F.struct("*").alias("row"), *row_ids(F.col(key), text_of(text)))
    return rows.join(hit, ["r1", "r2"], "left_anti").select(*[F.col("row")[c].alias(c) for c in docs.columns])


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with every benchmark item that it contains."""
    items = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("item"), text_of().alias("text"))
    found = contaminated(keyed(table(spark, sf_dir, "documents"), "doc_id", "text"), items)
    return found.select(F.col("key").alias("doc_id"), F.col("item").alias("item_id"), F.col("n_shingles").cast("long").alias("n_shingles"), F.col("n_shared").cast("long").alias("n_shared"))


OP2_SQL = r"""
WITH w AS (
  SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM benchmark
), i AS (
  SELECT item_id, least(5, len(w)) AS k, w FROM w WHERE len(w) > 0
), s AS (
  SELECT item_id, k, list_distinct(list_transform(range(1, len(w) - k + 2), lambda x: array_to_string(w[x:x + k - 1], ' '))) AS s FROM i
), u AS (
  SELECT item_id, len(s) AS n, unnest(s) AS s FROM s
), d AS (
  SELECT doc_id, row_number() OVER () AS row, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), e AS (
  SELECT DISTINCT doc_id, row, unnest(list_transform(range(1, len(w) - k + 2), lambda x: array_to_string(w[x:x + k - 1], ' '))) AS s
  FROM d, (SELECT DISTINCT k FROM s)
)
SELECT doc_id, item_id, n AS n_shingles, count(*) AS n_shared
FROM e JOIN u USING (s) GROUP BY doc_id, row, item_id, n HAVING 100 * count(*) >= 80 * n
"""
