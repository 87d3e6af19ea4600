"""Repeated passages of lines, removed where they were seen before.

``dedup_passages`` looks up the rolling hash at every line and so finds all passages of two lines
or more, as far as they reach. ``dedup_lines`` looks up whole content-defined chunks only; the
queries do not use it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import kept, let, row_ids, table, text_bytes, text_of

#: Bytes of text in one part of the rows that are dealt out by row key.
PART_BYTES = 8_000_000


def chunk_starts(lines: Column) -> Column:
    """Places (from 1) at which a chunk of lines starts.

    The rolling hash at a line covers that line and the one before. A chunk ends at a line
    whose rolling hash is below those of both neighbours, so a boundary depends on four
    lines only: it does not move when lines are added or lost elsewhere, and chunks have two
    lines at least, but for a last line on its own.
    """
    rolling_hashes = let(
        F.transform(lines, lambda line: F.xxhash64(line)),
        lambda hashes: F.transform(hashes, lambda h, i: F.xxhash64(h, F.when(i > 0, F.get(hashes, i - 1)))),
    )
    lowest = let(
        rolling_hashes,
        lambda r: F.transform(
            r, lambda h, i: F.when((i > 0) & (i < F.size(r) - 1) & (h < F.get(r, i - 1)) & (h < F.get(r, i + 1)), i + 2).otherwise(0)
        ),
    )
    return F.concat(F.array(F.lit(1)), F.filter(lowest, lambda i: i > 0))


def chunks_of(text: Column) -> Column:
    """The chunks of a text as an array of arrays of lines; their lines in order are the text's."""

    def cut(lines: Column, starts: Column) -> Column:
        return F.transform(starts, lambda s, i: F.slice(lines, s, F.coalesce(F.get(starts, i + 1), F.size(lines) + 1) - s))

    return let(F.split(text, "\n", -1), lambda lines: let(chunk_starts(lines), lambda starts: cut(lines, starts)))


def line_chunks(rows: DataFrame, text: str) -> DataFrame:
    """A row for each chunk of two or more lines: the row's keys, the chunk's place and text."""
    return (
        rows.select("*", F.posexplode(chunks_of(F.col(text))).alias("place", "lines"))
        .filter(F.size("lines") > 1)
        .select(*[c for c in rows.columns if c != text], "place", F.concat_ws("\n", "lines").alias("chunk"))
    )


def repeated_chunks(rows: DataFrame, dealt: DataFrame) -> DataFrame:
    """(r1, r2, places): by document the places of chunks that stood before.

    ``rows`` and ``dealt`` have (key, r1, r2, text), the latter dealt out by r1 and r2. The
    first copy, by key and then place, stays. Copies are found by their hash and then held
    against the first copy's text. Only hashes are grouped, with sums made before the
    shuffle; a chunk that very many documents have meets its first copy in a join, which
    Spark can split.
    """
    seen = line_chunks(rows, "text").select("key", "r1", "r2", "place", F.xxhash64("chunk", F.lit(1)).alias("h"))
    me = F.struct(F.col("key").isNull().alias("none"), "key", "r1", "r2", "place")
    firsts = seen.groupBy("h").agg(F.min(me).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    again = seen.join(firsts, "h").select("r1", "r2", F.struct("place", (F.col("first") == me).alias("is_first")).alias("use"))
    wanted = kept(again.groupBy("r1", "r2").agg(F.map_from_entries(F.collect_set("use")).alias("wanted")))
    texts = (
        line_chunks(dealt.join(wanted, ["r1", "r2"]).select("r1", "r2", "wanted", "text"), "text")
        .filter(F.map_contains_key("wanted", F.col("place")))
        .select("r1", "r2", "place", F.xxhash64("chunk", F.lit(1)).alias("h"), F.col("wanted")[F.col("place")].alias("is_first"), "chunk")
    )
    originals = texts.filter("is_first").groupBy("h").agg(F.first("chunk").alias("original"))
    same = texts.filter(~F.col("is_first")).join(originals, "h").filter(F.col("chunk") == F.col("original"))
    return same.groupBy("r1", "r2").agg(F.collect_set("place").alias("places"))


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the chunks of lines that stood before, with three columns more.

    ``kept_text`` is the text that is left, ``n_lines`` and ``n_removed_lines`` count lines.
    Texts are split at newlines and every line belongs to one chunk. A chunk of at least two
    lines that is byte for byte the same as one in a document with a smaller key, or earlier in
    the same document, goes with its line ends; the rest stays as it is.

    A null text stays null and has no lines; an empty text has one, empty line. Rows with the
    same key and text are one row for this purpose and have the same outcome. Null keys come
    after all others. Other columns pass through, whatever their names.
    """
    total, _ = text_bytes(docs, text)
    keys = row_ids(F.col(key), text_of(text))
    rows = docs.select(F.struct("*").alias("row"), *keys)
    narrow = lambda df: df.select(F.col("row")[key].alias("key"), "r1", "r2", F.coalesce(F.col("row")[text], F.lit("")).alias("text"))
    dealt = rows.repartition(max(64, total // PART_BYTES), "r1", "r2")
    joined = dealt.join(repeated_chunks(narrow(rows), narrow(dealt)), ["r1", "r2"], "left")
    body, places = F.col("row")[text], F.col("places")
    left = F.filter(
        F.transform(chunks_of(body), lambda lines, i: F.when(~F.array_contains(places, i.cast("int")), lines)),
        lambda lines: lines.isNotNull(),
    )
    cleaned = F.when(places.isNull(), body).otherwise(F.array_join(F.flatten(left), "\n"))
    lines = lambda t: F.length(t) - F.length(F.translate(t, "\n", "")) + 1
    after = F.when(places.isNull(), lines(body)).when(F.size(left) == 0, 0).otherwise(lines(F.col("cleaned")))
    columns = [F.col("row")[c].alias(c) for c in docs.columns]
    return joined.withColumn("cleaned", cleaned).select(
        *columns,
        F.col("cleaned").alias("kept_text"),
        F.coalesce(lines(body), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(lines(body) - after, F.lit(0)).cast("long").alias("n_removed_lines"),
    )


def windows_of(text: Column) -> Column:
    """(place, last, h) for each line with content and the next such line: their places (from 0) and a hash.

    Blank lines between the two belong to the window.
    """

    def windows(lines: Column, full: Column) -> Column:
        pairs = F.slice(full, 1, F.greatest(F.size(full) - 1, F.lit(0)))
        return F.transform(pairs, lambda a, k: F.struct(a.alias("place"), F.get(full, k + 1).alias("last"), F.xxhash64(F.slice(lines, a + 1, F.get(full, k + 1) - a + 1)).alias("h")))

    content = lambda line: F.translate(line, " \t\r\u000b\u000c", "") != ""
    places = lambda lines: F.filter(F.sequence(F.lit(0), F.size(lines) - 1), lambda i: content(F.get(lines, i)))
    return let(F.split(text, "\n", -1), lambda lines: let(places(lines), lambda full: windows(lines, full)))


def repeated_windows(rows: DataFrame, dealt: DataFrame) -> DataFrame:
    """(r1, r2, gone): by document the first and last places of windows that stood before.

    ``rows`` and ``dealt`` are those of ``repeated_chunks``, and copies are found in the same
    way: by their hash, and then by the SHA-256 of their text.
    """
    seen = rows.select("key", "r1", "r2", F.inline(windows_of(F.col("text"))))
    me = F.struct(F.col("key").isNull().alias("none"), "key", "r1", "r2", "place")
    firsts = seen.groupBy("h").agg(F.min(me).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    again = seen.join(firsts, "h").select("r1", "r2", F.struct("place", "last", (F.col("first") == me).alias("is_first")).alias("use"))
    wanted = kept(again.groupBy("r1", "r2").agg(F.collect_set("use").alias("wanted")))

    def digests(lines: Column) -> Column:
        digest = lambda w: F.unhex(F.sha2(F.array_join(F.slice(lines, w.place + 1, w.last - w.place + 1), "\n"), 256))
        return F.transform("wanted", lambda w: F.struct(w.place.alias("place"), w.last.alias("last"), w.is_first.alias("is_first"), digest(w).alias("digest")))

    texts = dealt.join(wanted, ["r1", "r2"]).select("r1", "r2", F.inline(let(F.split("text", "\n", -1), digests)))
    same = texts.filter(~F.col("is_first")).join(texts.filter("is_first").select("digest"), "digest", "left_semi")
    return same.groupBy("r1", "r2").agg(F.collect_set(F.struct("place", "last")).alias("gone"))


def dedup_passages(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the passages of lines that stood before, with three columns more.

    ``kept_text`` is the text that is left, ``n_lines`` and ``n_removed_lines`` count lines.
    Texts are split at newlines. A passage is two or more lines with content, and the blank
    lines between them; one that is byte for byte the same as one in a document with a smaller
    key, or earlier in the same document, goes with its line ends, however short it is and
    whatever stands around it. The first copy of a line always stays, and so does a repeated
    line whose neighbours are not repeated with it.

    A null text stays null and has no lines; an empty text has one, empty line. Rows with the
    same key and text are one row for this purpose and have the same outcome. Null keys come
    after all others. Other columns pass through, whatever their names.
    """
    total, _ = text_bytes(docs, text)
    keys = row_ids(F.col(key), text_of(text))
    rows = docs.select(F.struct("*").alias("row"), *keys)
    narrow = lambda df: df.select(F.col("row")[key].alias("key"), "r1", "r2", F.coalesce(F.col("row")[text], F.lit("")).alias("text"))
    dealt = rows.repartition(max(64, total // PART_BYTES), "r1", "r2")
    joined = dealt.join(repeated_windows(narrow(rows), narrow(dealt)), ["r1", "r2"], "left")
    body, gone = F.col("row")[text], F.col("gone")

    def left(lines: Column) -> Column:
        places = F.flatten(F.transform(gone, lambda w: F.sequence(w.place, w.last)))
        stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), places)
        return F.transform(stay, lambda i: F.get(lines, i))

    cleaned = F.when(gone.isNotNull(), let(F.split(body, "\n", -1), left))
    lines = F.length(body) - F.length(F.translate(body, "\n", "")) + 1
    columns = [F.col("row")[c].alias(c) for c in docs.columns]
    return joined.withColumn("cleaned", cleaned).select(
        *columns,
        F.coalesce(F.array_join("cleaned", "\n"), body).alias("kept_text"),
        F.coalesce(lines, F.lit(0)).cast("long").alias("n_lines"),
        F.when(gone.isNull(), 0).otherwise(lines - F.size("cleaned")).cast("long").alias("n_removed_lines"),
    )


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: the text that is left, and lines before and removed."""
    docs = table(spark, sf_dir, "documents")
    return dedup_passages(docs).select("doc_id", "kept_text", "n_lines", "n_removed_lines")
