"""Document fingerprints by consistent weighted sampling, over units of weight."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import kept, let, table, text_bytes, text_of, words_of

#: Samples in a fingerprint.
SAMPLES = 128
#: Bits kept of a sample; those above hold the slot.
SAMPLE_BITS = 24
PART_BYTES = 4_000_000
#: Rows that a range of keys is meant to have when neighbours are sought, and the most ranges.
RANGE_ROWS, MOST_RANGES = 20_000, 2_000


def terms_of(text: Column) -> Column:
    """Hashes of the pairs of neighbouring words; of the word, where there is only one."""

    def pairs(words: Column) -> Column:
        return F.when(F.size(words) == 1, F.transform(words, lambda w: F.xxhash64(w))).otherwise(
            F.transform(F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))), lambda w, i: F.xxhash64(F.get(words, i), w))
        )

    return let(words_of(text), pairs)


def drawn(units: Column, samples: int) -> Column:
    """The sorted samples of a text's units, one for each slot.

    A slot orders all units in a way of its own: first those whose top bits name it, by their
    hash, then all others by a hash of slot and unit. Its sample is the first of the text's
    units in that order. The others are only drawn where the first ones are missing, which
    texts of many units hardly have.
    """
    shift, low = 64 - (samples - 1).bit_length(), F.lit(2**SAMPLE_BITS - 1)
    slot = lambda unit: F.shiftrightunsigned(unit, shift).cast("int")
    entry = lambda i, sample: (i * 2**SAMPLE_BITS + sample.bitwiseAND(low).cast("int")).cast("int")

    def all_slots(ordered: Column, first: Column) -> Column:
        empty = F.array_except(F.sequence(F.lit(0), F.lit(samples - 1)), F.transform(first, slot))
        others = F.transform(empty, lambda i: entry(i, F.array_min(F.transform(ordered, lambda u: F.xxhash64(i, u)))))
        return F.sort_array(F.concat(F.transform(first, lambda u: entry(slot(u), u)), others))

    firsts = lambda ordered: F.filter(ordered, lambda u, i: (i == 0) | (slot(u) != slot(F.get(ordered, i - 1))))
    return let(F.sort_array(units), lambda ordered: let(firsts(ordered), lambda first: all_slots(ordered, first)))


def fingerprints(texts: DataFrame, ids: list[str], text: str = "text", samples: int = SAMPLES) -> DataFrame:
    """(ids, samples): for each row of ``texts`` its sorted samples, one for each slot.

    A term is a pair of neighbouring words and weighs as much as it occurs. Weights are whole
    numbers, so a term of weight w is w units, (term, 1) to (term, w): what two texts share of
    their units is the sum of the least weights, and all their units are the sum of the
    greatest. A slot's sample is the first unit in the slot's own order, so in each slot two
    texts agree with the probability of their generalised Jaccard similarity, however uneven
    the weights and however short the texts are. ``samples`` is a power of two.

    ``texts`` must be dealt out by some of ``ids``: then neither step shuffles. Texts without
    words have no row in the result.
    """
    counted = texts.select(*ids, F.explode(terms_of(F.col(text))).alias("term")).groupBy(*ids, "term").agg(F.count(F.lit(1)).alias("weight"))
    units = counted.select(*ids, "term", F.explode(F.sequence(F.lit(1).cast("long"), F.col("weight"))).alias("unit")).select(*ids, F.xxhash64("term", "unit").alias("unit"))
    return units.groupBy(*ids).agg(F.collect_list("unit").alias("units")).select(*ids, drawn(F.col("units"), samples).alias("samples"))


def printed(samples: Column) -> Column:
    """A fingerprint as text: 8 hex digits for each slot, in order of slots; none for a text without words."""
    return F.array_join(F.transform(samples, lambda e: F.lpad(F.hex(e.cast("long")), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Share of agreeing slots; 1 for two empty texts, 0 for an empty one and another."""
    slots = lambda samples: F.transform(samples, lambda e: F.shiftright(e, SAMPLE_BITS))
    either = F.size(F.array_union(slots(a), slots(b)))
    return F.when(either == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / either)


def with_next(ids: DataFrame, key: str, parts: int) -> DataFrame:
    """``ids`` with the next key below in ``next_key``; the lowest gets the highest.

    Keys are cut into ranges of about equal counts at approximate quantiles; within a range
    the next key is a window's, and between ranges the border rows are linked. One row a
    range goes to the last window.
    """
    cuts = sorted(set(ids.approxQuantile(key, [i / parts for i in range(1, parts)], 0.2 / parts))) if parts > 1 else []
    where = F.size(F.filter(F.lit([int(c) for c in cuts]), lambda c: c < F.col(key))) if cuts else F.lit(0)
    ranged = ids.withColumn("range", where)
    inside = ranged.withColumn("next_key", F.lead(key).over(Window.partitionBy("range").orderBy(F.col(key).desc())))
    borders = ranged.groupBy("range").agg(F.max(key).alias("high"))
    around = Window.partitionBy(F.lit(0)).orderBy(F.col("range").desc())
    highest = F.max("high").over(Window.partitionBy(F.lit(0)))
    borders = borders.select("range", F.coalesce(F.lead("high").over(around), highest).alias("high"))
    return inside.join(borders, "range").select(*ids.columns, F.coalesce("next_key", "high").alias("next_key"))


def fingerprint_edits(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """For each key its text's fingerprint, an edited text's, and how near they are.

    The edited text has the last third of the code points replaced by as many from the start
    of the next text, in descending order of keys, or all of it if it is shorter; after the
    lowest key comes the highest. The fingerprint of a text depends on the text alone.

    Null texts count as empty; two texts without words are alike to 1, one such text and
    another to 0. Rows with a null key are left out, and of rows with the same key the
    greatest text counts. Other columns are not read.
    """
    total, rows = text_bytes(docs, text)
    parts = max(64, total // PART_BYTES)
    ranges = min(max(1, rows // RANGE_ROWS), MOST_RANGES)
    named = docs.filter(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("id"), text_of(text).alias("text"))
    n = F.char_length("text")
    texts = named.repartition(parts, "id").groupBy("id").agg(F.max(F.struct(n, F.xxhash64("text"), "text"))["text"].alias("text"))
    chain = kept(with_next(named.groupBy("id").agg(F.max(n).alias("n")), "id", ranges))
    wants = chain.select(F.col("next_key").alias("id"), F.col("id").alias("to"), F.floor(F.col("n") / 3).cast("int").alias("want"))
    heads = texts.join(wants, "id").select(F.col("to").alias("id"), F.substring("text", F.lit(1), F.col("want")).alias("head"))
    edited = F.concat(F.substring("text", F.lit(1), n - F.floor(n / 3).cast("int")), F.col("head"))
    both = texts.join(heads.repartition(parts, "id"), "id").select("id", "text", n.cast("long").alias("n_chars"), edited.alias("edited"))
    sides = both.select("id", F.explode(F.array(F.struct(F.lit(0).alias("side"), "text"), F.struct(F.lit(1).alias("side"), F.col("edited").alias("text")))).alias("s"))
    prints = fingerprints(sides.select("id", "s.side", "s.text"), ["id", "side"])
    of_side = lambda side: F.coalesce(F.max(F.when(F.col("side") == side, F.col("samples"))), F.array().cast("array<int>"))
    paired = prints.groupBy("id").agg(of_side(0).alias("own"), of_side(1).alias("changed"))
    known = (
        both.select("id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"))
        .join(paired, "id", "left")
        .join(wants.select("id", "to"), "id")
        .select("*", F.coalesce("own", F.array().cast("array<int>")).alias("mine"), F.coalesce("changed", F.array().cast("array<int>")).alias("theirs"))
    )
    # each row tells the one before it its fingerprint
    as_self = F.struct("n_chars", "edited_sha256", "mine", "theirs")
    none = F.lit(None)
    told = known.select(
        F.explode(
            F.array(
                F.struct("id", as_self.alias("self"), none.cast("array<int>").alias("next")),
                F.struct(F.col("to").alias("id"), F.when(F.lit(False), as_self).alias("self"), F.col("mine").alias("next")),
            )
        ).alias("m")
    ).select("m.*")
    met = told.groupBy("id").agg(F.first("self", ignorenulls=True).alias("self"), F.first("next", ignorenulls=True).alias("next"))
    return met.select(
        F.col("id").alias(key),
        "self.n_chars",
        "self.edited_sha256",
        printed(F.col("self.mine")).alias("fingerprint"),
        printed(F.col("self.theirs")).alias("edited_fingerprint"),
        likeness(F.col("self.mine"), F.col("self.theirs")).alias("near_edited"),
        likeness(F.col("self.mine"), F.col("next")).alias("near_next"),
    )


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' fingerprints, and how near the edited and the next texts' are."""
    return fingerprint_edits(table(spark, sf_dir, "documents"))
