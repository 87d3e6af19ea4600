"""Quality rules as a short-circuit cascade, ordered by rejections per unit of cost on a sample."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BLANKS, UPPER, kept, let, table, text_of

#: The signs that count as symbols, and the length of a window of repeated words.
SYMBOLS = "[#*$%&|<>]"
REPEAT_WORDS = 8
#: Words that ordinary prose of the four languages has, compared after A-Z is lower-cased.
STOP_WORDS = ["the", "and", "of", "to", "in", "is", "that", "it", "for", "with", "le", "la", "les", "de", "des", "et", "un", "une", "der", "die", "das", "und", "ist", "el", "los", "las", "y", "que", "en"]
#: Rows of the sample on which each rule's cost and rejections are measured; only the order follows from it.
SAMPLE_ROWS = 2_000
#: Rounds of timing of each rule on the sample; the least time counts.
TIMINGS = 2


def plain_words(text: Column) -> Column:
    """Words of a text as they stand: runs of anything but space and U+0009 to U+000D."""
    return F.filter(F.split(text, BLANKS), lambda w: w != "")


def repeated_word_count(words: Column, width: int = REPEAT_WORDS) -> Column:
    """Words inside a window of ``width`` words whose sequence the text holds twice or more, first included.

    Windows are sorted with their start; equal neighbours mark repeated ones. The starts of
    those, sorted, cover ``min(width, next start - start)`` words each, ``width`` for the last.
    Exact: windows are compared as their words joined by a space, which no word holds.
    """

    def covered(w: Column) -> Column:
        m = F.size(w) - width + 1
        windows = F.array_sort(F.transform(F.sequence(F.lit(0), m - 1), lambda i: F.struct(F.array_join(F.slice(w, i + 1, width), " ").alias("g"), i.alias("p"))))

        def starts(s: Column) -> Column:
            again = lambda k: (F.get(s, k)["g"] == F.get(s, k - 1)["g"]) | (F.get(s, k)["g"] == F.get(s, k + 1)["g"])
            marked = F.transform(F.sequence(F.lit(0), m - 1), lambda k: F.when(F.coalesce(again(k), F.lit(False)), F.get(s, k)["p"]))
            return F.array_sort(F.filter(marked, lambda p: p.isNotNull()))

        def total(p: Column) -> Column:
            spans = F.transform(p, lambda x, k: F.least(F.lit(width), F.coalesce(F.get(p, k + 1) - x, F.lit(width))))
            return F.aggregate(spans, F.lit(0).cast("long"), lambda a, b: a + b)

        return F.when(m <= 0, F.lit(0).cast("long")).otherwise(let(let(windows, starts), total))

    return let(words, covered)


def base_columns(words: Column, lines: Column, text: Column) -> dict[str, Column]:
    """The counts every verdict starts from, of the columns ``plain_words``, ``word_lines`` and the text."""
    return {
        "n_words": F.size(words).cast("long"),
        "word_chars": F.char_length(F.regexp_replace(text, BLANKS, "")).cast("long"),
        "n_symbols": (F.char_length(text) - F.char_length(F.regexp_replace(text, SYMBOLS, ""))).cast("long"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        "n_repeat_words": repeated_word_count(words),
    }


def word_lines(text: Column) -> Column:
    """The lines of a text, split at \\n, that hold a word, in order."""
    return F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30)


@dataclass(frozen=True)
class Rule:
    """A rule by name, and when a document fails it, from the base columns, ``words`` and ``lines``."""

    name: str
    fails: Callable[[], Column]


def count_of(words: Column, test: Callable[[Column], Column]) -> Column:
    return F.size(F.filter(words, test))


#: Each rule and its threshold.
RULES = [
    Rule("symbols", lambda: F.col("n_symbols") * 10 > F.col("n_words")),
    Rule("word_length", lambda: (F.col("word_chars") < F.col("n_words") * 3) | (F.col("word_chars") > F.col("n_words") * 10)),
    Rule("letters", lambda: count_of(F.col("words"), lambda w: w.rlike(r"\p{L}")) * 10 < F.col("n_words") * 8),
    Rule("capitals", lambda: count_of(F.col("words"), lambda w: (F.char_length(w) > 1) & w.rlike(r"\p{Lu}") & ~w.rlike(r"\p{Ll}")) * 10 > F.col("n_words") * 3),
    Rule("stop_words", lambda: count_of(F.col("words"), lambda w: F.array_contains(F.array(*map(F.lit, STOP_WORDS)), F.translate(w, UPPER, UPPER.lower()))) < 1),
    Rule("dup_lines", lambda: F.col("n_dup_lines") * 2 > F.size("lines")),
]


def texts_of(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, t): every row's key and text, null as empty; other columns are left behind."""
    return docs.select(F.col(key).alias("doc_id"), text_of(text).alias("t"))


def based_of(texts: DataFrame) -> DataFrame:
    """(doc_id, words, lines and the base columns) of each row of ``texts_of``."""
    split = texts.select("doc_id", "t", plain_words(F.col("t")).alias("words"), word_lines(F.col("t")).alias("lines"))
    counts = base_columns(F.col("words"), F.col("lines"), F.col("t"))
    return split.select("doc_id", "words", "lines", *[c.alias(n) for n, c in counts.items()])


def measured_order(texts: DataFrame, rules: list[Rule] = RULES, sample_rows: int = SAMPLE_ROWS, seed: int = 7) -> list[tuple[str, float, float]]:
    """(rule, rejected share, seconds a row) on a sample of ``texts`` (doc_id, t), best first.

    Best is most rejections per second.
    Rows are counted over the whole table, but only the sample's base columns are worked out
    and written; each rule is one job over it that counts its rejections, and
    the least of ``TIMINGS`` wall times, less that of a job that evaluates nothing, is its cost.
    Only the order of the cascade follows, never a verdict.
    """
    rows = texts.count()
    if rows == 0:
        return [(r.name, 0.0, 0.0) for r in rules]
    sample = kept(based_of(texts.sample(fraction=min(1.0, 1.2 * sample_rows / rows), seed=seed).limit(sample_rows)))
    n = max(sample.count(), 1)

    def timed(column: Column) -> tuple[float, int]:
        best, value = float("inf"), 0
        for _ in range(TIMINGS):
            start = time.perf_counter()
            value = sample.agg(F.sum(column.cast("int"))).first()[0] or 0
            best = min(best, time.perf_counter() - start)
        return best, int(value)

    floor, _ = timed(F.lit(False))
    measured = []
    for rule in rules:
        seconds, rejected = timed(F.coalesce(rule.fails(), F.lit(False)) & ~base_failed())
        measured.append((rule.name, rejected / n, max(seconds - floor, 1e-4) / n))
    return sorted(measured, key=lambda m: (-m[1] / m[2], m[0]))


def cascade(order: list[str], rules: list[Rule] = RULES) -> tuple[Column, Column]:
    """(kept, rejected_by): the rules in ``order``, each tried only on rows all before it passed."""
    by_name = {r.name: r for r in rules}
    verdict = F.when(base_failed(), F.lit("base"))
    for name in order:
        verdict = verdict.when(F.coalesce(by_name[name].fails(), F.lit(False)), F.lit(name))
    return verdict.isNull(), verdict


def quality_rules(docs: DataFrame, key: str = "doc_id", text: str = "text", order: list[str] | None = None) -> DataFrame:
    """Every row of ``docs`` with its base counts and the cascade's verdict.

    Returns doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long),
    base_failed, kept (boolean) and rejected_by (the first rule that failed, ``base`` when the
    base did, null if kept). A null text counts as empty: no words, so the base fails. Repeated
    rows each get their own row; other columns, whatever their names, are not carried. An
    empty table gives no row. ``order`` is the cascade's order; by default it is measured on a
    sample (``measured_order``). The verdict is the same in any order: a row is kept when it
    passes all rules; the order decides only which rules are worked out for which rows.
    """
    texts = texts_of(docs, key, text)
    if order is None:
        order = [name for name, _, _ in measured_order(texts)]
    based = based_of(texts)
    keep, by = cascade(order)
    return based.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed().alias("base_failed"), keep.alias("kept"), by.alias("rejected_by"),
    )


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and verdicts of all documents."""
    return quality_rules(table(spark, sf_dir, "documents")).drop("rejected_by")


#: The same rows in DuckDB SQL: base counts by unnested windows, the verdict as all rules at once.
OP11_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT rid, doc_id, t,
         list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
         list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls
  FROM d),
g AS (SELECT rid, i, array_to_string(ws[i:i + 7], ' ') AS gram FROM (SELECT rid, ws, unnest(range(1, len(ws) - 6)) AS i FROM w)),
rep AS (SELECT rid, gram FROM g GROUP BY rid, gram HAVING count(*) > 1),
cov AS (SELECT rid, count(DISTINCT i + k) AS n_rep FROM (SELECT rid, i, unnest(range(0, 8)) AS k FROM g JOIN rep USING (rid, gram)) GROUP BY rid),
b AS (
  SELECT w.rid, doc_id, ws, ls,
         len(ws)::BIGINT AS n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
         coalesce(cov.n_rep, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN cov USING (rid))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 20 OR n_repeat_words * 100 > n_words * 30) AS base_failed,
       NOT (n_words < 20 OR n_repeat_words * 100 > n_words * 30)
       AND n_symbols * 10 <= n_words
       AND word_chars >= n_words * 3 AND word_chars <= n_words * 10
       AND len(list_filter(ws, lambda x: regexp_matches(x, '\p{L}'))) * 10 >= n_words * 8
       AND len(list_filter(ws, lambda x: length(x) > 1 AND regexp_matches(x, '\p{Lu}') AND NOT regexp_matches(x, '\p{Ll}'))) * 10 <= n_words * 3
       AND len(list_filter(ws, lambda x: list_contains(['the', 'and', 'of', 'to', 'in', 'is', 'that', 'it', 'for', 'with', 'le', 'la', 'les', 'de', 'des', 'et', 'un', 'une', 'der', 'die', 'das', 'und', 'ist', 'el', 'los', 'las', 'y', 'que', 'en'],
                                             translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')))) >= 1
       AND n_dup_lines * 2 <= len(ls) AS kept
FROM b
"""
