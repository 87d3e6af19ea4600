"""op11: base counts against a plain version, the cascade's verdict in any order, odd rows."""

import re
from collections import Counter
from pathlib import Path

import pyarrow.parquet as pq
import pytest

from postings.llm import quality_rules as q

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_counts(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    grams = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {i + k for i in range(len(words) - 7) if grams[tuple(words[i : i + 8])] > 1 for k in range(8)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


@pytest.mark.skipif(not Path(FOLDER).is_dir(), reason="no tables")
def test_base_counts_match_a_plain_count(spark):
    rows = pq.read_table(f"{FOLDER}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in q.op11_quality_rules(spark, FOLDER).collect()}
    assert got == {r["doc_id"]: plain_counts(r["text"]) for r in rows}


def test_verdict_does_not_depend_on_the_order(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    names = [r.name for r in q.RULES]
    one = {r.doc_id: (r.kept, r.base_failed) for r in q.quality_rules(docs, order=names).collect()}
    other = {r.doc_id: (r.kept, r.base_failed) for r in q.quality_rules(docs, order=names[::-1]).collect()}
    measured = {r.doc_id: (r.kept, r.base_failed) for r in q.quality_rules(docs).collect()}
    assert one == other == measured
    assert 0 < sum(k for k, _ in one.values()) < len(one)


def test_cascade_names_the_first_failed_rule(spark):
    junk = " ".join(f"w{i}$$$" for i in range(40))
    clean = " ".join(["the cat sat on a mat near"] * 1 + [f"word{i} and more" for i in range(10)])
    docs = spark.createDataFrame([(1, junk), (2, clean), (3, "few words")], "doc_id long, text string")
    out = {r.doc_id: (r.kept, r.rejected_by) for r in q.quality_rules(docs, order=["symbols", "stop_words"]).collect()}
    assert out == {1: (False, "symbols"), 2: (True, None), 3: (False, "base")}
    out = {r.doc_id: r.rejected_by for r in q.quality_rules(docs, order=["stop_words", "symbols"]).collect()}
    assert out[1] == "stop_words"


def test_repeated_windows_count_words_once():
    text = " ".join(["a b c d e f g h"] * 3 + ["x"])
    assert plain_counts(text)[4] == 24


def test_odd_rows(spark):
    long = "alpha beta gamma delta " * 20000
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, long), (4, long), (None, "the one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("kept", q.F.lit("clash")).withColumn("n_words", q.F.lit(-1))
    out = sorted(q.quality_rules(docs).collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0))
    assert [(r.doc_id, r.n_words, r.base_failed, r.kept) for r in out] == [
        (1, 0, True, False), (2, 0, True, False), (3, 0, True, False), (4, 80000, True, False), (4, 80000, True, False), (None, 21, False, True),
    ]
    assert out[3].n_repeat_words == 80000
    assert q.quality_rules(docs.limit(0)).count() == 0
