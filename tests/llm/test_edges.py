"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing names, for every operator."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from postings.llm import chat, decontaminate, fingerprints, jaccard_join, kd_shards, line_dedup, sentencepieces, suffix_dedup, suffix_tree_lm, toxicity

LONG = "alpha beta gamma delta " * 4000
#: doc_id, text: repeated rows, nulls in either column, blanks only, one word, a long text.
ROWS = [(1, "one two three four five six\nseven eight nine ten\neleven"), (1, "one two three four five six\nseven eight nine ten\neleven"), (2, None), (3, ""), (4, " \n\t"), (5, "word"), (6, LONG), (7, LONG), (None, "no key here at all, none"), (None, None)]
SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def docs(spark):
    """The rows, with columns named like those that operators make."""
    extra = ["shard", "key", "row", "r1", "place", "chunk", "h", "id", "bucket", "fp", "slot", "size", "wanted", "tie", "toxicity", "kept_text"]
    df = spark.createDataFrame(ROWS, SCHEMA).withColumns({c: F.lit("x") for c in ("lang", "source")} | {"n_chars": F.char_length("text").cast("long")})
    return df, df.withColumns({c: F.lit(7) for c in extra})


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA + ", lang string, source string, n_chars long")


@pytest.fixture(scope="module")
def vocabulary():
    return sentencepieces.Vocabulary.read(sentencepieces.MODEL)


def operators(spark, vocabulary):
    items = spark.createDataFrame([(1, "one two three four five six"), (2, None), (3, ""), (4, "word")], "item_id long, text string")
    labels = spark.createDataFrame([(1, 0, 0), (5, 0, 1), (6, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    return {
        "suffix_dedup": lambda d: suffix_dedup.remove_repeats(d),
        "decontaminate": lambda d: decontaminate.decontaminate(d, items),
        "fingerprints": lambda d: fingerprints.fingerprint_edits(d),
        "line_dedup": lambda d: line_dedup.dedup_lines(d),
        "sentencepieces": lambda d: sentencepieces.sampled_pieces(d, vocabulary),
        "toxicity": lambda d: toxicity.toxicity_scores(d, toxicity.fit(d, labels)),
        "suffix_tree_lm": lambda d: suffix_tree_lm.suffix_tree_scores(d),
        "kd_shards": lambda d: kd_shards.shard_by_bytes(d, shards=3),
        "jaccard_join": lambda d: jaccard_join.near_duplicates(d),
    }


NAMES = ["suffix_dedup", "decontaminate", "fingerprints", "line_dedup", "sentencepieces", "toxicity", "suffix_tree_lm", "kd_shards", "jaccard_join"]


@pytest.mark.parametrize("name", NAMES)
def test_empty_table_gives_no_row(spark, empty, vocabulary, name):
    assert operators(spark, vocabulary)[name](empty).count() == 0


@pytest.mark.parametrize("name", NAMES)
def test_odd_rows_and_clashing_names(spark, docs, vocabulary, name):
    plain, extra = docs
    run = operators(spark, vocabulary)[name]
    a, b = run(plain), run(extra)
    shared = [c for c in a.columns if c in b.columns and c not in ("lang", "source", "n_chars")]
    rows = lambda df: sorted(map(str, df.select(shared).collect()))
    got = rows(a)
    if name not in ("toxicity", "line_dedup", "kd_shards"):  # these pass columns of the clashing names through
        assert got == rows(b)
    else:
        assert b.count() == a.count()
    expected = {"decontaminate": len(ROWS) - 3, "fingerprints": 7, "sentencepieces": None}.get(name, len(ROWS))
    assert expected is None or len(got) == expected


def test_outcomes_of_odd_rows(spark, docs, vocabulary):
    plain, _ = docs
    groups = {(r.id, r.n_shingles): r.component for r in jaccard_join.near_duplicates(plain).collect()}
    assert groups[(7, 4)] == 6 and groups[(2, 0)] == 2 and groups[(None, 2)] is None
    cut = {r.id: r for r in suffix_dedup.remove_repeats(plain).collect() if r.id is not None}
    assert (cut[7].n_removed, cut[7].n_spans, cut[6].n_removed, cut[1].n_removed, cut[2].n_bytes) == (len(LONG), 1, 0, 0, 0)
    samples = sentencepieces.sampled_pieces(plain, vocabulary)
    assert samples.filter("not decodes").count() == 0
    assert samples.filter("doc_id in (2, 3)").select("n_tokens", "sample").distinct().collect() == [(0, 0)]
    lines = {(r.doc_id, r.text): r for r in line_dedup.dedup_lines(plain).collect()}
    assert lines[(1, ROWS[0][1])].n_removed_lines == 0 and lines[(2, None)].n_lines == 0 and lines[(3, "")].n_lines == 1
    scores = {r.id: r for r in suffix_tree_lm.suffix_tree_scores(plain).collect()}
    assert scores[2].n_tokens == 1 and scores[None].held_out and scores[4].score == scores[3].score
    prints = {r.doc_id: r for r in fingerprints.fingerprint_edits(plain).collect()}
    assert prints[6].fingerprint == prints[7].fingerprint and prints[3].fingerprint == "" and prints[7].near_next == 1.0


def test_chat_edges(spark):
    turns = spark.createDataFrame(
        [(1, 0, "user", None), (1, 1, "assistant", "a\\<|im_end|>"), (1, 1, "assistant", "a\\<|im_end|>"), (1, None, None, "first"), (2, 0, "user", ""), (None, 0, "assistant", "x")],
        "conv_id long, turn long, role string, text string",
    )
    examples = chat.prefix_examples(turns.withColumns({"conv": F.lit(1), "context": F.lit(2)}))
    rows = {(r.conv_id, r.example): r for r in examples.collect()}
    assert len(rows) == 4 and rows[(2, 0)].target is None
    assert chat.turns_in(rows[(1, 1)].context + rows[(1, 1)].target) == [("", "first"), ("user", ""), ("assistant", "a\\<|im_end|>"), ("assistant", "a\\<|im_end|>")]
    digest = {r.conv_id: r for r in chat.conversation_digests(examples).collect()}
    assert (digest[1].n_turns, digest[1].loss_chars, digest[2].loss_chars, digest[None].loss_chars) == (4, 24, 0, 1)
    assert chat.prefix_examples(turns.limit(0)).count() == 0


def test_pipeline_stages_take_odd_rows(spark, docs, tmp_path):
    plain, _ = docs
    folder = str(tmp_path)
    plain.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, 0, 0), (5, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, "one two three four five six")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    kept = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        kept = stage(spark, kept, folder)
        if name != "sentencepiece":
            assert kept.columns == corpus_pipeline.COLUMNS
    assert {r.doc_id for r in kept.select("doc_id").distinct().collect()} == {2, 3, 4, 5, 6, None}
