"""Documents to training tokens: five stages, each on all that the one before kept.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame; all but the last keep the columns of
``documents``. ``run`` applies them, and writes each stage's rows to the shared checkpoint
folder before the next one reads them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postings.llm.common import kept, table
from postings.llm.decontaminate import decontaminate
from postings.llm.jaccard_join import keep_one
from postings.llm.line_dedup import dedup_passages
from postings.llm.sentencepieces import MODEL, Vocabulary, sampled_pieces
from postings.llm.toxicity import THRESHOLD, fit, toxicity_scores

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold; learned from the labels of ``sf_dir``."""
    model = fit(docs, table(spark, sf_dir, "labels"))
    return toxicity_scores(docs.select(COLUMNS), model).filter(F.col("toxicity") < THRESHOLD).select(COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of lines that stood before; those left with nothing go."""
    cleaned = dedup_passages(docs.select(COLUMNS))
    left = cleaned.filter((F.col("n_removed_lines") == 0) | (F.trim("kept_text") != ""))
    n_chars = F.when(F.col("n_removed_lines") == 0, F.col("n_chars")).otherwise(F.char_length("kept_text"))
    return left.select("doc_id", F.col("kept_text").alias("text"), "lang", "source", n_chars.cast("long").alias("n_chars"))


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five words, 80 in 100."""
    return keep_one(docs.select(COLUMNS), size=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontaminate(docs.select(COLUMNS), table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Two sampled segmentations of each document, with their scores."""
    return sampled_pieces(docs, Vocabulary.read(MODEL))


STAGES = [
    ("toxicity", reject_toxic),
    ("line_dedup", drop_repeated_lines),
    ("jaccard_join", keep_one_of_each_group),
    ("decontamination", drop_contaminated),
    ("sentencepiece", encode),
]

#: Compression distances and sampled segmentations are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pipeline over ``documents`` of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
