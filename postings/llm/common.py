"""Small helpers that the operators share: words, row keys, sizes, intermediate results."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: What separates words, and the letters that are lower-cased.
BLANKS = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def words_of(text: Column) -> Column:
    """Words of a text with A-Z lower-cased, in order; blanks are space and U+0009 to U+000D."""
    return F.filter(F.split(F.translate(text, UPPER, UPPER.lower()), BLANKS), lambda w: w != "")


def let(value: Column, body) -> Column:
    """``body(value)``, with the value worked out once however often the body names it."""
    return F.transform(F.array(value), body)[0]


def row_ids(key: Column, text: Column) -> list[Column]:
    """128 bits that stand for a row's key and text, and are never null."""
    return [F.xxhash64(key, text).alias("r1"), F.xxhash64(text, F.lit(1), key).alias("r2")]


def fold(key: Column, folds: int) -> Column:
    """crc32 of the key as text, modulo ``folds``; null for a null key."""
    return F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(folds))


def kept(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder, its lineage cut there.

    The folder is ``spark.checkpoint.dir``. Only a local session may go without one; it gets
    a temporary folder.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        folder = context.getConf().get("spark.checkpoint.dir")
        if folder is None and not re.match(r"local(\[|$)", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoint-"))
    return df.checkpoint(eager=True)


def text_bytes(df: DataFrame, column: str = "text") -> tuple[int, int]:
    """(UTF-8 bytes of the column, rows), counted by Spark."""
    total, rows = df.agg(F.sum(F.octet_length(column)), F.count(F.lit(1))).first()
    return int(total or 0), int(rows)
