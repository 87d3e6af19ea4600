"""Table scans and typed rows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def typed_rows(spark: SparkSession, rows: Iterable, schema: StructType) -> DataFrame:
    """A small DataFrame of configuration or test rows with a declared schema."""
    return spark.createDataFrame(list(rows), schema)


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Scan of ``<folder>/<name>.parquet``; filters and columns are pushed into it."""
    return spark.read.parquet(f"{folder}/{name}.parquet")
