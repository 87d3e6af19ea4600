"""Timestamps and run stamps."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parse_timestamp(text: Column) -> Column:
    """ISO-8601 text, with or without offset, as a timestamp; NULL if it is none."""
    return F.try_to_timestamp(text)


def stamp(df: DataFrame, run_id: str, fetched_at: datetime) -> DataFrame:
    """Add the constants of a run."""
    return df.withColumn("run_id", F.lit(run_id)).withColumn("fetched_at", F.lit(fetched_at).cast("timestamp"))
