"""Counts over results, rejections and tables.

All are partial-then-final hash aggregations: a hot group is combined before the
shuffle and no group's rows are collected.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def source_summary(silver: DataFrame) -> DataFrame:
    """Rows, rated rows, best rate and latest sighting by provider, mode and source."""
    return silver.groupBy("provider", "scrape_mode", "source").agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count("hourly_max").alias("rows_with_rate"),
        F.max("hourly_max").alias("max_rate"),
        F.max("last_seen_at").alias("latest_seen_at"),
    )


def rejections_by_reason(rejected: DataFrame) -> DataFrame:
    return rejected.groupBy("reason").agg(F.count(F.lit(1)).alias("rows"))


def rejections_by_source(rejected: DataFrame) -> DataFrame:
    return rejected.groupBy("source", "reason").agg(F.count(F.lit(1)).alias("rows"))


def provider_funnel(classified: DataFrame) -> DataFrame:
    """Results in and accepted out per provider."""
    return classified.groupBy("provider").agg(
        F.count(F.lit(1)).alias("results"),
        F.count_if(F.col("reason").isNull()).alias("accepted"),
    )


def run_totals(bronze: DataFrame, classified: DataFrame, warnings: DataFrame) -> DataFrame:
    """One row: ``bronze_rows, silver_rows, rejected_rows, warnings``."""
    counts = (
        bronze.select(F.lit("bronze").alias("kind"))
        .unionByName(warnings.select(F.lit("warning").alias("kind")))
        .unionByName(
            classified.select(F.when(F.col("reason").isNull(), "silver").otherwise("rejected").alias("kind"))
        )
    )
    return counts.agg(
        F.count_if(F.col("kind") == "bronze").alias("bronze_rows"),
        F.count_if(F.col("kind") == "silver").alias("silver_rows"),
        F.count_if(F.col("kind") == "rejected").alias("rejected_rows"),
        F.count_if(F.col("kind") == "warning").alias("warnings"),
    )


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``table_name, rows`` for each table."""
    counts = (
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name, df in tables.items()
    )
    return reduce(DataFrame.unionByName, counts)
