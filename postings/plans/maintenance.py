"""Cleanup: empty the tables and verify the counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.aggregates import table_counts
from ..sinks.tables import Tables, truncate_tables


def count_tables(spark: SparkSession, tables: Tables) -> DataFrame:
    """Rows of each table that exists, as ``table_name, rows``."""
    present = {name: spark.table(name) for name in tables.all() if spark.catalog.tableExists(name)}
    if not present:
        return spark.createDataFrame([], "table_name string, rows bigint")
    return table_counts(present)


def cleanup(spark: SparkSession, tables: Tables) -> tuple[list[str], DataFrame]:
    """Empty all tables; returns the names emptied and the counts afterwards."""
    emptied = truncate_tables(spark, tables)
    return emptied, count_tables(spark, tables)
