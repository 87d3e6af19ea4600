"""Bronze, silver and gold tables, what runs leave beside them, and the ledger of runs.

Bronze and the other tables of runs are partitioned by run, and a run replaces its own
partition, so a repeated or half finished write leaves each row once. Silver and gold are
views over immutable table versions: a run writes a new version beside the one being read
and then moves the view, so readers see either the old or the new table and a failed run
leaves nothing visible. The last versions stay, so that a reader that has opened one can finish.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import BRONZE, GOLD, LEDGER, SILVER, SILVER_KEYS, align_to_schema

#: Versions of silver and gold that stay: the current one and those before it.
KEPT_VERSIONS = 3


class ConcurrentRun(RuntimeError):
    """Another run has moved the view since this one read it."""


@dataclass(frozen=True)
class Tables:
    """Qualified table names."""

    database: str = "postings"

    @property
    def bronze(self) -> str:
        return f"{self.database}.bronze_runs"

    @property
    def silver(self) -> str:
        return f"{self.database}.silver_results"

    @property
    def gold(self) -> str:
        return f"{self.database}.gold_high_rate"

    @property
    def rejected(self) -> str:
        return f"{self.database}.run_rejected"

    @property
    def quarantine(self) -> str:
        return f"{self.database}.run_quarantine"

    @property
    def metrics(self) -> str:
        return f"{self.database}.run_metrics"

    @property
    def ledger(self) -> str:
        return f"{self.database}.run_ledger"

    def all(self) -> tuple[str, ...]:
        return self.bronze, self.silver, self.gold

    def of_runs(self) -> tuple[str, ...]:
        """What runs leave beside the three tables."""
        return self.rejected, self.quarantine, self.metrics, self.ledger


def create_database(spark: SparkSession, database: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")


# --- tables of runs --------------------------------------------------------

RUN_PARTITION = ("fetched_date", "run_id")


def write_run(rows: DataFrame, name: str) -> None:
    """Write the rows of runs, each run's in place of what it had written on that date.

    ``rows`` have ``run_id`` and ``fetched_at``. Partitions are the UTC date and the run.
    """
    spark = rows.sparkSession
    create_database(spark, name.rsplit(".", 1)[0])
    dated = rows.withColumn("fetched_date", F.to_date("fetched_at"))
    if not spark.catalog.tableExists(name):
        dated.limit(0).write.partitionBy(*RUN_PARTITION).format("parquet").saveAsTable(name)
    columns = spark.catalog.listColumns(name)
    if tuple(c.name for c in columns if c.isPartition) != RUN_PARTITION:
        raise ValueError(f"{name} is not partitioned by {', '.join(RUN_PARTITION)}; copy it into a table that is")
    # an insert takes this from the session only
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        dated.select(*(c.name for c in columns)).write.mode("overwrite").insertInto(name)
    finally:
        spark.conf.set(mode, before)


def read_run(spark: SparkSession, name: str, run_id: str) -> DataFrame:
    """The rows that a run has left in a table of runs; reads its partition only."""
    return spark.table(name).where(F.col("run_id") == run_id)


def append_bronze(rows: DataFrame, tables: Tables) -> None:
    write_run(rows, tables.bronze)


def read_bronze(spark: SparkSession, tables: Tables) -> DataFrame:
    return align_to_schema(spark.table(tables.bronze), BRONZE, keep=("fetched_date",))


# --- ledger ----------------------------------------------------------------


def note(spark: SparkSession, tables: Tables, run_id: str, step: str, fetched_at: datetime) -> None:
    """Add a finished step of a run to the ledger."""
    create_database(spark, tables.database)
    row = spark.createDataFrame([(run_id, step, fetched_at)], LEDGER)
    row.coalesce(1).write.mode("append").format("parquet").saveAsTable(tables.ledger)


def steps_of(spark: SparkSession, tables: Tables, run_id: str) -> dict[str, datetime]:
    """The finished steps of exactly this run id, with the run's time."""
    if not spark.catalog.tableExists(tables.ledger):
        return {}
    rows = spark.table(tables.ledger).where(F.col("run_id") == run_id).groupBy("step").agg(F.min("fetched_at").alias("at"))
    return {r["step"]: r["at"] for r in rows.collect()}


# --- versions --------------------------------------------------------------


def version_table(name: str, number: int, version: str) -> str:
    """Table of a version: its number, and a hash so that no two names of runs meet."""
    return f"{name}__{number:06d}_{hashlib.sha256(version.encode()).hexdigest()[:12]}"


def version_number(table: str) -> int:
    return int(table.rsplit("__", 1)[1].split("_")[0])


def current_version(spark: SparkSession, name: str) -> str | None:
    """The table that the view ``name`` shows now."""
    return spark.catalog.getTable(name).description if spark.catalog.tableExists(name) else None


def versions(spark: SparkSession, name: str) -> list[str]:
    """The tables of all versions of ``name``, oldest first."""
    database, short = name.rsplit(".", 1)
    found = [f"{database}.{t.name}" for t in spark.catalog.listTables(database, f"{short}__*")]
    return sorted(found, key=version_number)


def bucket_count(spark: SparkSession, table: str) -> int:
    """Buckets of a table, 0 if it has none."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Num Buckets'").collect()
    return int(rows[0]["data_type"]) if rows else 0


def publish(
    df: DataFrame,
    name: str,
    version: str,
    bucket_by: Sequence[str] = (),
    buckets: int = 0,
    sort_by: Sequence[str] = (),
    aligned: bool = False,
    keep: int = KEPT_VERSIONS,
) -> str:
    """Write ``df`` as a new version of ``name``, move the view to it, drop versions long past.

    With ``bucket_by`` the version is bucketed and sorted on these columns, so that the
    next upsert reads it without shuffling it. Rows are first brought together by
    bucket, unless they are ``aligned`` already, as the result of an upsert into a
    version with as many buckets is; so a bucket is one file. ``sort_by`` orders rows
    inside files, which lets scans skip row groups.

    If another run moves the view meanwhile, this one's version is dropped and
    ``ConcurrentRun`` raised.
    """
    spark = df.sparkSession
    create_database(spark, name.rsplit(".", 1)[0])
    before = current_version(spark, name)
    table = version_table(name, version_number(before) + 1 if before else 1, version)
    if bucket_by:
        rows = df if aligned else df.repartition(buckets, *bucket_by)
        writer = rows.write.bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
    elif sort_by:
        writer = df.sortWithinPartitions(*sort_by).write
    else:
        writer = df.write
    writer.mode("overwrite").format("parquet").saveAsTable(table)
    if current_version(spark, name) != before:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        raise ConcurrentRun(f"{name} was moved from {before} by another run")
    spark.sql(f"CREATE OR REPLACE VIEW {name} COMMENT '{table}' AS SELECT * FROM {table}")
    for old in versions(spark, name):
        if version_number(old) <= version_number(table) - keep:
            spark.sql(f"DROP TABLE IF EXISTS {old}")
    return table


def read_silver(spark: SparkSession, tables: Tables) -> DataFrame:
    """The silver table in its current schema; empty before the first run.

    Reads the view: the base version with the batches merged on read, also where an older
    version lacks columns.
    """
    version = current_version(spark, tables.silver)
    if version is None:
        return spark.createDataFrame([], SILVER)
    return align_to_schema(spark.table(tables.silver), SILVER)


def read_gold(spark: SparkSession, tables: Tables) -> DataFrame:
    version = current_version(spark, tables.gold)
    return spark.createDataFrame([], GOLD) if version is None else spark.table(version)


def truncate_tables(spark: SparkSession, tables: Tables) -> list[str]:
    """Empty the tables that exist and return their names; missing ones are skipped.

    Silver and gold get an empty version, and the full ones go; the ledger forgets all runs, so
    that a run can be repeated under its old id.
    """
    emptied = []
    for name in tables.all():
        if not spark.catalog.tableExists(name):
            continue
        version = current_version(spark, name)
        spark.sql(f"DROP TABLE IF EXISTS {name}_changes")  # batches merged on read go with the table
        if version is None:
            spark.sql(f"TRUNCATE TABLE {name}")
        else:
            buckets = bucket_count(spark, version)
            keys = SILVER_KEYS if buckets else ()
            publish(spark.table(version).limit(0), name, "emptied", bucket_by=keys, buckets=buckets, keep=1)
        emptied.append(name)
    for name in tables.of_runs():
        if spark.catalog.tableExists(name):
            spark.sql(f"TRUNCATE TABLE {name}")
    return emptied
