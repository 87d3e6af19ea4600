"""Reports over silver, gold and rejected rows, in report order.

Each sort ends with a tie-breaker, so that the order is total. ``orderBy`` range
partitions by the whole sort key; ``limit`` after it keeps only k rows per task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.aggregates import rejections_by_reason, rejections_by_source, source_summary
from ..operators.classify import RUN_ORDER
from ..settings import RECENT_ROWS, REJECTED_SAMPLE_ROWS

# Columns of the reports.
GOLD_REPORT = ("provider", "source", "title", "hourly_min", "hourly_max", "url", "content", "last_seen_at")
GOLD_VIEW = ("provider", "scrape_mode") + GOLD_REPORT[1:]
RECENT_REPORT = ("provider", "scrape_mode", "source", "title", "url", "content",
                 "hourly_min", "hourly_max", "last_seen_at")


def ranked(report: DataFrame, store: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """A sorted report with ``rank``, from 1, as its rows stand.

    Rows are numbered within their sorted parts and stored; then each part starts from the
    sum of those before it. Only one row for each part goes through a window on its own.
    """
    place = F.monotonically_increasing_id()
    stored = store(report.select("*", place.alias("place")), "report")
    parts = stored.withColumn("part", F.shiftright("place", 33))
    before = Window.orderBy("part")
    starts = parts.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select("part", (F.sum("n").over(before) - F.col("n")).alias("start"))
    nth = F.col("place").bitwiseAND(F.lit(2**33 - 1))
    return parts.join(starts, "part").select(*report.columns, (F.col("start") + nth + 1).alias("rank"))


def in_gold_order(gold: DataFrame) -> DataFrame:
    return gold.orderBy(F.desc("hourly_max"), F.desc("last_seen_at"), "source", "result_id")


def gold_report(gold: DataFrame) -> DataFrame:
    """High-rate roles, best rate first."""
    return in_gold_order(gold).select(*GOLD_REPORT)


def gold_view(gold: DataFrame) -> DataFrame:
    """The same with the scrape mode."""
    return in_gold_order(gold).select(*GOLD_VIEW)


def summary_report(silver: DataFrame) -> DataFrame:
    """Source summary, largest source first."""
    return source_summary(silver).orderBy(F.desc("total_rows"), "provider", "scrape_mode", "source")


def recent_report(silver: DataFrame, rows: int = RECENT_ROWS) -> DataFrame:
    """The rows seen last."""
    newest = silver.orderBy(F.desc("last_seen_at"), "source", "result_id").limit(rows)
    return newest.select(*RECENT_REPORT)


def reason_report(rejected: DataFrame) -> DataFrame:
    """Rejections by reason, most common first."""
    return rejections_by_reason(rejected).orderBy(F.desc("rows"), "reason")


def source_reason_report(rejected: DataFrame) -> DataFrame:
    """Rejections by source and reason, most common first."""
    return rejections_by_source(rejected).orderBy(F.desc("rows"), "source", "reason")


def rejected_sample(
    rejected: DataFrame, rows: int = REJECTED_SAMPLE_ROWS, order: Sequence[str] = RUN_ORDER
) -> DataFrame:
    """The first rejected rows in run order."""
    return rejected.orderBy(*order).limit(rows)
