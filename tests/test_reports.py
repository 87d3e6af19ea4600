from datetime import datetime

from postings.plans import reports
from postings.schemas import SILVER


def silver_of(spark, rows):
    full = [
        (p, "rss", s, i, f"title {i}", f"u{i}", "c", "", "{}", rate, rate, datetime(2026, 1, 1), datetime(2026, 1, day))
        for p, s, i, rate, day in rows
    ]
    return spark.createDataFrame(full, SILVER).repartition(3)


ROWS = [("a", "x", "1", 130.0, 1), ("a", "x", "2", 150.0, 1), ("b", "y", "3", 150.0, 2), ("b", "y", "4", None, 9),
        ("b", "y", "5", 130.0, 1)]


def test_gold_order(spark):
    ordered = reports.in_gold_order(silver_of(spark, ROWS)).collect()
    assert [r["result_id"] for r in ordered] == ["3", "2", "1", "5", "4"]
    report = reports.gold_report(silver_of(spark, ROWS))
    assert report.columns == list(reports.GOLD_REPORT)
    assert [r["title"] for r in report.collect()] == [f"title {i}" for i in "32154"]
    assert reports.gold_view(silver_of(spark, ROWS)).columns == list(reports.GOLD_VIEW)


def test_recent(spark):
    recent = reports.recent_report(silver_of(spark, ROWS), 2)
    assert [r["title"] for r in recent.collect()] == ["title 4", "title 3"]


def test_summary_order(spark):
    assert [(r["source"], r["total_rows"]) for r in reports.summary_report(silver_of(spark, ROWS)).collect()] == [
        ("y", 3),
        ("x", 2),
    ]


def test_rejection_reports(spark):
    rows = [("a", "duplicate url"), ("a", "missing url"), ("b", "duplicate url"), ("a", "duplicate url")]
    rejected = spark.createDataFrame(rows, "source string, reason string")
    assert [tuple(r) for r in reports.reason_report(rejected).collect()] == [("duplicate url", 3), ("missing url", 1)]
    assert [tuple(r) for r in reports.source_reason_report(rejected).collect()] == [
        ("a", "duplicate url", 2),
        ("a", "missing url", 1),
        ("b", "duplicate url", 1),
    ]
    numbered = spark.createDataFrame([(i,) for i in range(50)], "n int").repartition(7)
    assert [r["n"] for r in reports.rejected_sample(numbered, order=("n",)).collect()] == list(range(20))
