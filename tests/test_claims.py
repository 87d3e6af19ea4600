"""URLs are claimed on narrow rows, and results are only shuffled where the claims are many."""

import pytest
from pyspark.sql import functions as F

from postings.functions.feeds import parse_feed
from postings.functions.rates import hourly_rate
from postings.functions.urls import canonical_url
from postings.plans import ingest
from postings.session import materialize

from .test_ingest import SETTINGS, response, rss, stored


def plan_of(df):
    return df._jdf.queryExecution().toString()


def run(spark):
    feeds = [
        response(i, "seek", "rss", i, f"https://feeds/{i}", rss(("t", "https://www.seek.co.nz/job/1", "$90 per hour"),
                 (f"t{i}", f"https://www.seek.co.nz/job/a{i}?utm_source=x", "c"), ("x", "https://other.example/", "c")))
        for i in range(20)
    ]
    plans = {}

    def keep(df, name):
        plans[name] = plan_of(df)
        return materialize(df, name)

    return ingest.plan_ingest(stored(spark, feeds, 4), SETTINGS, store=keep), plans


def test_few_claims_leave_results_unshuffled(spark):
    out, plans = run(spark)
    assert out.batch.count() == 21
    assert "BroadcastHashJoin" in plans["classified"] and "SortMergeJoin" not in plans["classified"]
    assert "to_json" not in plans["classified"]


def test_many_claims_give_the_same(spark, monkeypatch):
    few, _ = run(spark)
    rows = sorted(map(str, few.batch.collect())), sorted(map(str, few.rejected.collect()))
    monkeypatch.setattr(ingest, "BROADCAST_BYTES", -1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        many, plans = run(spark)
        assert (sorted(map(str, many.batch.collect())), sorted(map(str, many.rejected.collect()))) == rows
        assert "SortMergeJoin" in plans["classified"]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_gates_read_no_texts(spark):
    out, plans = run(spark)
    counted = lambda df: {tuple(r) for r in df.groupBy("provider", "reason").count().collect()}
    assert counted(out.reasons) == counted(out.classified)
    out, plans = run(spark)
    assert out.totals.first()["silver_rows"] == 21
    assert "classified" not in plans and "content" not in plans["urls"].split("== Optimized")[1].split("ReadSchema")[-1]


def test_prefixed_feeds_are_looked_for_first(spark):
    plan = plan_of(spark.createDataFrame([("<rss/>",)], "xml string").select(parse_feed(F.col("xml"))))
    assert "Contains" in plan and ":feed" in plan


@pytest.mark.parametrize(
    "url, clean",
    [(" \x01https://a.nz/x\t/y\r\n/", "https://a.nz/x/y"), ("!https", "!https"), ("https://a.nz/é \n", "https://a.nz/é"),
     ("https://a.nz/b\nc", "https://a.nz/bc")],
)
def test_marred_urls_are_cleaned(evaluate, url, clean):
    assert evaluate(canonical_url, [(url,)], "url string") == [clean]


def test_spellings_meet_after_replacing(evaluate):
    rows = evaluate(hourly_rate, [("nzd 1,20 per hour",), ("90 p,h",), ("80 – 90 an ho,ur",), (None,)], "text string")
    assert [tuple(r) for r in rows] == [(120.0, 120.0), (90.0, 90.0), (80.0, 90.0), (None, None)]
