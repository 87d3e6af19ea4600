import json
from dataclasses import replace
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from postings.operators.upsert import upsert
from postings.plans import ingest, maintenance
from postings.schemas import GOLD, RESPONSES, SILVER, SILVER_KEPT, SILVER_KEYS
from postings.session import materialize, shared_folder
from postings.settings import RunSettings
from postings.sinks import tables as sinks
from postings.streaming.hourly import ingest_arrivals

FIRST = datetime(2026, 1, 15, 12, tzinfo=timezone.utc)
SETTINGS = RunSettings(run_id="r1", fetched_at=FIRST, silver_buckets=4)


def rss(*items):
    body = "".join(
        f"<item><title>{t}</title><link>{u}</link><description>{c}</description></item>" for t, u, c in items
    )
    return f"<rss><channel>{body}</channel></rss>"


SEEK_FEED = rss(
    ("Dev", "https://www.seek.co.nz/job/1?utm_source=x", "$120 - $140 per hour"),
    ("Dev again", "https://www.seek.co.nz/job/1/", "copy"),
    ("About", "https://www.seek.co.nz/about", "not a job"),
    ("No link", "", "x" * 400),
)
BING_FEED = rss(
    ("Dev", "https://www.seek.co.nz/job/1", "seen by another provider"),
    ("Foreign", "https://foreign.org/job/9", "y" * 400),
    ("Indeed", "https://nz.indeed.com/viewjob?jk=5", "90 an hour"),
)
LISTING = """<title>Jobs</title><a href="/a/jobs/it/auckland/listing/7">Lead Contract Listed today</a>
<a href="/a/jobs/it/auckland/listing/7">twice</a><a href="/a/jobs/it/otago/listing/8">Elsewhere</a>"""
SEEK_PAGE = """<title>Seek</title><a href="/job/2">Rate $150/h</a><a href="/job/1">Dev</a><a href="https://x.org/job/3">x</a>"""


def response(number, provider, mode, order, url, body, status=200, server="", kind="text/html"):
    return (number, provider, mode, order, f"query {number}", url, status, server, kind, body)


RESPONSES_ROWS = [
    response(1, "bing", "rss", 0, "https://feeds/1", BING_FEED),
    response(2, "seek", "rss", 0, "https://feeds/2", SEEK_FEED),
    response(3, "seek", "html", 0, "https://www.seek.co.nz/page", SEEK_PAGE),
    response(4, "trademe", "html", 0, "https://www.trademe.co.nz/a/jobs", LISTING),
    response(5, "trademe", "html", 1, "https://www.trademe.co.nz/b", "Just a moment", status=403),
    response(6, "seek", "rss", 1, "https://feeds/6", "<rss><channel></rss>"),
    response(7, "google", "rss", 0, "https://feeds/7", "no feed"),
    response(8, "google", "html", 0, "https://www.google.com/", SEEK_PAGE),
    response(9, "seek", "ui", 0, "https://www.seek.co.nz/", SEEK_PAGE),
]


def stored(spark, rows=RESPONSES_ROWS, partitions=3):
    return spark.createDataFrame(rows, RESPONSES).repartition(partitions)


@pytest.fixture()
def store(spark):
    import uuid

    name = f"t_{uuid.uuid4().hex[:10]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{shared_folder(spark)}/{name}'")
    return sinks.Tables(name)


@pytest.fixture(scope="module")
def outputs(spark):
    return ingest.plan_ingest(stored(spark), SETTINGS, store=materialize)


def test_result_does_not_depend_on_partitions(spark, outputs):
    one = ingest.plan_ingest(stored(spark, partitions=1), SETTINGS, store=materialize)
    assert sorted(map(str, one.batch.collect())) == sorted(map(str, outputs.batch.collect()))


def test_run_plan(outputs):
    out = outputs
    batch = {(r["source"], r["url"]): r for r in out.batch.collect()}
    assert set(batch) == {
        ("seek", "https://www.seek.co.nz/job/1"),
        ("seek", "https://www.seek.co.nz/job/2"),
        ("trademe", "https://www.trademe.co.nz/a/jobs/it/auckland/listing/7"),
        ("bing", "https://nz.indeed.com/viewjob?jk=5"),
    }
    dev = batch["seek", "https://www.seek.co.nz/job/1"]
    assert (dev["title"], dev["scrape_mode"], dev["hourly_min"], dev["hourly_max"]) == ("Dev", "rss", 120.0, 140.0)
    assert json.loads(dev["raw_json"]) == {
        "content": "$120 - $140 per hour",
        "mode": "rss",
        "published": "",
        "title": "Dev",
        "url": "https://www.seek.co.nz/job/1?utm_source=x",
    }
    assert batch["trademe", "https://www.trademe.co.nz/a/jobs/it/auckland/listing/7"]["title"] == "Lead"
    assert batch["seek", "https://www.seek.co.nz/job/2"]["hourly_max"] == 150.0
    assert out.batch.columns == SILVER.fieldNames()

    rejected = sorted((r["stage"], r["source"], r["reason"], r["title"], len(r["content"])) for r in out.rejected.collect())
    assert rejected == [
        ("ingest", "bing", "domain not allowed", "Foreign", 300),
        ("ingest", "bing", "duplicate url", "Dev", 24),
        ("ingest", "seek", "duplicate url", "Dev", 8),
        ("ingest", "seek", "duplicate url", "Dev again", 4),
        ("provider", "seek", "domain not allowed", "About", 9),
        ("provider", "seek", "missing url", "No link", 300),
        ("provider", "trademe", "domain not allowed", "Elsewhere", 9),
    ]
    errors = {r["response_id"]: r["fetch_error"] for r in out.quarantine.collect()}
    assert errors == {5: "blocked by site protection", 6: "xml does not parse", 7: "not xml"}
    assert tuple(out.totals.first()) == (3, 4, 4, 3)
    assert {tuple(r) for r in out.funnel.collect()} == {("seek", 4, 2), ("trademe", 1, 1), ("bing", 3, 1)}


def test_accepted_and_rejected_are_all_results(outputs):
    out = outputs
    total = out.classified.count()
    accepted = out.classified.where("reason IS NULL")
    assert accepted.count() + out.rejected.where("stage = 'ingest'").count() == total
    assert accepted.select("clean_url").distinct().count() == accepted.count()


def test_bronze_payload(outputs):
    out = outputs
    payloads = {r["source"]: json.loads(r["response_json"]) for r in out.bronze.collect()}
    seek = payloads["seek"]
    assert seek["modes"] == ["rss", "html"] and seek["mode"] == "search"
    assert seek["queries"] == ["query 2"] and seek["feed_urls"] == ["https://feeds/2"]
    assert seek["urls"] == ["https://www.seek.co.nz/page"]
    assert seek["allowed_domains"] == ["seek.co.nz", "www.seek.co.nz", "nz.seek.com"]
    assert [(r["title"], r["mode"]) for r in seek["results"]] == [
        ("Dev", "rss"),
        ("Dev again", "rss"),
        ("Rate $150/h", "html"),
        ("Dev", "html"),
    ]
    query = json.loads(out.bronze.where("source = 'seek'").first()["query"])
    assert query == {
        "queries": ["query 2"],
        "urls": ["https://www.seek.co.nz/page"],
        "site_filters": ["seek.co.nz", "trademe.co.nz", "nz.indeed.com"],
    }


def test_payloads_of_a_large_provider_are_split(spark):
    rows = [response(i, "seek", "rss", i, f"https://feeds/{i}", SEEK_FEED) for i in range(10)]
    settings = replace(SETTINGS, responses_per_payload=3)
    bronze = ingest.plan_ingest(stored(spark, rows), settings, store=materialize).bronze
    sizes = sorted(len(json.loads(r["response_json"])["queries"]) for r in bronze.collect())
    assert sizes == [1, 3, 3, 3]


def test_rebuild_from_bronze(outputs):
    out = outputs
    rebuilt = ingest.rebuild_batch(out.bronze, SETTINGS)
    assert sorted(map(str, rebuilt.collect())) == sorted(map(str, out.batch.collect()))


def test_tables_over_two_runs(spark, store):
    ingest.run_ingest(spark, stored(spark), store, SETTINGS)
    assert {r["result_id"] for r in sinks.read_gold(spark, store).collect()} and sinks.read_gold(spark, store).columns == GOLD.fieldNames()
    first = {r["url"]: r for r in spark.table(store.silver).collect()}
    assert len(first) == 4 and spark.table(store.bronze).count() == 3

    feed = rss(
        ("Dev", "https://www.seek.co.nz/job/1", "no rate any more"), ("New", "https://www.seek.co.nz/job/9", "99/hour")
    )
    later = replace(SETTINGS, run_id="r2", fetched_at=datetime(2026, 1, 15, 13, tzinfo=timezone.utc))
    ingest.run_ingest(spark, stored(spark, [response(1, "seek", "rss", 0, "https://feeds/1", feed)]), store, later)
    second = {r["url"]: r for r in spark.table(store.silver).collect()}
    assert len(second) == 5 and spark.table(store.bronze).count() == 4
    dev = second["https://www.seek.co.nz/job/1"]
    assert (dev["hourly_max"], dev["content"]) == (None, "no rate any more")
    assert (dev["first_seen_at"], dev["last_seen_at"]) == (datetime(2026, 1, 15, 12), datetime(2026, 1, 15, 13))
    assert second["https://www.seek.co.nz/job/2"] == first["https://www.seek.co.nz/job/2"]
    assert [r["url"] for r in spark.table(store.gold).collect()] == ["https://www.seek.co.nz/job/2"]
    assert [len(sinks.versions(spark, name)) for name in (store.silver, store.gold)] == [2, 2]


def test_merge_keeps_a_file_for_each_bucket(spark, store):
    ingest.run_ingest(spark, stored(spark), store, SETTINGS)
    ingest.run_ingest(spark, stored(spark), store, replace(SETTINGS, run_id="r2"))
    version = sinks.current_version(spark, store.silver)
    assert spark.table(store.silver).count() == 4
    assert len(spark.table(version).inputFiles()) <= 4 and sinks.bucket_count(spark, version) == 4
    # another number of buckets spreads the table anew; no number keeps it
    ingest.run_ingest(spark, stored(spark), store, replace(SETTINGS, run_id="r3", silver_buckets=2))
    ingest.run_ingest(spark, stored(spark), store, replace(SETTINGS, run_id="r4", silver_buckets=None))
    version = sinks.current_version(spark, store.silver)
    assert sinks.bucket_count(spark, version) == 2 and len(spark.table(version).inputFiles()) <= 2
    assert spark.table(store.silver).count() == 4 and len(sinks.versions(spark, store.silver)) == sinks.KEPT_VERSIONS


def test_runs_that_differ_in_punctuation_only(spark, store):
    ingest.run_ingest(spark, stored(spark), store, replace(SETTINGS, run_id="run-1"))
    feed = rss(("Other", "https://www.seek.co.nz/job/99", "c"))
    ingest.run_ingest(spark, stored(spark, [response(1, "seek", "rss", 0, "https://feeds/1", feed)]), store, replace(SETTINGS, run_id="run.1"))
    assert spark.table(store.silver).count() == 5


def test_repeated_run_in_another_time_zone_and_day(spark, store):
    east = replace(SETTINGS, fetched_at=datetime(2026, 1, 16, 1, tzinfo=timezone(timedelta(hours=13))))
    ingest.run_ingest(spark, stored(spark), store, east)
    ingest.run_ingest(spark, stored(spark), store, replace(east, fetched_at=east.fetched_at + timedelta(days=1)))
    assert spark.table(store.bronze).count() == 3
    assert spark.table(store.bronze).select("fetched_at").distinct().count() == 1


def test_reader_outlives_a_run(spark, store):
    ingest.run_ingest(spark, stored(spark), store, SETTINGS)
    opened = sinks.read_silver(spark, store)
    ingest.run_ingest(spark, stored(spark), store, replace(SETTINGS, run_id="r2"))
    assert opened.count() == 4


def test_concurrent_run_is_told(spark, store):
    rows = spark.createDataFrame([(1,)], "a int")
    sinks.publish(rows, store.gold, "v1")

    from unittest import mock

    names = iter([sinks.current_version(spark, store.gold), "someone else's"])
    with mock.patch.object(sinks, "current_version", lambda *a: next(names)), pytest.raises(sinks.ConcurrentRun):
        sinks.publish(rows, store.gold, "v2")
    assert len(sinks.versions(spark, store.gold)) == 1


def test_bronze_is_written_before_anything_is_classified(spark, store):
    from unittest import mock

    with mock.patch.object(ingest, "classify", side_effect=RuntimeError("broken")), pytest.raises(RuntimeError, match="broken"):
        ingest.run_ingest(spark, stored(spark), store, SETTINGS)
    assert spark.table(store.bronze).count() == 3
    ingest.run_ingest(spark, stored(spark), store, SETTINGS)
    assert spark.table(store.bronze).count() == 3 and spark.table(store.silver).count() == 4


def test_what_a_run_leaves(spark, store):
    left = ingest.run_ingest(spark, stored(spark), store, SETTINGS)
    counts = left.metrics.first()
    assert counts["bronze_rows"] == left.bronze.count() == 3
    assert counts["warnings"] == left.quarantine.count() > 0
    assert counts["rejected_rows"] == left.rejected.where("stage = 'ingest'").count()
    import os

    folder = shared_folder(spark).removeprefix("file:")
    assert not [f for f in os.listdir(folder) if f.startswith("run-")]


def test_shared_folder_is_asked_for_off_local_masters(spark):
    from unittest import mock

    cluster = mock.MagicMock()
    cluster.conf.get.return_value = None
    cluster.sparkContext.master = "spark://host:7077"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(cluster)


def test_payloads_are_bounded_however_responses_are_numbered(spark):
    rows = [response(i, "seek", "rss", 0, f"https://feeds/{i}", SEEK_FEED) for i in range(7)]
    rows += [response(10 + i, "seek", "html", 0, "https://www.seek.co.nz/page", SEEK_PAGE) for i in range(3)]
    settings = replace(SETTINGS, responses_per_payload=4)
    bronze = ingest.plan_ingest(stored(spark, rows), settings).bronze
    sizes = sorted(len(p["queries"]) + len(p["urls"]) for p in (json.loads(r["response_json"]) for r in bronze.collect()))
    assert sizes == [2, 4, 4]


@pytest.mark.parametrize("width", [1, 3, 64])
def test_rebuild_does_not_depend_on_the_payloads(spark, width):
    rows = [response(i, "seek", "rss", 64 * i, f"https://feeds/{i}", rss((f"title {i}", "https://www.seek.co.nz/job/1", f"{100 + i} an hour"))) for i in range(8)]
    settings = replace(SETTINGS, responses_per_payload=width)
    plan = ingest.plan_ingest(stored(spark, rows), settings, store=materialize)
    rebuilt = ingest.rebuild_batch(plan.bronze, settings).collect()
    assert [r["title"] for r in rebuilt] == ["title 0"] and rebuilt == plan.batch.collect()


def test_repeated_run_changes_nothing(spark, store):
    ingest.run_ingest(spark, stored(spark), store, SETTINGS)
    before = sorted(map(str, spark.table(store.silver).collect()))
    ingest.run_ingest(spark, stored(spark), store, SETTINGS)
    assert sorted(map(str, spark.table(store.silver).collect())) == before
    assert spark.table(store.bronze).count() == 3


def test_gates(spark, store):
    bad = [response(1, "google", "rss", 0, "https://feeds/1", "no feed")]
    with pytest.raises(ingest.EmptyRun, match="no bronze"):
        ingest.run_ingest(spark, stored(spark, bad), store, SETTINGS)
    foreign = [response(1, "bing", "rss", 0, "https://feeds/1", rss(("t", "https://foreign.org/", "c")))]
    with pytest.raises(ingest.EmptyRun, match="no silver"):
        ingest.run_ingest(spark, stored(spark, foreign), store, SETTINGS)
    # The payload of the rejected run is kept, the other tables are untouched.
    assert spark.table(store.bronze).count() == 1
    assert not spark.catalog.tableExists(store.silver)


def test_cleanup(spark, store):
    assert maintenance.cleanup(spark, store)[0] == []
    ingest.run_ingest(spark, stored(spark), store, SETTINGS)
    emptied, counts = maintenance.cleanup(spark, store)
    assert emptied == list(store.all())
    assert {r["rows"] for r in counts.collect()} == {0}
    # the same run id fills the tables again
    ingest.run_ingest(spark, stored(spark), store, SETTINGS)
    assert [spark.table(name).count() for name in store.all()] == [3, 4, 2]


def test_legacy_silver_is_upgraded(spark, store):
    row = ("seek", "old", "t", "u", "c", 1.0, 2.0, datetime(2025, 1, 1), datetime(2025, 1, 1))
    schema = "source string, result_id string, title string, url string, content string, hourly_min double, hourly_max double, first_seen_at timestamp, last_seen_at timestamp"
    sinks.publish(spark.createDataFrame([row], schema), store.silver, "r0")
    ingest.run_ingest(spark, stored(spark), store, SETTINGS)
    silver = spark.table(store.silver)
    assert silver.count() == 5 and silver.columns == SILVER.fieldNames()
    assert silver.where("result_id = 'old'").first()["provider"] is None


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_upsert_does_not_shuffle_a_bucketed_table(spark, store):
    ingest.run_ingest(spark, stored(spark), store, SETTINGS)
    batch = spark.table(store.silver).limit(2)
    target = sinks.read_silver(spark, store)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = plan_of(upsert(target, batch, SILVER_KEYS, SILVER_KEPT))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    left = joined.split("FullOuter", 1)[1].split("Exchange", 1)[0]
    assert "silver_results__000001" in left
    small = plan_of(upsert(target, batch, SILVER_KEYS, SILVER_KEPT, small_batch=True))
    assert "BroadcastHashJoin" in small and "FullOuter" not in small


def test_filters_and_columns_reach_the_scan(spark, store):
    from postings.operators.aggregates import source_summary
    from postings.operators.classify import gold_rows

    ingest.run_ingest(spark, stored(spark), store, SETTINGS)
    silver = spark.table(store.silver)
    gold = plan_of(gold_rows(silver, 125))
    assert "GreaterThanOrEqual(hourly_max,125.0)" in gold and "raw_json" not in gold.split("ReadSchema")[1]
    summary = plan_of(source_summary(silver))
    assert "content" not in summary.split("ReadSchema")[1]


def test_no_cross_joins_and_one_pass_over_bodies(spark, outputs):
    out = outputs
    for df in (out.batch, out.bronze, out.rejected, out.totals):
        assert "Cartesian" not in plan_of(df) and "NestedLoop" not in plan_of(df)
    from postings.plans.collect import collect_responses

    collected = plan_of(collect_responses(spark.createDataFrame(RESPONSES_ROWS, RESPONSES), SETTINGS))
    assert "Exchange hash" not in collected and "+- Union" not in collected


def test_stream_of_arrivals(spark, store, tmp_path):
    folder, checkpoint = str(tmp_path / "in"), str(tmp_path / "cp")
    one = spark.createDataFrame(RESPONSES_ROWS[:3], RESPONSES).coalesce(1)
    two = spark.createDataFrame(RESPONSES_ROWS[3:], RESPONSES).coalesce(1)

    def arrive():
        query = ingest_arrivals(spark, folder, store, SETTINGS, checkpoint, clock=lambda: FIRST)
        query.awaitTermination()
        return spark.table(store.silver).count()

    one.write.mode("append").parquet(folder)
    assert arrive() == 3
    two.write.mode("append").parquet(folder)
    assert arrive() == 4
    assert arrive() == 4
    runs = {r["run_id"] for r in spark.table(store.bronze).select("run_id").distinct().collect()}
    assert runs == {"r1-0", "r1-1"}
    assert spark.table(store.metrics).count() == 2


def test_hot_url_is_not_one_task(spark):
    # A third of all results is one URL; its copies are combined before the shuffle.
    feeds = [
        response(i, "seek", "rss", i, f"https://feeds/{i}", rss(("t", "https://www.seek.co.nz/job/1", "c"),
                 (f"t{i}", f"https://www.seek.co.nz/job/a{i}", "c"), (f"u{i}", f"https://www.seek.co.nz/job/b{i}", "c")))
        for i in range(200)
    ]
    keep = lambda df, name: materialize(df, name) if name == "collected" else df
    out = ingest.plan_ingest(stored(spark, feeds, 8), SETTINGS, store=keep)
    plan = plan_of(out.classified)
    assert "Window" not in plan and "partial_min" in plan
    reasons = {r["reason"]: r["n"] for r in out.classified.groupBy("reason").agg(F.count("*").alias("n")).collect()}
    assert reasons == {None: 401, "duplicate url": 199}
