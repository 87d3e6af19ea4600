from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from postings.operators import aggregates, classify, dedupe, domains, expand, providers, upsert
from postings.schemas import SILVER, align_to_schema
from postings.settings import PROVIDERS, SITE_FILTERS

T = [datetime(2026, 1, d) for d in range(1, 6)]
SCHEMA = "source string, result_id string, v string, rate double, first_seen_at timestamp"
TARGET = [("a", "1", "old", 1.0, T[0]), ("a", "2", "old", 2.0, T[0]), ("b", "1", "old", None, T[1]),
          (None, "1", "null key", 3.0, T[0]), ("c", None, "null key", 3.0, T[0])]
BATCH = [("a", "1", "new", None, T[3]), ("b", "1", "new", 9.0, T[3]), ("b", "2", "new", 5.0, T[3]),
         (None, "1", "null key too", 4.0, T[3])]
KEYS, KEPT = ("source", "result_id"), ("first_seen_at",)


@pytest.mark.parametrize("small", [False, True])
def test_upsert(spark, small):
    target, batch = spark.createDataFrame(TARGET, SCHEMA), spark.createDataFrame(BATCH, SCHEMA)
    merged = upsert.upsert(target, batch, KEYS, KEPT, small_batch=small)
    got = sorted(map(tuple, merged.collect()), key=str)
    want = [
        ("a", "1", "new", None, T[0]),
        ("a", "2", "old", 2.0, T[0]),
        ("b", "1", "new", 9.0, T[1]),
        ("b", "2", "new", 5.0, T[3]),
        (None, "1", "null key", 3.0, T[0]),
        ("c", None, "null key", 3.0, T[0]),
        (None, "1", "null key too", 4.0, T[3]),
    ]
    assert got == sorted(want, key=str)


@pytest.mark.parametrize("small", [False, True])
def test_upsert_is_idempotent(spark, small):
    batch = spark.createDataFrame([r for r in BATCH if r[0]], SCHEMA)
    once = upsert.upsert(spark.createDataFrame(TARGET, SCHEMA), batch, KEYS, KEPT, small_batch=small)
    twice = upsert.upsert(once, batch, KEYS, KEPT, small_batch=small)
    assert sorted(map(str, once.collect())) == sorted(map(str, twice.collect()))


def test_first_wins_whatever_the_partitions(spark):
    # A third of the rows shares one key.
    rows = [(i, i % 7, f"k{i % 3 and i}", i % 5 != 0) for i in range(600)]
    df = spark.createDataFrame(rows, "id int, rank int, key string, ok boolean")
    best = {}
    for i, rank, key, ok in rows:
        if ok:
            best[key] = min(best.get(key, (99, 0)), (rank, i))
    want = {i for _, i in best.values()}
    for partitions in (1, 3, 16):
        flagged = dedupe.flag_first(df.repartition(partitions), ["key"], ["rank", "id"], ["id"], F.col("ok"))
        assert flagged.count() == len(rows)
        assert {r["id"] for r in flagged.where("is_first").collect()} == want
        firsts = dedupe.first_per_key(df.where("ok").repartition(partitions), ["key"], ["rank", "id"])
        assert firsts.columns == df.columns
        assert {r["id"] for r in firsts.collect()} == want


def test_reject_chain(spark):
    rows = [
        (1, 0, "https://h.nz/a", "foreign below"),
        (2, 0, "https://evil.nz/a", "domain"),
        (3, 0, "https://evil.nz/a", "domain again"),
        (4, 0, "https://h.nz/a/?utm_source=x#f", "duplicate of 1"),
        (5, 0, "", "missing"),
        (6, 0, "https://[bad", "unparsable"),
        (7, 0, "https://www.h.nz/b", "other"),
    ]
    df = spark.createDataFrame(rows, "response_id int, pos int, url string, note string")
    judged = classify.classify(
        classify.with_clean_url(df), ["h.nz"], order=("response_id", "pos"), row_key=("response_id", "pos")
    )
    got = {r["response_id"]: r["reason"] for r in judged.collect()}
    assert got == {
        1: None,
        2: providers.DOMAIN_NOT_ALLOWED,
        3: providers.DOMAIN_NOT_ALLOWED,
        4: providers.DUPLICATE_URL,
        5: providers.MISSING_URL,
        6: providers.MISSING_URL,
        7: None,
    }


def test_rejected_rows_do_not_claim_their_url(spark):
    df = spark.createDataFrame(
        [(1, 0, "https://h.nz/a", ["x.nz"]), (2, 0, "https://h.nz/a", ["h.nz"])],
        "response_id int, pos int, url string, domains array<string>",
    )
    judged = classify.classify(
        classify.with_clean_url(df), F.col("domains"), order=("response_id", "pos"), row_key=("response_id", "pos")
    )
    got = {r["response_id"]: r["reason"] for r in judged.collect()}
    assert got == {1: providers.DOMAIN_NOT_ALLOWED, 2: None}


def test_domain_join_under_skew(spark):
    hosts = ["www.big.nz"] * 400 + [f"h{i}.small.nz" for i in range(50)] + ["big.nz", "xbig.nz", "other.org", "BIG.nz:443"]
    df = spark.createDataFrame([(i, f"https://{h}/p") for i, h in enumerate(hosts)], "id int, url string")
    listed = spark.createDataFrame([("Big.nz",), ("h7.small.nz",), ("nothing.com",)], "domain string")
    got = {r["id"] for r in domains.rows_in_domains(df, listed).collect()}
    want = {i for i, h in enumerate(hosts) if h in ("www.big.nz", "big.nz", "h7.small.nz")}
    assert got == want


def test_provider_rules(spark):
    rows = [
        ("seek", "https://www.seek.co.nz/job/1", None),
        ("seek", "https://www.seek.co.nz/dev-jobs/in-All-Auckland", None),
        ("seek", "https://www.seek.co.nz/about", providers.DOMAIN_NOT_ALLOWED),
        ("trademe", "https://www.trademe.co.nz/a/jobs/x/Auckland/listing/1", None),
        ("trademe", "https://www.trademe.co.nz/a/jobs/x/otago/listing/1", providers.DOMAIN_NOT_ALLOWED),
        ("indeed", "https://nz.indeed.com/viewjob", None),
        ("indeed", "https://evil.com/indeed.com", providers.DOMAIN_NOT_ALLOWED),
        ("google", "https://anything.example/", None),
        ("bing", "", providers.MISSING_URL),
        ("bing", None, providers.MISSING_URL),
    ]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, provider string, url string, want string")
    reason = providers.provider_reject_reason(PROVIDERS, F.col("provider"), F.col("url"))
    assert [r["got"] for r in df.withColumn("got", reason).orderBy("i").collect()] == [r[2] for r in rows]


def test_gates(spark):
    df = spark.createDataFrame([(p.name, m) for p in PROVIDERS for m in ("rss", "html", "ui")], "provider string, mode string")
    count = lambda modes: providers.only_supported(df, PROVIDERS, modes).count()
    assert (count(("rss", "html")), count(("rss",)), count(("ui",)), count(())) == (7, 5, 0, 0)
    assert providers.only_enabled(df, None).count() == 15
    assert providers.only_enabled(df, ["bing"]).count() == 3


def test_expansion(spark):
    searches = spark.createDataFrame(
        [(1, ["Auckland", "contract", "software developer", ".NET"], 125.0, None)],
        "search_id int, keywords array<string>, min_rate double, max_rate double",
    )
    rows = expand.expand_queries(searches, PROVIDERS, SITE_FILTERS).collect()
    counts = {p.name: sum(r["provider"] == p.name for r in rows) for p in PROVIDERS}
    assert counts == {"seek": 2, "trademe": 2, "indeed": 2, "google": 6, "bing": 6}
    text = "Auckland contract software developer .NET"
    by_key = {(r["provider"], r["query_ord"]): r for r in rows}
    assert by_key["seek", 1]["query"] == f'site:seek.co.nz/job {text} "$125"'
    assert by_key["google", 2]["query"] == f"site:trademe.co.nz {text}"
    assert by_key["google", 2]["feed_url"] == (
        "https://news.google.com/rss/search?q=site%3Atrademe.co.nz+Auckland+contract+software+developer+.NET"
        "&hl=en-NZ&gl=NZ&ceid=NZ%3Aen"
    )
    no_sites = expand.expand_queries(searches, [p for p in PROVIDERS if p.name == "bing"])
    assert [r["query"] for r in no_sites.orderBy("query_ord").collect()] == [text, f'{text} "$125"']
    pages = expand.expand_page_urls(searches, PROVIDERS).collect()
    assert {r["url"] for r in pages} == {
        "https://www.seek.co.nz/software-developer-contract-jobs/in-All-Auckland",
        "https://www.seek.co.nz/net-contract-jobs/in-All-Auckland",
        "https://www.trademe.co.nz/a/jobs/it/programming-development/auckland/search"
        "?search_string=software+developer+.NET+contract",
        "https://www.trademe.co.nz/a/jobs/it/programming-development/auckland",
        "https://nz.indeed.com/jobs?q=Auckland+contract+software+developer+.NET",
        "https://www.google.com/search?q=Auckland+contract+software+developer+.NET&hl=en-NZ&gl=NZ",
        "https://www.bing.com/search?q=Auckland+contract+software+developer+.NET&cc=NZ&setmkt=en-NZ",
    }
    bing = [p for p in PROVIDERS if p.name == "bing"]
    limited = expand.expand_page_urls(searches, bing, SITE_FILTERS[:2]).first()["url"]
    one, two = (f"site%3A{site}+Auckland+contract+software+developer+.NET" for site in SITE_FILTERS[:2])
    assert limited == f"https://www.bing.com/search?q={one}+OR+{two}&cc=NZ&setmkt=en-NZ"
    with pytest.raises(ValueError, match="other"):
        expand.expand_page_urls(searches, [replace(bing[0], name="other")])


def test_normalize(spark):
    items = spark.createDataFrame(
        [("rss", "T", "u", "c", None), (None, None, None, None, None), ("", "é\"", "u", "", "p")],
        "mode string, title string, url string, content string, published string",
    )
    got = classify.normalize(items, F.lit("seek"), F.lit(""), F.lit("html")).collect()
    assert [(r["provider"], r["scrape_mode"], r["title"], r["published"]) for r in got] == [
        ("seek", "rss", "T", ""),
        ("seek", "html", "", ""),
        ("seek", "html", 'é"', "p"),
    ]
    assert got[0]["raw_json"] == '{"content":"c","mode":"rss","published":null,"title":"T","url":"u"}'
    assert '"title":"é\\""' in got[2]["raw_json"]
    plain = classify.normalize(items, F.lit("seek"), F.lit(None).cast("string"), F.lit(None).cast("string"))
    assert [r["scrape_mode"] for r in plain.collect()] == ["rss", "search", "search"]


def test_align_to_schema(spark):
    legacy = spark.createDataFrame([("s", "1", "t")], "source string, result_id string, title string")
    aligned = align_to_schema(legacy, SILVER)
    assert aligned.columns == SILVER.fieldNames()
    assert aligned.first()["provider"] is None and aligned.first()["title"] == "t"
    assert align_to_schema(aligned, SILVER).first() == aligned.first()


def test_summary_and_gold(spark):
    rows = [
        ("seek", "rss", "seek", "1", "Crane operator, nights", "u1", "c", "", "{}", 120.0, 130.0, T[0], T[1]),
        ("trademe", "html", "trademe", "2", "Pastry cook", "u2", "c", "", "{}", 80.0, 90.0, T[0], T[2]),
        ("trademe", "html", "trademe", "3", "No rate", "u3", "c", "", "{}", None, None, T[0], T[0]),
    ]
    silver = spark.createDataFrame(rows, SILVER)
    assert [r["title"] for r in classify.gold_rows(silver, 125).collect()] == ["Crane operator, nights"]
    summary = {r["source"]: tuple(r)[3:] for r in aggregates.source_summary(silver).collect()}
    assert summary == {"seek": (1, 1, 130.0, T[1]), "trademe": (2, 1, 90.0, T[2])}
