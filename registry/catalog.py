"""The registered queries, each with the SQL that checks it.

Keys start with the operator id of the inventory. Every query runs over whole tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postings.functions import entities, html, rates, responses, searches, text, times, urls
from postings.operators import aggregates, classify, dedupe, domains, envelope, expand, providers, upsert
from postings.plans import collect, ingest, maintenance, reports
from postings.schemas import BRONZE, SILVER, SILVER_KEPT, SILVER_KEYS, align_to_schema
from postings.session import materialize, shared_folder
from postings.settings import PROVIDERS, SITE_FILTERS
from postings.sinks import merge_on_read
from postings.sinks import tables as sinks
from postings.sources import scans, tables

from . import fixtures as fx
from . import oracle as sql
from .oracle import query

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(key: str, check: str | None = None):
    def add(fn: Query) -> Query:
        QUERIES[key] = fn
        if check is not None:
            ORACLES[key] = check
        return fn

    return add


def new_tables(spark: SparkSession) -> sinks.Tables:
    """Tables in a database of their own in the shared folder."""
    name = f"postings_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{shared_folder(spark)}/{name}'")
    return sinks.Tables(name)


# --- scans ----------------------------------------------------------------

FEED_COLUMNS = ["doc_id", "pos", "title", "url", "content", "published"]


@register("sc1_rss_scan", query("feed_items", select="SELECT * FROM feed_items"))
def sc1(spark, sf):
    return scans.scan_feeds(fx.feeds(spark, sf), ["doc_id"]).select(*FEED_COLUMNS)


@register(
    "sc2_atom_scan",
    query(
        "lines",
        select="""SELECT doc_id, pos, 'doc ' || doc_id AS title, url, CASE WHEN line = '' AND pos % 3 <> 0 THEN 'unused'
            ELSE line END AS content, CASE WHEN pos % 2 = 0 THEN 'p' ELSE 'u' END AS published FROM lines""",
    ),
)
def sc2(spark, sf):
    return scans.scan_feeds(fx.feeds(spark, sf, fx.atom_document), ["doc_id"]).select(*FEED_COLUMNS)


@register(
    "sc3_feed_order",
    query(
        "lines",
        select="""SELECT doc_id, pos + 1 AS pos, 'doc ' || doc_id AS title FROM lines
            UNION ALL SELECT doc_id, 0, 'rss ' || doc_id FROM documents""",
    ),
)
def sc3(spark, sf):
    return scans.scan_feeds(fx.feeds(spark, sf, fx.mixed_document), ["doc_id"]).select("doc_id", "pos", "title")


# Lines of the nested feeds: how many RSS items a line gives, and where its first one and its entry stand.
NESTED_LINES = """(SELECT doc_id, pos, line, CASE pos % 4 WHEN 2 THEN 2 WHEN 3 THEN 0 ELSE 1 END AS k,
        1 + coalesce(sum(CASE pos % 4 WHEN 2 THEN 2 WHEN 3 THEN 0 ELSE 1 END) OVER w, 0) AS first_at,
        coalesce(sum(CASE WHEN pos % 4 = 3 THEN 1 ELSE 0 END) OVER w, 0) AS entries_before,
        1 + sum(CASE pos % 4 WHEN 2 THEN 2 WHEN 3 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id) AS items
    FROM lines WINDOW w AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))"""


@register(
    "sc1_nested_items",
    query(
        "lines",
        select=f"""SELECT doc_id, 0 AS pos, 'first ' || doc_id AS title, '' AS content FROM documents
        UNION ALL SELECT doc_id, first_at, CASE WHEN pos % 4 = 1 THEN 'doc ' || doc_id || ' <item> x' ELSE 'doc ' || doc_id END, line FROM {NESTED_LINES} AS r WHERE k > 0
        UNION ALL SELECT doc_id, first_at + 1, 'inner ' || doc_id, '' FROM {NESTED_LINES} AS r WHERE k = 2
        UNION ALL SELECT doc_id, items + entries_before, 'doc ' || doc_id, line FROM {NESTED_LINES} AS r WHERE k = 0""",
    ),
)
def sc1_nested(spark, sf):
    return scans.scan_feeds(fx.feeds(spark, sf, fx.nested_document), ["doc_id"]).select("doc_id", "pos", "title", "content")


@register("sc4_anchor_scan", query("anchors", select="SELECT page_id, pos, href, text FROM anchors"))
def sc4(spark, sf):
    return scans.scan_anchors(tables.read_table(spark, sf, "pages"), ["page_id"])


@register("sc5_title_scan", query("titles", select="SELECT * FROM titles"))
def sc5(spark, sf):
    return scans.scan_titles(tables.read_table(spark, sf, "pages"), ["page_id"])


@register("sc6_page_links", query("page_items", select="SELECT * FROM page_items"))
def sc6(spark, sf):
    return scans.scan_page_links(tables.read_table(spark, sf, "pages"), ["page_id"], fx.PAGE_DOMAINS)


def listing_pages(spark, sf):
    link = F.concat(F.lit('href="/a/jobs/x/listing/'), F.col("page_id") % 7)
    pages = tables.read_table(spark, sf, "pages")
    return pages.select("page_id", "url", F.replace("html", F.lit('href="'), link).alias("html"))


LISTING_SQL = query(
    "anchors",
    "titles",
    select=rf"""SELECT page_id, pos, title, url, title AS content, '' AS published FROM (
        SELECT *, trim(regexp_replace({sql.collapse("fallback")},
            '\s+(Listed\s+\w+|\d+\s+days?\s+ago|Be an early applicant|Quick apply|Job closes|Full-time|Part-time|Contract)\b.*$',
            '')) AS title
        FROM (SELECT *, coalesce(nullif(text, ''), nullif(page_title, ''), url) AS fallback FROM (
            SELECT page_id, pos, text, page_title, regexp_extract(page_url, '^[a-z]+://[^/?#]*') || '/a/jobs/x/listing/'
                || page_id % 7 || href AS url
            FROM anchors JOIN titles USING (page_id))))
        QUALIFY row_number() OVER (PARTITION BY page_id, url ORDER BY pos) = 1""",
)


@register("sc7_listing_links", LISTING_SQL)
def sc7(spark, sf):
    return scans.scan_listing_links(listing_pages(spark, sf), ["page_id"])


@register(
    "sc8_bronze_unnest",
    query(
        "run_payloads",
        select="""SELECT provider AS source, part, i - 1 AS pos, results[i].title AS title, results[i].url AS url,
            results[i].content AS content, results[i].published AS published, results[i].mode AS mode
        FROM (SELECT *, unnest(generate_series(1, len(results))) AS i FROM run_payloads)""",
    ),
)
def sc8(spark, sf):
    payloads = run_payloads(spark, sf)
    bronze = payloads.select(
        F.col("provider").alias("source"), "part", F.to_json("payload").alias("response_json")
    )
    return scans.scan_payloads(bronze, ("source", "part")).select(
        "source", "part", "pos", "title", "url", "content", "published", "mode"
    )


@register(
    "sc9_typed_rows",
    query(
        "event_rows",
        select=f"""SELECT provider, list_position({sql.texts(fx.NAMES)}, provider) - 1 AS position, count(*) AS rows
        FROM event_rows GROUP BY ALL""",
    ),
)
def sc9(spark, sf):
    names = tables.typed_rows(spark, [(p.name, i) for i, p in enumerate(PROVIDERS)], "provider string, position int")
    counts = fx.event_rows(spark, sf).groupBy("provider").agg(F.count(F.lit(1)).alias("rows"))
    return names.join(counts, "provider").select("provider", "position", "rows")


@register(
    "sc10_table_scan",
    query("rate_silver", select="SELECT source, result_id, hourly_max FROM rate_silver WHERE hourly_max >= 200"),
)
def sc10(spark, sf):
    store = new_tables(spark)
    sinks.publish(fx.rate_silver(spark, sf), store.silver, "v1")
    return spark.table(store.silver).where("hourly_max >= 200").select("source", "result_id", "hourly_max")


# --- sinks ----------------------------------------------------------------


@register(
    "sk1_bronze_append",
    query(
        "event_rows",
        select=f"""SELECT run_id, source, {sql.STAMP} AS fetched_at, '{{}}' AS query, content AS response_json,
            DATE '2026-01-15' AS fetched_date
        FROM event_rows, (SELECT unnest(['run-1', 'run-2']) AS run_id)""",
    ),
)
def sk1(spark, sf):
    store = new_tables(spark)
    for run in ("run-1", "run-2"):
        rows = times.stamp(fx.event_rows(spark, sf), run, fx.RUN.fetched_at)
        sinks.append_bronze(
            rows.select(
                "run_id",
                "source",
                "fetched_at",
                F.lit("{}").alias("query"),
                F.col("content").alias("response_json"),
                F.lit(None).cast(BRONZE["result_order"].dataType).alias("result_order"),
            ),
            store,
        )
    return sinks.read_bronze(spark, store).drop("result_order")


def merged_on_read(spark, sf, compacted):
    """Silver of the events before the split, then the batch after it, merged on read."""
    store = new_tables(spark)
    for run, rows in (("v1", fx.event_target(spark, sf)), ("v2", fx.event_batch(spark, sf))):
        merge_on_read.append_batch(rows, store.silver, run, SILVER_KEYS, SILVER_KEPT, buckets=8)
    if compacted:
        merge_on_read.compact(spark, store.silver, "v3", SILVER_KEYS, SILVER_KEPT, buckets=8)
    return spark.table(store.silver)


@register("sk2_silver_upsert_sink", query("event_merged", select=f"SELECT {sql.SILVER} FROM event_merged"))
def sk2(spark, sf):
    return merged_on_read(spark, sf, compacted=False)


@register("sk2_silver_compacted", query("event_merged", select=f"SELECT {sql.SILVER} FROM event_merged"))
def sk2_compacted(spark, sf):
    return merged_on_read(spark, sf, compacted=True)


@register(
    "sk3_gold_replace", query("rate_silver", select=f"SELECT {sql.GOLD} FROM rate_silver WHERE hourly_max >= 125")
)
def sk3(spark, sf):
    store = new_tables(spark)
    silver = stored_silver(spark, sf)
    for version, rate in (("v1", 60), ("v2", 125)):
        sinks.publish(classify.gold_rows(silver, rate), store.gold, version, sort_by=["hourly_max"])
    return sinks.read_gold(spark, store)


@register(
    "sk4_truncate_tables",
    query(
        "rate_silver",
        select="""SELECT 'silver_results' AS table_name, count(*) AS rows_before, 0 AS rows_after, true AS emptied
            FROM rate_silver UNION ALL SELECT 'bronze_runs', NULL, NULL, false
            UNION ALL SELECT 'gold_high_rate', NULL, NULL, false""",
    ),
)
def sk4(spark, sf):
    store = new_tables(spark)
    sinks.publish(fx.rate_silver(spark, sf), store.silver, "v1")
    before = tables.typed_rows(spark, maintenance.count_tables(spark, store).collect(), "name string, rows_before bigint")
    emptied, after = maintenance.cleanup(spark, store)
    names = tables.typed_rows(spark, [(n, n in emptied) for n in store.all()], "name string, emptied boolean")
    after = after.select(F.col("table_name").alias("name"), F.col("rows").alias("rows_after"))
    joined = names.join(before, "name", "left").join(after, "name", "left")
    return joined.select(
        F.substring_index("name", ".", -1).alias("table_name"), "rows_before", "rows_after", "emptied"
    )


@register(
    "sk5_staging_view",
    query("event_silver", select="SELECT source, count(*) AS rows, max(last_seen_at) AS latest FROM event_silver GROUP BY 1"),
)
def sk5(spark, sf):
    fx.event_silver(spark, sf).createOrReplaceTempView("staged_results")
    return spark.sql("SELECT source, count(*) AS rows, max(last_seen_at) AS latest FROM staged_results GROUP BY source")


@register(
    "sk6_schema_upgrade",
    query(
        "event_silver",
        select="""SELECT NULL::VARCHAR AS provider, NULL::VARCHAR AS scrape_mode, source, result_id, title, url, content,
            NULL::VARCHAR AS published, NULL::VARCHAR AS raw_json, hourly_min, hourly_max, first_seen_at, last_seen_at
        FROM event_silver""",
    ),
)
def sk6(spark, sf):
    legacy = fx.event_silver(spark, sf).drop("provider", "scrape_mode", "published", "raw_json")
    return align_to_schema(legacy, SILVER)


# --- projections ----------------------------------------------------------


def raw_documents(spark, sf):
    key = F.col("doc_id")
    return tables.read_table(spark, sf, "documents").select(
        "doc_id",
        "source",
        F.when(key % 4 == 0, F.col("lang")).when(key % 4 == 1, "").alias("config_provider"),
        F.when(key % 3 == 0, "html").when(key % 3 == 1, "").alias("mode"),
        F.when(key % 2 == 0, "rss").alias("config_mode"),
        F.when(key % 5 != 0, F.concat(F.lit("doc "), key)).alias("title"),
        F.concat(F.lit("https://h.nz/"), key).alias("url"),
        F.col("text").alias("content"),
        F.lit(None).cast("string").alias("published"),
    )


RAW_JSON = """to_json(struct_pack(content := content, mode := mode, published := published,
    title := title, url := url))::VARCHAR"""
RAW_SQL = """SELECT doc_id, source, CASE doc_id % 4 WHEN 0 THEN lang WHEN 1 THEN '' END AS config_provider,
    CASE doc_id % 3 WHEN 0 THEN 'html' WHEN 1 THEN '' END AS mode, CASE WHEN doc_id % 2 = 0 THEN 'rss' END AS config_mode,
    CASE WHEN doc_id % 5 <> 0 THEN 'doc ' || doc_id END AS title, 'https://h.nz/' || doc_id AS url, text AS content,
    NULL::VARCHAR AS published FROM documents"""


@register(
    "pr1_normalize",
    f"""SELECT doc_id, coalesce(nullif(config_provider, ''), source) AS provider,
        coalesce(nullif(mode, ''), config_mode, 'search') AS scrape_mode, source, coalesce(title, '') AS title, url,
        content, '' AS published, {RAW_JSON} AS raw_json FROM ({RAW_SQL})""",
)
def pr1(spark, sf):
    rows = raw_documents(spark, sf)
    return classify.normalize(rows, F.col("source"), F.col("config_provider"), F.col("config_mode"), ["doc_id"])


@register(
    "pr2_tag_mode",
    """SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'html' WHEN 1 THEN '' ELSE 'rss' END AS mode FROM documents""",
)
def pr2(spark, sf):
    return classify.tag_mode(raw_documents(spark, sf), F.lit("rss")).select("doc_id", "mode")


def page_results(spark, sf):
    """Page links as normalised results of five providers and two modes, in run order."""
    key = F.col("page_id")
    items = materialize(sc6(spark, sf), "links").select(
        key.alias("response_id"),
        key.alias("query_ord"),
        "pos",
        (key % 5).cast("int").alias("provider_ord"),
        (key % 2).cast("int").alias("mode_ord"),
        fx.provider_name(key).alias("source"),
        F.when(key % 2 == 0, "rss").otherwise("html").alias("mode"),
        "title",
        "url",
        "content",
        "published",
    )
    results = classify.normalize(items, F.col("source"), F.col("source"), F.lit("search"), classify.RUN_ORDER)
    return classify.with_clean_url(results)


PAGE_CLASSIFIED = f"""classified AS (SELECT *, coalesce(url_reason, CASE WHEN row_number() OVER (
        PARTITION BY clean_url, url_reason IS NULL ORDER BY provider_ord, mode_ord, query_ord, response_id, pos) > 1
        THEN 'duplicate url' END) AS reason
    FROM (SELECT *, CASE WHEN clean_url = '' THEN 'missing url'
            WHEN NOT {sql.below(sql.host("clean_url"), ("example.com",))} THEN 'domain not allowed' END AS url_reason
        FROM (SELECT *, {sql.clean("url")} AS clean_url FROM page_results)))"""


def page_classified(spark, sf):
    return classify.classify(page_results(spark, sf), ["example.com"])


def with_page_classified(select: str) -> str:
    return query("page_results", select=f", {PAGE_CLASSIFIED} {select}")


PAGE_RATED = sql.rated(
    "(FROM classified WHERE reason IS NULL)", "*", "title || chr(10) || content || chr(10) || clean_url"
)
PAGE_SILVER_SQL = with_page_classified(
    f"""SELECT provider, mode AS scrape_mode, provider AS source,
        sha256(lower(trim(clean_url || '|' || title))) AS result_id, title, clean_url AS url, content, published,
        {RAW_JSON} AS raw_json, hourly_min, hourly_max, {sql.STAMP} AS first_seen_at, {sql.STAMP} AS last_seen_at
    FROM ({PAGE_RATED})"""
)


@register("pr3_silver_rows", PAGE_SILVER_SQL)
def pr3(spark, sf):
    accepted, _ = providers.split_by_reason(page_classified(spark, sf))
    return classify.silver_rows(accepted, fx.RUN.fetched_at)


@register("pr4_gold_columns", query("event_silver", select=f"SELECT {sql.GOLD} FROM event_silver WHERE hourly_max >= 20"))
def pr4(spark, sf):
    return classify.gold_rows(fx.event_silver(spark, sf), 20)


_stored: dict[tuple[str, str], object] = {}


def stored_silver(spark, sf):
    """The rate texts as a stored silver table, which filters and columns are pushed into.

    Written once for a session and folder, by the tasks that scan the lines: no row is dealt anew.
    """
    where = (spark.sparkContext.applicationId, sf)
    if where not in _stored:
        _stored[where] = materialize(fx.rate_silver(spark, sf), "silver")
    return _stored[where]


GOLD_REPORT = "provider, source, title, hourly_min, hourly_max, url, content, last_seen_at"
GOLD_VIEW = "provider, scrape_mode, source, title, hourly_min, hourly_max, url, content, last_seen_at"


@register(
    "pr5_gold_report",
    query("rate_silver", select=f"SELECT {GOLD_REPORT} FROM rate_silver WHERE hourly_max >= 125"),
)
def pr5(spark, sf):
    return reports.gold_report(classify.gold_rows(stored_silver(spark, sf), 125))


@register(
    "pr5_gold_view",
    query("rate_silver", select=f"SELECT {GOLD_VIEW} FROM rate_silver WHERE hourly_max >= 125"),
)
def pr5_view(spark, sf):
    return reports.gold_view(classify.gold_rows(stored_silver(spark, sf), 125))


RECENT = """SELECT provider, scrape_mode, source, title, url, content, hourly_min, hourly_max, last_seen_at
    FROM event_silver ORDER BY last_seen_at DESC, source, result_id LIMIT {}"""


@register("pr6_recent_columns", query("event_silver", select=RECENT.format(100)))
def pr6(spark, sf):
    return reports.recent_report(fx.event_silver(spark, sf))


@register(
    "pr7_rejected_rows",
    with_page_classified(
        """SELECT 'ingest' AS stage, provider AS source, reason, title, clean_url AS url,
            substring(content, 1, 300) AS content FROM classified WHERE reason IS NOT NULL"""
    ),
)
def pr7(spark, sf):
    _, rejected = providers.split_by_reason(page_classified(spark, sf))
    return classify.rejected_rows(rejected, "ingest")


# --- filters --------------------------------------------------------------

ALLOWED = ("seek.co.nz", "Trademe.co.nz")


def fi_allow(fn, spark, sf, domain_list):
    return fx.order_urls(spark, sf).select("id", fn(F.col("raw_url"), domain_list).alias("allowed"))


@register(
    "fi1_domain_allowed",
    query("order_urls", select=f"SELECT id, {sql.below(sql.host('raw_url'), ALLOWED)} AS allowed FROM order_urls"),
)
def fi1(spark, sf):
    return fi_allow(urls.domain_allowed, spark, sf, ALLOWED)


@register(
    "fi1_domain_allowed_per_row",
    query(
        "order_urls",
        select=f"""SELECT id, cust % 3 = 0 OR {sql.below(sql.host('raw_url'), ALLOWED)} AS allowed FROM order_urls""",
    ),
)
def fi1_per_row(spark, sf):
    lists = F.when(F.col("cust") % 3 == 0, F.array().cast("array<string>")).otherwise(F.array(*map(F.lit, ALLOWED)))
    return fx.order_urls(spark, sf).select("id", urls.domain_allowed(F.col("raw_url"), lists).alias("allowed"))


@register(
    "fi2_host_allowed",
    query(
        "order_urls",
        select=f"""SELECT id, {sql.below(sql.host('raw_url'), ALLOWED)} AS allowed, false AS allowed_by_none
        FROM order_urls""",
    ),
)
def fi2(spark, sf):
    return fx.order_urls(spark, sf).select(
        "id",
        urls.host_allowed(F.col("raw_url"), ALLOWED).alias("allowed"),
        urls.host_allowed(F.col("raw_url"), ()).alias("allowed_by_none"),
    )


def order_results(spark, sf):
    """Order URLs as results of the five providers."""
    return fx.order_urls(spark, sf).select("id", fx.provider_name(F.col("cust")).alias("provider"), F.col("raw_url").alias("url"))


ORDER_RESULTS = query(
    "order_urls", select=f", r AS (SELECT id, {sql.provider('cust')} AS provider, raw_url AS url FROM order_urls) "
)


@register("fi3_missing_url", ORDER_RESULTS + "SELECT id, provider FROM r WHERE url = ''")
def fi3(spark, sf):
    reason = providers.provider_reject_reason(PROVIDERS, F.col("provider"), F.col("url"))
    return order_results(spark, sf).where(reason == providers.MISSING_URL).select("id", "provider")


@register(
    "fi4_allowlist",
    ORDER_RESULTS
    + """SELECT id, provider, CASE provider WHEN 'seek' THEN 'seek.co.nz,www.seek.co.nz,nz.seek.com'
        WHEN 'trademe' THEN 'trademe.co.nz,www.trademe.co.nz' WHEN 'indeed' THEN 'nz.indeed.com,indeed.com'
        ELSE 'seek.co.nz,trademe.co.nz,nz.indeed.com' END AS domains FROM r""",
)
def fi4(spark, sf):
    listed = providers.allowlist(PROVIDERS, SITE_FILTERS, F.col("provider"))
    return order_results(spark, sf).select("id", "provider", F.array_join(listed, ",").alias("domains"))


@register("fi5_provider_url_rule", ORDER_RESULTS + f"SELECT id, provider, {sql.RULE} AS allowed FROM r")
def fi5(spark, sf):
    rule = providers.result_url_allowed(PROVIDERS, F.col("provider"), F.col("url"))
    return order_results(spark, sf).select("id", "provider", rule.alias("allowed"))


@register(
    "fi6_accept_reject",
    ORDER_RESULTS
    + f"""SELECT id, provider, url, CASE WHEN url = '' THEN 'missing url' WHEN NOT {sql.RULE} THEN 'domain not allowed'
        ELSE 'ok' END AS outcome FROM r""",
)
def fi6(spark, sf):
    judged = order_results(spark, sf).withColumn(
        "reason", providers.provider_reject_reason(PROVIDERS, F.col("provider"), F.col("url"))
    )
    accepted, rejected = providers.split_by_reason(judged)
    return accepted.withColumn("outcome", F.lit("ok")).unionByName(rejected.withColumnRenamed("reason", "outcome"))


@register(
    "fi7_reject_chain",
    with_page_classified("SELECT response_id, pos, clean_url, coalesce(reason, 'ok') AS outcome FROM classified"),
)
def fi7(spark, sf):
    return page_classified(spark, sf).select(
        "response_id", "pos", "clean_url", F.coalesce("reason", F.lit("ok")).alias("outcome")
    )


@register(
    "fi8_high_rate",
    query("rate_silver", select="SELECT source, result_id, hourly_max FROM rate_silver WHERE hourly_max >= 125"),
)
def fi8(spark, sf):
    return classify.gold_rows(stored_silver(spark, sf), 125).select("source", "result_id", "hourly_max")


@register(
    "fi9_listing_url",
    query("order_urls", select="SELECT id, raw_url FROM order_urls WHERE regexp_matches(raw_url, '/a/jobs/.+/listing/[0-9]+')"),
)
def fi9(spark, sf):
    return fx.order_urls(spark, sf).where(F.col("raw_url").rlike(html.LISTING_URL)).select("id", "raw_url")


@register("fi10_blocked", query("page_response", select=f"SELECT page_id, {sql.BLOCKED} AS blocked FROM page_response"))
def fi10(spark, sf):
    blocked = responses.is_blocked(F.col("status"), F.col("body"), F.col("server"))
    return fx.page_responses(spark, sf).select("page_id", blocked.alias("blocked"))


@register(
    "fi11_html_check",
    query(
        "page_response",
        select=f"""SELECT page_id, CASE WHEN NOT {sql.below(sql.host('request_url'), fx.PAGE_DOMAINS)}
                THEN 'url not in allowlist' WHEN {sql.BLOCKED} THEN 'blocked by site protection'
                WHEN status >= 400 THEN 'request failed' WHEN content_type <> 'text/html' THEN 'not html'
                ELSE 'ok' END AS fetch_error
        FROM page_response""",
    ),
)
def fi11(spark, sf):
    error = responses.html_error(
        F.col("request_url"),
        F.col("status"),
        F.col("body"),
        F.col("server"),
        F.col("content_type"),
        fx.PAGE_DOMAINS,
    )
    return fx.page_responses(spark, sf).select("page_id", F.coalesce(error, F.lit("ok")).alias("fetch_error"))


@register(
    "fi12_feed_check",
    query(
        select="""SELECT doc_id, CASE WHEN doc_id % 17 = 0 THEN 'request failed' WHEN doc_id % 7 = 0 THEN 'not xml'
            WHEN doc_id % 13 = 0 THEN 'xml does not parse' ELSE 'ok' END AS fetch_error FROM documents"""
    ),
)
def fi12(spark, sf):
    key, xml = F.col("doc_id"), F.col("xml")
    feeds = fx.feeds(spark, sf)
    feeds = feeds.select(
        "doc_id",
        F.when(key % 17 == 0, 500).otherwise(200).alias("status"),
        F.when(key % 7 == 0, F.concat(F.lit("-" * 300), xml))
        .when(key % 13 == 0, F.replace(xml, F.lit("</channel>"), F.lit("")))
        .otherwise(xml)
        .alias("body"),
    ).withColumn("early", responses.feed_error(F.col("status"), F.col("body")))
    malformed = F.when(F.col("early").isNull(), collect.parse_feed(F.col("body"))["malformed"])
    late = F.when(malformed.isNotNull(), responses.BAD_XML)
    return feeds.select("doc_id", F.coalesce("early", late, F.lit("ok")).alias("fetch_error"))


@register(
    "fi13_enabled_providers",
    query("event_rows", select="SELECT event_id, provider FROM event_rows WHERE provider IN ('seek', 'bing')"),
)
def fi13(spark, sf):
    return providers.only_enabled(fx.event_rows(spark, sf), ("seek", "bing")).select("event_id", "provider")


@register(
    "fi14_mode_gate",
    query(
        "event_rows",
        select="""SELECT event_id, provider, scrape_mode AS mode FROM event_rows
        WHERE scrape_mode = 'rss' OR provider IN ('seek', 'trademe')""",
    ),
)
def fi14(spark, sf):
    rows = fx.event_rows(spark, sf).select("event_id", "provider", F.col("scrape_mode").alias("mode"))
    return providers.only_supported(rows, PROVIDERS, ("rss", "html", "ui"))


# --- joins ----------------------------------------------------------------


def merged_events(spark, sf, small):
    target, batch = fx.event_target(spark, sf), fx.event_batch(spark, sf)
    return upsert.upsert(target, batch, SILVER_KEYS, SILVER_KEPT, small_batch=small)


EVENT_MERGED = query("event_merged", select=f"SELECT {sql.SILVER} FROM event_merged")


@register("jn1_upsert", EVENT_MERGED)
def jn1(spark, sf):
    return merged_events(spark, sf, small=False)


@register("jn1_upsert_small_batch", EVENT_MERGED)
def jn1_small(spark, sf):
    target, batch = fx.event_target(spark, sf), fx.event_batch(spark, sf)
    small = ingest.batch_bytes(batch) <= 64 * 1024 * 1024
    return upsert.upsert(target, batch, SILVER_KEYS, SILVER_KEPT, small_batch=small)


SEARCH_LISTS = """SELECT search_id, provider, i - 1 AS query_ord, list[i] AS {name} FROM (
    SELECT *, unnest(generate_series(1, len(list))) AS i FROM ({lists}))"""
SITE_LISTS = f"""SELECT search_id, provider, flatten(list_transform({sql.texts(SITE_FILTERS)},
        lambda s: ['site:' || s || ' ' || text] || list_transform(terms, lambda t: 'site:' || s || ' ' || text || ' ' || t)))
        AS list
    FROM search_terms, (SELECT unnest(['google', 'bing']) AS provider)"""
PREFIX_LISTS = """SELECT search_id, provider, [prefix || ' ' || text]
        || list_transform(terms, lambda t: prefix || ' ' || text || ' ' || t) AS list
    FROM search_terms, (SELECT unnest([{'provider': 'seek', 'prefix': 'site:seek.co.nz/job'},
        {'provider': 'trademe', 'prefix': 'site:trademe.co.nz/a/jobs'},
        {'provider': 'indeed', 'prefix': 'site:nz.indeed.com'}], recursive := true))"""


def search_lists(lists: str, name: str, select: str = "SELECT * FROM q") -> str:
    return query("search_terms", select=f", q AS ({SEARCH_LISTS.format(lists=lists, name=name)}) {select}")


def queries_of(spark, sf, names):
    chosen = [p for p in PROVIDERS if p.name in names]
    return expand.expand_queries(fx.searches(spark, sf), chosen, SITE_FILTERS)


@register("jn2_expand_by_site", search_lists(SITE_LISTS, "query"))
def jn2(spark, sf):
    return queries_of(spark, sf, ("google", "bing")).drop("feed_url")


@register("jn3_expand_by_provider", search_lists(PREFIX_LISTS, "query"))
def jn3(spark, sf):
    return queries_of(spark, sf, ("seek", "trademe", "indeed")).drop("feed_url")


@register(
    "jn4_domain_join",
    query(
        "order_urls",
        select=f"""SELECT id, raw_url FROM order_urls
        WHERE {sql.below(sql.host('raw_url'), ('seek.co.nz', 'b.trademe.co.nz'))}""",
    ),
)
def jn4(spark, sf):
    # The allowlist is a table; here its rows come from the nations, padded with foreign names.
    nations = tables.read_table(spark, sf, "nation")
    name = (
        F.when(F.col("n_nationkey") == 0, "SEEK.co.nz")
        .when(F.col("n_nationkey") == 1, "b.trademe.co.nz")
        .otherwise(F.concat(F.lower("n_name"), F.lit(".example.org")))
    )
    listed = nations.select(name.alias("domain"))
    return domains.rows_in_domains(fx.order_urls(spark, sf), listed, url="raw_url", store=materialize).select("id", "raw_url")


# --- aggregations ---------------------------------------------------------

SUMMARY = """SELECT provider, scrape_mode, source, count(*) AS total_rows, count(hourly_max) AS rows_with_rate,
    max(hourly_max) AS max_rate, max(last_seen_at) AS latest_seen_at FROM {} GROUP BY ALL"""


@register("ag1_source_summary", query("event_merged", select=SUMMARY.format("event_merged")))
def ag1(spark, sf):
    return aggregates.source_summary(merged_events(spark, sf, small=False))


RUN_REJECTED = "SELECT {} FROM run_rejected WHERE stage = 'ingest' GROUP BY ALL"


def run_plan(spark, sf):
    return ingest.plan_ingest(fx.run_responses(spark, sf), fx.RUN, store=materialize)


def ingest_rejected(spark, sf):
    return run_plan(spark, sf).rejected.where(F.col("stage") == ingest.INGEST_STAGE)


@register(
    "ag2_rejected_by_reason",
    query(
        "run_rejected",
        select=f"""SELECT *, row_number() OVER (ORDER BY rows DESC, reason) AS rank
        FROM ({RUN_REJECTED.format("reason, count(*) AS rows")})""",
    ),
)
def ag2(spark, sf):
    return reports.ranked(reports.reason_report(ingest_rejected(spark, sf)), materialize)


@register(
    "ag3_rejected_by_source",
    query(
        "run_rejected",
        select=f"""SELECT *, row_number() OVER (ORDER BY rows DESC, source, reason) AS rank
        FROM ({RUN_REJECTED.format("source, reason, count(*) AS rows")})""",
    ),
)
def ag3(spark, sf):
    return reports.ranked(reports.source_reason_report(ingest_rejected(spark, sf)), materialize)


@register(
    "ag4_provider_funnel",
    query(
        "run_results",
        select="""SELECT provider, count(*) AS results, count(*) FILTER (reason IS NULL) AS accepted
        FROM run_results GROUP BY 1""",
    ),
)
def ag4(spark, sf):
    return run_plan(spark, sf).funnel


TOTALS = query(
    "run_results",
    "run_payloads",
    select="""SELECT (SELECT count(*) FROM run_payloads) AS bronze_rows,
        (SELECT count(*) FROM run_results WHERE reason IS NULL) AS silver_rows,
        (SELECT count(*) FROM run_results WHERE reason IS NOT NULL) AS rejected_rows,
        (SELECT count(*) FROM run_responses WHERE fetch_error IS NOT NULL) AS warnings""",
)


@register("ag5_run_totals", TOTALS)
def ag5(spark, sf):
    return run_plan(spark, sf).totals


@register(
    "ag6_table_counts",
    query(
        "event_target",
        "event_batch",
        "rate_silver",
        select="""SELECT 'target' AS table_name, count(*) AS rows FROM event_target
            UNION ALL SELECT 'batch', count(*) FROM event_batch UNION ALL SELECT 'rates', count(*) FROM rate_silver""",
    ),
)
def ag6(spark, sf):
    return aggregates.table_counts(
        {"target": fx.event_target(spark, sf), "batch": fx.event_batch(spark, sf), "rates": fx.rate_silver(spark, sf)}
    )


def run_payloads(spark, sf):
    # Numbering reads the responses twice; stored, their bodies are scanned once.
    collected = materialize(collect.collect_responses(fx.run_responses(spark, sf), fx.RUN), "collected")
    listed = providers.allowlist(PROVIDERS, SITE_FILTERS, F.col("provider"))
    return envelope.fold_payloads(collect.payload_input(collected), listed, fx.RUN.responses_per_payload)


DOMAIN_LISTS = """CASE provider WHEN 'seek' THEN ['seek.co.nz', 'www.seek.co.nz', 'nz.seek.com']
    WHEN 'trademe' THEN ['trademe.co.nz', 'www.trademe.co.nz'] WHEN 'indeed' THEN ['nz.indeed.com', 'indeed.com']
    ELSE ['seek.co.nz', 'trademe.co.nz', 'nz.indeed.com'] END"""
BRONZE_SQL = query(
    "run_payloads",
    select=f"""SELECT 'run-1' AS run_id, provider AS source, {sql.STAMP} AS fetched_at,
        to_json(struct_pack(queries := coalesce(queries, []), urls := coalesce(urls, []),
            site_filters := {sql.texts(SITE_FILTERS)}))::VARCHAR AS query,
        to_json(struct_pack(source := provider, provider := provider, mode := 'search', modes := modes,
            allowed_domains := {DOMAIN_LISTS}, queries := coalesce(queries, []), feed_urls := coalesce(feed_urls, []),
            urls := coalesce(urls, []), results := results))::VARCHAR AS response_json
    FROM run_payloads""",
)


@register("ag7_payload_envelope", BRONZE_SQL)
def ag7(spark, sf):
    return run_plan(spark, sf).bronze.drop("result_order")


@register(
    "ag8_run_gates",
    TOTALS.replace("SELECT (SELECT count(*) FROM run_payloads)", "SELECT 'pass' AS gate, (SELECT count(*) FROM run_payloads)"),
)
def ag8(spark, sf):
    totals = run_plan(spark, sf).totals
    counts = totals.first()
    ingest.check_run(counts["bronze_rows"], counts["silver_rows"])
    return tables.typed_rows(spark, [counts], totals.schema).withColumn("gate", F.lit("pass"))


# --- de-duplication -------------------------------------------------------


@register(
    "dd1_page_links_first",
    query(
        "anchors",
        select="""SELECT page_id, pos, regexp_extract(page_url, '^[a-z]+://[^/?#]*') || href AS url FROM anchors
        QUALIFY row_number() OVER (PARTITION BY page_id, href ORDER BY pos) = 1""",
    ),
)
def dd1(spark, sf):
    pages = tables.read_table(spark, sf, "pages")
    firsts = html.first_of_each(html.resolved_anchors(F.col("html"), F.col("url")), "url")
    return scans.unnest(pages, ["page_id"], firsts).select("page_id", "pos", "url")


@register(
    "dd2_canonical_url_first",
    with_page_classified(
        """SELECT clean_url, provider, response_id, pos FROM classified WHERE reason IS NULL"""
    ),
)
def dd2(spark, sf):
    accepted, _ = providers.split_by_reason(page_classified(spark, sf))
    return accepted.select("clean_url", "provider", "response_id", "pos")


@register(
    "dd3_key_first",
    query(
        "event_rows",
        select="""SELECT source, result_id, event_id, title FROM event_rows
        QUALIFY row_number() OVER (PARTITION BY source, result_id ORDER BY ts, event_id) = 1""",
    ),
)
def dd3(spark, sf):
    rows = fx.event_rows(spark, sf).select("source", "result_id", "event_id", "title", "ts")
    return dedupe.first_per_key(rows, SILVER_KEYS, ["ts", "event_id"]).drop("ts")


# --- sorts ----------------------------------------------------------------


@register(
    "so1_gold_order",
    query(
        "rate_silver",
        select=f"""SELECT {sql.GOLD}, row_number() OVER (ORDER BY hourly_max DESC, last_seen_at DESC, source, result_id) AS rank
        FROM rate_silver WHERE hourly_max >= 125""",
    ),
)
def so1(spark, sf):
    return reports.ranked(reports.in_gold_order(classify.gold_rows(stored_silver(spark, sf), 125)), materialize)


@register(
    "so2_recent_top_k",
    query(
        "rate_silver",
        select="""SELECT provider, scrape_mode, source, title, url, content, hourly_min, hourly_max, last_seen_at,
            row_number() OVER (ORDER BY last_seen_at DESC, source, result_id) AS rank FROM rate_silver
        QUALIFY rank <= 25""",
    ),
)
def so2(spark, sf):
    return reports.ranked(reports.recent_report(stored_silver(spark, sf), 25), materialize)


@register(
    "so3_summary_order",
    query(
        "rate_silver",
        select=f"""SELECT *, row_number() OVER (ORDER BY total_rows DESC, provider, scrape_mode, source) AS rank
        FROM ({SUMMARY.format("rate_silver")})""",
    ),
)
def so3(spark, sf):
    return reports.ranked(reports.summary_report(stored_silver(spark, sf)), materialize)


SAMPLE = "stage, source, reason, title, url, content"


@register(
    "so4_rejected_sample",
    query(
        "run_rejected",
        select=f"""SELECT {SAMPLE}, row_number() OVER (ORDER BY provider_ord, mode_ord, query_ord, response_id, pos) AS rank
        FROM run_rejected WHERE stage = 'ingest' QUALIFY rank <= 20""",
    ),
)
def so4(spark, sf):
    return reports.ranked(reports.rejected_sample(ingest_rejected(spark, sf)).select(*SAMPLE.split(", ")), materialize)


@register(
    "so5_first_roles", query("search_terms", select="SELECT search_id, array_to_string(roles, '|') AS roles FROM search_terms")
)
def so5(spark, sf):
    return fx.searches(spark, sf).select(
        "search_id", F.array_join(searches.role_keywords(F.col("keywords")), "|").alias("roles")
    )


# --- unions ---------------------------------------------------------------


@register(
    "un1_union_responses",
    query("run_items", select="SELECT provider, mode, query_ord, count(*) AS items FROM run_items GROUP BY ALL"),
)
def un1(spark, sf):
    collected = collect.collect_responses(fx.run_responses(spark, sf), fx.RUN)
    items = scans.unnest(collected, ["provider", "query_ord"], F.col("items"))
    return items.groupBy("provider", "mode", "query_ord").agg(F.count(F.lit(1)).alias("items"))


@register(
    "un2_union_modes_providers",
    query(
        "run_items",
        select="""SELECT provider, mode, count(*) AS items, count(*) FILTER (reject_reason IS NULL) AS kept
        FROM run_items GROUP BY ALL""",
    ),
)
def un2(spark, sf):
    collected = collect.collect_responses(fx.run_responses(spark, sf), fx.RUN)
    items = scans.unnest(collected, ["provider"], F.col("items"))
    return items.groupBy("provider", "mode").agg(
        F.count(F.lit(1)).alias("items"), F.count_if(F.col("reject_reason").isNull()).alias("kept")
    )


# --- scalar functions -----------------------------------------------------


@register(
    "st1_canonical_url",
    query("order_urls", select=f"SELECT id, {sql.clean('raw_url')} AS clean_url FROM order_urls"),
)
def st1(spark, sf):
    return fx.order_urls(spark, sf).select("id", urls.canonical_url(F.col("raw_url")).alias("clean_url"))


@register("st1_canonical_page_url", f"SELECT page_id, {sql.clean('url')} AS clean_url FROM pages")
def st1_pages(spark, sf):
    return tables.read_table(spark, sf, "pages").select(
        "page_id", urls.canonical_url(F.col("url")).alias("clean_url")
    )


@register(
    "st2_tracking_parameters",
    query("order_urls", select=f"SELECT id, {sql.kept_query('raw_url')} AS kept FROM order_urls"),
)
def st2(spark, sf):
    raw = F.regexp_extract("raw_url", r"\?([^#]*)", 1)
    return fx.order_urls(spark, sf).select("id", urls.clean_query(raw).alias("kept"))


@register(
    "st3_result_id",
    query("order_urls", select="SELECT id, sha256(lower(trim(raw_url || '|' || 'Role ' || id))) AS result_id FROM order_urls"),
)
def st3(spark, sf):
    title = F.concat(F.lit("Role "), F.col("id"))
    return fx.order_urls(spark, sf).select("id", text.result_id(F.col("raw_url"), title).alias("result_id"))


@register("st4_hourly_rate", query("text_rates", select="SELECT id, line, hourly_min, hourly_max FROM text_rates"))
def st4(spark, sf):
    rated = fx.rate_texts(spark, sf).select("id", "line", rates.hourly_rate(F.col("text")).alias("rate"))
    return rated.select("id", "line", "rate.*")


DOCUMENT_RATES = "WITH d AS (" + sql.rated("documents", "doc_id", "text || chr(10) || ' 75 per hour'") + ") SELECT * FROM d"


@register("st4_hourly_rate_documents", DOCUMENT_RATES)
def st4_documents(spark, sf):
    stated = F.concat("text", F.lit("\n 75 per hour"))
    rated = tables.read_table(spark, sf, "documents").select("doc_id", rates.hourly_rate(stated).alias("rate"))
    return rated.select("doc_id", "rate.*")


@register(
    "st5_combined_text",
    "SELECT doc_id, md5('doc ' || doc_id || chr(10) || text || chr(10) || 'https://h.nz/' || doc_id) AS combined FROM documents",
)
def st5(spark, sf):
    combined = text.combined_text(
        F.concat(F.lit("doc "), "doc_id"), F.col("text"), F.concat(F.lit("https://h.nz/"), "doc_id")
    )
    return tables.read_table(spark, sf, "documents").select("doc_id", F.md5(combined).alias("combined"))


RELATIVE = ("/c?x=1#y", "c", "c/../d//e", "../c", "?q=1", "#f", "//K.example/z", "mailto:x@y", "/a/./b/..")


@register(
    "st6_resolve_url",
    rf"""SELECT page_id, href, CASE
            WHEN href = '/c?x=1#y' THEN origin || href
            WHEN href = 'c' THEN origin || folder || 'c'
            WHEN href = 'c/../d//e' THEN origin || folder || 'd/e'
            WHEN href = '../c' THEN origin || regexp_replace(folder, '[^/]+/$', '') || 'c'
            WHEN href = '?q=1' THEN origin || path || '?q=1'
            WHEN href = '#f' THEN origin || path || CASE WHEN q = '' THEN '' ELSE '?' || q END || '#f'
            WHEN href = '//K.example/z' THEN regexp_extract(origin, '^[a-z]+:') || href
            WHEN href = '/a/./b/..' THEN origin || '/a/'
            ELSE href END AS url
        FROM (SELECT *, regexp_replace(path, '[^/]*$', '') AS folder FROM (
            SELECT page_id, regexp_extract(url, '^[a-z]+://[^/?#]*') AS origin,
                regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS path, regexp_extract(url, '\?([^#]*)', 1) AS q
            FROM pages)), (SELECT unnest({sql.texts(RELATIVE)}) AS href)""",
)
def st6(spark, sf):
    pages = tables.read_table(spark, sf, "pages")
    pairs = pages.select("page_id", "url", F.explode(F.array(*map(F.lit, RELATIVE))).alias("href"))
    return pairs.select("page_id", "href", urls.resolve_url(F.col("url"), F.col("href")).alias("url"))


STOPS = (" Listed today", " 3 days ago", " Be an early applicant", "  Quick apply now", " Job closes", "\tFull-time",
         " Part-time x", " Contract Lead", " Contractor", "")


@register(
    "st7_listing_title",
    f"""SELECT p_partkey, {sql.collapse(r"regexp_replace(" + sql.collapse("raw") + r", '\s+(Listed\s+\w+|\d+\s+days?\s+ago|Be an early applicant|Quick apply|Job closes|Full-time|Part-time|Contract)\b.*$', '')")} AS title
    FROM (SELECT p_partkey, p_name || {sql.texts(STOPS)}[p_partkey % 10 + 1] AS raw FROM part)""",
)
def st7(spark, sf):
    raw = F.concat("p_name", fx.pick(STOPS, F.col("p_partkey") % 10))
    return tables.read_table(spark, sf, "part").select("p_partkey", text.listing_title(raw).alias("title"))


@register(
    "st8_title_fallback",
    query(
        "anchors",
        "titles",
        select="""SELECT page_id, pos, coalesce(nullif(text, ''), nullif(page_title, ''), href) AS title
        FROM (SELECT * REPLACE (CASE WHEN pos % 2 = 0 THEN '' ELSE text END AS text,
            CASE WHEN page_id % 2 = 0 THEN '' ELSE page_title END AS page_title) FROM anchors JOIN titles USING (page_id))""",
    ),
)
def st8(spark, sf):
    pages = tables.read_table(spark, sf, "pages")
    title = F.when(F.col("page_id") % 2 == 0, "").otherwise(html.page_title(F.col("html")))
    links = scans.scan_anchors(pages.withColumn("page_title", title), ["page_id", "page_title"])
    shown = F.when(F.col("pos") % 2 == 0, "").otherwise(F.col("text"))
    return links.select("page_id", "pos", text.first_non_empty(shown, F.col("page_title"), F.col("href")).alias("title"))


@register("st9_unescape", f"SELECT page_id, md5({sql.decode('html')}) AS decoded FROM pages")
def st9(spark, sf):
    return tables.read_table(spark, sf, "pages").select(
        "page_id", F.md5(entities.unescape(F.col("html"))).alias("decoded")
    )


@register("st10_snippet", r"SELECT page_id, regexp_replace(substring(html, 1, 5000), '\s+', ' ', 'g') AS snippet FROM pages")
def st10(spark, sf):
    return tables.read_table(spark, sf, "pages").select("page_id", text.snippet(F.col("html")).alias("snippet"))


@register(
    "st10_collapse",
    f"SELECT doc_id, md5({sql.collapse('text')}) AS collapsed FROM documents",
)
def st10_collapse(spark, sf):
    return tables.read_table(spark, sf, "documents").select(
        "doc_id", F.md5(text.collapse(F.col("text"))).alias("collapsed")
    )


@register("st11_item_json", f"SELECT doc_id, {RAW_JSON} AS raw_json FROM ({RAW_SQL})")
def st11(spark, sf):
    fields = (F.col(c) for c in ("content", "mode", "published", "title", "url"))
    return raw_documents(spark, sf).select("doc_id", classify.item_json(*fields).alias("raw_json"))


@register("st12_parse_timestamp", "SELECT event_id, CASE WHEN event_id % 9 <> 0 THEN ts END AS parsed FROM events")
def st12(spark, sf):
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
    written = F.when(F.col("event_id") % 9 == 0, "not a time").otherwise(iso)
    return tables.read_table(spark, sf, "events").select("event_id", times.parse_timestamp(written).alias("parsed"))


@register(
    "st13_rate_terms", query("search_terms", select="SELECT search_id, array_to_string(terms, ' ') AS terms FROM search_terms")
)
def st13(spark, sf):
    terms = searches.rate_terms(F.col("min_rate"), F.col("max_rate"))
    return fx.searches(spark, sf).select("search_id", F.array_join(terms, " ").alias("terms"))


@register("st14_query_text", query("search_terms", select="SELECT search_id, text FROM search_terms"))
def st14(spark, sf):
    return fx.searches(spark, sf).select("search_id", searches.query_text(F.col("keywords")).alias("text"))


def encoded(expression: str) -> str:
    """Form encoding of the characters that occur in the searches."""
    pairs = (("%", "%25"), ("\"", "%22"), ("$", "%24"), (":", "%3A"), ("/", "%2F"), ("*", "%2A"), (" ", "+"))
    return sql.chain(expression, pairs)


FEED_URLS = f"""SELECT search_id, provider, query_ord, CASE provider
        WHEN 'google' THEN 'https://news.google.com/rss/search?q=' || {encoded("query")} || '&hl=en-NZ&gl=NZ&ceid=NZ%3Aen'
        ELSE 'https://www.bing.com/search?q=' || {encoded("query")} || '&format=rss&cc=NZ&setmkt=en-NZ' END AS feed_url
    FROM q"""


@register("st15_feed_url", search_lists(f"{SITE_LISTS} UNION ALL {PREFIX_LISTS}", "query", FEED_URLS))
def st15(spark, sf):
    return queries_of(spark, sf, fx.NAMES).drop("query")


TRADEME_PATH = """'https://www.trademe.co.nz/a/jobs/it/programming-development' || CASE WHEN local THEN '/auckland' ELSE '' END"""
SITES = "'site:seek.co.nz ' || text || ' OR site:trademe.co.nz ' || text || ' OR site:nz.indeed.com ' || text"
PAGE_URL_LISTS = f"""SELECT search_id, 'trademe' AS provider, [{TRADEME_PATH} || '/search?search_string='
            || {encoded("trim(array_to_string(roles, ' ') || CASE WHEN contract THEN ' contract' ELSE '' END)")},
            {TRADEME_PATH}] AS list FROM search_terms
    UNION ALL SELECT search_id, 'indeed', ['https://nz.indeed.com/jobs?q=' || {encoded("text")}] FROM search_terms
    UNION ALL SELECT search_id, 'google', ['https://www.google.com/search?q=' || {encoded(SITES)} || '&hl=en-NZ&gl=NZ'] FROM search_terms
    UNION ALL SELECT search_id, 'bing', ['https://www.bing.com/search?q=' || {encoded(SITES)} || '&cc=NZ&setmkt=en-NZ'] FROM search_terms"""


@register("st15_page_url", search_lists(PAGE_URL_LISTS, "url"))
def st15_pages(spark, sf):
    chosen = [p for p in PROVIDERS if p.name != "seek"]
    return expand.expand_page_urls(fx.searches(spark, sf), chosen, SITE_FILTERS)


SLUG_LISTS = """SELECT search_id, 'seek' AS provider, list_transform(roles, lambda k: 'https://www.seek.co.nz/'
        || replace(replace(lower(k), '.', ''), ' ', '-') || CASE WHEN contract THEN '-contract' ELSE '' END
        || '-jobs/in-' || CASE WHEN local THEN 'All-Auckland' ELSE 'All-New-Zealand' END) AS list FROM search_terms"""


@register("st16_slug_url", search_lists(SLUG_LISTS, "url"))
def st16(spark, sf):
    return expand.expand_page_urls(fx.searches(spark, sf), [p for p in PROVIDERS if p.name == "seek"])


@register(
    "st17_run_stamp", f"SELECT event_id, 'run-1' AS run_id, {sql.STAMP} AS fetched_at FROM events"
)
def st17(spark, sf):
    events = tables.read_table(spark, sf, "events").select("event_id")
    return times.stamp(events, fx.RUN.run_id, fx.RUN.fetched_at)


# --- jobs -----------------------------------------------------------------

RUN_SILVER = query("run_batch", select=f"SELECT {sql.SILVER} FROM run_batch")


@register("jb1_ingest_silver", RUN_SILVER)
def jb1(spark, sf):
    return run_plan(spark, sf).batch


def ingested(spark, sf):
    """The job with all its writes, run twice so that the second run meets a full table."""
    store = new_tables(spark)
    stored = fx.run_responses(spark, sf)
    ingest.run_ingest(spark, stored, store, fx.RUN)
    ingest.run_ingest(spark, stored, store, replace(fx.RUN, run_id="run-2"))
    return store


@register("jb1_ingest_gold_table", query("run_batch", select=f"SELECT {sql.GOLD} FROM run_batch WHERE hourly_max >= 125"))
def jb1_gold(spark, sf):
    return sinks.read_gold(spark, ingested(spark, sf))


@register(
    "jb1_ingest_rejected",
    query("run_rejected", select=f"SELECT {SAMPLE} FROM run_rejected"),
)
def jb1_rejected(spark, sf):
    return run_plan(spark, sf).rejected.select(*SAMPLE.split(", "))


@register("jb1_rebuild_from_bronze", RUN_SILVER)
def jb1_rebuild(spark, sf):
    bronze = materialize(run_plan(spark, sf).bronze, "bronze")
    return ingest.rebuild_batch(bronze, fx.RUN, store=materialize)


@register("jb1_rebuild_small_payloads", RUN_SILVER)
def jb1_rebuild_small(spark, sf):
    """The number of responses in a payload does not matter."""
    settings = replace(fx.RUN, responses_per_payload=3)
    bronze = materialize(ingest.plan_ingest(fx.run_responses(spark, sf), settings, store=materialize).bronze, "bronze")
    return ingest.rebuild_batch(bronze, settings, store=materialize)


@register(
    "jb1_run_tables",
    query(
        "run_rejected",
        "run_responses",
        "run_payloads",
        select="""SELECT 'rejected ' || stage || ' ' || reason AS kept, count(*) AS rows FROM run_rejected GROUP BY ALL
        UNION ALL SELECT 'quarantine ' || fetch_error, count(*) FROM run_responses WHERE fetch_error IS NOT NULL GROUP BY ALL
        UNION ALL SELECT 'bronze_rows', count(*) FROM run_payloads
        UNION ALL SELECT 'warnings', count(*) FROM run_responses WHERE fetch_error IS NOT NULL""",
    ),
)
def jb1_run_tables(spark, sf):
    """What a run leaves beside its tables, read back by run."""
    store = new_tables(spark)
    left = ingest.run_ingest(spark, fx.run_responses(spark, sf), store, fx.RUN)
    kept = lambda df, *text: df.groupBy(F.concat_ws(" ", *text).alias("kept")).agg(F.count(F.lit(1)).alias("rows"))
    counts = left.metrics.select(F.explode(F.create_map(*[x for c in ("bronze_rows", "warnings") for x in (F.lit(c), F.col(c))])).alias("kept", "rows"))
    return (
        kept(left.rejected, F.lit("rejected"), "stage", "reason")
        .unionByName(kept(left.quarantine, F.lit("quarantine"), "fetch_error"))
        .unionByName(counts)
    )


JB2_COLUMNS = ("report", "rank", "provider", "scrape_mode", "source", "title", "url", "hourly_max", "total_rows")


@register(
    "jb2_reports",
    query(
        "run_batch",
        select=f"""SELECT 'summary' AS report, row_number() OVER (ORDER BY total_rows DESC, provider, scrape_mode, source) AS rank,
            provider, scrape_mode, source, NULL AS title, NULL AS url, NULL AS hourly_max, total_rows
        FROM ({SUMMARY.format("run_batch")})
        UNION ALL SELECT 'gold', row_number() OVER (ORDER BY hourly_max DESC, last_seen_at DESC, source, result_id),
            provider, scrape_mode, source, title, url, hourly_max, NULL FROM run_batch WHERE hourly_max >= 125
        UNION ALL (SELECT 'recent', row_number() OVER (ORDER BY last_seen_at DESC, source, result_id) AS rank,
            provider, scrape_mode, source, title, url, hourly_max, NULL FROM run_batch QUALIFY rank <= 100)""",
    ),
)
def jb2(spark, sf):
    batch = materialize(run_plan(spark, sf).batch, "batch")
    made = {
        "summary": reports.summary_report(batch),
        "gold": reports.gold_view(classify.gold_rows(batch, fx.RUN.min_rate)),
        "recent": reports.recent_report(batch),
    }
    empty = {"title": "string", "url": "string", "hourly_max": "double", "total_rows": "bigint"}
    rows = []
    for name, report in made.items():
        whole = reports.ranked(report, materialize).withColumn("report", F.lit(name))
        rows.append(whole.withColumns({c: F.lit(None).cast(kind) for c, kind in empty.items() if c not in whole.columns}).select(*JB2_COLUMNS))
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@register(
    "jb3_cleanup_rerun",
    query(
        "run_payloads",
        "run_batch",
        select="""SELECT 'bronze_runs' AS table_name, count(*) AS rows FROM run_payloads
            UNION ALL SELECT 'silver_results', count(*) FROM run_batch
            UNION ALL SELECT 'gold_high_rate', count(*) FROM run_batch WHERE hourly_max >= 125""",
    ),
)
def jb3_rerun(spark, sf):
    """After a cleanup the same run id fills all tables again."""
    store = new_tables(spark)
    for step in (0, 1):
        ingest.run_ingest(spark, fx.run_responses(spark, sf), store, fx.RUN)
        if not step:
            maintenance.cleanup(spark, store)
    return maintenance.count_tables(spark, store).withColumn("table_name", F.substring_index("table_name", ".", -1))


@register(
    "jb3_cleanup",
    query(
        "run_payloads",
        "run_batch",
        select="""SELECT 'bronze_runs' AS table_name, count(*) * 2 AS rows_before, 0 AS rows_after FROM run_payloads
            UNION ALL SELECT 'silver_results', count(*), 0 FROM run_batch
            UNION ALL SELECT 'gold_high_rate', count(*), 0 FROM run_batch WHERE hourly_max >= 125""",
    ),
)
def jb3(spark, sf):
    store = ingested(spark, sf)
    before = tables.typed_rows(spark, maintenance.count_tables(spark, store).collect(), "table_name string, rows_before bigint")
    _, after = maintenance.cleanup(spark, store)
    joined = before.join(after.withColumnRenamed("rows", "rows_after"), "table_name")
    return joined.withColumn("table_name", F.substring_index("table_name", ".", -1))


ITEM_COLUMNS = "provider, mode, query_ord, response_id, pos, title, url, content, published, reject_reason"


@register("jb4_provider_collect", query("run_items", select=f"SELECT {ITEM_COLUMNS} FROM run_items"))
def jb4(spark, sf):
    collected = collect.collect_responses(fx.run_responses(spark, sf), fx.RUN)
    items = scans.unnest(collected, ["provider", "query_ord", "response_id"], F.col("items"))
    return items.select(*ITEM_COLUMNS.split(", "))


@register(
    "jb5_quarantine",
    query(
        "run_responses",
        select="""SELECT response_id, provider, mode, request_url, fetch_error FROM run_responses
        WHERE fetch_error IS NOT NULL""",
    ),
)
def jb5(spark, sf):
    return run_plan(spark, sf).quarantine.drop("body_start")
