"""Inputs that the registered queries derive from the given tables.

The tables hold no pay rates, feeds or response metadata, so each derivation adds
them by a fixed rule over all rows. ``registry.oracle`` states the same rules in SQL.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postings.functions.rates import hourly_rate
from postings.functions.text import replaced
from postings.schemas import RESPONSES, SILVER
from postings.settings import PROVIDERS, RunSettings
from postings.sources.tables import read_table

RUN = RunSettings(run_id="run-1", fetched_at=datetime(2026, 1, 15, 12, 0, tzinfo=timezone.utc))
NAMES = [p.name for p in PROVIDERS]
PAGE_DOMAINS = ("example.net", "example.com")

HOSTS = ("www.seek.co.nz", "seek.co.nz", "jobs.Seek.co.nz", "www.trademe.co.nz", "nz.indeed.com",
         "evilseek.co.nz", "www.seek.co.nz:443", "a.b.trademe.co.nz")
PATHS = ("/job/{}", "/developer-jobs/in-All-Auckland", "/a/jobs/it/auckland/listing/{}", "/x/{}/", "")
QUERIES = ("", "?utm_source=a&b=1&c=", "?ref=x#top", "?GCLID=1", "#frag", "?q=a+b&x=1&&tracking=z", "?k")


def pick(values, index: Column) -> Column:
    return F.get(F.array(*map(F.lit, values)), index.cast("int"))


def provider_name(key: Column) -> Column:
    return pick(NAMES, key % 5)


def order_urls(spark: SparkSession, sf: str) -> DataFrame:
    """One URL per order: ``id, cust, raw_url``; every eleventh is missing."""
    key = F.col("o_orderkey")
    path = F.replace(pick(PATHS, F.floor(key / 8) % 5), F.lit("{}"), F.col("o_custkey").cast("string"))
    url = F.concat(F.lit("https://"), pick(HOSTS, key % 8), path, pick(QUERIES, F.floor(key / 40) % 7))
    return read_table(spark, sf, "orders").select(
        key.alias("id"),
        F.col("o_custkey").alias("cust"),
        F.when(key % 11 == 0, "").otherwise(url).alias("raw_url"),
    )


def rate_texts(spark: SparkSession, sf: str) -> DataFrame:
    """One text per order line that may state a rate: ``id, line, part, ..., text``."""
    n, m = F.col("l_partkey") % 400, F.col("l_suppkey") % 97 + 60
    form = F.col("l_orderkey") % 7
    text = (
        F.when(form == 0, F.format_string("$%d/h", n))
        .when(form == 1, F.format_string("$%d - $%d per hour", n, m))
        .when(form == 2, F.format_string("NZD %d.50 an hour", n))
        .when(form == 3, F.format_string("Rate %d-%d + GST", m, n))
        .when(form == 4, F.format_string("posted 2026-01-15, $1,%d ph", n))
        .when(form == 5, F.format_string("salary %d only", F.col("l_partkey")))
        .otherwise(F.format_string("was %d now %d hourly rate", F.col("l_suppkey"), n))
    )
    return read_table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("id"),
        F.col("l_linenumber").alias("line"),
        F.col("l_returnflag").alias("flag"),
        F.col("l_linestatus").alias("status"),
        F.col("l_shipdate").cast("timestamp").alias("seen"),
        text.alias("text"),
    )


def rate_silver(spark: SparkSession, sf: str) -> DataFrame:
    """The rate texts as a silver table."""
    texts = rate_texts(spark, sf).withColumn("rate", hourly_rate(F.col("text")))
    key = F.concat_ws("-", F.col("id"), F.col("line"))
    return texts.select(
        provider_name(F.col("id")).alias("provider"),
        F.when(F.col("status") == "F", "rss").otherwise("html").alias("scrape_mode"),
        F.col("flag").alias("source"),
        key.alias("result_id"),
        F.concat(F.lit("Role "), key).alias("title"),
        F.concat(F.lit("https://h.nz/job/"), key).alias("url"),
        F.col("text").alias("content"),
        F.lit("").alias("published"),
        F.lit("{}").alias("raw_json"),
        F.col("rate.hourly_min").alias("hourly_min"),
        F.col("rate.hourly_max").alias("hourly_max"),
        F.col("seen").alias("first_seen_at"),
        F.col("seen").alias("last_seen_at"),
    )


def event_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Events as sightings of results, in the silver schema with ``event_id`` and ``ts``."""
    rate = F.when(F.col("event_id") % 3 != 0, F.col("value"))
    return read_table(spark, sf, "events").select(
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        provider_name(F.col("user_id")).alias("provider"),
        F.when(F.col("user_id") % 2 == 0, "rss").otherwise("html").alias("scrape_mode"),
        F.col("event_type").alias("source"),
        F.concat_ws("-", F.col("user_id"), F.hour("ts") % 4).alias("result_id"),
        F.concat(F.lit("Event "), F.col("event_id")).alias("title"),
        F.concat(F.lit("https://h.nz/e/"), F.col("event_id")).alias("url"),
        F.col("props").alias("content"),
        F.lit("").alias("published"),
        F.col("props").alias("raw_json"),
        rate.alias("hourly_min"),
        rate.alias("hourly_max"),
    )


SPLIT_TS = "2024-01-16"


def event_target(spark: SparkSession, sf: str) -> DataFrame:
    """Silver before the run: the last sighting of each key, with its first time."""
    rows = event_rows(spark, sf).where(F.col("ts") < F.lit(SPLIT_TS).cast("timestamp"))
    return _last_per_key(rows).select(*SILVER.fieldNames())


def event_silver(spark: SparkSession, sf: str) -> DataFrame:
    """Silver over all events: the last sighting of each key, with its first time."""
    return _last_per_key(event_rows(spark, sf)).select(*SILVER.fieldNames())


def event_batch(spark: SparkSession, sf: str) -> DataFrame:
    """The batch of the run, one row per key."""
    rows = event_rows(spark, sf).where(F.col("ts") >= F.lit(SPLIT_TS).cast("timestamp"))
    return _last_per_key(rows).withColumn("first_seen_at", F.col("last_seen_at")).select(*SILVER.fieldNames())


def _last_per_key(rows: DataFrame) -> DataFrame:
    keys = ["source", "result_id"]
    rest = [c for c in rows.columns if c not in (*keys, "ts", "event_id")]
    return (
        rows.groupBy(*keys)
        .agg(
            F.max_by(F.struct(*rest), F.col("event_id")).alias("last"),
            F.min("ts").alias("first_seen_at"),
            F.max("ts").alias("last_seen_at"),
        )
        .select(*keys, "last.*", "first_seen_at", "last_seen_at")
    )


# --- feeds ---------------------------------------------------------------


def escaped(text: Column) -> Column:
    for plain, reference in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = replaced(text, plain, reference)
    return text


def document_lines(text: Column) -> Column:
    return F.split(text, "\n")


def item_url(doc: Column, line: Column) -> Column:
    """URL of a feed item: lines alternate between sites, documents share keys."""
    key = (doc % 97).cast("string")
    return (
        F.when(line % 4 == 0, F.concat(F.lit("https://www.seek.co.nz/job/"), key, F.lit("/?utm_source=f&p="), line))
        .when(line % 4 == 1, F.concat(F.lit("https://www.trademe.co.nz/a/jobs/auckland/"), key, F.lit("-"), line))
        .when(line % 4 == 2, F.concat(F.lit("https://NZ.indeed.com/viewjob?jk="), key, F.lit("&gclid=1")))
        .otherwise(F.concat(F.lit("https://other.example.org/"), key))
    )


def item_content(doc: Column, text: Column) -> Column:
    return F.concat(F.lit("$"), (doc % 250 + 50).cast("string"), F.lit(" per hour. "), text)


def rss_document(doc: Column, text: Column) -> Column:
    """An RSS 2.0 feed with one item per line of a document."""
    # Texts are escaped as a whole, which adds and drops no line end.
    items = F.transform(
        document_lines(escaped(text)),
        lambda t, i: F.concat(
            F.lit("<item><title>doc "),
            doc.cast("string"),
            F.lit("</title><link>"),
            escaped(item_url(doc, i)),
            F.lit("</link><description>"),
            item_content(doc, t),
            F.when(i % 2 == 0, F.concat(F.lit("</description><pubDate>day "), i, F.lit("</pubDate></item>"))).otherwise(
                "</description></item>"
            ),
        ),
    )
    head = '<?xml version="1.0" encoding="utf-8"?><rss version="2.0"><channel><title>feed</title>'
    return F.concat(F.lit(head), F.array_join(items, ""), F.lit("</channel></rss>"))


def atom_entries(doc: Column, text: Column, namespace: str) -> Column:
    entries = F.transform(
        document_lines(escaped(text)),
        lambda t, i: F.concat(
            F.lit(f'<entry{namespace}><title type="html">doc '),
            doc.cast("string"),
            F.lit('</title><link rel="self" href="'),
            escaped(item_url(doc, i)),
            F.lit('"/><link href="second"/>'),
            F.when(i % 3 == 0, F.lit("<summary></summary><content>")).otherwise("<summary>"),
            t,
            F.when(i % 3 == 0, F.lit("</content>")).otherwise("</summary><content>unused</content>"),
            F.when(i % 2 == 0, F.lit("<published>p</published>")).otherwise(""),
            F.lit("<updated>u</updated></entry>"),
        ),
    )
    return F.array_join(entries, "")


ATOM_NAMESPACE = ' xmlns="http://www.w3.org/2005/Atom"'


def atom_document(doc: Column, text: Column) -> Column:
    return F.concat(F.lit(f"<feed{ATOM_NAMESPACE}>"), atom_entries(doc, text, ""), F.lit("</feed>"))


def nested_document(doc: Column, text: Column) -> Column:
    """Items at every depth: one at the root ahead of the channel, then by line: a direct item; one
    inside a group whose CDATA title holds ``<item>``; a commented-out item, then an item that holds
    another; an Atom entry inside the RSS channel."""
    d = doc.cast("string")

    def line(t: Column, i: Column) -> Column:
        body = F.concat(F.lit("<description>"), escaped(t), F.lit("</description>"))
        return (
            F.when(i % 4 == 0, F.concat(F.lit("<item><title>doc "), d, F.lit("</title>"), body, F.lit("</item>")))
            .when(i % 4 == 1, F.concat(F.lit("<group><item><title><![CDATA[doc "), d, F.lit(" <item> x]]></title>"), body, F.lit("</item></group>")))
            .when(i % 4 == 2, F.concat(F.lit("<!-- <item><title>ghost</title></item> --><item><title>doc "), d, F.lit("</title>"), body, F.lit("<item><title>inner "), d, F.lit("</title></item></item>")))
            .otherwise(F.concat(F.lit(f"<entry{ATOM_NAMESPACE}><title>doc "), d, F.lit("</title><summary>"), escaped(t), F.lit("</summary></entry>")))
        )

    head = F.concat(F.lit("<rss><item><title>first "), d, F.lit("</title></item><channel>"))
    return F.concat(head, F.array_join(F.transform(document_lines(text), line), ""), F.lit("</channel></rss>"))


def mixed_document(doc: Column, text: Column) -> Column:
    """Atom entries ahead of RSS items in one channel."""
    item = F.concat(F.lit("<item><title>rss "), doc.cast("string"), F.lit("</title></item>"))
    return F.concat(
        F.lit("<rss><channel>"), atom_entries(doc, text, ATOM_NAMESPACE), item, F.lit("</channel></rss>")
    )


def feeds(spark: SparkSession, sf: str, build=rss_document) -> DataFrame:
    documents = read_table(spark, sf, "documents")
    return documents.select("doc_id", build(F.col("doc_id"), F.col("text")).alias("xml"))


# --- stored responses ----------------------------------------------------


def page_responses(spark: SparkSession, sf: str) -> DataFrame:
    """Pages with response metadata by ``page_id``, as FI10 and FI11 need them."""
    key = F.col("page_id")
    status = F.when(key % 10 == 0, 403).when(key % 10 == 1, 429).when(key % 10 == 2, 503).when(key % 10 == 3, 404)
    return read_table(spark, sf, "pages").select(
        "page_id",
        F.col("url").alias("request_url"),
        status.otherwise(200).alias("status"),
        F.when(key % 3 == 0, "cloudflare").otherwise("nginx").alias("server"),
        F.when(key % 7 == 0, "application/pdf").otherwise("text/html").alias("content_type"),
        F.concat(F.when(key % 5 == 0, "Just a moment...").otherwise(""), F.col("html")).alias("body"),
    )


def run_responses(spark: SparkSession, sf: str) -> DataFrame:
    """All stored responses of a run: a page per row of ``pages``, a feed per document.

    Pages are moved below the site of their provider and their links below its job
    paths, so that the provider rules have results to accept. A twentieth of the pages is of a
    provider without pages, for the mode gate.
    """
    key = F.col("page_id")
    site = F.when(key % 2 == 0, "https://www.seek.co.nz/page/").otherwise("https://www.trademe.co.nz/page/")
    link = F.when(key % 2 == 0, F.lit('href="/job')).otherwise(
        F.concat(F.lit('href="/a/jobs/auckland/x/listing/'), key % 7)
    )
    pages = read_table(spark, sf, "pages").select(
        (key * 2).alias("response_id"),
        F.when(key % 20 == 19, "indeed").when(key % 2 == 0, "seek").otherwise("trademe").alias("provider"),
        F.lit("html").alias("mode"),
        key.alias("query_ord"),
        F.lit("").alias("query"),
        F.concat(site, key).alias("request_url"),
        F.when(key % 10 == 5, 503).otherwise(200).alias("status"),
        F.when(key % 3 == 0, "cloudflare").otherwise("nginx").alias("server"),
        F.when(key % 11 == 0, "application/pdf").otherwise("text/html").alias("content_type"),
        F.replace(F.col("html"), F.lit('href="'), link).alias("body"),
    )
    doc = F.col("doc_id")
    xml = rss_document(doc, F.col("text"))
    body = F.when(doc % 13 == 0, F.replace(xml, F.lit("</channel>"), F.lit(""))).otherwise(xml)
    documents = read_table(spark, sf, "documents").select(
        (doc * 2 + 1).alias("response_id"),
        provider_name(doc).alias("provider"),
        F.lit("rss").alias("mode"),
        doc.alias("query_ord"),
        F.concat(F.lit("query "), doc).alias("query"),
        F.concat(F.lit("https://feeds.example.com/"), doc).alias("request_url"),
        F.when(doc % 17 == 0, 500).otherwise(200).alias("status"),
        F.lit("").alias("server"),
        F.lit("application/rss+xml").alias("content_type"),
        body.alias("body"),
    )
    aligned = [
        df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in RESPONSES.fields)) for df in (pages, documents)
    ]
    return aligned[0].unionByName(aligned[1])


def searches(spark: SparkSession, sf: str) -> DataFrame:
    """Saved searches from parts: ``search_id, keywords, min_rate, max_rate``."""
    key, size = F.col("p_partkey"), F.col("p_size").cast("double")
    none = F.array().cast("array<string>")
    keywords = F.concat(
        F.split("p_name", " "),
        F.when(key % 2 == 0, F.array(F.lit("Auckland"))).otherwise(none),
        F.when(key % 3 == 0, F.array(F.lit("contract"))).otherwise(none),
        F.when(key % 7 == 0, F.array(F.lit(".NET C* ~x"))).otherwise(none),
    )
    low = F.when(key % 5 != 0, size + 100)
    high = F.when(key % 3 == 1, low).when(key % 3 == 2, low + 50)
    return read_table(spark, sf, "part").select(
        key.alias("search_id"), keywords.alias("keywords"), low.alias("min_rate"), high.alias("max_rate")
    )
