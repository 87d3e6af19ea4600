"""Scans of stored pages, feeds and bronze payloads as DataFrames.

``keep`` names the columns of the input that every output row repeats.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from ..functions import feeds as feed_functions
from ..functions import html as html_functions
from ..schemas import PAYLOAD, RESULT_ORDER


def unnest(df: DataFrame, keep: Sequence[str], items: Column) -> DataFrame:
    """One row per struct of the array ``items``.

    The outer form with a filter behind it, because for the inner form the optimizer
    adds tests of the array before the step and so computes it up to three times.
    """
    return df.select(*keep, F.inline_outer(items)).where(F.col("pos").isNotNull())


def scan_anchors(pages: DataFrame, keep: Sequence[str], html: str = "html") -> DataFrame:
    """One row per closed link: ``pos, href, text``."""
    return unnest(pages, keep, html_functions.anchors(F.col(html)))


def scan_titles(pages: DataFrame, keep: Sequence[str], html: str = "html") -> DataFrame:
    return pages.select(*keep, html_functions.page_title(F.col(html)).alias("page_title"))


def scan_page_links(
    pages: DataFrame, keep: Sequence[str], domains: Sequence[str] | Column, html: str = "html", base: str = "url"
) -> DataFrame:
    """One row per result link of a page: ``pos, title, url, content, published``."""
    return unnest(pages, keep, html_functions.page_links(F.col(html), F.col(base), domains))


def scan_listing_links(
    pages: DataFrame,
    keep: Sequence[str],
    pattern: str = html_functions.LISTING_URL,
    html: str = "html",
    base: str = "url",
) -> DataFrame:
    """One row per listing link of a page: ``pos, title, url, content, published``."""
    return unnest(pages, keep, html_functions.listing_links(F.col(html), F.col(base), pattern))


def scan_feeds(feeds: DataFrame, keep: Sequence[str], xml: str = "xml") -> DataFrame:
    """One row per feed item, RSS items before Atom entries; malformed feeds give none."""
    return unnest(feeds, keep, feed_functions.parse_feed(F.col(xml))["items"])


def read_rss_files(spark: SparkSession, path: str) -> DataFrame:
    """Items of RSS files, split across tasks by the XML source: ``title, url, content, published``.

    For feeds that are too large for one row. Files carry no item order.
    """
    texts = "title string, link string, description string, pubDate string"
    items = spark.read.format("xml").option("rowTag", "item").option("ignoreSurroundingSpaces", "false")
    return items.schema(texts).load(path).select(
        F.coalesce("title", F.lit("")).alias("title"),
        F.coalesce("link", F.lit("")).alias("url"),
        F.coalesce("description", F.lit("")).alias("content"),
        F.coalesce("pubDate", F.lit("")).alias("published"),
    )


def scan_payloads(bronze: DataFrame, keep: Sequence[str] = ("run_id", "source", "fetched_at")) -> DataFrame:
    """One row per stored result: ``payload_provider, payload_mode, allowed_domains, pos`` and the item.

    ``order`` is its place in run order, NULL for rows that were stored without.
    """
    order = F.col("result_order") if "result_order" in bronze.columns else F.lit(None).cast(ArrayType(RESULT_ORDER))
    parsed = bronze.select(*keep, order.alias("result_order"), F.from_json("response_json", PAYLOAD).alias("payload"))
    named = parsed.select(
        *keep,
        F.col("payload.provider").alias("payload_provider"),
        F.col("payload.mode").alias("payload_mode"),
        F.col("payload.allowed_domains").alias("allowed_domains"),
        F.transform("payload.results", lambda item, i: F.struct(i.alias("pos"), item.alias("item"), F.get("result_order", i).alias("order"))).alias("results"),
    )
    described = (*keep, "payload_provider", "payload_mode", "allowed_domains")
    return unnest(named, described, F.col("results")).select(*described, "pos", "order", "item.*")
