"""Normalise result rows, accept or reject them, and shape silver and rejected rows."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rates import hourly_rate
from ..functions.text import REJECTED_CONTENT_CHARS, combined_text, first_non_empty, or_empty, result_id
from ..functions.urls import canonical_url, domain_allowed
from ..schemas import GOLD, REJECTED, SILVER
from .dedupe import first_claims, flag_claimed
from .providers import DOMAIN_NOT_ALLOWED, DUPLICATE_URL, MISSING_URL

DEFAULT_MODE = "search"
# The order in which results claim a URL, and the unique key of a result within a run.
RUN_ORDER = ("provider_ord", "mode_ord", "query_ord", "response_id", "pos")
ROW_KEY = ("response_id", "pos")


def item_json(content: Column, mode: Column, published: Column, title: Column, url: Column) -> Column:
    """The raw item as JSON with sorted keys; absent values are written as null."""
    fields = F.struct(
        content.alias("content"),
        mode.alias("mode"),
        published.alias("published"),
        title.alias("title"),
        url.alias("url"),
    )
    return F.to_json(fields, {"ignoreNullFields": "false"})


def tag_mode(items: DataFrame, payload_mode: Column) -> DataFrame:
    """Each item keeps its own mode or gets that of its payload."""
    return items.withColumn("mode", F.coalesce(F.col("mode"), payload_mode))


def normalize(
    items: DataFrame, source: Column, provider: Column, config_mode: Column, keep: Sequence[str] = ()
) -> DataFrame:
    """Items with ``mode, title, url, content, published`` in the raw result schema.

    No text is NULL afterwards; the provider falls back to the source and the mode
    to the configured mode, then to ``search``.
    """
    texts = {name: or_empty(F.col(name)) for name in ("title", "url", "content", "published")}
    return items.select(
        *keep,
        first_non_empty(provider, source).alias("provider"),
        first_non_empty(F.col("mode"), F.coalesce(config_mode, F.lit(DEFAULT_MODE))).alias("scrape_mode"),
        or_empty(source).alias("source"),
        *(text.alias(name) for name, text in texts.items()),
        item_json(*(F.col(c) for c in ("content", "mode", "published", "title", "url"))).alias("raw_json"),
    )


def with_clean_url(results: DataFrame) -> DataFrame:
    return results.withColumn("clean_url", canonical_url(F.col("url")))


def url_reject_reason(clean_url: Column, domains: Sequence[str] | Column) -> Column:
    """The reject tests that look at one row only, first match wins."""
    return F.when(clean_url == "", MISSING_URL).when(~domain_allowed(clean_url, domains), DOMAIN_NOT_ALLOWED)


def url_claims(
    results: DataFrame,
    domains: Sequence[str] | Column,
    order: Sequence[str] = RUN_ORDER,
    row_key: Sequence[str] = ROW_KEY,
) -> DataFrame:
    """The first acceptable row of each URL in run order; needs ``clean_url``, ``order`` and the domains only."""
    judged = results.withColumn("reason", url_reject_reason(F.col("clean_url"), domains))
    return first_claims(judged, ["clean_url"], order, row_key, F.col("reason").isNull())


def classify(
    results: DataFrame,
    domains: Sequence[str] | Column,
    order: Sequence[str] = RUN_ORDER,
    row_key: Sequence[str] = ROW_KEY,
    claims: DataFrame | None = None,
) -> DataFrame:
    """Add ``reason``: missing url, domain not allowed, duplicate url, or NULL if accepted.

    ``results`` carry ``clean_url``; the first acceptable row of a URL in run order is
    accepted and rows rejected for other reasons do not claim their URL. ``claims`` are the
    :func:`url_claims` of the same results, if they are at hand.
    """
    claims = url_claims(results, domains, order, row_key) if claims is None else claims
    judged = results.withColumn("reason", url_reject_reason(F.col("clean_url"), domains))
    flagged = flag_claimed(judged, claims, ["clean_url"], row_key)
    reason = F.when(F.col("reason").isNull() & ~F.col("is_first"), DUPLICATE_URL).otherwise(F.col("reason"))
    return flagged.withColumn("reason", reason).drop("is_first")


def silver_rows(accepted: DataFrame, fetched_at: datetime | Column, keep: Sequence[str] = ()) -> DataFrame:
    """Accepted results in the silver schema, seen first and last at the fetch time."""
    seen = fetched_at if isinstance(fetched_at, Column) else F.lit(fetched_at)
    rate = hourly_rate(combined_text(F.col("title"), F.col("content"), F.col("clean_url")))
    shaped = accepted.select(
        *keep,
        "provider",
        "scrape_mode",
        "source",
        F.coalesce(result_id(F.col("clean_url"), F.col("title")), F.lit("")).alias("result_id"),
        "title",
        F.col("clean_url").alias("url"),
        "content",
        "published",
        "raw_json",
        rate.alias("rate"),
        seen.cast("timestamp").alias("first_seen_at"),
        seen.cast("timestamp").alias("last_seen_at"),
    )
    rates = {name: F.col("rate")[name].alias(name) for name in ("hourly_min", "hourly_max")}
    return shaped.select(*keep, *(rates.get(c, F.col(c)) for c in SILVER.fieldNames()))


def rejected_rows(rejected: DataFrame, stage: str, url: str = "clean_url", keep: Sequence[str] = ()) -> DataFrame:
    """Rejected results with their reason and the first 300 characters of content."""
    shaped = rejected.select(
        *keep,
        F.lit(stage).alias("stage"),
        "source",
        "reason",
        "title",
        F.col(url).alias("url"),
        F.substring("content", 1, REJECTED_CONTENT_CHARS).alias("content"),
    )
    return shaped.select(*keep, *REJECTED.fieldNames())


def gold_rows(silver: DataFrame, min_rate: float) -> DataFrame:
    """Rows that reach the rate, in the gold schema; rows without rate never do."""
    return silver.where(F.col("hourly_max") >= F.lit(float(min_rate))).select(*GOLD.fieldNames())
