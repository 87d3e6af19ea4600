"""From stored responses to result items: one pass, no shuffle, no union.

Feeds and pages of all providers go through one projection. The rows that leave it
are still one per response, with their items inside.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.feeds import parse_feed
from ..functions.html import link_items
from ..functions.responses import BAD_XML, feed_error, html_error
from ..operators.providers import (
    allowlist,
    only_enabled,
    only_supported,
    provider_reject_reason,
    run_order,
)
from ..settings import HTML, RSS, RunSettings
from ..sources.scans import unnest

QUARANTINE_BODY_CHARS = 1000


def collect_responses(responses: DataFrame, settings: RunSettings) -> DataFrame:
    """Check and scan stored responses.

    Gives one row per response of an enabled provider and mode, with its place in run
    order, ``fetch_error`` (NULL if usable), and ``items``: title, url, content,
    published, mode and the provider's ``reject_reason`` (NULL if accepted). A bad
    response has no items and never fails the job.
    """
    gated = only_enabled(responses, settings.enabled_providers)
    gated = only_supported(gated, settings.providers, settings.enabled_modes)
    provider, mode = F.col("provider"), F.col("mode")
    provider_ord, mode_ord = run_order(settings.providers, provider, mode)
    checked = gated.select(
        *responses.columns,
        provider_ord.alias("provider_ord"),
        mode_ord.alias("mode_ord"),
        allowlist(settings.providers, settings.site_filters, provider).alias("domains"),
    ).withColumn(
        "response_error",
        F.when(mode == RSS, feed_error(F.col("status"), F.col("body"))).otherwise(
            html_error(
                F.col("request_url"),
                F.col("status"),
                F.col("body"),
                F.col("server"),
                F.col("content_type"),
                F.col("domains"),
            )
        ),
    )

    usable = F.col("response_error").isNull()
    listed = [p for p in settings.providers if p.listing_pattern]
    patterns = {p.listing_pattern for p in listed}
    if len(patterns) > 1:
        raise ValueError("listing providers must share one pattern")
    pages = link_items(
        F.col("body"),
        F.col("request_url"),
        F.col("domains"),
        provider.isin(*(p.name for p in listed)),
        *patterns,
    )
    scanned = checked.withColumn(
        "scan",
        F.when(usable & (mode == RSS), parse_feed(F.col("body"))).when(
            usable & (mode == HTML), F.struct(F.lit(None).cast("string").alias("malformed"), pages.alias("items"))
        ),
    )
    items = F.transform(
        F.coalesce(F.col("scan.items"), F.array()),
        lambda x: F.struct(
            x["pos"].alias("pos"),
            x["title"].alias("title"),
            x["url"].alias("url"),
            x["content"].alias("content"),
            x["published"].alias("published"),
            mode.alias("mode"),
            provider_reject_reason(settings.providers, provider, x["url"]).alias("reject_reason"),
        ),
    )
    error = F.coalesce(F.col("response_error"), F.when(F.col("scan.malformed").isNotNull(), BAD_XML))
    return scanned.select(
        "response_id",
        "provider",
        "mode",
        "query_ord",
        "query",
        "request_url",
        "provider_ord",
        "mode_ord",
        error.alias("fetch_error"),
        F.when(error.isNotNull(), F.substring("body", 1, QUARANTINE_BODY_CHARS)).alias("body_start"),
        items.alias("items"),
    )


def quarantine(collected: DataFrame) -> DataFrame:
    """Responses that could not be used; the run goes on without them."""
    return collected.where(F.col("fetch_error").isNotNull()).select(
        "response_id", "provider", "mode", "request_url", "fetch_error", "body_start"
    )


def payload_input(collected: DataFrame) -> DataFrame:
    """Responses with the items their provider accepted, as payloads hold them."""
    accepted = F.filter("items", lambda x: x["reject_reason"].isNull())
    results = F.transform(
        accepted, lambda x: F.struct(x["title"], x["url"], x["content"], x["published"], x["mode"])
    )
    places = F.transform(
        accepted,
        lambda x: F.struct(
            F.col("mode_ord").cast("int").alias("mode_ord"), "query_ord", "response_id", x["pos"].cast("int").alias("pos")
        ),
    )
    return collected.where(F.col("fetch_error").isNull()).select(
        "provider", "mode", "mode_ord", "query_ord", "response_id", "query", "request_url",
        results.alias("results"), places.alias("places"),
    )


PLACE = ("provider", "provider_ord", "mode_ord", "query_ord", "response_id")


def explode_items(collected: DataFrame) -> DataFrame:
    """One row per item with its place in run order."""
    return unnest(collected, PLACE, F.col("items"))


def explode_urls(collected: DataFrame) -> DataFrame:
    """The same with ``pos, url, reject_reason`` only, so that a stored table's texts are not read."""
    names = ("pos", "url", "reject_reason")
    fields = collected.select(*PLACE, *(F.col("items")[name].alias(name) for name in names))
    return unnest(fields, PLACE, F.arrays_zip(*names))
