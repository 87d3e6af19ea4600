"""Checks of stored responses: blocked pages, failed fetches, unusable feeds."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import or_empty
from .urls import host_allowed

# What marks a protection page, and the status codes it comes with.
BLOCK_STATUS = (403, 429, 503)
BLOCK_SERVER = "cloudflare"
BLOCK_MARKERS = (
    "just a moment",
    "checking your browser",
    "challenge.cloudflare.com",
    "cf-chl",
    "captcha",
    "access denied",
    "bot detection",
)
BLOCK_SCAN_CHARS = 5000
# How a feed document starts.
FEED_STARTS = ("<rss", "<?xml", "<feed")
FEED_SCAN_CHARS = 300

NOT_IN_ALLOWLIST = "url not in allowlist"
BLOCKED = "blocked by site protection"
FAILED = "request failed"
NOT_HTML = "not html"
NOT_XML = "not xml"
BAD_XML = "xml does not parse"


def _contains_any(text: Column, words: Sequence[str]) -> Column:
    return reduce(or_, (text.contains(word) for word in words))


def is_blocked(status: Column, body: Column, server: Column) -> Column:
    """A refused request that carries the marks of a protection page."""
    start = F.lower(F.substring(or_empty(body), 1, BLOCK_SCAN_CHARS))
    marked = F.lower(or_empty(server)).contains(BLOCK_SERVER) | _contains_any(start, BLOCK_MARKERS)
    return F.coalesce(status.isin(*BLOCK_STATUS), F.lit(False)) & marked


def html_error(
    url: Column,
    status: Column,
    body: Column,
    server: Column,
    content_type: Column,
    domains: Sequence[str] | Column,
) -> Column:
    """Why a stored page cannot be used, or NULL. The first failing test counts."""
    kind = F.lower(or_empty(content_type))
    return (
        F.when(~host_allowed(url, domains), NOT_IN_ALLOWLIST)
        .when(is_blocked(status, body, server), BLOCKED)
        .when(status >= 400, FAILED)
        .when(~(kind.contains("html") | kind.contains("text/plain")), NOT_HTML)
    )


def feed_error(status: Column, body: Column) -> Column:
    """Why a stored feed cannot be parsed, or NULL; parsing itself is checked later."""
    start = F.lower(F.substring(or_empty(body), 1, FEED_SCAN_CHARS))
    return F.when(status >= 400, FAILED).when(~_contains_any(start, FEED_STARTS), NOT_XML)
