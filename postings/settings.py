"""Provider table and run settings."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from .functions.html import LISTING_URL

RSS, HTML, UI = "rss", "html", "ui"
# Within a provider feeds come before pages, pages before browser results.
MODES = (RSS, HTML, UI)


@dataclass(frozen=True)
class Provider:
    """What a provider offers and which of its result URLs count.

    ``domains`` is its own allowlist, or None when the site filters of the run
    apply. A result URL must contain one of ``any_of`` and all of ``all_of``.
    ``query_prefix`` is put before search texts, or None for one search per site.
    """

    name: str
    supports: tuple[str, ...]
    domains: tuple[str, ...] | None = None
    any_of: tuple[str, ...] = ()
    all_of: tuple[str, ...] = ()
    listing_pattern: str | None = None
    query_prefix: str | None = None
    feed_endpoint: str = "https://www.bing.com/search"
    feed_parameters: tuple[tuple[str, str], ...] = (("format", "rss"), ("cc", "NZ"), ("setmkt", "en-NZ"))


# The providers in run order.
PROVIDERS = (
    Provider(
        name="seek",
        supports=(RSS, HTML),
        domains=("seek.co.nz", "www.seek.co.nz", "nz.seek.com"),
        any_of=("/job/", "-jobs/in-", "/jobs/in-"),
        query_prefix="site:seek.co.nz/job",
    ),
    Provider(
        name="trademe",
        supports=(RSS, HTML),
        domains=("trademe.co.nz", "www.trademe.co.nz"),
        all_of=("trademe.co.nz", "/auckland/"),
        listing_pattern=LISTING_URL,
        query_prefix="site:trademe.co.nz/a/jobs",
    ),
    Provider(
        name="indeed",
        supports=(RSS,),
        domains=("nz.indeed.com", "indeed.com"),
        all_of=("indeed.com",),
        query_prefix="site:nz.indeed.com",
    ),
    Provider(
        name="google",
        supports=(RSS,),
        feed_endpoint="https://news.google.com/rss/search",
        feed_parameters=(("hl", "en-NZ"), ("gl", "NZ"), ("ceid", "NZ:en")),
    ),
    Provider(name="bing", supports=(RSS,)),
)

# Defaults of a run.
SITE_FILTERS = ("seek.co.nz", "trademe.co.nz", "nz.indeed.com")
MIN_RATE = 125
ENABLED_MODES = (RSS, HTML)
RECENT_ROWS = 100
REJECTED_SAMPLE_ROWS = 20


@dataclass(frozen=True)
class RunSettings:
    """Everything a run depends on besides its input; ids and times are given, not drawn."""

    run_id: str
    fetched_at: datetime
    providers: Sequence[Provider] = PROVIDERS
    site_filters: Sequence[str] = SITE_FILTERS
    enabled_providers: Sequence[str] | None = None
    enabled_modes: Sequence[str] = ENABLED_MODES
    min_rate: float = MIN_RATE
    # Responses per bronze row: bounds what one task must hold for one payload.
    responses_per_payload: int = 64
    # Buckets of silver; a current version with another number is spread anew. Without it, a
    # version keeps its number and a first load gets a bucket for each 200 MB of text.
    silver_buckets: int | None = None
