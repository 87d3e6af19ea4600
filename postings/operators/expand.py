"""Search expansion: the feed queries and page URLs of every saved search.

All functions take searches with ``search_id, keywords, min_rate, max_rate`` and
explode literal arrays inside the row: no join, no shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.searches import (
    CONTRACT_WORD,
    PLACE_WORD,
    has_word,
    query_text,
    rate_terms,
    role_keywords,
    role_slugs,
    search_texts,
    search_url,
)
from ..settings import Provider
from ..sources.scans import unnest


def _texts(prefix: str, trimmed: bool) -> Column:
    return search_texts(
        query_text(F.col("keywords")), rate_terms(F.col("min_rate"), F.col("max_rate")), prefix, trimmed
    )


def _unnest_texts(searches: DataFrame, per_provider: Column, texts: str, name: str) -> DataFrame:
    """One row per provider and text, numbered within the provider."""
    numbered = F.flatten(
        F.transform(
            per_provider,
            lambda p: F.transform(
                p[texts], lambda t, i: F.struct(p["provider"].alias("provider"), i.alias("pos"), t.alias(name))
            ),
        )
    )
    return unnest(searches, ["search_id"], numbered).withColumnRenamed("pos", "query_ord")


def expand_queries(
    searches: DataFrame, providers: Sequence[Provider], site_filters: Sequence[str] = ()
) -> DataFrame:
    """Feed queries: ``search_id, provider, query_ord, query, feed_url``.

    A provider with its own prefix has one base query per search, the others one per
    site (or one without site); each base query is followed by one per rate term.
    """

    def queries(p: Provider) -> Column:
        if p.query_prefix is not None:
            return _texts(p.query_prefix, trimmed=False)
        prefixes = [f"site:{site}" for site in site_filters] or [""]
        return F.concat(*(_texts(prefix, trimmed=True) for prefix in prefixes))

    per_provider = F.array(
        *(
            F.struct(
                F.lit(p.name).alias("provider"),
                queries(p).alias("queries"),
            )
            for p in providers
        )
    )
    exploded = _unnest_texts(searches, per_provider, "queries", "query")
    url = F
    for p in providers:
        url = url.when(F.col("provider") == p.name, search_url(p.feed_endpoint, F.col("query"), "q", p.feed_parameters))
    return exploded.withColumn("feed_url", url)


def seek_urls(keywords: Column) -> Column:
    """Page URLs with the role in the path, one per role keyword."""
    place = F.when(has_word(keywords, PLACE_WORD), F.lit("All-Auckland")).otherwise(F.lit("All-New-Zealand"))
    contract = F.when(has_word(keywords, CONTRACT_WORD), F.lit("-contract")).otherwise(F.lit(""))
    return F.transform(
        role_slugs(keywords),
        lambda slug: F.concat(F.lit("https://www.seek.co.nz/"), slug, contract, F.lit("-jobs/in-"), place),
    )


def trademe_urls(keywords: Column) -> Column:
    """The search page with the role keywords, then the category page."""
    place = F.when(has_word(keywords, PLACE_WORD), F.lit("/auckland")).otherwise(F.lit(""))
    path = F.concat(F.lit("https://www.trademe.co.nz/a/jobs/it/programming-development"), place)
    roles = F.array_join(role_keywords(keywords), " ")
    text = F.when(has_word(keywords, CONTRACT_WORD), F.trim(F.concat(roles, F.lit(" contract")))).otherwise(roles)
    return F.array(F.concat(path, search_url("/search", text, "search_string")), path)


def indeed_urls(keywords: Column) -> Column:
    return F.array(search_url("https://nz.indeed.com/jobs", query_text(keywords), "q"))


def web_urls(endpoint: str, fixed: Sequence[tuple[str, str]]) -> Callable[[Column, Sequence[str]], Column]:
    """The result page of a web search, for any of the sites."""

    def urls(keywords: Column, sites: Sequence[str]) -> Column:
        text = query_text(keywords)
        parts = [F.concat(F.lit(f"site:{site} "), text) for site in sites]
        return F.array(search_url(endpoint, F.concat_ws(" OR ", *parts) if parts else text, "q", fixed))

    return urls


PAGE_URLS = {
    "seek": lambda keywords, sites: seek_urls(keywords),
    "trademe": lambda keywords, sites: trademe_urls(keywords),
    "indeed": lambda keywords, sites: indeed_urls(keywords),
    "google": web_urls("https://www.google.com/search", (("hl", "en-NZ"), ("gl", "NZ"))),
    "bing": web_urls("https://www.bing.com/search", (("cc", "NZ"), ("setmkt", "en-NZ"))),
}


def expand_page_urls(searches: DataFrame, providers: Sequence[Provider], sites: Sequence[str] = ()) -> DataFrame:
    """Page URLs: ``search_id, provider, query_ord, url``. Web searches are limited to ``sites``."""
    if unknown := [p.name for p in providers if p.name not in PAGE_URLS]:
        raise ValueError(f"no page URLs are known for {', '.join(unknown)}")
    per_provider = F.array(
        *(
            F.struct(F.lit(p.name).alias("provider"), PAGE_URLS[p.name](F.col("keywords"), sites).alias("urls"))
            for p in providers
        )
    )
    return _unnest_texts(searches, per_provider, "urls", "url")
