"""HTML scans as Column expressions: anchors, title, page links, listing links.

A page is scanned inside its own row. Links leave the row only after they are
resolved, filtered and de-duplicated, so the scan needs no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import entities
from .entities import unescape
from .text import collapse, first_non_empty, let, listing_title, or_empty
from .urls import base_parts, host_allowed, resolve

# Comments, scripts and styles hold no tags.
_HIDDEN = r"(?is)<!--.*?-->|<(script|style)\b.*?</\1\s*>"
_TAG = r"<[A-Za-z/!?][^>]*>"
_TITLE = r"(?is)<title(?=[\s>])[^>]*>(.*?)</title\s*>"
_ANCHOR_END = r"(?i)</a\s*>"
# An anchor written <a href="x" /> is closed at once.
_SELF_CLOSED = r"(?is)(<a\s[^>]*[\"'\s])/>"
_ATTRIBUTE = r"[^\s/>=][^\s/>=]*+(?:\s*=\s*(?:\"[^\"]*\"|'[^']*'|[^\s\"'>][^\s>]*+))?"
_OPEN_TO_HREF = r"<a(?:[\s/]+(?!href[\s=/>])" + _ATTRIBUTE + r")*+[\s/]+href\s*=\s*"
_VALUE = r"(?:\"([^\"]+)\"|'([^']+)'|([^\s\"'>][^\s>]*))"
_REST_OF_TAG = r"(?:[^\"'>]++|\"[^\"]*\"|'[^']*')*+>"
# The greedy start finds the last opening tag with a link before the end tag:
# a new link discards an unfinished one, an anchor without link does not.
_LAST_OPEN = r"(?is)^.*(" + _OPEN_TO_HREF + _VALUE + _REST_OF_TAG + r".*)$"
_OPEN = r"(?is)^" + _OPEN_TO_HREF + _VALUE

# Fixed value: what a job listing URL looks like.
LISTING_URL = r"/a/jobs/.+/listing/[0-9]+"

LINK_ITEM = "struct<pos:int,title:string,url:string,content:string,published:string>"


def visible(html: Column) -> Column:
    """The page without comments, scripts and styles."""
    return F.regexp_replace(or_empty(html), _HIDDEN, " ")


def _text(markup: Column, names: Column) -> Column:
    """Text of a fragment: tags become spaces, references are decoded, blanks collapsed."""
    return collapse(unescape(F.regexp_replace(markup, _TAG, " "), names))


def anchors(html: Column) -> Column:
    """All closed links of a page: ``array<struct<pos,href,text>>`` in page order."""
    return let(entities.names(), lambda names: _anchors(visible(html), names))


def _anchors(page: Column, names: Column) -> Column:
    closed = F.regexp_replace(page, _SELF_CLOSED, "$1></a>")
    # The piece after the last end tag belongs to no closed anchor.
    pieces = let(F.split(closed, _ANCHOR_END), lambda p: F.slice(p, F.lit(1), F.size(p) - 1))
    opened = F.filter(
        F.transform(pieces, lambda p, i: F.struct(i.alias("pos"), F.regexp_extract(p, _LAST_OPEN, 1).alias("tail"))),
        lambda x: x["tail"] != "",
    )

    def link(x: Column) -> Column:
        tail = x["tail"]
        href = F.concat(*(F.regexp_extract(tail, _OPEN, group) for group in (1, 2, 3)))
        body = F.regexp_replace(tail, r"(?is)^" + _OPEN_TO_HREF + _VALUE + _REST_OF_TAG, "")
        # Anchor text is decoded by the page parser and once more as text.
        return F.struct(
            x["pos"], unescape(href, names).alias("href"), unescape(_text(body, names), names).alias("text")
        )

    return F.transform(opened, link)


def page_title(html: Column) -> Column:
    """Text of the last title element, empty if there is none."""
    return let(entities.names(), lambda names: _title(visible(html), names))


def _title(page: Column, names: Column) -> Column:
    found = F.regexp_extract_all(page, F.lit(_TITLE), F.lit(1))
    return let(found, lambda t: F.when(F.size(t) > 0, _text(F.element_at(t, -1), names)).otherwise(F.lit("")))


def first_of_each(items: Column, key: str) -> Column:
    """Keep the first item (lowest ``pos``) per value of ``key``, inside the row.

    Sorting the array costs n log n and, unlike a window, no shuffle. ``pos`` must be
    the first field of the items, whose order is restored by it.
    """
    keyed = F.sort_array(F.transform(items, lambda x: F.struct(x[key].alias("key"), x["pos"].alias("pos"), x.alias("item"))))
    firsts = let(
        keyed,
        lambda s: F.filter(s, lambda x, i: (i == 0) | (F.get(s, i - 1)["key"] != x["key"])),
    )
    return F.sort_array(F.transform(firsts, lambda x: x["item"]))


def resolved_anchors(html: Column, base: Column) -> Column:
    """Anchors with their absolute URL: ``array<struct<pos,url,text>>``."""
    return _resolved(anchors(html), base)


def _resolved(found: Column, base: Column) -> Column:
    return let(
        base_parts(base),
        lambda b: F.transform(
            found, lambda a: F.struct(a["pos"], resolve(b, a["href"]).alias("url"), a["text"])
        ),
    )


def link_items(
    html: Column,
    base: Column,
    domains: Sequence[str] | Column,
    is_listing: Column | None = None,
    pattern: str = LISTING_URL,
) -> Column:
    """Result items of a page as of :func:`page_links`, or where ``is_listing`` of :func:`listing_links`."""
    is_listing = F.lit(False) if is_listing is None else is_listing

    def wanted(link: Column) -> Column:
        return F.when(is_listing, link["url"].rlike(pattern)).otherwise(host_allowed(link["url"], domains))

    def item(link: Column, page_title: Column) -> Column:
        return let(
            first_non_empty(link["text"], page_title, link["url"]),
            lambda text: let(
                F.when(is_listing, listing_title(text)).otherwise(text),
                lambda title: F.struct(
                    link["pos"],
                    title.alias("title"),
                    link["url"],
                    F.when(is_listing, title).otherwise(F.concat(page_title, F.lit(" "), title)).alias("content"),
                    F.lit("").alias("published"),
                ),
            ),
        )

    def items(page: Column, names: Column) -> Column:
        links = first_of_each(F.filter(_resolved(_anchors(page, names), base), wanted), "url")
        return let(_title(page, names), lambda title: F.transform(links, lambda link: item(link, title)))

    return let(entities.names(), lambda names: let(visible(html), lambda page: items(page, names)))


def page_links(html: Column, base: Column, domains: Sequence[str] | Column) -> Column:
    """Result items of a page: links inside the (closed) allowlist, first of each URL.

    The title falls back from the link text to the page title to the URL, and the
    content is the page title followed by the title.
    """
    return link_items(html, base, domains)


def listing_links(html: Column, base: Column, pattern: str = LISTING_URL) -> Column:
    """Result items of a listing page: links whose URL matches, with cleaned titles.

    The host is not tested here and the content is the title.
    """
    return link_items(html, base, (), F.lit(True), pattern)
