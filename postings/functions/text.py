"""Text expressions: trimming, collapsing, fallbacks, ids and snippets.

Every function takes and returns a ``Column`` and uses built-in functions only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Code points of the Unicode whitespace characters.
_BLANK_CODES = (*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
                0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
WHITESPACE = "".join(map(chr, _BLANK_CODES))
# The same set as a regex class. Spelled out because the Java blank class is ASCII only.
BLANK = "[" + "".join(rf"\x{{{code:x}}}" for code in _BLANK_CODES) + "]"

# Phrases that end a listing title (matched with case, in a collapsed title).
LISTING_TITLE_STOPS = (
    r"Listed \w+",
    r"\d+ days? ago",
    "Be an early applicant",
    "Quick apply",
    "Job closes",
    "Full-time",
    "Part-time",
    "Contract",
)

SNIPPET_CHARS = 5000
REJECTED_CONTENT_CHARS = 300


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` once for use in ``body``.

    Spark shares repeated subexpressions in generated code but not inside
    lambdas; a one-element ``transform`` does it in both places.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def replaced(text: Column, found: str, by: str) -> Column:
    """``replace`` for texts that seldom hold ``found``: looking for it is much cheaper than replacing."""
    return let(text, lambda t: F.when(t.contains(found), F.replace(t, F.lit(found), F.lit(by))).otherwise(t))


def strip(text: Column) -> Column:
    """Remove leading and trailing Unicode whitespace."""
    return F.btrim(text, F.lit(WHITESPACE))


def collapse(text: Column) -> Column:
    """Turn every run of whitespace into one space and trim the ends."""
    return F.trim(F.regexp_replace(text, BLANK + "+", " "))


def or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def first_non_empty(*texts: Column) -> Column:
    """The first text that is neither NULL nor empty, else the empty string."""
    return F.coalesce(*(F.nullif(t, F.lit("")) for t in texts), F.lit(""))


def snippet(text: Column) -> Column:
    """First 5000 characters with whitespace runs replaced by one space."""
    return F.regexp_replace(F.substring(text, 1, SNIPPET_CHARS), BLANK + "+", " ")


def listing_title(text: Column) -> Column:
    """Collapse whitespace and cut the title at the first listing phrase."""
    stop = r"(?sU)\s+(?:" + "|".join(LISTING_TITLE_STOPS) + r")\b.*$"
    return F.trim(F.regexp_replace(collapse(text), stop, ""))


def result_id(url: Column, title: Column) -> Column:
    """Stable id of a result: SHA-256 of the trimmed, lower-cased ``url|title``."""
    return F.sha2(F.lower(strip(F.concat_ws("|", url, title))), 256)


def combined_text(title: Column, content: Column, url: Column) -> Column:
    """The text that the rate parser reads."""
    return F.concat_ws("\n", title, content, url)
