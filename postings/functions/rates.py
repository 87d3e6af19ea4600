"""Hourly pay rates in free text."""

from __future__ import annotations

import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import BLANK, let, replaced

# Spellings that are unified before parsing, in this order.
SPELLINGS = (
    (",", ""),
    ("nzd", "$"),
    ("per hour", "/h"),
    ("per hr", "/h"),
    ("an hour", "/h"),
    ("p/h", "/h"),
    ("ph", "/h"),
    ("–", "-"),
    ("—", "-"),
)
# A text without any of these has no hourly rate.
HOURLY_HINTS = ("/h", "hour", "+ gst", "contract rate")
# Bounds of a plausible hourly rate.
LOWEST_RATE, HIGHEST_RATE = 50, 300

# A currency sign and blanks in front of a number never change which number is found,
# so the patterns start at the digits.
_AMOUNT = r"\d{2,3}(?:\.\d+)?"
_RANGE = rf"({_AMOUNT}){BLANK}*-{BLANK}*(?:\${BLANK}*)?({_AMOUNT})"

# Decimal digits of other scripts, folded to ASCII before parsing.
_DIGITS = [c for c in map(chr, range(0x80, sys.maxunicode + 1)) if unicodedata.category(c) == "Nd"]
_FOLDED = "".join(str(unicodedata.digit(c)) for c in _DIGITS)


def _ascii_digits(text: Column) -> Column:
    # Only texts with characters beyond ASCII pay for the search.
    foreign = (F.octet_length(text) > F.length(text)) & text.rlike(r"(?U)[\d&&[^0-9]]")
    return F.when(foreign, F.translate(text, "".join(_DIGITS), _FOLDED)).otherwise(text)


def _plausible(rate: Column) -> Column:
    return rate.between(LOWEST_RATE, HIGHEST_RATE)


def _number(text: Column) -> Column:
    return text.try_cast("double")


def hourly_rate(text: Column) -> Column:
    """Lowest and highest hourly rate as ``struct<hourly_min,hourly_max>``.

    Both fields are NULL unless the text hints at hourly pay. The first range
    counts if both ends are plausible; otherwise the first two plausible numbers.
    """
    unified = F.lower(text)
    for spelling, plain in SPELLINGS:
        unified = replaced(unified, spelling, plain)

    def rate(low: Column, high: Column) -> Column:
        return F.struct(low.alias("hourly_min"), high.alias("hourly_max"))

    none = rate(F.lit(None).cast("double"), F.lit(None).cast("double"))

    def numbers(t: Column) -> Column:
        found = F.transform(F.regexp_extract_all(t, F.lit(_AMOUNT), F.lit(0)), _number)
        return let(
            F.slice(F.filter(found, _plausible), 1, 2),
            lambda n: rate(F.array_min(n), F.array_max(n)),
        )

    def ranged(t: Column) -> Column:
        def by_first(a: Column) -> Column:
            second = let(_number(F.regexp_extract(t, _RANGE, 2)), lambda b: by_both(a, b))
            return F.when(_plausible(a), second).otherwise(numbers(t))

        def by_both(a: Column, b: Column) -> Column:
            return F.when(_plausible(b), rate(F.least(a, b), F.greatest(a, b))).otherwise(numbers(t))

        first = let(_number(F.regexp_extract(t, _RANGE, 1)), by_first)
        return F.when(t.contains("-"), first).otherwise(numbers(t))

    def hinted(t: Column) -> Column:
        hint = F.lit(False)
        for word in HOURLY_HINTS:
            hint = hint | t.contains(word)
        return F.when(hint, let(_ascii_digits(t), ranged)).otherwise(none)

    return let(F.coalesce(unified, F.lit("")), hinted)
