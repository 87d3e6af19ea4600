"""HTML character references as a Column expression.

The named table comes from the Python standard library. It reaches the plan as one
literal string, which the optimizer folds into one map; expressions that decode
several texts bind :func:`names` once and pass it on, to keep the plan small.
"""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let

_PAIR, _KEY = "\x01", "\x02"
_TABLE = _PAIR.join(f"{name}{_KEY}{value}" for name, value in html5.items())
# Names that HTML accepts without ';', longest first so that a prefix match is the longest.
_BARE = "|".join(sorted((n for n in html5 if not n.endswith(";")), key=len, reverse=True))
_NAME = r"^[^\t\n\f <&#;]{1,32};?"
_REPLACEMENT = "\ufffd"


def _windows_1252(code: int) -> str:
    try:
        return bytes([code]).decode("cp1252")
    except UnicodeDecodeError:
        return chr(code)


# References 128..159 mean the Windows-1252 character.
_C1 = "".join(_windows_1252(code) for code in range(0x80, 0xA0))


def _character(code: Column) -> Column:
    """Character of a code point; ``code`` is NULL when the number is out of range."""
    beyond = code.isNull() | (code > 0x10FFFF) | code.between(0xD800, 0xDFFF) | (code == 0)
    unprintable = (
        code.between(0x1, 0x8)
        | (code == 0xB)
        | code.between(0xE, 0x1F)
        | (code == 0x7F)
        | code.between(0xFDD0, 0xFDEF)
        | (F.pmod(code, F.lit(0x10000)) >= 0xFFFE)
    )
    utf32 = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    return (
        F.when(beyond, F.lit(_REPLACEMENT))
        .when(code.between(0x80, 0x9F), F.substring(F.lit(_C1), (code - 0x7F).cast("int"), F.lit(1)))
        .when(unprintable, F.lit(""))
        .otherwise(utf32)
    )


def _numeric(tail: Column) -> Column:
    pattern = r"^#(?:([0-9]+)|[xX]([0-9a-fA-F]+));?"
    decimal, hexadecimal = F.regexp_extract(tail, pattern, 1), F.regexp_extract(tail, pattern, 2)
    number = F.when(hexadecimal != "", F.conv(hexadecimal, 16, 10)).otherwise(decimal)
    return F.when(
        tail.rlike(pattern),
        F.concat(let(number.try_cast("bigint"), _character), F.regexp_replace(tail, pattern, "")),
    ).otherwise(F.concat(F.lit("&"), tail))


def names() -> Column:
    """The table of named references as a map."""
    return F.str_to_map(F.lit(_TABLE), F.lit(_PAIR), F.lit(_KEY))


def _named(tail: Column, table: Column) -> Column:
    def after(name: Column) -> Column:
        return F.substring(tail, F.length(name) + 1, F.length(tail))

    def by_name(name: Column) -> Column:
        return let(
            F.try_element_at(table, name),
            lambda whole: F.when(whole.isNotNull(), F.concat(whole, after(name))).otherwise(
                let(F.regexp_extract(name, "^(?:" + _BARE + ")", 0), by_prefix)
            ),
        )

    def by_prefix(prefix: Column) -> Column:
        return F.when(prefix == "", F.concat(F.lit("&"), tail)).otherwise(
            F.concat(F.try_element_at(table, prefix), after(prefix))
        )

    # The reference nearly all pages use, ahead of the table lookup.
    return F.when(tail.startswith("amp;"), F.concat(F.lit("&"), F.substring(tail, F.lit(5), F.length(tail)))).otherwise(
        let(F.regexp_extract(tail, _NAME, 0), by_name)
    )


def unescape(text: Column, table: Column | None = None) -> Column:
    """Replace named and numeric character references once, as HTML5 defines them."""
    if table is None:
        return let(names(), lambda bound: unescape(text, bound))

    def expand(parts: Column) -> Column:
        tails = F.slice(parts, 2, F.size(parts))
        decoded = F.transform(tails, lambda t: F.when(t.startswith("#"), _numeric(t)).otherwise(_named(t, table)))
        return F.concat(F.get(parts, F.lit(0)), F.array_join(decoded, ""))

    return F.when(text.contains("&"), let(F.split(text, "&"), expand)).otherwise(text)
