"""Expressions that turn a saved search into query texts and search URLs."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import quote_plus

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip
from .urls import form_encode

# Keywords that name a place or a contract, not a role.
PLACE_WORD, CONTRACT_WORD = "auckland", "contract"
ROLES_PER_SEARCH = 3


def rate_terms(min_rate: Column, max_rate: Column) -> Column:
    """Quoted dollar terms of a search: the minimum and, if different, the maximum.

    Empty without a minimum; a maximum of NULL or 0 does not count.
    """

    def term(rate: Column) -> Column:
        return F.format_string('"$%d"', rate.cast("bigint"))

    use_max = min_rate.isNotNull() & (F.coalesce(max_rate, F.lit(0)) != 0) & (max_rate != min_rate)
    return F.array_compact(F.array(F.when(min_rate.isNotNull(), term(min_rate)), F.when(use_max, term(max_rate))))


def query_text(keywords: Column) -> Column:
    return F.array_join(keywords, " ")


def has_word(keywords: Column, word: str) -> Column:
    return F.exists(keywords, lambda k: F.lower(k) == word)


def role_keywords(keywords: Column) -> Column:
    """The first three keywords that name a role."""
    roles = F.filter(keywords, lambda k: ~F.lower(k).isin(PLACE_WORD, CONTRACT_WORD))
    return F.slice(roles, 1, ROLES_PER_SEARCH)


def search_texts(text: Column, terms: Column, prefix: str, trimmed: bool) -> Column:
    """The base text and one text per rate term, each behind ``prefix``."""
    base = F.concat(F.lit(prefix + " " if prefix else ""), text)
    texts = F.concat(F.array(base), F.transform(terms, lambda t: F.concat(base, F.lit(" "), t)))
    return F.transform(texts, strip) if trimmed else texts


def search_url(endpoint: str, query: Column, name: str, fixed: Sequence[tuple[str, str]] = ()) -> Column:
    """``endpoint?name=query&fixed...`` with form-encoded values."""
    tail = "".join(f"&{key}={quote_plus(value)}" for key, value in fixed)
    return F.concat(F.lit(f"{endpoint}?{name}="), form_encode(query), F.lit(tail))


def role_slugs(keywords: Column) -> Column:
    return F.transform(
        role_keywords(keywords),
        lambda k: F.replace(F.replace(F.lower(k), F.lit("."), F.lit("")), F.lit(" "), F.lit("-")),
    )
