"""Provider rules as filters and expressions.

The provider table is configuration with a handful of rows, so it enters the plan
as literals: enabled providers and modes become pushed-down filters, allowlists
and URL rules become CASE expressions. No join is needed.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import let
from ..functions.urls import host, host_in
from ..settings import MODES, Provider

MISSING_URL = "missing url"
DOMAIN_NOT_ALLOWED = "domain not allowed"
DUPLICATE_URL = "duplicate url"


def only_enabled(df: DataFrame, enabled: Sequence[str] | None, column: str = "provider") -> DataFrame:
    """Rows of the enabled providers; None enables all."""
    return df if enabled is None else df.where(F.col(column).isin(*enabled))


def only_supported(df: DataFrame, providers: Sequence[Provider], modes: Sequence[str]) -> DataFrame:
    """Rows whose mode is enabled for the run and supported by the provider."""
    pairs = [
        (F.col("mode") == mode) & F.col("provider").isin(*(p.name for p in providers if mode in p.supports))
        for mode in modes
        if any(mode in p.supports for p in providers)
    ]
    return df.where(reduce(or_, pairs, F.lit(False)))


def _by_provider(providers: Sequence[Provider], value, column: Column) -> Column:
    chain = F
    for p in providers:
        chain = chain.when(column == p.name, value(p))
    return chain


def _texts(values: Sequence[str]) -> Column:
    return F.array(*map(F.lit, values)) if values else F.array().cast("array<string>")


def run_order(providers: Sequence[Provider], provider: Column, mode: Column) -> tuple[Column, Column]:
    """Positions of provider and mode in run order."""
    index = {p.name: i for i, p in enumerate(providers)}
    return (
        _by_provider(providers, lambda p: F.lit(index[p.name]), provider).otherwise(len(index)),
        F.coalesce(F.array_position(_texts(MODES), mode).cast("int"), F.lit(0)) - 1,
    )


def allowlist(providers: Sequence[Provider], site_filters: Sequence[str], provider: Column) -> Column:
    """The provider's own domains if it declares any, else the site filters."""
    sites = _texts(site_filters)
    return _by_provider(
        providers, lambda p: sites if p.domains is None else _texts(p.domains), provider
    ).otherwise(sites)


def result_url_allowed(providers: Sequence[Provider], provider: Column, url: Column) -> Column:
    """The provider's domain and path rules for result URLs.

    A provider without domains of its own allows every result here.
    """

    def rules(name: Column, lowered: Column) -> Column:
        def rule(p: Provider) -> Column:
            tests = [host_in(name, p.domains) if p.domains else F.lit(True)]
            if p.any_of:
                tests.append(reduce(or_, (lowered.contains(part) for part in p.any_of)))
            tests += [lowered.contains(part) for part in p.all_of]
            return reduce(and_, tests)

        return _by_provider(providers, rule, provider).otherwise(F.lit(True))

    return let(host(url), lambda name: let(F.lower(url), lambda lowered: rules(name, lowered)))


def provider_reject_reason(providers: Sequence[Provider], provider: Column, url: Column) -> Column:
    """Why a provider drops a result, or NULL."""
    return F.when(F.coalesce(url, F.lit("")) == "", MISSING_URL).when(
        ~result_url_allowed(providers, provider, url), DOMAIN_NOT_ALLOWED
    )


def split_by_reason(df: DataFrame, reason: str = "reason") -> tuple[DataFrame, DataFrame]:
    """Accepted and rejected rows."""
    return df.where(F.col(reason).isNull()).drop(reason), df.where(F.col(reason).isNotNull())
