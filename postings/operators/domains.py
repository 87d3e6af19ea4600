"""Domain allowlist as a join, for allowlists that are tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import let
from ..functions.urls import host


def host_suffixes(host_name: Column) -> Column:
    """``a.b.c`` gives ``a.b.c``, ``b.c`` and ``c``."""
    return let(
        F.split(host_name, r"\."),
        lambda parts: F.transform(
            F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), ".")
        ),
    )


def rows_in_domains(
    rows: DataFrame,
    domains: DataFrame,
    url: str = "url",
    domain: str = "domain",
    store: Callable[[DataFrame, str], DataFrame] = lambda df, name: df,
    broadcast_rows: int = 100_000,
) -> DataFrame:
    """Rows whose host equals a listed domain or lies below one.

    The suffix test becomes an equi-join on the distinct hosts. The allowed hosts are then
    stored and counted: up to ``broadcast_rows`` of them are broadcast, so the rows are not
    shuffled; more meet their rows in a join whose hot hosts Spark splits.
    """
    named = rows.withColumn("host", host(F.col(url)))
    suffixed = named.select("host").distinct().select("host", F.explode(host_suffixes(F.col("host"))).alias("suffix"))
    listed = domains.select(F.lower(F.col(domain)).alias("suffix")).distinct()
    allowed = store(suffixed.join(listed, "suffix").select("host").distinct(), "hosts")
    few = allowed.limit(broadcast_rows + 1).count() <= broadcast_rows
    return named.join(F.broadcast(allowed) if few else allowed, "host", "left_semi").select(*rows.columns)
