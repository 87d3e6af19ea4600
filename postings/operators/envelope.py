"""Provider payloads: the responses of a run folded into bronze rows."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from ..schemas import BRONZE, PAYLOAD, RESULT_ORDER
from ..settings import HTML, RSS
from .classify import DEFAULT_MODE


def fold_payloads(collected: DataFrame, domains: Column, responses_per_payload: int) -> DataFrame:
    """One payload per provider, as ``provider, part, payload``.

    ``collected`` has one row per response: ``provider, mode, mode_ord, query_ord,
    response_id, query, request_url``, ``results`` (items in page order) and ``places``
    (where each stands in run order). Queries, URLs and results keep run order. A
    provider with more responses than ``responses_per_payload`` gets several payloads of
    so many responses each, however its responses are numbered; the last may have fewer.
    """
    numbered = in_run_order(collected, responses_per_payload)
    part = F.floor(F.col("place") / F.lit(responses_per_payload)).alias("part")
    responses = F.sort_array(
        F.collect_list(
            F.struct("mode_ord", "query_ord", "response_id", "mode", "query", "request_url", "results", "places")
        )
    )
    grouped = numbered.groupBy("provider", part).agg(responses.alias("responses"))

    def of_mode(mode: str, name: str) -> Column:
        return F.transform(F.filter("responses", lambda r: r["mode"] == mode), lambda r: r[name])

    payload = {
        "source": F.col("provider"),
        "provider": F.col("provider"),
        "mode": F.lit(DEFAULT_MODE),
        "modes": F.array_distinct(F.transform("responses", lambda r: r["mode"])),
        "allowed_domains": domains,
        "queries": of_mode(RSS, "query"),
        "feed_urls": of_mode(RSS, "request_url"),
        "urls": of_mode(HTML, "request_url"),
        "results": F.flatten(F.transform("responses", lambda r: r["results"])),
    }
    fields = [payload[name].alias(name) for name in PAYLOAD.fieldNames()]
    order = F.flatten(F.transform("responses", lambda r: r["places"])).cast(ArrayType(RESULT_ORDER))
    return grouped.select("provider", "part", F.struct(*fields).alias("payload"), order.alias("result_order"))


def in_run_order(collected: DataFrame, width: int) -> DataFrame:
    """``collected`` with ``place``: a response's number in its provider, from 0, in run order.

    Responses are numbered in ranges of ``width`` query numbers, each from the sum of the ranges
    before it, so no task sorts a whole provider.
    """
    ranged = collected.withColumn("range", F.floor(F.col("query_ord") / F.lit(width)))
    before = Window.partitionBy("provider").orderBy("mode_ord", "range")
    starts = (
        ranged.groupBy("provider", "mode_ord", "range")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("provider", "mode_ord", "range", (F.sum("n").over(before) - F.col("n")).alias("start"))
    )
    inside = Window.partitionBy("provider", "mode_ord", "range").orderBy("query_ord", "response_id")
    placed = ranged.withColumn("nth", F.row_number().over(inside) - 1).join(starts, ["provider", "mode_ord", "range"])
    return placed.withColumn("place", F.col("start") + F.col("nth")).drop("start", "nth", "range")


def bronze_rows(payloads: DataFrame, run_id: str, fetched_at: datetime, site_filters: Sequence[str]) -> DataFrame:
    """Payloads as bronze rows, payload and query serialised to JSON."""
    sites = F.array(*map(F.lit, site_filters)) if site_filters else F.array().cast("array<string>")
    query = F.struct(
        F.col("payload.queries").alias("queries"), F.col("payload.urls").alias("urls"), sites.alias("site_filters")
    )
    return payloads.select(
        F.lit(run_id).alias("run_id"),
        F.col("provider").alias("source"),
        F.lit(fetched_at).cast("timestamp").alias("fetched_at"),
        F.to_json(query).alias("query"),
        F.to_json("payload", {"ignoreNullFields": "false"}).alias("response_json"),
        "result_order",
    ).select(*BRONZE.fieldNames())
