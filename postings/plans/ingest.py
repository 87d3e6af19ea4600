"""The ingest job: stored responses to bronze, silver, gold, rejected rows and counts."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.aggregates import provider_funnel, run_totals
from ..operators.classify import (
    DEFAULT_MODE,
    ROW_KEY,
    RUN_ORDER,
    classify,
    gold_rows,
    normalize,
    rejected_rows,
    silver_rows,
    url_claims,
    with_clean_url,
)
from ..operators.dedupe import first_per_key
from ..operators.envelope import bronze_rows, fold_payloads
from ..operators.providers import allowlist
from ..schemas import SILVER, SILVER_KEPT, SILVER_KEYS
from ..session import scratch
from ..settings import RunSettings
from ..sinks.merge_on_read import append_batch
from ..sinks.tables import (
    Tables,
    append_bronze,
    bucket_count,
    current_version,
    note,
    publish,
    read_run,
    read_silver,
    steps_of,
    write_run,
)
from ..sources.scans import scan_payloads
from .collect import collect_responses, explode_items, explode_urls, payload_input, quarantine

PROVIDER_STAGE, INGEST_STAGE = "provider", "ingest"
#: Bytes of text that a bucket of a first silver version is meant to hold.
BUCKET_BYTES = 200_000_000


#: Up to so many bytes, measured, the claims on URLs are broadcast, so that results are not shuffled.
BROADCAST_BYTES = 20_000_000


class EmptyRun(RuntimeError):
    """A run without bronze rows or without silver rows."""


def accepted_items(items: DataFrame) -> DataFrame:
    """Items that their provider accepted, with their source and canonical URL."""
    accepted = items.where(F.col("reject_reason").isNull()).drop("reject_reason")
    return with_clean_url(accepted.withColumn("source", F.col("provider")))


def results_of(items: DataFrame) -> DataFrame:
    """Classified items as normalised results. The raw JSON is only made for the rows in use."""
    provider = F.col("provider")
    return normalize(items, provider, provider, F.lit(DEFAULT_MODE), keep=(*RUN_ORDER, "clean_url", "reason"))


def within_broadcast(claims: DataFrame) -> bool:
    """The claims are few and short enough to be sent to all tasks."""
    size = F.sum(F.octet_length("clean_url") + F.lit(100))
    return claims.agg(F.coalesce(size, F.lit(0))).first()[0] <= BROADCAST_BYTES


def batch_of(classified: DataFrame, settings: RunSettings) -> DataFrame:
    """Accepted rows in the silver schema, the first of each key in run order."""
    accepted = classified.where(F.col("reason").isNull())
    rows = silver_rows(accepted, F.lit(settings.fetched_at), keep=RUN_ORDER)
    return first_per_key(rows, SILVER_KEYS, RUN_ORDER).select(*SILVER.fieldNames())


def bronze_of(collected: DataFrame, settings: RunSettings) -> DataFrame:
    """Bronze rows of collected responses: their payloads, before any gate."""
    listed = allowlist(settings.providers, settings.site_filters, F.col("provider"))
    payloads = fold_payloads(payload_input(collected), listed, settings.responses_per_payload)
    return bronze_rows(payloads, settings.run_id, settings.fetched_at, settings.site_filters)


@dataclass
class Outputs:
    """What a run derives from its collected responses.

    Everything is lazy and made on first use. ``store`` is called on tables that are used
    more than once and may write them down; the default leaves them lazy too.
    """

    collected: DataFrame
    settings: RunSettings
    store: Callable[[DataFrame, str], DataFrame] = lambda df, name: df

    @cached_property
    def bronze(self) -> DataFrame:
        return bronze_of(self.collected, self.settings)

    @cached_property
    def domains(self) -> Column:
        return allowlist(self.settings.providers, self.settings.site_filters, F.col("source"))

    @cached_property
    def urls(self) -> DataFrame:
        return self.store(accepted_items(explode_urls(self.collected)), "urls")

    @cached_property
    def claims(self) -> DataFrame:
        claims = self.store(url_claims(self.urls, self.domains), "claims")
        return F.broadcast(claims) if within_broadcast(claims) else claims

    @cached_property
    def classified(self) -> DataFrame:
        items = accepted_items(explode_items(self.collected))
        return results_of(self.store(classify(items, self.domains, claims=self.claims), "classified"))

    @cached_property
    def reasons(self) -> DataFrame:
        """Provider and reason of each result, as ``classified`` has them, from the URLs alone."""
        return classify(self.urls, self.domains, claims=self.claims).select("provider", "reason")

    @cached_property
    def batch(self) -> DataFrame:
        return batch_of(self.classified, self.settings)

    @cached_property
    def rejected(self) -> DataFrame:
        dropped = explode_items(self.collected).where(F.col("reject_reason").isNotNull())
        dropped = dropped.withColumn("source", F.col("provider")).withColumnRenamed("reject_reason", "reason")
        late = rejected_rows(self.classified.where(F.col("reason").isNotNull()), INGEST_STAGE, keep=RUN_ORDER)
        return late.unionByName(rejected_rows(dropped, PROVIDER_STAGE, url="url", keep=RUN_ORDER))

    @cached_property
    def quarantine(self) -> DataFrame:
        return quarantine(self.collected)

    @cached_property
    def totals(self) -> DataFrame:
        return run_totals(
            self.bronze.select("run_id"), self.reasons.select("reason"), self.quarantine.select("response_id")
        )

    @cached_property
    def funnel(self) -> DataFrame:
        return provider_funnel(self.reasons)


def plan_ingest(responses: DataFrame, settings: RunSettings, store=lambda df, name: df) -> Outputs:
    """The outputs of a run, without publishing any table.

    With ``store=materialize`` the response bodies are read once for all outputs.
    """
    return Outputs(store(collect_responses(responses, settings), "collected"), settings, store)


def check_run(bronze_count: int, silver_count: int) -> None:
    """Stop a run that found nothing, before silver and gold are touched."""
    if not bronze_count:
        raise EmptyRun("no bronze rows: no provider returned a usable response")
    if not silver_count:
        raise EmptyRun("no silver rows: all results were rejected")


def batch_bytes(batch: DataFrame) -> int:
    """Bytes of text in a batch, which size the first version's buckets."""
    strings = [f.name for f in batch.schema.fields if f.dataType.typeName() == "string"]
    texts = [F.coalesce(F.octet_length(c), F.lit(0)) for c in strings]
    return batch.agg(F.coalesce(F.sum(sum(texts, F.lit(64))), F.lit(0))).first()[0]


@dataclass(frozen=True)
class Published:
    """What a run has left in the tables of runs, and its counts."""

    bronze: DataFrame
    rejected: DataFrame
    quarantine: DataFrame
    metrics: DataFrame


def published(spark: SparkSession, tables: Tables, run_id: str) -> Published:
    return Published(*(read_run(spark, t, run_id) for t in (tables.bronze, tables.rejected, tables.quarantine, tables.metrics)))


def run_ingest(spark: SparkSession, responses: DataFrame, tables: Tables, settings: RunSettings) -> Published:
    """Run the job and publish its tables.

    Response bodies are read once, into a table of collected items. Bronze is written
    first, before anything is classified, so that a run that fails or whose results are all
    rejected keeps its payloads. Rejected rows, the quarantine and the counts are kept by
    run. A run that stopped half way can be repeated under the same id: it keeps the time of
    its first attempt, replaces what it wrote, and leaves out the versions it had
    published. What it stores on the way is deleted at its end.
    """
    done = steps_of(spark, tables, settings.run_id)
    if "started" in done:
        settings = replace(settings, fetched_at=done["started"])
    else:
        note(spark, tables, settings.run_id, "started", settings.fetched_at)
    stamp = {"run_id": F.lit(settings.run_id), "fetched_at": F.lit(settings.fetched_at).cast("timestamp")}
    with scratch(spark) as store:
        run = Outputs(store(collect_responses(responses, settings), "collected"), settings, store)
        append_bronze(run.bronze, tables)
        write_run(run.quarantine.withColumns(stamp), tables.quarantine)
        write_run(run.rejected.withColumns(stamp), tables.rejected)
        stored = read_run(spark, tables.bronze, settings.run_id).select("run_id")
        totals = run_totals(stored, run.classified.select("reason"), run.quarantine.select("response_id"))
        write_run(totals.withColumns(stamp), tables.metrics)
        result = published(spark, tables, settings.run_id)
        counts = result.metrics.first()
        check_run(counts["bronze_rows"], counts["silver_rows"])
        if "silver" not in done:
            publish_silver(spark, store(run.batch, "batch"), tables, settings)
            note(spark, tables, settings.run_id, "silver", settings.fetched_at)
        if "gold" not in done:
            gold = gold_rows(read_silver(spark, tables), settings.min_rate)
            publish(gold, tables.gold, settings.run_id, sort_by=["hourly_max"])
            note(spark, tables, settings.run_id, "gold", settings.fetched_at)
    return result


def publish_silver(spark: SparkSession, batch: DataFrame, tables: Tables, settings: RunSettings) -> None:
    """Add a batch to silver, merged on read.

    The batch is written as a partition of silver's changes; the base version is not rewritten
    until the changes pass a share of its bytes, then they are compacted into a new base, read in
    its buckets with only the changes shuffled.
    """
    version = current_version(spark, tables.silver)
    have = bucket_count(spark, version) if version else 0
    buckets = settings.silver_buckets or have or max(1, -(-batch_bytes(batch) // BUCKET_BYTES))
    append_batch(batch, tables.silver, settings.run_id, SILVER_KEYS, SILVER_KEPT, buckets=buckets)


def rebuild_batch(
    bronze: DataFrame, settings: RunSettings, store: Callable[[DataFrame, str], DataFrame] = lambda df, name: df
) -> DataFrame:
    """The silver batch of stored bronze rows of one run, without the responses.

    Each result carries its place in run order, so neither the number of payloads nor their
    order matters. With ``store`` the payloads are parsed and the URLs are made canonical once:
    the results are used twice, and tests of a lazy column are worked out once per mention.
    """
    items = scan_payloads(bronze, keep=("source", "fetched_at")).select("*", "order.mode_ord", "order.query_ord", "order.response_id", F.col("order.pos").alias("item_pos"))
    items = items.drop("order", "pos").withColumnRenamed("item_pos", "pos")
    order = F
    for index, provider in enumerate(settings.providers):
        order = order.when(F.col("source") == provider.name, index)
    items = items.withColumn("provider_ord", order.otherwise(len(settings.providers)))
    keep = (*RUN_ORDER, "allowed_domains", "fetched_at")
    results = with_clean_url(normalize(items, F.col("source"), F.col("payload_provider"), F.col("payload_mode"), keep))
    classified = store(classify(store(results, "results"), F.col("allowed_domains"), RUN_ORDER, ROW_KEY), "classified")
    accepted = classified.where(F.col("reason").isNull())
    rows = silver_rows(accepted, F.col("fetched_at"), keep=RUN_ORDER)
    return first_per_key(rows, SILVER_KEYS, RUN_ORDER).select(*SILVER.fieldNames())
