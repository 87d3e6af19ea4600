"""The recurring run as a stream over newly stored responses.

Each trigger ingests the response files that arrived since the last one, as one run.
The checkpoint remembers which files were taken; a batch that is repeated after a
failure has the same run id and keeps the time of its first attempt.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..plans.ingest import EmptyRun, run_ingest
from ..schemas import RESPONSES
from ..settings import RunSettings
from ..sinks.tables import Tables


def ingest_arrivals(
    spark: SparkSession,
    folder: str,
    tables: Tables,
    settings: RunSettings,
    checkpoint: str,
    clock: Callable[[], datetime] = lambda: datetime.now(timezone.utc),
    every: str | None = None,
) -> StreamingQuery:
    """Ingest the parquet response files of ``folder``, each file once.

    Without ``every`` the query takes what has arrived and ends, for a scheduler that
    starts it hourly; with it (``"1 hour"``) it keeps running. Run ids are
    ``settings.run_id`` and the batch number. A batch without any result publishes nothing;
    its payloads, rejected rows, quarantine and counts are kept like any other's.
    """

    def run(batch: DataFrame, number: int) -> None:
        stamped = replace(settings, run_id=f"{settings.run_id}-{number}", fetched_at=clock())
        try:
            run_ingest(batch.sparkSession, batch, tables, stamped)
        except EmptyRun:
            pass

    writer = spark.readStream.schema(RESPONSES).parquet(folder).writeStream.foreachBatch(run)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()
