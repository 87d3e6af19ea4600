"""Table schemas and schema alignment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _fields(kind, *names: str) -> list[StructField]:
    return [StructField(name, kind) for name in names]


# One stored response of a provider: a feed document or a page. ``response_id`` is
# unique; ``query_ord`` numbers the responses of one provider and mode in run order.
RESPONSES = StructType(
    _fields(LongType(), "response_id")
    + _fields(StringType(), "provider", "mode")
    + _fields(LongType(), "query_ord")
    + _fields(StringType(), "query", "request_url")
    + _fields(IntegerType(), "status")
    + _fields(StringType(), "server", "content_type", "body")
)

ITEM = StructType(_fields(StringType(), "title", "url", "content", "published", "mode"))

# The payload text of a bronze row.
PAYLOAD = StructType(
    _fields(StringType(), "source", "provider", "mode")
    + _fields(ArrayType(StringType()), "modes", "allowed_domains", "queries", "feed_urls", "urls")
    + [StructField("results", ArrayType(ITEM))]
)

RAW_RESULT = StructType(
    _fields(StringType(), "provider", "scrape_mode", "source", "title", "url", "content", "published", "raw_json")
)

# Where each result of a payload stands in run order.
RESULT_ORDER = StructType(_fields(IntegerType(), "mode_ord") + _fields(LongType(), "query_ord", "response_id") + _fields(IntegerType(), "pos"))

BRONZE = StructType(
    _fields(StringType(), "run_id", "source")
    + _fields(TimestampType(), "fetched_at")
    + _fields(StringType(), "query", "response_json")
    + [StructField("result_order", ArrayType(RESULT_ORDER))]
)

# A finished step of a run; ``fetched_at`` is the time of the run's first attempt.
LEDGER = StructType(_fields(StringType(), "run_id", "step") + _fields(TimestampType(), "fetched_at"))

SILVER = StructType(
    _fields(StringType(), "provider", "scrape_mode", "source", "result_id", "title", "url", "content")
    + _fields(StringType(), "published", "raw_json")
    + _fields(DoubleType(), "hourly_min", "hourly_max")
    + _fields(TimestampType(), "first_seen_at", "last_seen_at")
)
SILVER_KEYS = ("source", "result_id")
# Columns that an update leaves as they are in the table.
SILVER_KEPT = ("first_seen_at",)

GOLD = StructType(
    _fields(StringType(), "provider", "scrape_mode", "source", "result_id", "title", "url", "content")
    + _fields(DoubleType(), "hourly_min", "hourly_max")
    + _fields(TimestampType(), "last_seen_at")
)

REJECTED = StructType(_fields(StringType(), "stage", "source", "reason", "title", "url", "content"))


def align_to_schema(df: DataFrame, schema: StructType, keep: Sequence[str] = ()) -> DataFrame:
    """Columns of ``schema`` in order, then those to ``keep``; those the table lacks are NULL.

    Upgrades tables written before a column existed; on a current table it is a
    plain projection.
    """
    present = set(df.columns)
    return df.select(
        *(
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ),
        *keep,
    )
