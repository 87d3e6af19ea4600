"""Keyed upsert: the MERGE of a batch into a table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _keyed(df: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(and_, (df[k].isNotNull() for k in keys))


def _merged(c: str, kept: Sequence[str]) -> Column:
    old, new = F.col(f"old.{c}"), F.col(f"new.{c}")
    if c in kept:
        return F.when(F.col("old.present"), old).otherwise(new).alias(c)
    return F.when(F.col("new.present"), new).otherwise(old).alias(c)


def upsert(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    kept: Sequence[str] = (),
    small_batch: bool = False,
) -> DataFrame:
    """``target`` after merging ``batch``, which holds each key at most once.

    A matched row takes all values of the batch, also NULLs, except the ``kept``
    columns; unmatched rows of both sides stay. NULL keys match nothing and are not
    shuffled. With ``small_batch``, to be set only for a batch of measured size, the
    batch is broadcast and the target is not shuffled at all.
    """
    columns = target.columns
    batch = batch.select(*columns)
    old, old_null = target.where(_keyed(target, keys)), target.where(~_keyed(target, keys))
    new, new_null = batch.where(_keyed(batch, keys)), batch.where(~_keyed(batch, keys))
    old = old.withColumn("present", F.lit(True))
    new = new.withColumn("present", F.lit(True))
    on = reduce(and_, (F.col(f"old.{k}") == F.col(f"new.{k}") for k in keys))

    if small_batch:
        updated = old.alias("old").join(F.broadcast(new.alias("new")), on, "left")
        updated = updated.select(*(F.col(f"old.{c}") if c in keys else _merged(c, kept) for c in columns))
        known = old.select(*keys).join(F.broadcast(new.select(*keys)), list(keys), "left_semi").distinct()
        inserted = new.select(*columns).join(known, list(keys), "left_anti").select(*columns)
        merged = updated.unionByName(inserted)
    else:
        joined = old.alias("old").join(new.alias("new"), on, "full_outer")
        merged = joined.select(
            *(
                F.coalesce(F.col(f"old.{c}"), F.col(f"new.{c}")).alias(c) if c in keys else _merged(c, kept)
                for c in columns
            )
        )
    return merged.unionByName(old_null.select(*columns)).unionByName(new_null.select(*columns))
