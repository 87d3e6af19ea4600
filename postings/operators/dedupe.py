"""First-wins de-duplication that holds under skew.

A window per key would send all copies of one hot key to a single task. These
operators find the first row by an aggregation, which combines copies before the
shuffle, and come back to the full rows, where needed, over the unique row key,
which is spread evenly whatever the keys look like.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def flag_first(
    rows: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    row_key: Sequence[str],
    eligible: Column,
    flag: str = "is_first",
) -> DataFrame:
    """Add ``flag``: True for the first eligible row of each key, else False.

    ``order`` ranks the rows; with ``row_key``, which must be unique and part of
    ``order``, the rank has no ties. Keys are not NULL. Ineligible rows never claim a
    key. The input is computed twice, once with the key and order columns only, so
    start from stored rows, or find the claims on narrow rows and flag the wide ones.
    """
    return flag_claimed(rows, first_claims(rows, keys, order, row_key, eligible, flag), keys, row_key, flag)


def first_claims(
    rows: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    row_key: Sequence[str],
    eligible: Column,
    flag: str = "is_first",
) -> DataFrame:
    """``keys``, ``row_key`` and ``flag`` (True) of the first eligible row of each key."""
    # A condition inside the aggregate, not a filter below it: the optimizer would push a
    # filter through every projection and compute what it tests once more per mention.
    return (
        rows.groupBy(*keys)
        .agg(F.min(F.when(eligible, F.struct(*order))).alias("first"))
        .where(F.col("first").isNotNull())
        .select(*keys, *(F.col("first")[name].alias(name) for name in row_key), F.lit(True).alias(flag))
    )


def flag_claimed(
    rows: DataFrame, firsts: DataFrame, keys: Sequence[str], row_key: Sequence[str], flag: str = "is_first"
) -> DataFrame:
    """Add ``flag``: True for the rows that :func:`first_claims` named, else False."""
    # The row key spreads the join; with the keys beside it a row meets at most one
    # winner, so a row key that is not unique after all cannot multiply rows.
    flagged = rows.join(firsts, [*row_key, *keys], "left").select(*rows.columns, flag)
    return flagged.withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def first_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key, copies being combined before the shuffle.

    The output is partitioned by ``keys``, so a join on them needs no further shuffle.
    """
    rest = [c for c in rows.columns if c not in keys]
    first = F.min_by(F.struct(*rest), F.struct(*order))
    return (
        rows.groupBy(*keys)
        .agg(first.alias("first"))
        .select(*(F.col(c) if c in keys else F.col("first")[c].alias(c) for c in rows.columns))
    )
