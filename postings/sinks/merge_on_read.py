"""Keyed tables that are merged on read: a bucketed base version and a table of changes.

A batch is written once, as its own partition of the changes table (``<name>_changes``),
numbered by ``batch_seq``; the base is not rewritten. The view ``name`` resolves both: of
each key the row of the newest batch wins, its ``kept`` columns come from the oldest row of
the key (the base if it has it), keys with a NULL part match nothing. The view pins the
batches it shows (``through`` < batch_seq <= ``upto``), so a batch becomes visible all at
once when the view is moved, and a half written one is never seen. Compaction folds the
shown batches into a new base version once their bytes pass a measured share of the base's.

One writer per table: a batch's number is the last one plus one.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .tables import create_database, current_version, publish

#: Compact when the changes shown hold more bytes than this share of the base.
COMPACT_SHARE = 0.25
SEQ, RUN = "batch_seq", "batch_run"


def changes_table(name: str) -> str:
    return f"{name}_changes"


@dataclass(frozen=True)
class State:
    """What the view shows: the base version and the batches after ``through`` up to ``upto``."""

    base: str | None
    through: int
    upto: int


def state_of(spark: SparkSession, name: str) -> State:
    base = current_version(spark, name)
    if base is None:
        return State(None, 0, 0)
    props = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    return State(base, int(props.get("through", 0)), int(props.get("upto", 0)))


def merged_sql(spark: SparkSession, state: State, name: str, schema: StructType, keys: Sequence[str], kept: Sequence[str]) -> str:
    """SQL of the view: base and the shown changes, resolved by key; a column the base lacks is NULL there."""
    columns = schema.fieldNames()
    have = set(spark.table(state.base).columns)
    base_cols = ", ".join(c if c in have else f"CAST(NULL AS {schema[c].dataType.simpleString()}) AS {c}" for c in columns)
    base = f"(SELECT {base_cols} FROM {state.base})"
    if state.upto <= state.through:
        return f"SELECT * FROM {base}"
    changes = changes_table(name)
    shown = f"{SEQ} > {state.through} AND {SEQ} <= {state.upto}"
    keyed = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    rest = [c for c in columns if c not in keys]
    newest = "named_struct(" + ", ".join(f"'{c}', {c}" for c in rest) + ")"
    first = ", ".join(f"min_by({c}, {SEQ}) AS first_{c}" for c in kept)
    resolved = f"SELECT {', '.join(keys)}, max_by({newest}, {SEQ}) AS n, {first} FROM {changes} WHERE {shown} AND {keyed} GROUP BY {', '.join(keys)}"

    def column(c: str) -> str:
        if c in keys:
            return f"coalesce(b.{c}, c.{c}) AS {c}"
        if c in kept:
            return f"CASE WHEN b.{keys[0]} IS NOT NULL THEN b.{c} ELSE c.first_{c} END AS {c}"
        return f"CASE WHEN c.{keys[0]} IS NOT NULL THEN c.n.{c} ELSE b.{c} END AS {c}"

    on = " AND ".join(f"b.{k} = c.{k}" for k in keys)
    joined = f"SELECT {', '.join(map(column, columns))} FROM (SELECT * FROM {base} WHERE {keyed}) b FULL OUTER JOIN ({resolved}) c ON {on}"
    loose = f"SELECT {', '.join(columns)} FROM {base} WHERE NOT ({keyed}) UNION ALL SELECT {', '.join(columns)} FROM {changes} WHERE {shown} AND NOT ({keyed})"
    return f"{joined} UNION ALL {loose}"


def show(spark: SparkSession, name: str, state: State, schema: StructType, keys: Sequence[str], kept: Sequence[str]) -> None:
    """Move the view to ``state``."""
    body = merged_sql(spark, state, name, schema, keys, kept)
    spark.sql(f"CREATE OR REPLACE VIEW {name} COMMENT '{state.base}' TBLPROPERTIES ('through' = '{state.through}', 'upto' = '{state.upto}') AS {body}")


def batches(spark: SparkSession, name: str) -> dict[int, str]:
    """batch_seq and run of each partition of the changes table."""
    changes = changes_table(name)
    if not spark.catalog.tableExists(changes):
        return {}
    out = {}
    for row in spark.sql(f"SHOW PARTITIONS {changes}").collect():
        parts = dict(p.split("=", 1) for p in row["partition"].split("/"))
        out[int(parts[SEQ])] = parts[RUN]
    return out


def shown_bytes(spark: SparkSession, table: str, where: str = "true") -> int:
    """Bytes of the files that rows of ``table`` matching ``where`` lie in, read from file metadata."""
    files = spark.table(table).where(where).select("_metadata.file_path", "_metadata.file_size").distinct()
    return int(files.agg(F.sum("file_size")).first()[0] or 0)


def append_batch(
    batch: DataFrame,
    name: str,
    run_id: str,
    keys: Sequence[str],
    kept: Sequence[str] = (),
    buckets: int = 1,
    compact_share: float = COMPACT_SHARE,
) -> State:
    """Add ``batch`` (each key at most once) to the table ``name`` and show it; returns the view's state.

    The first batch becomes the base, bucketed by ``keys`` into ``buckets``. A later one is written
    as a partition of the changes table: what a run writes follows its batch, not the table. A run
    id that has written a batch before replaces that batch in its place. Past ``compact_share``
    the shown batches are folded into a new base.
    """
    spark = batch.sparkSession
    create_database(spark, name.rsplit(".", 1)[0])
    schema = batch.schema
    state = state_of(spark, name)
    if state.base is None:
        publish(batch, name, run_id, bucket_by=keys, buckets=buckets)
        show(spark, name, State(current_version(spark, name), 0, 0), schema, keys, kept)
        return state_of(spark, name)
    known = batches(spark, name)
    seq = next((s for s, run in known.items() if run == run_id and s > state.through), max([state.upto, *known]) + 1)
    rows = batch.withColumn(SEQ, F.lit(seq).cast("long")).withColumn(RUN, F.lit(run_id))
    changes = changes_table(name)
    if not spark.catalog.tableExists(changes):
        rows.limit(0).write.partitionBy(SEQ, RUN).format("parquet").saveAsTable(changes)
    spark.sql(f"ALTER TABLE {changes} DROP IF EXISTS PARTITION ({SEQ} = {seq}, {RUN} = '{run_id}')")
    target = spark.table(changes).columns
    rows.repartition(max(1, min(buckets, 64)), *keys).select(*target).write.mode("append").insertInto(changes)
    state = State(state.base, state.through, max(state.upto, seq))
    show(spark, name, state, schema, keys, kept)
    if shown_bytes(spark, changes, f"{SEQ} > {state.through} AND {SEQ} <= {state.upto}") > compact_share * max(shown_bytes(spark, state.base), 1):
        state = compact(spark, name, run_id, keys, kept, buckets)
    return state


def compact(spark: SparkSession, name: str, run_id: str, keys: Sequence[str], kept: Sequence[str] = (), buckets: int = 1) -> State:
    """Fold the shown batches into a new base version and drop the batches it holds.

    The merged rows come from the view, so the new base holds what readers saw; the base is read
    in its buckets and only the changes are shuffled.
    """
    state = state_of(spark, name)
    if state.base is None or state.upto <= state.through:
        return state
    merged = spark.table(name)
    publish(merged, name, f"{run_id}-compacted", bucket_by=keys, buckets=buckets)
    done = State(current_version(spark, name), state.upto, state.upto)
    show(spark, name, done, merged.schema, keys, kept)
    for seq, run in batches(spark, name).items():
        if seq <= done.through:
            spark.sql(f"ALTER TABLE {changes_table(name)} DROP IF EXISTS PARTITION ({SEQ} = {seq}, {RUN} = '{run}')")
    return done


def drop_changes(spark: SparkSession, name: str) -> None:
    """Forget all batches, as when the table is emptied."""
    spark.sql(f"DROP TABLE IF EXISTS {changes_table(name)}")
