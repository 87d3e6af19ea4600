"""Silver merged on read: the same rows as an upsert, before and after compaction; writes follow the batch."""

import uuid
from datetime import datetime

import pytest

from postings.operators.upsert import upsert
from postings.session import shared_folder
from postings.sinks import merge_on_read as mor
from postings.sinks import tables as sinks

T = [datetime(2026, 1, d) for d in range(1, 8)]
SCHEMA = "source string, result_id string, v string, rate double, first_seen_at timestamp"
TARGET = [("a", "1", "old", 1.0, T[0]), ("a", "2", "old", 2.0, T[0]), ("b", "1", "old", None, T[1]),
          (None, "1", "null key", 3.0, T[0]), ("c", None, "null key", 3.0, T[0])]
BATCH = [("a", "1", "new", None, T[3]), ("b", "1", "new", 9.0, T[3]), ("b", "2", "new", 5.0, T[3]),
         (None, "1", "null key too", 4.0, T[3])]
LATER = [("b", "2", "newer", 6.0, T[5]), ("d", "1", "newer", 1.0, T[5]), ("a", "2", None, None, T[5])]
KEYS, KEPT = ("source", "result_id"), ("first_seen_at",)


@pytest.fixture()
def name(spark):
    database = f"m_{uuid.uuid4().hex[:10]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{shared_folder(spark)}/{database}'")
    return f"{database}.silver"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def chained(spark, *batches):
    out = spark.createDataFrame(TARGET, SCHEMA)
    for batch in batches:
        out = upsert(out, spark.createDataFrame(batch, SCHEMA), KEYS, KEPT)
    return rows(out)


def add(spark, name, batch, run, share=10.0):
    return mor.append_batch(spark.createDataFrame(batch, SCHEMA), name, run, KEYS, KEPT, buckets=4, compact_share=share)


def test_reads_as_the_upsert_did_before_and_after_compaction(spark, name):
    add(spark, name, TARGET, "r0")
    add(spark, name, BATCH, "r1")
    state = add(spark, name, LATER, "r2")
    assert (state.through, state.upto) == (0, 2)
    assert rows(spark.table(name)) == chained(spark, BATCH, LATER)
    done = mor.compact(spark, name, "r2", KEYS, KEPT, buckets=4)
    assert (done.through, done.upto) == (2, 2) and mor.batches(spark, name) == {}
    assert rows(spark.table(name)) == chained(spark, BATCH, LATER)
    assert sinks.bucket_count(spark, done.base) == 4
    add(spark, name, [("a", "1", "after", 7.0, T[6])], "r3")
    assert rows(spark.table(name)) == chained(spark, BATCH, LATER, [("a", "1", "after", 7.0, T[6])])


def test_a_batch_writes_only_itself(spark, name):
    add(spark, name, TARGET * 1, "r0")
    base = sinks.current_version(spark, name)
    before = sorted(spark.table(base).inputFiles())
    add(spark, name, BATCH, "r1")
    assert sinks.current_version(spark, name) == base
    assert sorted(spark.table(base).inputFiles()) == before
    written = mor.shown_bytes(spark, mor.changes_table(name), "batch_seq = 1")
    assert 0 < written <= mor.shown_bytes(spark, mor.changes_table(name))


def test_a_repeated_run_replaces_its_batch(spark, name):
    add(spark, name, TARGET, "r0")
    add(spark, name, [("a", "1", "first try", 0.0, T[3])], "r1")
    add(spark, name, BATCH, "r1")
    assert mor.batches(spark, name) == {1: "r1"}
    assert rows(spark.table(name)) == chained(spark, BATCH)


def test_a_batch_not_shown_is_not_read(spark, name):
    add(spark, name, TARGET, "r0")
    add(spark, name, BATCH, "r1")
    stray = spark.createDataFrame([("a", "1", "half written", 0.0, T[4])], SCHEMA)
    stray.selectExpr("*", "9L AS batch_seq", "'r9' AS batch_run").write.insertInto(mor.changes_table(name))
    assert rows(spark.table(name)) == chained(spark, BATCH)


def test_compaction_past_the_share(spark, name):
    add(spark, name, TARGET, "r0", share=0.0)
    state = add(spark, name, BATCH, "r1", share=0.0)
    assert state.through == state.upto == 1
    assert rows(spark.table(name)) == chained(spark, BATCH)


def test_reading_does_not_shuffle_the_base(spark, name):
    add(spark, name, TARGET, "r0")
    add(spark, name, BATCH, "r1")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = spark.table(name)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    base = sinks.current_version(spark, name).split(".")[1]
    left = plan.split("FullOuter", 1)[1].split("Exchange", 1)[0]
    assert base in left


def test_emptied_tables_forget_their_batches(spark, name):
    add(spark, name, TARGET, "r0")
    add(spark, name, BATCH, "r1")
    tables = sinks.Tables(name.split(".")[0])
    spark.sql(f"ALTER VIEW {name} RENAME TO {tables.silver}") if name != tables.silver else None
    spark.sql(f"ALTER TABLE {mor.changes_table(name)} RENAME TO {mor.changes_table(tables.silver)}")
    sinks.truncate_tables(spark, tables)
    assert not spark.catalog.tableExists(mor.changes_table(tables.silver))
    assert spark.table(tables.silver).count() == 0
