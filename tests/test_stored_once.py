"""What the registered queries store, and what they work out again."""

import datetime

import pytest
from registry import catalog, fixtures


@pytest.fixture
def folder(spark, tmp_path):
    documents = [(i, f"line {i}\n$75 per hour {i}") for i in range(1, 40)]
    pages = [(i, f"https://www.seek.co.nz/{i}", '<title>t</title><a href="/x">a b</a>') for i in range(1, 20)]
    lines = [(i, i % 7, i, i % 5, "N", "O", datetime.date(2024, 1, 1 + i % 20)) for i in range(1, 60)]
    for name, rows, schema in (
        ("documents", documents, "doc_id bigint, text string"),
        ("pages", pages, "page_id bigint, url string, html string"),
        ("lineitem", lines, "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_returnflag string, l_linestatus string, l_shipdate date"),
    ):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


@pytest.fixture
def stored(monkeypatch):
    plans, real = {}, catalog.materialize

    def record(df, name, *rest):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return real(df, name, *rest)

    monkeypatch.setattr(catalog, "materialize", record)
    return plans


def test_silver_is_stored_without_a_shuffle(spark, folder, stored):
    assert catalog.stored_silver(spark, folder).count() == fixtures.rate_silver(spark, folder).count() == 59
    assert "Exchange" not in stored["silver"]


@pytest.mark.parametrize("key", ["jb1_rebuild_from_bronze", "jb1_rebuild_small_payloads", "sc8_bronze_unnest"])
def test_bodies_and_payloads_are_parsed_once(spark, folder, stored, key):
    rows = catalog.QUERIES[key](spark, folder)
    assert rows.count() > 0
    assert "from_xml" not in rows._jdf.queryExecution().executedPlan().toString()
    assert stored["collected"].count("from_xml") > 0
    if key != "sc8_bronze_unnest":
        assert "from_xml" not in stored["bronze"]
        assert "from_json" not in stored["classified"]
