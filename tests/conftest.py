import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from postings.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    folder = tempfile.mkdtemp(prefix="postings-test-")
    session = build_session(
        "local[4]",
        4,
        spark__sql__warehouse__dir=f"{folder}/warehouse",
        spark__checkpoint__dir=f"{folder}/checkpoint",
        spark__driver__memory="4g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def evaluate(spark):
    """Evaluate ``expression(columns...)`` on rows of values; returns the results in order."""

    def run(expression, rows, schema):
        df = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], f"i int, {schema}")
        names = df.columns[1:]
        out = df.select("i", expression(*(df[n] for n in names)).alias("out")).orderBy("i")
        return [r["out"] for r in out.collect()]

    return run
