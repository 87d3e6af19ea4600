"""Session settings and tables that cut lineage."""

from __future__ import annotations

import contextlib
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution.

    On a cluster, leave ``master`` and ``shuffle_partitions`` to the submit
    settings. Sort-merge joins stay available for data of any size; adaptive
    execution splits skewed partitions and coalesces small ones.
    """
    builder = (
        SparkSession.builder.appName("postings")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


_local_folder: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables: ``spark.checkpoint.dir`` of the session.

    Only a local session may leave it unset, as in tests; it gets a new local folder. On a
    cluster a folder of the driver would be out of the executors' sight.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if not _local_folder:
            _local_folder.append(tempfile.mkdtemp(prefix="postings-"))
        folder = _local_folder[0]
    return folder.rstrip("/")


def materialize(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """Write ``df`` as a table in the shared folder and return the table.

    Later steps start from the files, so a lost executor costs only its own tasks,
    and each step reads only the columns it needs.
    """
    path = f"{folder or shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """A ``materialize`` whose tables are deleted at the end, also after a failure."""
    folder = f"{shared_folder(spark)}/run-{uuid.uuid4().hex}"
    try:
        yield lambda df, name: materialize(df, name, folder)
    finally:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
