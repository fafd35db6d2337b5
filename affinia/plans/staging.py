"""Materialising intermediate results, and small facts about them the driver may hold."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

TASK_ROWS = 500_000
#: For tables with rows of megabytes. Parquet's writer looks at its memory each 100 rows, and a reader
#: decodes up to 4,096 rows of a row group at once: groups end by bytes, looked at row by row.
WIDE_ROWS = {"parquet.block.size": 16 << 20, "parquet.page.size.row.check.min": 1}


def shared_folder(spark: SparkSession) -> str:
    """This application's folder in the one that all executors share.

    That is ``spark.checkpoint.dir``, else the context's checkpoint folder, else the warehouse. A
    warehouse on a local disk serves one machine only: on a cluster each executor would write to a
    disk of its own and a stage could come back empty, so there a folder must be named.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir")
        if not serves(context.master, base):
            raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
    return f"{base.rstrip('/')}/affinia-{context.applicationId}"


def serves(master: str, folder: str) -> bool:
    """Whether a folder that nobody named can be read by all executors of ``master``."""
    one_machine = master == "local" or master.startswith("local[")
    on_disk = folder.startswith(("/", "file:")) or "://" not in folder
    return one_machine or not on_disk


def stage(df: DataFrame, name: str, options: dict | None = None) -> DataFrame:
    """Write ``df`` as a table in the shared folder and return a scan of it.

    Cuts the lineage of iterative jobs, survives the loss of executors, and gives the optimizer
    the true size of the result, so that it can choose broadcast joins on evidence.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.options(**(options or {})).parquet(path)
    scan = spark.read.schema(df.schema).parquet(path)
    scan.staged_at = path
    return scan


def spent(*stages: DataFrame) -> None:
    """Delete staged tables that nothing reads any more, such as a loop's round before last."""
    for df in stages:
        path = getattr(df, "staged_at", None)
        if path:
            java = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            conf = df.sparkSession._jsparkSession.sessionState().newHadoopConf()
            java.getFileSystem(conf).delete(java, True)


def tasks_for(spark: SparkSession, rows: int) -> int | None:
    """The number of tasks that hold at most about ``TASK_ROWS`` rows each; None for one task's rows.

    Adaptive execution sizes tasks by compressed bytes, of which narrow rows need few: sorted or
    hashed, such a task would hold millions of rows.
    """
    return max(-(-rows // TASK_ROWS), spark.sparkContext.defaultParallelism) if rows > TASK_ROWS else None


@contextmanager
def partition_kept(spark: SparkSession) -> Iterator[None]:
    """Lets joins on (block, …) use inputs that are partitioned by block alone."""
    with _set(spark, "spark.sql.requireAllClusterKeysForCoPartition", "false"):
        yield


@contextmanager
def at_once(spark: SparkSession, rows: int) -> Iterator[None]:
    """What is staged meanwhile sends wide rows to Python so few at a time, not 10,000 in one batch."""
    with _set(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", str(rows)):
        yield


@contextmanager
def _set(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


class Appended:
    """A table that a loop adds to, so that the plan of the whole does not grow with the rounds."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.schema = spark, None
        self.path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"

    def add(self, df: DataFrame) -> None:
        df.write.mode("append").parquet(self.path)
        self.schema = df.schema

    def rows(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path)


def facts(df: DataFrame) -> dict:
    """The single row of a global aggregate, as a dict."""
    return df.first().asDict()


def has_rows(df: DataFrame) -> bool:
    return not df.isEmpty()
