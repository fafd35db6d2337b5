import os
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from affinia.plans import staging


@pytest.mark.parametrize("master, folder, may", [
    ("local[8]", "file:/home/x/spark-warehouse", True),
    ("local", "/home/x/spark-warehouse", True),
    ("yarn", "file:/home/x/spark-warehouse", False),
    ("spark://head:7077", "spark-warehouse", False),
    ("local-cluster[3,2,1024]", "/home/x/spark-warehouse", False),
    ("yarn", "hdfs://names/warehouse", True),
])
def test_a_local_warehouse_serves_one_machine_only(master, folder, may):
    assert staging.serves(master, folder) is may


def test_spent_stages_are_deleted(spark):
    held = staging.stage(spark.range(5), "spent")
    folder = held.staged_at.removeprefix("file:")
    assert held.count() == 5 and os.path.isdir(folder)
    staging.spent(held, spark.range(1))
    assert not os.path.exists(folder)


def test_row_groups_of_wide_rows_end_by_bytes(spark):
    """A writer or a reader of rows of megabytes holds a few of them, however many a file has."""
    rows = spark.range(0, 40, 1, 1).select("id", F.array_repeat(F.rand(3), 250_000).alias("x")).select(
        "id", F.transform("x", lambda v, i: v * i).alias("x")
    )
    staged = staging.stage(rows, "wide", staging.WIDE_ROWS)
    (file,) = Path(staged.staged_at.removeprefix("file:")).glob("*.parquet")
    held = pq.ParquetFile(file).metadata
    most = max(held.row_group(i).total_byte_size for i in range(held.num_row_groups))
    assert held.num_rows == 40 and most < 32 << 20
    assert staged.agg(F.sum(F.size("x"))).first()[0] == 40 * 250_000


def test_wide_rows_travel_a_few_at_a_time(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], ["n"])

    def seen():
        return staging.stage(spark.range(0, 50, 1, 1).mapInArrow(sizes, "n long"), "sizes").agg(F.max("n")).first()[0]

    with staging.at_once(spark, 4):
        few = seen()
    assert few == 4 and seen() == 50
