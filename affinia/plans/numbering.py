"""Consecutive numbers for the rows of a table, by measured ranges of an order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from affinia.plans.staging import stage

_IN_RANGE = 33  # monotonically_increasing_id: bits of the place inside a partition


def numbered(df: DataFrame, order: list[Column | str], number: str = "number") -> DataFrame:
    """``df`` with a column ``number``: the place (from 0) of the row in ``order``, a long.

    Rows are shuffled once, into ranges of the order that a sample of the keys balances; each range
    is sorted and written, and the numbers before a range are the sum of the counts of those before
    it. Only the counts, one row a range, meet in one task and are broadcast. Rows equal in the
    whole order land in one range and get consecutive numbers, whichever of them first: where very
    many may be equal, the caller adds a last key that tells them apart.
    """
    placed = stage(
        df.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id()),
        "numbered",
    )
    mine = F.shiftright("_place", _IN_RANGE)
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy(mine.alias("_range")).agg(F.count("*").alias("_n"))
        .select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    )
    inside = F.col("_place").bitwiseAND(F.lit((1 << _IN_RANGE) - 1))
    return (
        placed.withColumn("_range", mine).join(F.broadcast(starts), "_range")
        .withColumn(number, F.col("_start") + inside)
        .drop("_range", "_place", "_start")
    )
