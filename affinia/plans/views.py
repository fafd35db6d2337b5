"""Interaction views over the TPC-H-like tables: who bought, rated or wrote what."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from affinia.plans.staging import tasks_for


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _stars() -> Column:
    return F.floor((F.col("l_quantity") - 1) / 10) + 1


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    part = table(spark, sf_dir, "part")
    return (
        lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.col("o_custkey").cast("string").alias("user_id"),
            F.col("l_suppkey").cast("string").alias("business_id"),
            F.round(F.col("l_discount") * 100).cast("long").alias("useful"),
            F.col("p_name").alias("text"),
            _stars().cast("double").alias("stars"),
        )
    )


def reviewers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The user of every review."""
    lineitem = table(spark, sf_dir, "lineitem").select("l_orderkey")
    orders = table(spark, sf_dir, "orders")
    return lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").cast("string").alias("user_id")
    )


def review_stars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("business_id"),
        _stars().cast("double").alias("stars"),
    )


def businesses(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier")
    nation = table(spark, sf_dir, "nation")
    return supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").cast("string").alias("business_id"),
        F.col("n_name").alias("state"),
    )


def order_suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(order, supplier) rows by their numbers, repeated where an order names a supplier twice."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("basket"), F.col("l_suppkey").alias("item")
    )


def basket_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``order_suppliers`` with names."""
    return order_suppliers(spark, sf_dir).select(
        F.col("basket").cast("string"), F.col("item").cast("string")
    )


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rating per customer and supplier: the one on the first order line."""
    lineitem = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    first_line = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    return (
        lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("o_custkey", "l_suppkey")
        .agg(F.min_by(_stars().cast("double"), first_line).alias("rating"))
        .select(
            F.col("o_custkey").alias("user_id"), F.col("l_suppkey").alias("business_id"), "rating"
        )
    )


def _in_test() -> Column:
    return (F.col("user_id") * 31 + F.col("business_id") * 17) % 10 == 0


def train(ratings: DataFrame) -> DataFrame:
    return ratings.where(~_in_test() & (F.col("user_id") % 50 != 0))


def train_cold_items(ratings: DataFrame) -> DataFrame:
    return ratings.where(~_in_test() & (F.col("business_id") % 25 != 0))


def test(ratings: DataFrame) -> DataFrame:
    return ratings.where(_in_test())


def doc_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document and distinct lower-case token of its whole text."""
    words = F.array_distinct(F.split(F.trim(F.lower("text")), r"\s+"))
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("item"), F.explode(words).alias("element")
    )


def customer_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(customer, part) rows by their numbers, one per order line."""
    lineitem = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    tasks = order_line_tasks(spark, sf_dir)
    if tasks:
        lineitem = lineitem.repartition(tasks, "l_orderkey")
    return lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("business_id")
    )


def order_line_tasks(spark: SparkSession, sf_dir: str) -> int | None:
    """The tasks that a row per order line is dealt to; the footers of the files tell the rows."""
    return tasks_for(spark, table(spark, sf_dir, "lineitem").count())


def graph_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``customer_parts`` with names."""
    return customer_parts(spark, sf_dir).select(
        F.col("user_id").cast("string"), F.col("business_id").cast("string")
    )
