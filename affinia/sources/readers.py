"""Readers with explicit schemas for JSON reviews and businesses and for header CSV pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

REVIEW = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("business_id", T.StringType()),
    T.StructField("useful", T.LongType()),
    T.StructField("text", T.StringType()),
    T.StructField("stars", T.DoubleType()),
])
BUSINESS = T.StructType([
    T.StructField("business_id", T.StringType()),
    T.StructField("state", T.StringType()),
])
_BROKEN = "_corrupt_record"


def read_reviews(spark: SparkSession, path: str) -> DataFrame:
    """Reviews, one JSON object per line. Lines that do not parse come out as nulls."""
    return spark.read.schema(REVIEW).json(path)


def read_businesses(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BUSINESS).json(path)


def count_malformed(spark: SparkSession, path: str, schema: T.StructType = REVIEW) -> DataFrame:
    """(n_lines, n_malformed) of a JSON-lines file."""
    marked = T.StructType([*schema.fields, T.StructField(_BROKEN, T.StringType())])
    parsed = F.from_json("value", marked, {"columnNameOfCorruptRecord": _BROKEN})
    lines = spark.read.text(path).where(F.trim("value") != "")
    return lines.select(parsed[_BROKEN].alias("broken")).agg(
        F.count("*").alias("n_lines"), F.count("broken").alias("n_malformed")
    )


def read_pairs(
    spark: SparkSession, path: str, names: tuple[str, str] = ("user_id", "business_id")
) -> DataFrame:
    """The first two columns of a header CSV, as strings.

    Rows with fewer columns are dropped, and so is every line that repeats the header.
    """
    return _csv(spark, path, 2).select(
        F.col("c0").alias(names[0]), F.col("c1").alias(names[1])
    )


def read_ratings(spark: SparkSession, path: str) -> DataFrame:
    """(user_id, business_id, rating) from the first three columns of a header CSV.

    Rows whose rating is missing or not a number are dropped.
    """
    rating = F.expr("try_cast(c2 AS double)")
    return _csv(spark, path, 3).select(
        F.col("c0").alias("user_id"), F.col("c1").alias("business_id"), rating.alias("rating")
    ).where(F.col("rating").isNotNull())


def _csv(spark: SparkSession, path: str, width: int) -> DataFrame:
    """Lines split at every comma, without quoting, into at least two and ``width`` columns."""
    lines = spark.read.text(path).select("value")
    header = lines.limit(1).first()
    first = header["value"] if header else ""
    cells = F.split("value", ",")
    return (
        lines.where(F.col("value") != first)
        .select(cells.alias("cells"))
        .where(F.size("cells") > 1)
        .select(*[F.get("cells", F.lit(i)).alias(f"c{i}") for i in range(width)])
    )
