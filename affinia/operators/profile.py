"""Review profiling: scalar metrics, most active keys, mean stars per state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def review_metrics(reviews: DataFrame) -> DataFrame:
    """Useful reviews, 5-star reviews, longest text, distinct users and businesses, in one pass."""
    return reviews.agg(
        F.count_if(F.col("useful") > 0).alias("n_review_useful"),
        F.count_if(F.col("stars") == 5).alias("n_review_5_star"),
        F.max(F.length("text")).cast("long").alias("n_characters"),
        F.count_distinct("user_id").alias("n_user"),
        F.count_distinct("business_id").alias("n_business"),
    )


def top_keys(reviews: DataFrame, key: str, n: int = 20) -> DataFrame:
    """The ``n`` keys with most rows; ties go to the smaller key."""
    counts = reviews.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), F.asc(key)).limit(n)


def profile_summary(reviews: DataFrame, n: int = 20) -> DataFrame:
    """One row with the five metrics and both lists of most active keys."""

    def as_list(key: str, name: str) -> DataFrame:
        ranked = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("r"), key)))
        return top_keys(reviews, key, n).agg(
            F.transform(ranked, lambda x: F.struct(x[key].alias("id"), (-x["r"]).alias("n")))
            .alias(name)
        )

    parts = (
        review_metrics(reviews)
        .unionByName(as_list("user_id", "top20_user"), allowMissingColumns=True)
        .unionByName(as_list("business_id", "top20_business"), allowMissingColumns=True)
    )
    return parts.agg(*[F.any_value(c, ignoreNulls=True).alias(c) for c in parts.columns])


def state_avg_stars(reviews: DataFrame, businesses: DataFrame) -> DataFrame:
    """Mean stars per state, best first.

    Reviews are reduced to one (sum, count) row per business before they meet the businesses, so
    the join moves businesses, not reviews, and a business with most reviews is no hot key.
    """
    per_business = (
        reviews.where(F.col("business_id").isNotNull())
        .groupBy("business_id")
        .agg(F.sum("stars").alias("total"), F.count("stars").alias("rated"))
    )
    return (
        per_business.join(businesses.where(F.col("state").isNotNull()), "business_id")
        .groupBy("state")
        .agg(F.try_divide(F.sum("total"), F.sum("rated")).alias("stars"))
        .orderBy(F.desc("stars"), F.asc("state"))
    )
