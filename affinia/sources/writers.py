"""Result writers. All overwrite, so that running a job again does not double its output."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinia.operators.profile import profile_summary


def write_profile(reviews: DataFrame, path: str) -> None:
    """One JSON object: five scalars and the two lists of most active keys."""
    profile_summary(reviews).coalesce(1).write.mode("overwrite").json(path)


def write_state_stars(stars: DataFrame, path: str) -> None:
    """``state,stars`` with a header, best first; one row per state fits one file."""
    ordered = stars.select("state", "stars").orderBy(F.desc("stars"), F.asc("state"))
    ordered.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_itemsets(candidates: DataFrame, frequent: DataFrame, path: str) -> None:
    """Candidates and frequent itemsets as (phase, size, items, freq), one folder per phase."""
    phases = candidates.select(
        F.lit("candidates").alias("phase"), "size", "items", F.lit(None).cast("long").alias("freq")
    ).union(frequent.select(F.lit("frequent"), "size", "items", "freq"))
    ordered = phases.repartitionByRange("phase", "size", "items").sortWithinPartitions(
        "phase", "size", "items"
    )
    ordered.write.mode("overwrite").partitionBy("phase").json(path)


def write_similar_pairs(pairs: DataFrame, path: str) -> None:
    """``business_id_1,business_id_2,similarity``, ordered by ids."""
    named = pairs.select(
        F.col("id_1").alias("business_id_1"), F.col("id_2").alias("business_id_2"), "similarity"
    )
    _write_csv(named.orderBy("business_id_1", "business_id_2"), path)


def write_predictions(predictions: DataFrame, path: str) -> None:
    _write_csv(predictions.select("user_id", "business_id", "prediction"), path)


def write_betweenness(edges: DataFrame, path: str) -> None:
    """``u,v,betweenness``, highest first."""
    scored = edges.select("u", "v", "betweenness")
    _write_csv(scored.orderBy(F.desc(F.round("betweenness", 9)), "u", "v"), path)


def write_communities(communities: DataFrame, path: str) -> None:
    """(community_id, size, node) rows ordered by size, community and node, as JSON lines.

    A community may hold most of the nodes, so its members stay rows.
    """
    ordered = communities.select("community_id", "size", "node").orderBy(
        "size", "community_id", "node"
    )
    ordered.write.mode("overwrite").json(path)


def _write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)
