from __future__ import annotations

from pyspark.sql import functions as F

from affinia.operators import profile
from affinia.plans import views

def _summary(spark, sf):
    """The metrics and both lists in one row, the lists as id:n;id:n;..."""
    row = profile.profile_summary(views.reviews(spark, sf), 20)
    lists = {
        name: F.array_join(F.transform(name, lambda x: F.concat_ws(":", x["id"], x["n"])), ";")
        for name in ("top20_user", "top20_business")
    }
    return row.withColumns(lists)


QUERIES = {
    "review_metrics": lambda spark, sf: profile.review_metrics(views.reviews(spark, sf)),
    "top_users": lambda spark, sf: profile.top_keys(views.reviewers(spark, sf), "user_id", 20),
    "top_businesses": lambda spark, sf: profile.top_keys(
        views.review_stars(spark, sf), "business_id", 20
    ),
    "profile_summary": _summary,
    "state_avg_stars": lambda spark, sf: profile.state_avg_stars(
        views.review_stars(spark, sf), views.businesses(spark, sf)
    ).withColumn("stars", F.round("stars", 6)),
    "state_top5": lambda spark, sf: profile.state_avg_stars(
        views.review_stars(spark, sf), views.businesses(spark, sf)
    ).limit(5).withColumn("stars", F.round("stars", 6)),
}

_REVIEWS = """
reviews AS (
  SELECT o_custkey::VARCHAR AS user_id, l_suppkey::VARCHAR AS business_id,
         round(l_discount * 100)::BIGINT AS useful, p_name AS text,
         1 + floor((l_quantity - 1) / 10) AS stars
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)
"""

_STATES = """
WITH reviews AS (
  SELECT l_suppkey AS business_id, 1 + floor((l_quantity - 1) / 10) AS stars FROM lineitem),
businesses AS (
  SELECT s_suppkey AS business_id, n_name AS state
  FROM supplier JOIN nation ON s_nationkey = n_nationkey)
SELECT state, round(avg(stars), 6) AS stars
FROM reviews JOIN businesses USING (business_id) GROUP BY state
ORDER BY avg(stars) DESC, state
"""


def _top(key: str) -> str:
    return (
        f"WITH {_REVIEWS} SELECT {key}, count(*) AS n FROM reviews "
        f"GROUP BY {key} ORDER BY n DESC, {key} LIMIT 20"
    )


def _listed(key: str) -> str:
    return f"(SELECT string_agg({key} || ':' || n, ';' ORDER BY n DESC, {key}) FROM ({_top(key)}))"


ORACLES = {
    "profile_summary": f"""
WITH {_REVIEWS}
SELECT count(*) FILTER (useful > 0) AS n_review_useful,
       count(*) FILTER (stars = 5) AS n_review_5_star,
       max(length(text)) AS n_characters,
       count(DISTINCT user_id) AS n_user,
       count(DISTINCT business_id) AS n_business,
       {_listed("user_id")} AS top20_user, {_listed("business_id")} AS top20_business
FROM reviews""",
    "review_metrics": f"""
WITH {_REVIEWS}
SELECT count(*) FILTER (useful > 0) AS n_review_useful,
       count(*) FILTER (stars = 5) AS n_review_5_star,
       max(length(text)) AS n_characters,
       count(DISTINCT user_id) AS n_user,
       count(DISTINCT business_id) AS n_business
FROM reviews""",
    "top_users": _top("user_id"),
    "top_businesses": _top("business_id"),
    "state_avg_stars": _STATES,
    "state_top5": f"{_STATES} LIMIT 5",
}
