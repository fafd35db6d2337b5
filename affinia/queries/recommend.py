from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinia.operators import recommend
from affinia.plans import views
from affinia.plans.staging import stage

_TRAIN = {"user": views.train, "item": views.train_cold_items}


def _split(spark: SparkSession, sf: str, side: str = "user") -> tuple[DataFrame, DataFrame]:
    ratings = stage(views.ratings(spark, sf), "ratings")
    return _TRAIN[side](ratings), views.test(ratings)


def _similarity(side: str):
    def query(spark: SparkSession, sf: str) -> DataFrame:
        # One row per entity: all its neighbours would be rows in the square of the entities.
        pairs = recommend.pair_similarity(*_split(spark, sf, side), side)
        return pairs.groupBy("id_1").agg(
            F.count("*").alias("n_neighbours"), F.sum("n_common").cast("long").alias("n_common"),
            F.round(F.sum("w"), 4).alias("total_w"),
        )

    return query


def _predict(side: str):
    def query(spark: SparkSession, sf: str) -> DataFrame:
        return _rounded(recommend.cf_predict(*_split(spark, sf, side), side))

    return query


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumn("prediction", F.round("prediction", 6))


def _rmse(spark: SparkSession, sf: str) -> DataFrame:
    train, test = _split(spark, sf)
    error = recommend.rmse(test, recommend.cf_predict(train, test, "user"))
    return error.withColumn("rmse", F.round("rmse", 6))


def _cold(key: str, side: str):
    def query(spark: SparkSession, sf: str) -> DataFrame:
        train, test = _split(spark, sf, side)
        return recommend.cold_rows(test, train, key)

    return query


QUERIES = {
    "id_universe": lambda spark, sf: recommend.id_universe(*_split(spark, sf)),
    "cold_users": _cold("user_id", "user"),
    "cold_items": _cold("business_id", "item"),
    "cf_user_similarity": _similarity("user"),
    "cf_item_similarity": _similarity("item"),
    "cf_user_predict": _predict("user"),
    "cf_item_predict": _predict("item"),
    "rmse_eval": _rmse,
    "als_predict": lambda spark, sf: _rounded(recommend.als_predict(*_split(spark, sf))),
}

_RATINGS = """
ratings AS MATERIALIZED (
  SELECT o_custkey AS user_id, l_suppkey AS business_id,
         arg_min(1 + floor((l_quantity - 1) / 10),
                 (l_orderkey, l_linenumber, l_partkey, l_extendedprice)) AS rating
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2),
test AS MATERIALIZED (
  SELECT * FROM ratings WHERE (user_id * 31 + business_id * 17) % 10 = 0)
"""

_TRAIN_SQL = {
    "user": """train AS MATERIALIZED (SELECT * FROM ratings
  WHERE (user_id * 31 + business_id * 17) % 10 <> 0 AND user_id % 50 <> 0)""",
    "item": """train AS MATERIALIZED (SELECT * FROM ratings
  WHERE (user_id * 31 + business_id * 17) % 10 <> 0 AND business_id % 25 <> 0)""",
}


def _pairs_sql(side: str) -> str:
    entity, feature = {"user": ("user_id", "business_id"), "item": ("business_id", "user_id")}[side]
    return f"""
WITH {_RATINGS}, {_TRAIN_SQL[side]},
a AS MATERIALIZED (SELECT {entity} AS e, {feature} AS f, rating AS r FROM train),
targets AS MATERIALIZED (SELECT {entity} AS e, {feature} AS f FROM test),
wanted AS MATERIALIZED (
  SELECT t.e, a.e AS v, t.f, a.r FROM targets t JOIN a ON t.f = a.f),
needed AS MATERIALIZED (SELECT DISTINCT e, v FROM wanted),
moments AS MATERIALIZED (
  SELECT p.e, q.e AS v, count(*)::DOUBLE AS n, sum(p.r) AS sx, sum(q.r) AS sy,
         sum(p.r * p.r) AS sxx, sum(q.r * q.r) AS syy, sum(p.r * q.r) AS sxy
  FROM a p JOIN a q ON p.f = q.f WHERE p.e IN (SELECT e FROM targets) GROUP BY 1, 2),
pairs AS MATERIALIZED (
  SELECT m.e, m.v, n, sy / n AS mean,
         CASE WHEN n * sxx - sx * sx = 0 OR n * syy - sy * sy = 0 THEN 0.1
              ELSE (n * sxy - sx * sy) / sqrt((n * sxx - sx * sx) * (n * syy - sy * sy)) END AS w
  FROM moments m JOIN needed USING (e, v))
"""


def _predict_sql(side: str) -> str:
    entity, feature = {"user": ("user_id", "business_id"), "item": ("business_id", "user_id")}[side]
    return f"""
{_pairs_sql(side)},
sums AS (
  SELECT e, f, sum(w * (r - mean)) AS above, sum(abs(w)) AS weight
  FROM wanted JOIN pairs USING (e, v) GROUP BY 1, 2),
base AS (SELECT e, avg(r) AS base FROM a GROUP BY 1),
warm AS (
  SELECT e, f, base + CASE WHEN weight <> 0 THEN above / weight ELSE 0 END AS p
  FROM targets JOIN base USING (e) LEFT JOIN sums USING (e, f)),
limited AS MATERIALIZED (
  SELECT e, f, CASE WHEN p > 5 THEN 5.0 WHEN p < 0 THEN 0.0 ELSE p END AS p FROM warm),
predicted AS MATERIALIZED (
  SELECT e AS {entity}, f AS {feature},
         coalesce(limited.p, (SELECT avg(p) FROM limited)) AS prediction
  FROM targets LEFT JOIN limited USING (e, f))
"""


def _cold_sql(key: str, side: str) -> str:
    return (
        f"WITH {_RATINGS}, {_TRAIN_SQL[side]} SELECT {key}, count(*) AS n_rows FROM test "
        f"WHERE {key} NOT IN (SELECT {key} FROM train) GROUP BY 1"
    )


def _similarity_sql(side: str) -> str:
    return (
        f"{_pairs_sql(side)} SELECT e AS id_1, count(*) AS n_neighbours, "
        "sum(n)::BIGINT AS n_common, round(sum(w), 4) AS total_w FROM pairs GROUP BY 1"
    )


def _rounded_sql(side: str) -> str:
    return (
        f"{_predict_sql(side)} SELECT user_id, business_id, round(prediction, 6) AS prediction "
        "FROM predicted"
    )


ORACLES = {
    "id_universe": f"""
WITH {_RATINGS}, {_TRAIN_SQL["user"]}, both_parts AS (
  SELECT user_id, business_id FROM train UNION ALL SELECT user_id, business_id FROM test)
SELECT 'user' AS kind, user_id::VARCHAR AS key, row_number() OVER (ORDER BY user_id) - 1 AS id
FROM (SELECT DISTINCT user_id FROM both_parts)
UNION ALL SELECT 'business', business_id::VARCHAR, row_number() OVER (ORDER BY business_id) - 1
FROM (SELECT DISTINCT business_id FROM both_parts)""",
    "cold_users": _cold_sql("user_id", "user"),
    "cold_items": _cold_sql("business_id", "item"),
    "cf_user_similarity": _similarity_sql("user"),
    "cf_item_similarity": _similarity_sql("item"),
    "cf_user_predict": _rounded_sql("user"),
    "cf_item_predict": _rounded_sql("item"),
    "rmse_eval": f"""
{_predict_sql("user")}
SELECT count(*) AS n, round(sqrt(avg((rating - prediction) ** 2)), 6) AS rmse
FROM test JOIN predicted USING (user_id, business_id)""",
}
