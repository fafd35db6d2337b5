"""Rating prediction: collaborative filtering by neighbours, ALS, and their evaluation."""

from __future__ import annotations

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinia.operators.neighbours import HOT, HOT_ENTITY, PAIR_ROWS, Neighbourhood
from affinia.plans.numbering import numbered
from affinia.plans.staging import facts, stage

HIGHEST, LOWEST = 5.0, 0.0
_SIDES = {"user": ("user_id", "business_id"), "item": ("business_id", "user_id")}


def unique_ratings(ratings: DataFrame) -> DataFrame:
    """One rating per user and item: the highest where a pair is repeated."""
    known = ratings.where("user_id IS NOT NULL AND business_id IS NOT NULL AND rating IS NOT NULL")
    return known.groupBy("user_id", "business_id").agg(F.max("rating").alias("rating"))


def cold_rows(test: DataFrame, train: DataFrame, key: str) -> DataFrame:
    """(key, n_rows): test keys that never occur in train, with their number of test rows."""
    return test.join(train.select(key), key, "left_anti").groupBy(key).agg(
        F.count("*").alias("n_rows")
    )


def pair_similarity(
    train: DataFrame, test: DataFrame, side: str = "user",
    hot: int = HOT, hot_entity: int = HOT_ENTITY, pair_rows: int = PAIR_ROWS,
) -> DataFrame:
    """(id_1, id_2, n_common, w) for every test entity and each neighbour it needs."""
    around = _neighbourhood(train, test, side, hot, hot_entity, pair_rows)
    return around.pairs().select(
        F.col("e").alias("id_1"), F.col("v").alias("id_2"), F.col("n").alias("n_common"), "w"
    )


def cf_predict(
    train: DataFrame, test: DataFrame, side: str = "user",
    hot: int = HOT, hot_entity: int = HOT_ENTITY, pair_rows: int = PAIR_ROWS,
) -> DataFrame:
    """(user_id, business_id, prediction) for every test row.

    The mean rating of the active entity plus the weighted deviations of all its neighbours,
    limited to 0..5; rows of entities without any rating get the mean of all other predictions.
    Of a pair that ``train`` repeats, neighbours use the highest rating, the mean all of them.
    """
    entity, feature = _SIDES[side]
    around = _neighbourhood(train, test, side, hot, hot_entity, pair_rows)
    sums = around.sums().withColumnsRenamed({"e": entity, "f": feature})
    base = train.groupBy(entity).agg(F.avg("rating").alias("base"))
    shift = F.when(F.col("weight") != 0, F.col("above") / F.col("weight")).otherwise(0.0)
    scored = (
        test.select("user_id", "business_id")
        .join(base, entity, "left")
        .join(sums, ["user_id", "business_id"], "left")
        .select("user_id", "business_id", _limited(F.col("base") + shift).alias("prediction"))
    )
    scored = stage(scored, "predictions")
    return _filled(scored, F.col("prediction").isNull())


def encode_ids(train: DataFrame, test: DataFrame, key: str) -> DataFrame:
    """(key, id): all keys of train and test, numbered from 0 in their order."""
    keys = train.select(key).union(test.select(key)).where(F.col(key).isNotNull()).distinct()
    return numbered(keys, [key], "id").select(key, "id")


def id_universe(train: DataFrame, test: DataFrame) -> DataFrame:
    """(kind, key, id) over both kinds of ids."""
    return encode_ids(train, test, "user_id").select(
        F.lit("user").alias("kind"), F.col("user_id").cast("string").alias("key"), "id"
    ).union(
        encode_ids(train, test, "business_id").select(
            F.lit("business"), F.col("business_id").cast("string"), "id"
        )
    )


def als_fit(
    train: DataFrame, test: DataFrame, rank: int = 2, iterations: int = 20, reg: float = 0.5,
    seed: int = 42,
) -> tuple[ALSModel, DataFrame, DataFrame]:
    """The model of explicit ratings, and (user_id, user) and (business_id, item): its numbers."""
    users = stage(encode_ids(train, test, "user_id").withColumnRenamed("id", "user"), "ids")
    items = stage(encode_ids(train, test, "business_id").withColumnRenamed("id", "item"), "ids")
    als = ALS(
        rank=rank, maxIter=iterations, regParam=reg, seed=seed, userCol="user", itemCol="item",
        ratingCol="rating", coldStartStrategy="nan",
    )
    coded = train.join(users, "user_id").join(items, "business_id")
    model = als.fit(coded.select("user", "item", F.col("rating").cast("float").alias("rating")))
    return model, users, items


def als_predict(
    train: DataFrame, test: DataFrame, rank: int = 2, iterations: int = 20, reg: float = 0.5,
    seed: int = 42,
) -> DataFrame:
    """(user_id, business_id, prediction) by alternating least squares on explicit ratings.

    Pairs the model cannot score get the mean of its scores. Scores are not limited to 0..5.
    """
    model, users, items = als_fit(train, test, rank, iterations, reg, seed)
    coded = test.select("user_id", "business_id").join(users, "user_id").join(items, "business_id")
    scored = model.transform(coded).select(
        "user_id", "business_id", F.col("prediction").cast("double").alias("prediction")
    )
    scored = stage(scored, "predictions")
    return _filled(scored, F.isnan("prediction") | F.col("prediction").isNull())


def rmse(actual: DataFrame, predicted: DataFrame) -> DataFrame:
    """(n, rmse) over the ratings whose pair is predicted; a repeated pair has one prediction."""
    error = F.col("rating") - F.col("prediction")
    pair = ["user_id", "business_id"]
    joined = actual.join(predicted.groupBy(*pair).agg(F.avg("prediction").alias("prediction")), pair)
    return joined.agg(F.count(error).alias("n"), F.sqrt(F.avg(error * error)).alias("rmse"))


def _neighbourhood(
    train: DataFrame, test: DataFrame, side: str, hot: int, hot_entity: int, pair_rows: int
) -> Neighbourhood:
    entity, feature = _SIDES[side]
    ratings = stage(unique_ratings(train).select(
        F.col(entity).alias("e"), F.col(feature).alias("f"), F.col("rating").alias("x")
    ), "unique")
    targets = test.select(F.col(entity).alias("e"), F.col(feature).alias("f")).distinct()
    return Neighbourhood(ratings, targets, hot, hot_entity, pair_rows)


def _limited(value: Column) -> Column:
    return F.when(value > HIGHEST, HIGHEST).when(value < LOWEST, LOWEST).otherwise(value)


def _filled(scored: DataFrame, unknown: Column) -> DataFrame:
    """``scored`` with the mean of the known predictions in place of the unknown ones."""
    mean = facts(scored.agg(F.avg(F.when(~unknown, F.col("prediction"))).alias("mean")))["mean"]
    fill = F.lit(mean).cast("double")
    return scored.withColumn("prediction", F.when(unknown, fill).otherwise(F.col("prediction")))
