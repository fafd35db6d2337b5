"""Centroid clustering (Lloyd's rounds) in integers, by Walsh-Hadamard progressive search.

Vectors become integers floor(SCALE x) and are transformed exactly by the Walsh-Hadamard matrix in
sequency order. The transform multiplies every squared distance by the dimension (64), so sums of
squared coefficient differences, coarse to fine, are lower bounds of it that only grow. After the
first step the centroid that looks best for a vector is summed to the end; from then on, after each
of ``STEPS`` coefficients, a centroid whose sum so far exceeds that whole sum is strictly worse and
is dropped. Those left finish all 64, so the nearest centroid and its distance are exact, ties
going to the smaller number.

A round is one map over the staged vectors: a task returns a row per centroid (count, componentwise
sums), Spark adds these up, and the driver holds only the ``k`` centroids. Hot vectors or clusters
move no more than any other.

Defined cases: vectors that are null, not of 64 components, or hold a null or non-finite component
take no part, nor do rows without a vec_id, nor vectors with an integer of 2^27 or more (|x| at or
above 131,072), whose squared distances a long could not hold; rows that repeat a vec_id are
vectors of their own; fewer than ``k`` vectors give as many centroids, with equal hashes in the
order of the vectors; empty clusters keep their centroid; a sum of distances beyond a long is null;
no vectors give no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinia.llm.common import stage

DIMENSION = 64
SCALE = 1024
CLUSTERS = 8
ROUNDS = 10
SEED = 3
#: Numbers of coefficients after which pairs are dropped.
STEPS = (4, 8, 16, 24, 32, 40, 48, 56, 64)
LIMIT = 1 << 27
#: Below this, 64 x 64 squared differences fit a signed 64-bit sum; else Python integers are used.
FAST = 1 << 24

_RESULT = (
    "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
)


def sequency(dimension: int = DIMENSION) -> np.ndarray:
    """The rows of the natural Walsh-Hadamard matrix by their number of sign changes."""
    matrix = np.ones((1, 1), np.int8)
    while len(matrix) < dimension:
        matrix = np.block([[matrix, matrix], [matrix, -matrix]])
    return np.argsort(np.count_nonzero(np.diff(matrix, axis=1), axis=1), kind="stable")


def transformed(vectors: np.ndarray) -> np.ndarray:
    """The coefficients of the rows, coarse to fine: butterflies over all rows at once."""
    n, dimension = vectors.shape
    out, half = vectors, 1
    while half < dimension:
        pairs = out.reshape(n, dimension // (2 * half), 2, half)
        a, b = pairs[:, :, 0], pairs[:, :, 1]
        out = np.stack((a + b, a - b), axis=2).reshape(n, dimension)
        half *= 2
    return out[:, sequency(dimension)]


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """For each vector (one at least) the number of its nearest centroid and the squared distance;
    and how many coefficient differences were computed in all."""
    n, dimension, k = *vectors.shape, len(centroids)
    largest = max(int(np.abs(vectors).max(initial=0)), int(np.abs(centroids).max(initial=0)))
    kind = np.int64 if largest < FAST else object
    v, c = transformed(vectors.astype(kind)), transformed(centroids.astype(kind))
    row, number = np.repeat(np.arange(n), k), np.tile(np.arange(k), n)
    done = STEPS[0]
    total = _summed(v, c, row, number, 0, done)
    likely = total.reshape(n, k).argmin(axis=1)
    least = total.reshape(n, k)[np.arange(n), likely]
    least = least + _summed(v, c, np.arange(n), likely, done, dimension)
    work = n * k * done + n * (dimension - done)
    stays = (total <= least[row]) & (number != likely[row])
    for step in STEPS[1:]:
        row, number, total = row[stays], number[stays], total[stays]
        total = total + _summed(v, c, row, number, done, step)
        work += len(row) * (step - done)
        done, stays = step, total <= least[row]
    # The finished pairs of a row, nearest first; of equal ones that with the smaller number.
    row, number, total = row[stays], number[stays], total[stays]
    order = np.lexsort((number, total, row))
    first = order[np.diff(row[order], prepend=-1) > 0]
    better = (total[first] < least[row[first]]) | (number[first] < likely[row[first]])
    at = row[first[better]]
    likely[at], least[at] = number[first[better]], total[first[better]]
    return likely, least // dimension, work


def _summed(v: np.ndarray, c: np.ndarray, row: np.ndarray, number: np.ndarray, start: int, stop: int) -> np.ndarray:
    """Squared differences of the coefficients ``start`` to ``stop`` for pairs (row, number)."""
    difference = v[row, start:stop] - c[number, start:stop]
    return (difference * difference).sum(axis=1)


def integers(embeddings: DataFrame, dimension: int = DIMENSION, scale: int = SCALE) -> DataFrame:
    """vec_id, vector (longs) of the rows that take part."""
    x = F.col("vector")
    finite = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < LIMIT / scale))
    return (
        embeddings.select(
            F.col("vec_id").cast("long").alias("vec_id"),
            F.col("embedding").cast("array<double>").alias("vector"),
        )
        .where(F.col("vec_id").isNotNull() & (F.size(x) == dimension) & finite)
        .select("vec_id", F.transform(x, lambda e: F.floor(e * F.lit(float(scale)))).alias("vector"))
    )


def first_centroids(held: DataFrame, k: int = CLUSTERS, seed: int = SEED) -> np.ndarray:
    """The vectors with the smallest SHA-256 of "seed:vec_id"; ``k`` rows reach the driver."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    chosen = held.orderBy(key, "vector").limit(k).select("vector").collect()
    return np.array([r.vector for r in chosen], np.int64).reshape(-1, DIMENSION)


def _rows(batch: pa.RecordBatch) -> np.ndarray:
    column = batch.column(batch.schema.get_field_index("vector"))
    return column.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def moved(held: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round: the floor of the mean of each one's vectors."""
    k, dimension = centroids.shape

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, sums = np.zeros(k, np.int64), np.zeros((k, dimension), np.int64)
        for batch in batches:
            if batch.num_rows:
                vectors = _rows(batch)
                number, _, _ = nearest(vectors, centroids)
                count += np.bincount(number, minlength=k)
                np.add.at(sums, number, vectors)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(k, dtype=np.int32)), pa.array(count), pa.array(sums.tolist(), pa.list_(pa.int64()))],
            ["cluster", "n", "sums"],
        )

    parts = held.select("vector").mapInArrow(add_up, "cluster int, n long, sums array<long>")
    exact = [F.sum(F.col("sums")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(dimension)]
    found = parts.groupBy("cluster").agg(F.sum("n").alias("n"), *exact).where("n > 0").collect()
    after = centroids.copy()
    for r in found:
        after[r.cluster] = [int(r[f"s{i}"]) // r.n for i in range(dimension)]
    return after


def fit(held: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED) -> np.ndarray:
    centroids = first_centroids(held, k, seed)
    for _ in range(rounds if len(centroids) else 0):
        centroids = moved(held, centroids)
    return centroids


def assigned(held: DataFrame, centroids: np.ndarray) -> DataFrame:
    """vec_id, cluster, distance (squared)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                number, distance, _ = nearest(_rows(batch), centroids)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(number.astype(np.int32)), pa.array(distance.astype(np.int64))],
                    ["vec_id", "cluster", "distance"],
                )

    return held.select("vec_id", "vector").mapInArrow(run, "vec_id long, cluster int, distance long")


def cluster(
    embeddings: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED
) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 for every vector."""
    spark = embeddings.sparkSession
    held = stage(integers(embeddings), "integers")
    centroids = fit(held, k, rounds, seed)
    if not len(centroids):
        return spark.createDataFrame([], _RESULT)
    found = stage(assigned(held, centroids), "assigned")
    sums = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("own"))
    own = {r.cluster: int(r.own) for r in sums.collect()}  # at most k rows
    facts = spark.createDataFrame([
        (number, _as_long(own[number]), _as_long(sum(own.values())),
         hashlib.sha256(",".join(map(str, centroids[number].tolist())).encode()).hexdigest())
        for number in sorted(own)
    ], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(facts), "cluster").select(*[c.split()[0] for c in _RESULT.split(", ")])


def _as_long(value: int) -> int | None:
    return value if value < 1 << 63 else None
