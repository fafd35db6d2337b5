"""Approximate nearest neighbours by collision counting over single projections.

A block of vectors keeps, for each of ``PROJECTIONS`` random directions, its projections as a sorted
array. A query opens a window around its own projection in every array; a vector collides once for
each window it lies in, and one that collides at least ``NEEDED`` times is verified by its exact
distance. The windows are ``WIDTH`` x radius to either side, and the radius grows from round to round
(virtual rehashing: the arrays stay as they are, only the ends of the windows move; a vector's place
in an array tells whether it lies in the window): by ``GROWTH``, or to the distance of the k-th
nearest verified vector once there are ``k``. It ends when ``k`` verified vectors lie within the
radius, or the whole block is verified. A vector at the radius is within a window with
probability 0.77, so it has fewer than ``NEEDED`` of 192 collisions with a probability of about 0.08,
and a nearer one with less; of vectors at 1.2 times the radius about one in eight is verified, at
1.4 times hardly any.

Vectors are shuffled once, into blocks, whose arrays are built once; the queries are sent to every
block and stream past it in batches, so a task holds a block and a batch, however many queries there
are. A block returns ``k`` rows a query; the best of them follow by a ranking per query. The
projections are a fixed function of dimension and seed: nothing is fitted.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite components take no
part; vectors are compared with those of the same dimension; rows without a vec_id take no part;
rows that repeat a vec_id are one vector (the smallest of them); equal distances go to the smaller
vec_id; fewer than ``k`` candidates give all of them; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from affinia.llm.common import stage

PROJECTIONS = 192
WIDTH = 1.2
NEEDED = 139
GROWTH = 1.1
VECTORS = 4096
SEED = 20_240_229

_FOUND = "query_id long, vec_id long, score double"


def directions(dimension: int, projections: int = PROJECTIONS) -> np.ndarray:
    """Columns of standard normal components: the projection of a distance d is normal, with spread d."""
    return np.random.default_rng([SEED, dimension]).standard_normal((dimension, projections))


class Block:
    """The sorted projections of a block of vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        self.direction = directions(vectors.shape[1])
        projected = (vectors @ self.direction).T
        order = np.argsort(projected, axis=1, kind="stable")
        # One array for all directions, each lifted above the one before it, so that the ends of all
        # windows are found at once; and every vector's place in each of the arrays.
        self.lift = (4 + 4 * float(np.abs(projected).max())) * np.arange(len(projected))
        self.sorted = (np.take_along_axis(projected, order, axis=1) + self.lift[:, None]).ravel()
        self.place = np.empty(order.shape, np.uint16 if len(ids) < 1 << 16 else np.uint32)
        np.put_along_axis(self.place, order, np.arange(len(ids), dtype=self.place.dtype)[None], axis=1)
        # A first radius: most of the usual distance within which k of the block's vectors lie.
        sample = vectors[:: max(1, len(vectors) // 32)][:32]
        tenth = min(10, len(vectors) - 1)
        near = np.array([np.partition(self.distance(v, slice(None)), tenth)[tenth] for v in sample])
        self.radius = 0.95 * float(np.median(near[near > 0])) if (near > 0).any() else 1e-9
        self.verified = 0

    def distance(self, query: np.ndarray, rows) -> np.ndarray:
        return np.sqrt(((self.vectors[rows] - query) ** 2).sum(axis=1))

    def search(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """ids and distances of the k nearest found, the query's own row left out."""
        n, m = len(self.ids), len(self.lift)
        centre = query @ self.direction
        edge = np.arange(m) * n
        # A query from another block may lie outside the block's range.
        reach = (self.lift[1] if m > 1 else 1.0) / 2 - 1
        verified = np.zeros(n, bool)
        rows, dist = np.zeros(0, np.int64), np.zeros(0)
        own = self.ids == query_id
        radius = self.radius
        while True:
            half = WIDTH * radius
            low = np.searchsorted(self.sorted, np.clip(centre - half, -reach, reach) + self.lift, "left") - edge
            high = np.searchsorted(self.sorted, np.clip(centre + half, -reach, reach) + self.lift, "right") - edge
            # Places below the window wrap around to numbers above any width.
            kind = self.place.dtype
            inside = self.place - low[:, None].astype(kind) < (high - low)[:, None].astype(kind)
            full = (high - low == n).all()
            fresh = np.flatnonzero((full | (inside.sum(axis=0, dtype=np.uint16) >= NEEDED)) & ~verified)
            verified[fresh] = True
            fresh = fresh[~own[fresh]]
            rows = np.concatenate((rows, fresh))
            dist = np.concatenate((dist, self.distance(query, fresh)))
            if verified.all():
                break
            # With k verified, the last of them is the radius within which nothing may be missed.
            wanted = np.partition(dist, k - 1)[k - 1] if len(dist) >= k else np.inf
            if wanted <= radius:
                break
            radius = min(wanted * 1.0001 + 1e-12, max(radius * GROWTH, self._next(centre, low, high) if not inside.any() else 0))
        self.verified += len(rows)
        best = np.lexsort((self.ids[rows], dist))[:k]
        return self.ids[rows[best]], dist[best]

    def _next(self, centre: np.ndarray, low: np.ndarray, high: np.ndarray) -> float:
        """The radius at which a window meets its next projection."""
        n, gaps = len(self.ids), []
        for i, (a, b) in enumerate(zip(low.tolist(), high.tolist())):
            own = self.sorted[i * n:(i + 1) * n] - self.lift[i]
            gaps += [centre[i] - own[a - 1]] if a else []
            gaps += [own[b] - centre[i]] if b < n else []
        return float(min(gaps)) / WIDTH * 1.0001 + 1e-9


def _answered(k: int):
    """A function of rows in the order (dim, block, role, id): each block's vectors, then queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, vectors, block = None, [], [], None
        for batch in batches:
            dim, number, role = (batch.column(c).to_numpy() for c in ("dim", "block", "role"))
            cuts = np.flatnonzero((np.diff(dim) != 0) | (np.diff(number) != 0) | (np.diff(role) != 0)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                if a == b:
                    continue
                part = batch.slice(a, b - a)
                if key != (dim[a], number[a]):
                    key, ids, vectors, block = (dim[a], number[a]), [], [], None
                own, values = _arrays(part, int(dim[a]))
                if role[a] == 0:
                    ids.append(own)
                    vectors.append(values)
                elif ids:
                    block = block or Block(np.concatenate(ids), np.concatenate(vectors))
                    found = [block.search(q, v, k) for q, v in zip(own.tolist(), values)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.repeat(own, [len(i) for i, _ in found])),
                         pa.array(np.concatenate([i for i, _ in found]).astype(np.int64)),
                         pa.array(np.concatenate([d for _, d in found]))],
                        ["query_id", "vec_id", "score"],
                    )

    return run


def _arrays(batch: pa.RecordBatch, dimension: int) -> tuple[np.ndarray, np.ndarray]:
    flat = batch.column("vector").flatten().to_numpy(zero_copy_only=False)
    return batch.column("id").to_numpy(), flat.reshape(batch.num_rows, dimension)


def usable(embeddings: DataFrame) -> DataFrame:
    """id, vector (doubles), dim of the vectors that take part, one for each vec_id."""
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return (
        embeddings.select(
            F.col("vec_id").cast("long").alias("id"), F.col("embedding").cast("array<double>").alias("vector")
        )
        .where(F.col("id").isNotNull() & F.col("vector").isNotNull())
        .where(finite & F.exists("vector", lambda x: x != 0))
        .groupBy("id").agg(F.min("vector").alias("vector"))
        .withColumn("dim", F.size("vector"))
    )


def nearest(embeddings: DataFrame, every: int = 100, k: int = 10, vectors: int = VECTORS) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each vector whose id divides by ``every``."""
    held = stage(usable(embeddings), "vectors")
    blocks = -(-held.count() // vectors) or 1
    own = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("long")
    every_block = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))
    columns = ["dim", "block", "role", "id", "vector"]
    rows = held.select("*", own.alias("block"), F.lit(0).alias("role")).select(*columns).union(
        held.where(F.col("id") % every == 0)
        .select("*", every_block.alias("block"), F.lit(1).alias("role")).select(*columns)
    )
    tasks = max(held.sparkSession.sparkContext.defaultParallelism, 2 * blocks)
    found = rows.repartition(tasks, "dim", "block").sortWithinPartitions(*columns[:-1]).mapInArrow(
        _answered(k), _FOUND
    )
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
