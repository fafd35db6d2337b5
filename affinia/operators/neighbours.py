"""Similarity of two raters over what both rated, and the neighbour sums built on it.

An *active* entity is one with a rating to predict, a *neighbour* one that rated the target.
Columns here: ``e`` active entity, ``v`` neighbour, ``f`` feature, ``x`` and ``y`` their ratings.

The number of (active, neighbour, common feature) rows far exceeds the input, so no such row is
ever moved: entities are hashed into B blocks and ratings are copied, packed (``grid``), to the B
block pairs they belong to. Each is one group for both ways round, active entities of one block and
neighbours of the other, that works on its ratings as sorted arrays and returns sums. B is fixed, so
that the copies grow with the ratings only; it is smaller where there are too few pairs for it, and
larger beyond 16M ratings a block. Blocks are packed in parts of at most about 4M ratings: a group keeps
them packed and sorts one part of either side at a time, held in the narrowest type. Inside a group the active entities go
slice by slice, near ``pair_rows`` (target, neighbour) rows each, so the pairs of a whole group are
never held. A feature rated by very many entities is dealt to the whole grid like any other; in a
slice it is paired as an outer product where that is the smaller, and looked up for the pairs that are
needed where these are fewer.

Entities with more than ``hot_entity`` ratings would fill whole blocks alone; their pairs are joined
on the feature instead, reduced before they move, the other side dealt out so that no feature is
one task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from itertools import chain
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from affinia.operators import grid
from affinia.plans.numbering import numbered
from affinia.plans.staging import facts, has_rows, stage

PAIR_ROWS = 1_000_000
HOT = 20_000
HOT_ENTITY = 1_000_000
FLAT_WEIGHT = 0.1
#: Rows that a slice expands at a time, and cells of the table in which it finds its pairs.
AT_ONCE = 1 << 18
CELLS = 1 << 22
#: Ratings of a block that a group sorts at a time, of either side; the others wait packed.
PART_ROWS = 4_000_000


class Neighbourhood:
    """Ratings and targets, split into the parts that are joined in different ways."""

    def __init__(
        self, ratings: DataFrame, targets: DataFrame,
        hot: int = HOT, hot_entity: int = HOT_ENTITY, pair_rows: int = PAIR_ROWS,
    ):
        """``ratings`` (e, f, x) with unique (e, f); ``targets`` (e, f), distinct."""
        self.spark = ratings.sparkSession
        self.ratings = ratings
        self.targets = targets
        raters = ratings.groupBy("f").agg(F.count("*").alias("raters"))
        wanted = targets.groupBy("f").agg(F.count("*").alias("wanted"))
        features = raters.join(wanted, "f", "left").select(
            F.col("raters").cast("double").alias("raters"),
            F.coalesce("wanted", F.lit(0)).alias("wanted"),
        )
        known = facts(features.agg(
            F.coalesce(F.sum("raters"), F.lit(0.0)).alias("rows"),
            F.coalesce(
                F.sum(F.when(F.col("raters") <= hot, F.col("raters") ** 2).otherwise(0)
                      + F.col("raters") * F.col("wanted")), F.lit(0.0)
            ).alias("pairs"),
            F.coalesce(F.max("raters"), F.lit(0.0)).alias("most"),
        ))
        degree = ratings.groupBy("e").agg(F.count("*").alias("_n"))
        self.hot_entities = degree.where(F.col("_n") > hot_entity).select("e")
        self.any_hot_entity = has_rows(self.hot_entities)
        self.salts = int(known["most"]) // hot + 1
        worthwhile = int(known["pairs"] / max(known["rows"], 1.0))
        busy = isqrt(4 * self.spark.sparkContext.defaultParallelism)
        wished = min(max(busy, isqrt(int(known["pairs"]) // pair_rows) + 1), max(busy, grid.SIDE))
        wished = max(1, min(wished, worthwhile))
        self.blocks = max(wished, -(-int(known["rows"]) // grid.BLOCK_ROWS))
        self.parts = max(1, -(-int(known["rows"]) // (self.blocks * PART_ROWS)))
        self.pair_rows = pair_rows

    def pairs(self) -> DataFrame:
        """(e, v, n, mean, w) for every active entity and neighbour with a common feature.

        Not staged: the pairs far exceed the ratings, and who adds them up need not store them.
        """
        parts = [self._in_blocks(*self._ordinary(), _pairs_of)]
        parts += [p.select("e", "v", "n", "mean", "w") for _, p in self._of_hot_entities()]
        return reduce(DataFrame.union, parts)

    def sums(self) -> DataFrame:
        """(e, f, above, weight): Σ w·(rating − mean) and Σ |w| for every target."""
        parts = [self._in_blocks(*self._ordinary(), _sums_of)] + [
            wanted.join(pairs, ["salt", "e", "v"]).groupBy("e", "f").agg(
                F.sum(F.col("w") * (F.col("y") - F.col("mean"))).alias("above"),
                F.sum(F.abs("w")).alias("weight"),
            )
            for wanted, pairs in self._of_hot_entities()
        ]
        return stage(
            reduce(DataFrame.union, parts).groupBy("e", "f")
            .agg(F.sum("above").alias("above"), F.sum("weight").alias("weight")), "sums",
        )

    def _sides(self) -> tuple[DataFrame, DataFrame]:
        active = self.ratings.join(self.targets.select("e").distinct(), "e", "left_semi")
        return active, self.ratings.withColumnsRenamed({"e": "v", "x": "y"})

    def _ordinary(self) -> tuple[DataFrame, DataFrame]:
        """Ratings and targets without hot entities."""
        if not self.any_hot_entity:
            return self.ratings, self.targets
        hot = self.hot_entities
        return self.ratings.join(hot, "e", "left_anti"), self.targets.join(hot, "e", "left_anti")

    def _of_hot_entities(self) -> list[tuple[DataFrame, DataFrame]]:
        """(target, neighbour) rows and pairs with a hot entity on either side.

        The side that is not hot is dealt out by its entity, the other copied to all salts.
        """
        if not self.any_hot_entity:
            return []
        active, neighbours = self._sides()
        hot = self.hot_entities
        own = active.join(hot, "e", "left_semi"), self.targets.join(hot, "e", "left_semi")
        others = active.join(hot, "e", "left_anti"), self.targets.join(hot, "e", "left_anti")
        theirs = neighbours.join(hot.withColumnRenamed("e", "v"), "v", "left_semi")

        def dealt(df: DataFrame, by: str) -> DataFrame:
            return df.withColumn("salt", F.pmod(F.xxhash64(by), F.lit(self.salts)).cast("int"))

        def copied(df: DataFrame) -> DataFrame:
            return df.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(self.salts - 1))))

        return [
            _matched(copied(own[0]), dealt(neighbours, "v"), copied(own[1])),
            _matched(dealt(others[0], "e"), copied(theirs), dealt(others[1], "e")),
        ]

    def _in_blocks(self, ratings: DataFrame, targets: DataFrame, answer: Callable) -> DataFrame:
        """What ``answer`` says about the active entities of a block and the neighbours of another,
        for every two blocks and both ways round, as a table or tables."""
        blocks, parts, slice_rows = self.blocks, self.parts, self.pair_rows
        entities, features = _codes(self.ratings, "e"), _codes(self.ratings, "f")

        def placed(df: DataFrame, role: int, rating: Column) -> DataFrame:
            rows = df.where(F.col("e").isNotNull() & F.col("f").isNotNull()).select(
                F.lit(role).alias("role"), "e", "f", rating.cast("double").alias("x")
            )
            rows = _coded(_coded(rows, "e", entities), "f", features)
            return rows.select("role", grid.block_of("e", blocks * parts).alias("own"), "e", "f", "x")

        rows = placed(ratings, _RATING, F.col("x")).union(placed(targets, _TARGET, F.lit(0)))
        copied = grid.copied(grid.packed(rows), blocks, parts)
        columns = {
            "e": T.LongType(), "v": T.LongType(), "n": T.LongType(), "mean": T.DoubleType(), "w": T.DoubleType(),
        } if answer is _pairs_of else {
            "e": T.LongType(), "f": T.LongType(), "above": T.DoubleType(), "weight": T.DoubleType(),
        }

        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            first = next(batches)
            same = first.column(0)[0].as_py() % (blocks + 1) == 0
            held = grid.held(chain([first], batches), 4, parts)
            small, large, targets, others = (held[i * parts:(i + 1) * parts] for i in range(4))
            ways = [(small, small, targets)] if same else [(small, large, targets), (large, small, others)]
            for active, raters, wanted in ways:
                for k in range(parts):
                    found = (answer(_Group(active[k], own, wanted[k], slice_rows)) for own in raters)
                    tables = chain.from_iterable([t] if isinstance(t, pa.Table) else t for t in found)
                    for table in [_added(tables)] if parts > 1 and answer is _sums_of else tables:
                        yield from table.combine_chunks().to_batches()

        found = copied.repartition(2 * blocks * blocks, "block").groupBy("block").applyInArrow(
            search, T.StructType([T.StructField(c, kind) for c, kind in columns.items()])
        )
        names = {"e": ("e", entities), "v": ("e", entities), "f": ("f", features)}
        for column in columns.keys() & names.keys():
            key, codes = names[column]
            found = _named(found, column, codes, self.ratings.schema[key].dataType)
        return found.select(*columns)


_RATING, _TARGET = 0, 1


def _codes(ratings: DataFrame, key: str) -> DataFrame | None:
    """(_key, _code) for the values of a column; None for whole numbers, which are codes themselves."""
    if isinstance(ratings.schema[key].dataType, T.IntegralType):
        return None
    keys = ratings.select(F.col(key).alias("_key")).where("_key IS NOT NULL").distinct()
    return stage(numbered(keys, ["_key"], "_code"), "codes")


def _coded(rows: DataFrame, column: str, codes: DataFrame | None) -> DataFrame:
    """``rows`` with the code of ``column``; values without one have no rating."""
    if codes is None:
        return rows.withColumn(column, F.col(column).cast("long"))
    return rows.withColumnRenamed(column, "_key").join(codes, "_key").drop("_key").withColumnRenamed(
        "_code", column
    )


def _named(rows: DataFrame, column: str, codes: DataFrame | None, kind: T.DataType) -> DataFrame:
    if codes is None:
        return rows.withColumn(column, F.col(column).cast(kind))
    return rows.withColumnRenamed(column, "_code").join(codes, "_code").drop("_code").withColumnRenamed(
        "_key", column
    )


class _Group:
    """One block pair, one way round: its ratings and targets as sorted arrays of places, the
    neighbours' in ``ids``, those of features in ``features``, the active ones' in ``entities``,
    which have targets with raters. Takes packed rows, and unpacks one role at a time."""

    def __init__(self, active: tuple, raters: tuple, targets: tuple, slice_rows: int):
        self.slice_rows = slice_rows
        v, f, y = grid.opened(raters, True)
        self.ids, self.features = np.unique(v), np.unique(f)
        self.many = len(self.ids)
        v, f = grid.placed(self.ids, v), grid.placed(self.features, f)
        self.held = np.bincount(f, minlength=len(self.features))
        self.start = np.append(0, np.cumsum(self.held))
        order = np.argsort(f, kind="stable").astype(np.int32)
        del f
        self.raters = v[order], y[order]
        del v, y, order

        e, self.target_feature, _ = self._rated(targets)
        self.entities, self.first, own = np.unique(e, return_index=True, return_inverse=True)
        self.first = np.append(self.first, len(e))
        self.target_own = own.astype(np.int32)
        e, f, x = self._rated(active)
        own = grid.placed(self.entities, e)
        if len(self.entities):
            mine = np.flatnonzero(self.entities[np.minimum(own, len(self.entities) - 1)] == e).astype(np.int32)
        else:
            mine = np.zeros(0, np.int32)
        self.active = own[mine], f[mine], x[mine]
        self.slots: np.ndarray | None = None

    def _rated(self, rows: tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows of features with raters, in the order of their entities."""
        e, f, x = grid.opened(rows, True)
        if not len(self.features):
            return e[:0], np.zeros(0, np.int32), x[:0]
        at = np.minimum(grid.placed(self.features, f), np.int32(len(self.features) - 1))
        kept = np.flatnonzero(self.features[at] == f).astype(np.int32)
        del f
        kept = kept[np.argsort(e[kept], kind="stable").astype(np.int32)]
        return e[kept], at[kept], x[kept]

    @property
    def target(self) -> np.ndarray:
        """The target of every (target, neighbour) row."""
        return np.repeat(np.arange(len(self.target_own)), self.held[self.target_feature])

    @property
    def needed(self) -> np.ndarray:
        """The pairs that the targets need."""
        return np.concatenate([np.zeros(0, np.int64), *[part.needed + part.at * self.many for part in self.slices()]])

    def slices(self) -> Iterator["_Slice"]:
        """The targets of some active entities at a time.

        A slice ends where its (target, neighbour) rows exceed ``slice_rows``, or its pairs the
        cells of a table; one active entity may exceed both alone.
        """
        total = np.append(0, np.cumsum(self.held[self.target_feature]))[self.first]
        most = max(1, CELLS // max(self.many, 1))
        at = 0
        while at < len(self.entities):
            stop = int(np.searchsorted(total, total[at] + self.slice_rows, "right")) - 1
            stop = max(at + 1, min(stop, at + most))
            yield _Slice(self, at, stop)
            at = stop

    def table(self, cells: int) -> np.ndarray:
        """At least ``cells`` cells of -1, which who uses them resets."""
        if self.slots is None or len(self.slots) < cells:
            self.slots = np.full(cells, -1, np.int32)
        return self.slots


class _Slice:
    """The targets ``low`` to ``high`` of ``many`` active entities, the pairs these need, and their similarity.

    ``wanted`` rows join targets with the raters of their feature: ``target`` is the number of the
    target, ``rater`` the place of the rating, ``pair`` that of the pair among the ``needed`` ones.
    """

    def __init__(self, group: _Group, at: int, stop: int):
        """The active entities from place ``at`` to ``stop``."""
        self.group, self.at, self.many = group, at, stop - at
        self.low, self.high = group.first[at], group.first[stop]
        feature = group.target_feature[self.low:self.high]
        self.target, self.rater = grid.places(group.held[feature], group.start[feature])
        own = (group.target_own[self.low:self.high] - at).astype(np.int64)
        keys = own[self.target] * group.many + group.raters[0][self.rater]
        self.slots = group.table(self.many * group.many)
        self.slots[keys] = np.arange(len(keys), dtype=np.int32)
        last = np.flatnonzero(self.slots[keys] == np.arange(len(keys)))
        self.needed = keys[last]
        self.slots[self.needed] = np.arange(len(last), dtype=np.int32)
        self.pair = self.slots[keys]
        self.moments = np.zeros((6, len(self.needed)))  # n, sx, sy, sxx, syy, sxy
        if len(self.needed):
            self._add_up()
        self.slots[self.needed] = -1

    def _add_up(self) -> None:
        group, many = self.group, self.group.many
        e, f, x = group.active
        low, high = np.searchsorted(e, np.array([self.at, self.at + self.many], e.dtype))
        own, f, x = (e[low:high] - self.at).astype(np.int64), f[low:high], x[low:high].astype(float)
        v, y = group.raters
        features, place, raters = np.unique(f, return_inverse=True, return_counts=True)
        expanded = raters * group.held[features]
        looked_up = expanded > max(len(self.needed), AT_ONCE)
        for k in np.flatnonzero(looked_up):
            start, stop = group.start[features[k]], group.start[features[k] + 1]
            ours, theirs = np.full(self.many, np.nan), np.full(many, np.nan)
            ours[own[place == k]] = x[place == k]
            theirs[v[start:stop]] = y[start:stop]
            self._count(np.arange(len(self.needed)), ours[self.needed // many], theirs[self.needed % many])
        plain = np.flatnonzero(~looked_up[place])
        own, f, x = own[plain], f[plain], x[plain]
        total = np.cumsum(group.held[f])
        at = 0
        while at < len(f):
            before = total[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(total, before + AT_ONCE, "right")))
            row, other = grid.places(group.held[f[at:stop]], group.start[f[at:stop]])
            pair = self.slots[own[at:stop][row] * many + v[other]]
            hit = np.flatnonzero(pair >= 0)
            self._count(pair[hit], x[at:stop][row[hit]], y[other[hit]].astype(float))
            at = stop

    def _count(self, place: np.ndarray, x: np.ndarray, y: np.ndarray) -> None:
        """Add common ratings to the moments of pairs; pairs without one have NaN."""
        both = ~(np.isnan(x) | np.isnan(y))
        place, x, y = place[both], x[both], y[both]
        for i, value in enumerate((np.ones(len(x)), x, y, x * x, y * y, x * y)):
            self.moments[i] += np.bincount(place, value, len(self.needed))

    def similarity(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """n, the neighbour's mean and the weight of the needed pairs; 0 without a common feature."""
        n, sx, sy, sxx, syy, sxy = self.moments
        spread_x, spread_y = n * sxx - sx * sx, n * syy - sy * sy
        flat = (spread_x <= n * sxx * 1e-12) | (spread_y <= n * syy * 1e-12)
        with np.errstate(divide="ignore", invalid="ignore"):
            w = np.where(flat, FLAT_WEIGHT, (n * sxy - sx * sy) / np.sqrt(spread_x * spread_y))
            mean = np.where(n > 0, sy / n, 0.0)
        return n, mean, np.where(n > 0, w, 0.0)


def _pairs_of(group: _Group) -> Iterator[pa.Table]:
    def of(part: _Slice) -> pa.Table:
        n, mean, w = part.similarity()
        met = np.flatnonzero(n > 0)
        keys = part.needed[met]
        return pa.table({
            "e": _long(group.entities[part.at + keys // group.many]), "v": _long(group.ids[keys % group.many]),
            "n": pa.array(n[met].astype(np.int64)), "mean": pa.array(mean[met]), "w": pa.array(w[met]),
        })

    return _gathered(map(of, group.slices()))


def _sums_of(group: _Group) -> Iterator[pa.Table]:
    def of(part: _Slice) -> pa.Table:
        n, mean, w = part.similarity()
        pair, many = part.pair, part.high - part.low
        y = group.raters[1][part.rater]
        above = np.bincount(part.target, w[pair] * (y - mean[pair]), many)
        weight = np.bincount(part.target, np.abs(w[pair]), many)
        met = np.flatnonzero(np.bincount(part.target, n[pair] > 0, many))
        return pa.table({
            "e": _long(group.entities[group.target_own[part.low + met]]),
            "f": _long(group.features[group.target_feature[part.low + met]]),
            "above": pa.array(above[met].astype(float)), "weight": pa.array(weight[met].astype(float)),
        })

    return _gathered(map(of, group.slices()))


def _added(tables: Iterator[pa.Table]) -> pa.Table:
    """The sums of the same targets, which met one part of the neighbours after the other."""
    none = [pa.table({"e": _long([]), "f": _long([]), "above": pa.array([], pa.float64()), "weight": pa.array([], pa.float64())})]
    sums = pa.concat_tables(none + list(tables)).group_by(["e", "f"]).aggregate([("above", "sum"), ("weight", "sum")])
    return sums.select(["e", "f", "above_sum", "weight_sum"]).rename_columns(["e", "f", "above", "weight"])


def _long(values: np.ndarray) -> pa.Array:
    return pa.array(values, pa.int64())


def _gathered(tables: Iterator[pa.Table]) -> Iterator[pa.Table]:
    """Fewer and larger tables with the same rows."""
    held, n = [], 0
    for table in tables:
        held.append(table)
        n += table.num_rows
        if n >= AT_ONCE:
            yield pa.concat_tables(held)
            held, n = [], 0
    if n:
        yield pa.concat_tables(held)


def _matched(active: DataFrame, neighbours: DataFrame, targets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The (target, neighbour) rows and the similarity of the pairs in them, salt by salt."""
    pair = ["salt", "e", "v"]
    wanted = targets.join(neighbours, ["salt", "f"])
    common = active.join(neighbours, ["salt", "f"]).select(*pair, "x", "y")
    common = common.join(wanted.select(*pair).hint("shuffle_hash"), pair, "left_semi")
    return wanted, _weighted(common.groupBy(*pair))


def _weighted(groups) -> DataFrame:
    """Pearson correlation over common features from raw moments.

    Zero variance on either side, as with a single common feature, gives the flat weight.
    """
    x, y = F.col("x"), F.col("y")
    moments = groups.agg(
        F.count("*").alias("n"), F.sum(x).alias("sx"), F.sum(y).alias("sy"),
        F.sum(x * x).alias("sxx"), F.sum(y * y).alias("syy"), F.sum(x * y).alias("sxy"),
    )
    n, sx, sy = F.col("n"), F.col("sx"), F.col("sy")
    spread_x = n * F.col("sxx") - sx * sx
    spread_y = n * F.col("syy") - sy * sy
    flat = (spread_x <= n * F.col("sxx") * 1e-12) | (spread_y <= n * F.col("syy") * 1e-12)
    w = F.when(flat, F.lit(FLAT_WEIGHT)).otherwise(
        (n * F.col("sxy") - sx * sy) / F.sqrt(spread_x * spread_y)
    )
    return moments.select("salt", "e", "v", "n", (sy / n).alias("mean"), w.alias("w"))
