import math
import random
import tracemalloc
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from affinia.operators import grid, neighbours, recommend
from affinia.plans.numbering import numbered


def frame(spark, rows, rated=True):
    schema = "user_id string, business_id string" + (", rating double" if rated else "")
    return spark.createDataFrame(rows, schema)


def expected_predictions(train, test, side):
    """Neighbour prediction from the definition, pair by pair."""
    turn = (lambda u, i: (u, i)) if side == "user" else (lambda u, i: (i, u))
    of, holders = defaultdict(dict), defaultdict(set)
    for u, i, r in train:
        e, f = turn(u, i)
        of[e][f] = r
        holders[f].add(e)
    raw = {}
    for u, i in test:
        e, f = turn(u, i)
        if e not in of:
            raw[u, i] = None
            continue
        above = weight = 0.0
        for v in holders[f]:
            both = of[e].keys() & of[v].keys()
            if not both:
                continue
            xs, ys = [of[e][k] for k in both], [of[v][k] for k in both]
            mx, my = sum(xs) / len(xs), sum(ys) / len(ys)
            den = math.sqrt(sum((x - mx) ** 2 for x in xs) * sum((y - my) ** 2 for y in ys))
            num = sum((x - mx) * (y - my) for x, y in zip(xs, ys))
            w = num / den if den > 1e-9 else 0.1
            above += w * (of[v][f] - my)
            weight += abs(w)
        base = sum(of[e].values()) / len(of[e])
        raw[u, i] = min(5.0, max(0.0, base + (above / weight if weight else 0.0)))
    warm = [p for p in raw.values() if p is not None]
    mean = sum(warm) / len(warm) if warm else None
    return {k: mean if p is None else p for k, p in raw.items()}


def data():
    rng = random.Random(11)
    pairs = [(f"u{u}", f"b{b}") for u in range(14) for b in range(10)]
    rng.shuffle(pairs)
    train = [(u, b, float(rng.randint(1, 5))) for u, b in pairs[:80]]
    train += [("flat", f"b{n}", 3.0) for n in range(4)] + [("single", "b1", 2.0)]
    test = pairs[80:110] + [("flat", "b7"), ("single", "b2"), ("nobody", "b1"), ("u1", "nothing"),
                            ("nobody", "nothing"), train[0][:2]]
    return train, test


@pytest.mark.parametrize("side", ["user", "item"])
@pytest.mark.parametrize("limits", [
    {}, {"pair_rows": 100}, {"hot": 5, "pair_rows": 300},
    {"hot": 5, "hot_entity": 6, "pair_rows": 300},
])
def test_predictions_follow_the_definition(spark, side, limits):
    train, test = data()
    made = recommend.cf_predict(frame(spark, train), frame(spark, test, False), side, **limits)
    found = {(r["user_id"], r["business_id"]): r["prediction"] for r in made.collect()}
    assert found == pytest.approx(expected_predictions(train, test, side))


def test_similarity_is_the_same_however_it_is_split(spark):
    train, test = data()
    ratings, targets = frame(spark, train), frame(spark, test, False)
    plain = recommend.pair_similarity(ratings, targets).collect()
    split = recommend.pair_similarity(
        ratings, targets, hot=4, hot_entity=6, pair_rows=100
    ).collect()
    assert sorted(map(tuple, plain)) == sorted(map(tuple, split))


def test_only_cold_rows_have_no_prediction(spark):
    train = frame(spark, [("a", "x", 1.0)])
    made = recommend.cf_predict(train, frame(spark, [("b", "x"), ("c", "y")], False))
    assert [r["prediction"] for r in made.collect()] == [None, None]


def test_cold_rows(spark):
    train = frame(spark, [("a", "x", 1.0)])
    test = frame(spark, [("a", "y"), ("b", "x"), ("b", "y")], False)
    assert [tuple(r) for r in recommend.cold_rows(test, train, "user_id").collect()] == [("b", 2)]


def test_ids_are_dense(spark):
    train, test = data()
    ids = recommend.encode_ids(frame(spark, train), frame(spark, test, False), "user_id").collect()
    assert sorted(map(tuple, ids)) == [(u, i) for i, u in enumerate(sorted({u for u, *_ in train + test}))]


@pytest.mark.parametrize("ranges", ["1", "7"])
def test_numbers_of_many_rows_follow_the_order(spark, ranges):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", ranges)
    keys = spark.range(30_000).select((F.col("id") * 7919 % 30_011).alias("k"))
    rows = numbered(keys.repartition(5), ["k"])
    check = rows.agg(
        F.min("number"), F.max("number"), F.count_distinct("number"),
        F.count_if(F.col("number") > F.col("k")),
    ).first()
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert tuple(check) == (0, 29_999, 30_000, 0)
    assert rows.schema["number"].dataType.simpleString() == "bigint"
    assert numbered(keys.limit(0), ["k"]).isEmpty()


def test_als_covers_every_row_and_learns(spark):
    train, test = data()
    targets = frame(spark, test, False)
    made = recommend.als_predict(frame(spark, train), targets).collect()
    assert len(made) == len(test)
    assert all(r["prediction"] is not None and not math.isnan(r["prediction"]) for r in made)
    unknown = {r["prediction"] for r in made if r["user_id"] == "nobody"}
    assert len(unknown) == 1


def test_als_solves_its_normal_equations(spark):
    """The side solved last has ridge solutions, scores are products, the rest gets their mean."""
    train, test = data()
    ratings, targets = frame(spark, train), frame(spark, test, False)
    model, users, items = recommend.als_fit(ratings, targets)
    number = {r["user_id"]: r["user"] for r in users.collect()}
    place = {r["business_id"]: r["item"] for r in items.collect()}
    of_user = {r["id"]: np.array(r["features"], float) for r in model.userFactors.collect()}
    of_item = {r["id"]: np.array(r["features"], float) for r in model.itemFactors.collect()}
    assert {len(x) for x in of_user.values()} == {2}
    rated = defaultdict(list)
    for u, i, r in train:
        rated[number[u]].append((of_item[place[i]], r))
    assert rated.keys() == of_user.keys()
    for user, mine in rated.items():
        a = sum(np.outer(v, v) for v, _ in mine) + 0.5 * len(mine) * np.eye(2)
        b = sum(v * r for v, r in mine)
        assert np.abs(a @ of_user[user] - b).max() < 1e-3 * max(1, np.abs(b).max())
    expected = {}
    for u, i in test:
        known = number[u] in of_user and place[i] in of_item
        expected[u, i] = of_user[number[u]] @ of_item[place[i]] if known else None
    scored = [p for p in expected.values() if p is not None]
    fill = sum(scored) / len(scored)
    made = {(r["user_id"], r["business_id"]): r["prediction"] for r in recommend.als_predict(ratings, targets).collect()}
    assert 0 < len(scored) < len(test)
    assert made == pytest.approx({k: fill if p is None else p for k, p in expected.items()}, abs=1e-4)


def neighbour_data(seed, hot):
    """Ratings with one item that a third of the users rated, and one user with very many ratings."""
    rng = random.Random(seed)
    rows = {(f"u{u}", f"b{rng.randrange(60)}"): float(rng.randint(1, 5)) for u in range(120) for _ in range(7)}
    if hot:
        rows |= {(f"u{u}", "b0"): float(rng.randint(1, 5)) for u in range(0, 120, 3)}
        rows |= {("u5", f"b{b}"): float(rng.randint(1, 5)) for b in range(55)}
    pairs = [(f"u{rng.randrange(125)}", rng.choice(["b0", f"b{rng.randrange(62)}"])) for _ in range(150)]
    return [(u, b, r) for (u, b), r in rows.items()], sorted(set(pairs))


@pytest.mark.parametrize("side", ["user", "item"])
@pytest.mark.parametrize("limits", [{}, {"pair_rows": 200}, {"hot": 9, "hot_entity": 30, "pair_rows": 500}])
def test_hot_items_and_entities_change_nothing(spark, side, limits, monkeypatch):
    if limits:  # the other ways inside a group
        monkeypatch.setattr(neighbours, "AT_ONCE", 50)
        monkeypatch.setattr(neighbours, "CELLS", 100)
    train, test = neighbour_data(2, True)
    made = recommend.cf_predict(frame(spark, train), frame(spark, test, False), side, **limits)
    found = {(r["user_id"], r["business_id"]): r["prediction"] for r in made.collect()}
    assert found == pytest.approx(expected_predictions(train, test, side))


def test_a_hot_item_is_dealt_to_the_whole_grid(spark):
    """With an item rated by a third of all users no block pair is three times the usual one."""
    rng = random.Random(4)
    rows = {(u, rng.randrange(1, 400)): 1.0 * rng.randint(1, 5) for u in range(3000) for _ in range(6)}
    rows |= {(u, 0): 1.0 * rng.randint(1, 5) for u in range(0, 3000, 3)}
    ratings = spark.createDataFrame([(u, b, r) for (u, b), r in rows.items()], "e long, f long, x double")
    targets = spark.createDataFrame([(u, 0 if u % 2 else rng.randrange(400)) for u in range(0, 3000, 5)], "e long, f long")
    around = neighbours.Neighbourhood(ratings, targets, pair_rows=20_000)

    def measured(group):
        return pa.table({
            "e": pa.array([len(group.target)]), "f": pa.array([len(group.needed)]),
            "above": pa.array([1.0]), "weight": pa.array([1.0]),
        })

    parts = around._in_blocks(*around._ordinary(), measured).collect()
    assert len(parts) == around.blocks**2 >= 25
    for column in ("e", "f"):
        work = sorted(r[column] for r in parts)
        assert work[-1] < 3 * work[len(work) // 2]


def test_rmse(spark):
    actual = frame(spark, [("a", "x", 3.0), ("a", "y", 1.0)])
    predicted = spark.createDataFrame(
        [("a", "x", 2.0), ("a", "y", 4.0)], "user_id string, business_id string, prediction double"
    )
    row = recommend.rmse(actual, predicted).first()
    assert row["n"] == 2 and row["rmse"] == pytest.approx(math.sqrt(5))


def test_repeated_ratings_are_reduced(spark):
    rows = frame(spark, [("a", "x", 3.0), ("a", "x", 5.0), ("b", None, 1.0)])
    assert [tuple(r) for r in recommend.unique_ratings(rows).collect()] == [("a", "x", 5.0)]


def test_rmse_counts_every_rating_of_a_repeated_pair_once(spark):
    names = "user_id long, business_id long, "
    actual = spark.createDataFrame([(1, 1, 5.0), (1, 1, 3.0), (2, 1, 4.0)], names + "rating double")
    predicted = spark.createDataFrame(
        [(1, 1, 4.0), (1, 1, 4.0), (2, 1, 2.0)], names + "prediction double"
    )
    row = recommend.rmse(actual, predicted).first()
    assert row.n == 3 and abs(row.rmse - 2**0.5) < 1e-12


def test_repeated_training_pairs_are_reduced(spark):
    names = "user_id long, business_id long, rating double"
    once = [(1, 1, 4.0), (2, 1, 5.0), (2, 2, 3.0), (3, 1, 2.0), (3, 2, 5.0), (1, 3, 1.0), (2, 3, 2.0)]
    test = spark.createDataFrame([(1, 2, 0.0)], names)

    def predicted(rows):
        return recommend.cf_predict(spark.createDataFrame(rows, names), test).first().prediction

    # The repeats are equal to the neighbours' ratings or lower, and do not touch the active user.
    assert abs(predicted(once) - predicted(once + [(2, 1, 5.0), (3, 2, 1.0)])) < 1e-12


def test_ratings_are_copied_a_fixed_number_of_times(spark):
    """More pairs make larger groups, worked on slice by slice, and not more copies of each rating."""
    rng = random.Random(9)
    rows = {(u, rng.randrange(30)): 1.0 * rng.randint(1, 5) for u in range(1500) for _ in range(8)}
    ratings = spark.createDataFrame([(u, b, r) for (u, b), r in rows.items()], "e long, f long, x double")
    targets = spark.createDataFrame([(u, u % 30) for u in range(0, 1500, 2)], "e long, f long")
    fine = neighbours.Neighbourhood(ratings, targets, pair_rows=500)
    assert fine.blocks == max(grid.SIDE, math.isqrt(4 * spark.sparkContext.defaultParallelism))
    found, whole = (
        {(r["e"], r["f"]): (r["above"], r["weight"]) for r in around.sums().collect()}
        for around in (fine, neighbours.Neighbourhood(ratings, targets))
    )
    assert found and found.keys() == whole.keys()
    assert all(found[k] == pytest.approx(whole[k]) for k in found)


def test_a_rating_goes_once_to_a_pair_of_blocks(spark):
    """Both ways round are one group: a packed rating is copied once for each block, sorted ids as differences."""
    rows = spark.createDataFrame([(0, e % 3, e, e % 7, 1.0) for e in range(300)], "role int, own int, e long, f long, x double")
    copies = grid.copied(grid.packed(rows.coalesce(1)), 3).select("block", "role").collect()
    assert sorted(tuple(r) for r in copies) == [(0, 0), (1, 0), (1, 1), (2, 0), (2, 1), (4, 0), (5, 0), (5, 1), (8, 0)]
    assert len(grid.ascending(np.arange(10**6, 10**6 + 50_000))) < 1000
    for values in ([5, 5, 9, 1 << 40], [-(1 << 62), 1 << 62], [7], []):
        blob = grid.ascending(np.array(values, np.int64))
        assert grid._unpacked([blob, blob], np.dtype(np.int64), True).tolist() == values * 2


def test_a_group_holds_its_ratings_narrowly():
    """Whole numbers stay in the narrowest type, one role at a time is unpacked, and results are as wide ones'."""
    rng = np.random.default_rng(2)
    users, n = np.sort(rng.integers(0, 20_000, 400_000)), 400_000
    keys = np.unique(users * 3_000 + rng.integers(0, 3_000, n))
    e, f, x = keys // 3_000, keys % 3_000, rng.integers(1, 6, len(keys)).astype(float)

    def packed(e, f, x):
        return [grid.ascending(e)], [grid.narrow(f)], [grid.narrow(x)]

    ratings, targets = packed(e, f, x), packed(e[::200], f[::200], x[::200] * 0)
    tracemalloc.start()
    group = neighbours._Group(ratings, ratings, targets, 100_000)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40 * len(keys)
    assert group.raters[1].dtype == np.int8 and group.active[2].dtype == np.int8
    sums = pa.concat_tables(neighbours._sums_of(group))
    large = packed(e + (1 << 40), f + (1 << 40), x), packed(e[::200] + (1 << 40), f[::200] + (1 << 40), x[::200] * 0)
    wide = pa.concat_tables(neighbours._sums_of(neighbours._Group(large[0], large[0], large[1], 100_000)))
    assert sums.num_rows > 1900
    assert sums.column("above").to_pylist() == pytest.approx(wide.column("above").to_pylist())
    assert (wide.column("e").to_numpy() - (1 << 40) == sums.column("e").to_numpy()).all()


@pytest.mark.parametrize("side", ["user", "item"])
def test_blocks_worked_on_in_parts_give_the_same(spark, side, monkeypatch):
    train, test = neighbour_data(2, True)
    monkeypatch.setattr(neighbours, "PART_ROWS", 20)  # 910 ratings in 5 blocks or more
    made = recommend.cf_predict(frame(spark, train), frame(spark, test, False), side)
    found = {(r["user_id"], r["business_id"]): r["prediction"] for r in made.collect()}
    assert found == pytest.approx(expected_predictions(train, test, side))
    rows = [recommend.pair_similarity(frame(spark, train), frame(spark, test, False), side)]
    monkeypatch.undo()
    rows.append(recommend.pair_similarity(frame(spark, train), frame(spark, test, False), side))
    split, whole = ({(r.id_1, r.id_2): (r.n_common, r.w) for r in df.collect()} for df in rows)
    assert split.keys() == whole.keys() and all(split[k] == pytest.approx(whole[k]) for k in whole)
