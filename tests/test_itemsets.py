from collections import Counter
from itertools import combinations
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import functions as F

from affinia.operators import grid, itemsets, pairing, vertical
from affinia.plans.staging import stage


def make_rows(spark, baskets):
    rows = [(b, i) for b, items in baskets.items() for i in items]
    return spark.createDataFrame(rows, "basket string, item string")


def brute_force(baskets, support):
    counts = Counter()
    for items in baskets.values():
        for size in range(1, len(items) + 1):
            counts.update(combinations(sorted(items), size))
    return {items: n for items, n in counts.items() if n >= support}


def found(df):
    return {tuple(r["items"]): r["freq"] for r in df.collect()}


@pytest.fixture(scope="module")
def baskets():
    rng = random.Random(5)
    names = [f"i{n}" for n in range(12)]
    made = {f"b{n}": set(rng.sample(names, rng.randint(1, 5))) for n in range(40)}
    made["wide1"] = set(names)
    made["wide2"] = set(names[:11])
    return made


@pytest.mark.parametrize("hot", [6, 2000])
def test_frequent_itemsets_with_and_without_large_baskets(spark, baskets, hot):
    mined = itemsets.frequent_itemsets(make_rows(spark, baskets), 4, hot=hot)
    assert found(mined) == brute_force(baskets, 4)


@pytest.mark.parametrize("hot", [6, 2000])
def test_two_phases_give_the_same_and_candidates_contain_it(spark, baskets, hot):
    rows = make_rows(spark, baskets)
    expected = brute_force(baskets, 6)
    assert found(itemsets.son_frequent(rows, 6, 2, hot=hot)) == expected
    candidates = itemsets.son_candidates(rows, 6, 2, hot=hot).collect()
    assert set(expected) <= {tuple(r["items"]) for r in candidates}


@pytest.mark.parametrize("chunks,chunk", [
    (16, None), (2, "if(basket = 'b1', 0, 1)"),
])
def test_small_and_uneven_chunks_give_the_same(spark, baskets, chunks, chunk):
    chunk = None if chunk is None else F.expr(chunk)
    mined = itemsets.son_frequent(make_rows(spark, baskets), 6, chunks, chunk)
    assert found(mined) == brute_force(baskets, 6)


@pytest.mark.parametrize("hot", [6, 2000])
@pytest.mark.parametrize("largest", [1, 2, 3, 4])
def test_only_candidates_are_counted(spark, baskets, largest, hot, monkeypatch):
    everything = brute_force(baskets, 1)
    top = [items for items in sorted(everything) if len(items) == largest][::7]
    chosen = {part for items in top for n in range(1, largest + 1) for part in combinations(items, n)}
    candidates = spark.createDataFrame(
        [(len(items), list(items)) for items in chosen], "size int, items array<string>"
    )
    lengths, kept = [], itemsets._extended
    monkeypatch.setattr(itemsets, "_extended", lambda *a: lengths.append(a[2]) or kept(*a))
    counted = found(itemsets.count_candidates(make_rows(spark, baskets), candidates, 3, hot))
    assert counted == {items: n for items, n in everything.items() if n >= 3 and items in chosen}
    assert lengths == list(range(3, largest + 1))  # no longer sets are listed


def test_both_phases_read_the_baskets_staged_once(spark, baskets, monkeypatch):
    names, kept = [], itemsets.stage
    monkeypatch.setattr(itemsets, "stage", lambda df, name: names.append(name) or kept(df, name))
    itemsets.son_frequent(make_rows(spark, baskets), 6, 2)
    assert names.count("baskets") == 1
    assert names.count("occurrences") >= 2  # those of pairs too, which a join reads twice


def test_joins_of_rows_with_themselves_shuffle_them_once(spark, baskets):
    rows = stage(make_rows(spark, baskets).withColumn("need", F.lit(2)), "rows")
    pairs = stage(rows.where("item > 'i5'").select(F.array(F.lit("i1"), "item").alias("items")), "pairs")
    occurrences = stage(itemsets._pair_occurrences(rows, pairs, [], None), "occurrences")
    before = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for joined in (
            itemsets.baskets(rows, min_rows=2),
            itemsets._pair_occurrences(rows, pairs, [], None),
            itemsets._extended(occurrences, [], 3),
        ):
            assert "ReusedExchange" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_small_chunks_are_joined():
    joined = itemsets._large_chunks({0: 1, 1: 100, 2: 100}, 5)
    assert joined[0] in (joined[1], joined[2]) and joined[1] != joined[2]
    assert len(set(itemsets._large_chunks({c: 10 for c in range(10)}, 4).values())) <= 2


def test_fp_growth_agrees(spark, baskets):
    rows = make_rows(spark, baskets)
    arrays = rows.groupBy("basket").agg(F.collect_set("item").alias("items"))
    model = FPGrowth(minSupport=(5 - 0.5) / len(baskets)).fit(arrays)
    other = {tuple(sorted(r["items"])): r["freq"] for r in model.freqItemsets.collect()}
    assert found(itemsets.frequent_itemsets(rows, 5)) == other


def test_candidates_need_every_subset(spark):
    pairs = [(["a", "b"], 3), (["a", "c"], 3), (["b", "c"], 3), (["a", "d"], 3), (["b", "d"], 3),
             (["c", "e"], 3)]
    frequent = spark.createDataFrame(pairs, "items array<string>, freq long")
    made = itemsets.apriori_candidates(frequent, 3).collect()
    assert sorted(tuple(r["items"]) for r in made) == [("a", "b", "c"), ("a", "b", "d")]


def test_active_rows_are_shuffled_once_and_to_the_tasks_named(spark):
    """Counted, made distinct and joined where one shuffle by basket puts them."""
    rows = [(b, i) for b in range(20) for i in range(b % 5) for _ in range(1 + b % 2)] + [(None, 1), (3, None)] * 9
    pairs = stage(spark.createDataFrame(rows, "basket long, item long"), "pairs")
    before = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    for name, value in zip(before, ("false", "-1")):
        spark.conf.set(name, value)
    try:
        kept = itemsets.baskets(pairs, min_rows=3, tasks=7)
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert plan.count("ReusedExchange") == 1 and plan.count("Exchange hashpartitioning") == 2  # one of them names the reused one
        assert kept.rdd.getNumPartitions() == 7
        found = kept.collect()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    expected = {(b, i) for b in range(20) for i in range(b % 5) if b % 5 * (1 + b % 2) > 3}
    assert len(found) == len(expected) and {tuple(r) for r in found} == expected


def test_raw_rows_decide_about_activity(spark):
    pairs = spark.createDataFrame(
        [("u", "x"), ("u", "x"), ("u", "y"), ("v", "x"), ("v", "y")], "basket string, item string"
    )
    kept = itemsets.baskets(pairs, min_rows=2).collect()
    assert sorted(map(tuple, kept)) == [("u", "x"), ("u", "y")]


def test_nothing_in_nothing_out(spark):
    empty = spark.createDataFrame([], "basket string, item string")
    assert itemsets.frequent_itemsets(empty, 2).count() == 0
    assert itemsets.son_frequent(empty, 2, 2).count() == 0


@pytest.mark.parametrize("hot", [1, 3, 5, 100])
def test_sharing_pairs_counts_exactly_whatever_is_withheld(spark, hot):
    rng = random.Random(hot)
    features = [f"f{n}" for n in range(15)]
    weights = [15 - n for n in range(15)]
    held = {f"e{n:02}": set(rng.choices(features, weights, k=8)) for n in range(30)}
    rows = spark.createDataFrame(
        [(e, f, 3) for e, fs in held.items() for f in fs], "e string, f string, need long"
    )
    expected = {
        (a, b): len(held[a] & held[b]) for a, b in combinations(sorted(held), 2)
        if len(held[a] & held[b]) >= 3
    }
    pairs = pairing.sharing_pairs(rows, "e", "f", hot=hot).collect()
    assert {(r["e1"], r["e2"]): r["shared"] for r in pairs} == expected


def test_blocks_give_every_pair_once(spark):
    rows = spark.createDataFrame(
        [("g", n) for n in range(50)] + [("h", n) for n in range(3)], "g string, e int"
    )
    pairs = [(r["g"], r["e1"], r["e2"]) for r in
             pairing.block_pairs(rows, ["g"], "e", block=7).collect()]
    assert len(pairs) == len(set(pairs)) == 50 * 49 // 2 + 3
    assert all(a < b for _, a, b in pairs)


def eclat(baskets, support):
    """Itemsets by intersecting the baskets of items, depth first."""
    holders = {}
    for b, items in baskets.items():
        for i in items:
            holders.setdefault(i, set()).add(b)
    out = {}

    def extend(prefix, known):
        for k, (item, held) in enumerate(known):
            out[(*prefix, item)] = len(held)
            more = [(other, held & theirs) for other, theirs in known[k + 1:]]
            extend((*prefix, item), [(o, h) for o, h in more if len(h) >= support])

    extend((), [(i, h) for i, h in sorted(holders.items()) if len(h) >= support])
    return out


def wide_baskets(seed, dense):
    """Hundreds of items a basket, with groups of items that go together."""
    rng = random.Random(seed)
    names = [f"i{n:04}" for n in range(2500)]
    made = {f"b{n:03}": set(rng.sample(names, rng.randint(200, 500))) for n in range(130)}
    for g in range(12):
        group = rng.sample(names, 4)
        for b in rng.sample(sorted(made), 100 if dense else 40):
            made[b] |= set(group)
    return made


@pytest.mark.parametrize("dense, support", [(False, 36), (True, 90)])
def test_wide_baskets_from_the_side_of_the_items(spark, dense, support):
    baskets = wide_baskets(3, dense)
    expected = eclat(baskets, support)
    assert max(map(len, expected)) >= 4
    rows = make_rows(spark, baskets).repartition(4)
    assert found(vertical.vertical_itemsets(rows, support)) == expected


@pytest.mark.parametrize("support", [1, 3, 12])
def test_both_sides_of_the_search_agree(spark, support):
    """Few items in very many baskets: differences are shorter from the first levels on."""
    rng = random.Random(support)
    baskets = {f"b{n}": {i for i in "abcdefg" if rng.random() < 0.8} for n in range(150)}
    expected = brute_force(baskets, support)
    assert found(vertical.vertical_itemsets(make_rows(spark, baskets), support, hot=5)) == expected
    short = {k: n for k, n in expected.items() if len(k) <= 3}
    assert found(vertical.vertical_itemsets(make_rows(spark, baskets), support, max_size=3)) == short


def test_differences_take_over_where_they_are_fewer(spark, monkeypatch):
    used = []
    for name in ("_by_words", "_by_differences"):
        kept = getattr(vertical, name)
        monkeypatch.setattr(vertical, name, lambda *a, n=name, f=kept: used.append(n) or f(*a))
    baskets = {f"b{n}": set("abcde") if n % 9 else set("ab") for n in range(90)}
    assert found(vertical.vertical_itemsets(make_rows(spark, baskets), 5)) == brute_force(baskets, 5)
    assert set(used) == {"_by_differences"}


def test_no_rows_and_null_rows_of_the_items_side(spark):
    empty = spark.createDataFrame([], "basket string, item string")
    assert vertical.vertical_itemsets(empty, 2).count() == 0
    rows = [("x", "a"), ("x", "a"), ("y", "a"), (None, "a"), ("y", None), ("x", "b")]
    made = vertical.vertical_itemsets(spark.createDataFrame(rows, "basket string, item string"), 2)
    assert found(made) == {("a",): 2}


@pytest.mark.parametrize("at_once", [3, 40, 1 << 20])
@pytest.mark.parametrize("hot", [3, 100])
def test_pairs_counted_in_a_grid_are_those_of_the_join(spark, hot, at_once, monkeypatch):
    """Many pairs a row: every row goes to a fixed number of block pairs, and no pair is shuffled."""
    rng = random.Random(hot)
    rows = [
        (g, f"e{e}", f"f{f}", 2 + g) for g in (0, 1) for e in range(40)
        for f in {rng.randrange(25) for _ in range(1 + e % 9)}
    ]
    df = spark.createDataFrame(rows, "g int, e string, f string, need long")
    joined = pairing.sharing_pairs(df, "e", "f", ["g"], hot=hot).collect()
    counted = []
    monkeypatch.setattr(pairing, "FEW_PAIRS", 0)
    monkeypatch.setattr(pairing, "MANY", 0)
    monkeypatch.setattr(grid, "AT_ONCE", at_once)
    kept = grid.shared_counts
    monkeypatch.setattr(grid, "shared_counts", lambda *a: counted.append(a) or kept(*a))
    made = pairing.sharing_pairs(df, "e", "f", ["g"], hot=hot)
    assert joined and len(counted) == 1
    assert set(made.columns) == {"g", "e1", "e2", "need", "shared"}
    key = lambda r: (r["g"], r["e1"], r["e2"], r["need"], r["shared"])
    assert sorted(map(key, made.collect())) == sorted(map(key, joined))


@pytest.mark.parametrize("values", [
    [1, -2, 127], [300, 5], [1 << 20, 0], [1 << 40, 7], [1.0, 5.0], [0.5, 3.0], [float("nan"), 1e300], [],
])
def test_packed_values_come_back(values):
    kind = np.float64 if any(isinstance(v, float) for v in values) else np.int64
    packed = grid.narrow(np.array(values, kind))
    assert np.array_equal(grid.widened([packed, packed], kind), np.array(values * 2, kind), equal_nan=kind is np.float64)


def test_packed_values_take_the_bytes_they_vary_in():
    """Sorted inside entities, features of a million take their 20 bits and less, not three bytes and more."""
    rng = np.random.default_rng(3)
    values = np.sort(rng.integers(0, 1_200_000, (1_600, 40)), axis=1).ravel()
    assert len(grid.narrow(values)) < 2.4 * len(values)


@pytest.mark.parametrize("mostly", [0, 0.75, 2])
@pytest.mark.parametrize("wide", [0, 1 << 40])
def test_whole_numbers_are_their_own_codes_in_a_grid(spark, wide, mostly, monkeypatch):
    """No rows are joined with numbers, nor filtered unless many can meet nobody; wide numbers are numbered."""
    rng = random.Random(5)
    rows = [(e * 3 - 60, f - 9 + wide * (f == 7), 3) for e in range(40) for f in {rng.randrange(25) for _ in range(1 + e % 9)}]
    rows += [(e, 1000 + e, 3) for e in range(200, 230)] + [(None, 4, 3), (None, 5, 3), (None, 6, 3), (3, None, 3)]
    df = spark.createDataFrame(rows, "e int, f long, need long")
    joined = pairing.sharing_pairs(df.where("e IS NOT NULL AND f IS NOT NULL"), "e", "f").collect()
    numbers, counted, number, kept = [], [], pairing.numbered, grid.shared_counts
    monkeypatch.setattr(pairing, "FEW_PAIRS", 0)
    monkeypatch.setattr(pairing, "MANY", 0)
    monkeypatch.setattr(pairing, "MOSTLY", mostly)
    monkeypatch.setattr(pairing, "numbered", lambda *a: numbers.append(a) or number(*a))
    monkeypatch.setattr(grid, "shared_counts", lambda *a: counted.append(a[0]) or kept(*a))
    made = pairing.sharing_pairs(df, "e", "f")
    assert [f.dataType.simpleString() for f in made.select("e1", "e2", "need", "shared").schema] == ["int", "int", "bigint", "bigint"]
    assert joined and sorted(map(str, made.collect())) == sorted(map(str, made.sparkSession.createDataFrame(joined).select(
        F.col("e1").cast("int"), F.col("e2").cast("int"), "need", "shared").collect()))
    assert len(numbers) == (2 if wide else 0)
    if not wide:
        plan = counted[0]._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("LeftSemi") == (2 if mostly > 1 else 0)


def test_a_block_pair_holds_its_rows_narrow(monkeypatch):
    """Reading and counting a group takes few bytes a row beside a slice."""
    monkeypatch.setattr(grid, "AT_ONCE", 1 << 12)
    rng, n = np.random.default_rng(6), 400_000
    sides = [np.unique(rng.integers(low, low + n // 40, n) * n + rng.integers(0, n // 4, n)) for low in (0, n // 40)]
    names = ["block", "role", "e", "f", "x"]
    batches = [
        pa.RecordBatch.from_arrays([
            pa.array([1]), pa.array([role]), *[pa.array([blob], pa.binary()) for blob in (
                grid.ascending(keys // n), grid.narrow(keys % n), grid.narrow(np.full(len(keys), 2.0)))],
        ], names=names)
        for role, keys in enumerate(sides)
    ]
    tracemalloc.start()
    sides = grid.read(iter(batches), 2, True)
    found = sum(b.num_rows for b in grid._counted(sides, False, lambda shared, *_: shared >= 2))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found and peak < 60 * n


@pytest.mark.parametrize("ids", [[1, 2, 3], [0, 1 << 33, 1 << 40], [-(1 << 50), 7, 70_000]])
def test_codes_of_any_width_come_back_from_a_group(ids):
    e, f = np.array(ids), np.array(ids[::-1])
    blobs = [pa.array([b], pa.binary()) for b in (grid.ascending(e), grid.narrow(f), grid.narrow(f / 2))]
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([0]), *blobs], names=["block", "role", "e", "f", "x"])
    for narrowly in (False, True):
        (found, none) = grid.read([batch], 2, narrowly)
        assert found[0].tolist() == ids and found[1].tolist() == ids[::-1] and found[2].tolist() == (f / 2).tolist()
        assert not any(map(len, none))
