import heapq
import random
from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from affinia.operators import communities, graph, pairing
from affinia.plans import staging, views
from affinia.plans.staging import stage
from affinia.queries.graph import edges as registered_edges

SEVEN = [("A", "B"), ("A", "C"), ("B", "C"), ("B", "D"), ("D", "E"), ("D", "F"), ("D", "G"),
         ("E", "F"), ("F", "G")]
BOW = [("A", "B"), ("A", "C"), ("B", "C"), ("C", "D"), ("D", "E"), ("X", "Y")]
TWO_PARTS = SEVEN + [("X", "Y"), ("Y", "Z"), ("U", "V")]


def frame(spark, edges):
    return spark.createDataFrame(edges, "u string, v string")


def reach(edges, start):
    seen, new = set(), {start}
    while new:
        seen |= new
        new = {b for e in edges for a, b in (e, e[::-1]) if a in seen} - seen
    return frozenset(seen)


def parts(edges, nodes):
    return {reach(edges, n) for n in nodes}


def brute_betweenness(edges):
    """All shortest paths listed one by one."""
    nodes = sorted({n for e in edges for n in e})
    near = {n: {b for e in edges for a, b in (e, e[::-1]) if a == n} for n in nodes}
    total = Counter({tuple(sorted(e)): 0.0 for e in edges})
    for s, t in combinations(nodes, 2):
        paths = [[s]]
        while paths and not any(p[-1] == t for p in paths):
            paths = [p + [n] for p in paths for n in near[p[-1]] if n not in p]
        paths = [p for p in paths if p[-1] == t]
        for p in paths:
            for a, b in zip(p, p[1:]):
                total[tuple(sorted((a, b)))] += 1 / len(paths)
    return dict(total)


def half_modularity(edges, groups):
    m = len(edges)
    degree = Counter(n for e in edges for n in e)
    linked = {frozenset(e) for e in edges}
    return sum(
        (frozenset(p) in linked) - degree[p[0]] * degree[p[1]] / (2 * m)
        for g in groups for p in combinations(sorted(g), 2)
    ) / (2 * m)


def brute_girvan_newman(edges):
    nodes = sorted({n for e in edges for n in e})
    left, groups = list(edges), parts(edges, nodes)
    best, answer, removed = half_modularity(edges, groups), groups, []
    while left:
        scored = brute_betweenness(left)
        top = min(scored, key=lambda e: (-round(scored[e], 9), e))
        removed.append((top, round(scored[top], 9)))
        left.remove(top)
        groups = parts(left, nodes)
        value = half_modularity(edges, groups)
        if value > best + 1e-12:
            best, answer = value, groups
    return answer, removed


def grouped(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["community_id"], set()).add(r["node"])
    return {frozenset(g) for g in out.values()}


@pytest.mark.parametrize("small", [0, 20_000])
def test_betweenness_in_groups_and_by_frontiers(spark, small):
    scored = graph.edge_betweenness(frame(spark, TWO_PARTS), small=small).collect()
    found = {(r["u"], r["v"]): r["betweenness"] for r in scored}
    assert found == pytest.approx(brute_betweenness(TWO_PARTS))
    assert (scored[0]["u"], scored[0]["v"], scored[0]["betweenness"]) == ("B", "D", 12.0)


def test_roots_of_one_component_in_several_groups(spark, monkeypatch):
    monkeypatch.setattr(graph, "TASK_STEPS", 10)
    found = {(r["u"], r["v"]): r["betweenness"]
             for r in graph.edge_betweenness(frame(spark, SEVEN)).collect()}
    assert found == pytest.approx(brute_betweenness(SEVEN))


def test_path_counts_agree_on_both_ways(spark, monkeypatch):
    monkeypatch.setattr(graph, "HUB", 2)
    ways = [
        sorted(map(tuple, graph.shortest_path_counts(frame(spark, TWO_PARTS), small=s).collect()))
        for s in (0, 20_000)
    ]
    assert ways[0] == ways[1]
    assert ("A", "F", 3, 1.0) in ways[0] and ("E", "G", 2, 2.0) in ways[0]


def test_components_of_a_long_path(spark):
    edges = [(f"n{i:03}", f"n{i + 1:03}") for i in range(60)] + [("x", "y")]
    labels = {r["node"]: r["component"] for r in graph.components(frame(spark, edges)).collect()}
    assert set(labels.values()) == {"n000", "x"} and labels["n060"] == "n000"


def test_contraction_shrinks_the_links_every_round(spark):
    """A path in the order of its names, a hub, and a path with its names mixed up."""
    n = 100_000
    path = spark.range(n).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v"))
    hub = spark.range(n).select(F.lit(3 * n).alias("u"), (F.col("id") + 3 * n + 1).alias("v"))
    mixed = spark.range(n).select(
        (F.col("id") * 7919 % 100_003 + 10 * n).alias("u"), ((F.col("id") + 1) * 7919 % 100_003 + 10 * n).alias("v")
    )
    edges = stage(path.union(hub).union(mixed), "edges")
    left, sizes = edges.select(F.col("u").alias("a"), F.col("v").alias("b")), [3 * n]
    while sizes[-1] > 1000:
        _, left = graph.contracted(left, len(sizes))
        sizes.append(left.count())
        assert sizes[-1] < 0.6 * sizes[-2]
    assert len(sizes) <= 8
    labels = graph.components(edges, one_task=1000)
    least = [0, 3 * n, 10 * n]
    assert sorted(map(tuple, labels.groupBy("component").count().collect())) == [(c, n + 1) for c in least]
    assert labels.count() == 3 * n + 3


def test_modularity_of_components(spark):
    edges = frame(spark, TWO_PARTS)
    row = graph.modularity(edges, graph.components(edges)).first()
    groups = parts(TWO_PARTS, {n for e in TWO_PARTS for n in e})
    assert row["n_communities"] == 3
    assert row["modularity_half"] == pytest.approx(half_modularity(TWO_PARTS, groups))
    degree = Counter(n for e in TWO_PARTS for n in e)
    squares = sum(k * k for k in degree.values()) / (4 * len(TWO_PARTS) ** 2)
    assert row["modularity"] == pytest.approx(2 * row["modularity_half"] - squares)


RING = [(f"r{i:02}", f"r{(i + 1) % 12:02}") for i in range(12)] + [("r00", "r05"), ("r02", "r09"), ("s1", "s2")]
RING = [tuple(sorted(e)) for e in RING]


@pytest.mark.parametrize("edges, task_steps", [
    (TWO_PARTS, 10**9), (TWO_PARTS, 40), (BOW, 20), (BOW, 60), (RING, 200), (RING, 1000),
])
def test_communities_follow_the_definition(spark, edges, task_steps):
    """In one group, in several rounds of one group, and with roots spread over groups."""
    answer, removed = brute_girvan_newman(edges)
    sequence = communities.gn_removal_sequence(frame(spark, edges), task_steps).collect()
    rows = sorted(sequence, key=lambda r: r["rank"])
    assert [r["rank"] for r in rows] == list(range(1, len(edges) + 1))
    assert [((r["u"], r["v"]), round(r["betweenness"], 9)) for r in rows] == removed
    for component in {r["component"] for r in rows}:
        steps = [r["step"] for r in rows if r["component"] == component]
        assert steps == list(range(1, len(steps) + 1))
    assert grouped(communities.girvan_newman(frame(spark, edges), task_steps)) == answer


def test_components_are_kept_when_no_removal_improves(spark):
    edges = [("a", "b"), ("c", "d")]
    assert grouped(communities.girvan_newman(frame(spark, edges))) == {
        frozenset("ab"), frozenset("cd")
    }


def test_no_edges(spark):
    empty = frame(spark, [])
    assert graph.edge_betweenness(empty).count() == 0
    assert graph.modularity(empty, graph.components(empty)).count() == 0
    assert communities.girvan_newman(empty).count() == 0


@pytest.mark.parametrize("hot", [1, 2000])
def test_edges_need_common_items_not_rows(spark, hot):
    rows = [("a", "x"), ("a", "x"), ("a", "y"), ("b", "x"), ("b", "y"), ("c", "x"), ("c", "x")]
    pairs = spark.createDataFrame(rows, "user_id string, business_id string")
    edges = graph.coactivity_edges(pairs, 2, hot=hot).collect()
    assert [tuple(r) for r in edges] == [("a", "b", 2)]
    with pytest.raises(ValueError):
        graph.coactivity_edges(pairs, 0)


def test_edges_by_number_are_those_by_name(spark, tmp_path):
    held = {9: range(20), 10: range(8), 100: range(13, 30), 7: range(12, 19), 8: [0, 1, 2, 3, 4, 5, 5]}
    lines = [(customer, part) for customer, parts in held.items() for part in parts]
    spark.createDataFrame([(customer, customer) for customer in [*held, None]], "o_orderkey long, o_custkey long").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([*lines, (9, None), (None, 3)], "l_orderkey long, l_partkey long").write.parquet(f"{tmp_path}/lineitem.parquet")
    expected = {("10", "9", 8), ("100", "9", 7), ("7", "9", 7)}
    assert {tuple(r) for r in registered_edges(spark, str(tmp_path)).collect()} == expected


def test_order_lines_are_dealt_to_tasks_of_few_rows(spark, tmp_path, monkeypatch):
    spark.createDataFrame([(o, o % 7) for o in range(50)], "o_orderkey long, o_custkey long").write.parquet(f"{tmp_path}/orders.parquet")
    lines = [(o, (o * p) % 11) for o in range(50) for p in range(4)]
    spark.createDataFrame([*lines, (None, 3)], "l_orderkey long, l_partkey long").write.parquet(f"{tmp_path}/lineitem.parquet")
    assert views.order_line_tasks(spark, str(tmp_path)) is None
    monkeypatch.setattr(staging, "TASK_ROWS", 2)
    assert views.order_line_tasks(spark, str(tmp_path)) == 101
    dealt = views.customer_parts(spark, str(tmp_path))
    assert "hashpartitioning(l_orderkey#" in dealt._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, dealt.collect())) == sorted((o % 7, p) for o, p in lines)
    tasks, made = [], graph.coactivity_edges
    monkeypatch.setattr(graph, "coactivity_edges", lambda *a, **b: tasks.append(b["tasks"]) or made(*a, **b))
    assert {tuple(r) for r in registered_edges(spark, str(tmp_path)).collect()} == {
        (str(u), str(v), n) for u in range(7) for v in range(u + 1, 7)
        if (n := len({p for o, p in lines if o % 7 == u} & {p for o, p in lines if o % 7 == v})) >= 7
    }
    assert tasks == [101]


def test_edges_are_made_once_for_both_directions(spark):
    edges = frame(spark, [("a", "b"), ("b", "c")])
    both = graph.both_directions(edges)
    assert "Union" not in both._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, both.collect())) == [("a", "b"), ("b", "a"), ("b", "c"), ("c", "b")]
    assert {tuple(r) for r in graph.degrees(edges).collect()} == {("a", 1), ("b", 2), ("c", 1)}


def test_holders_of_items_are_counted_once(spark, monkeypatch):
    rows = [(f"u{n}", f"i{(n * 7 + k) % 40}") for n in range(60) for k in range(9)]
    pairs = spark.createDataFrame(rows, "user_id string, business_id string")
    monkeypatch.setattr(pairing, "FEW_PAIRS", 10)
    monkeypatch.setattr(pairing, "MANY", 0)
    sizes, meetings, size_of, in_grid = [], [], pairing.pairs_of, pairing._met_in_grid
    monkeypatch.setattr(pairing, "pairs_of", lambda df: sizes.append(df) or size_of(df))
    monkeypatch.setattr(pairing, "_met_in_grid", lambda *a: meetings.append(a[1]) or in_grid(*a))
    found = graph.coactivity_edges(pairs, 5).collect()
    held = {}
    for user, item in rows:
        held.setdefault(user, set()).add(item)
    expected = {(u, v, len(held[u] & held[v])) for u in held for v in held if u < v}
    assert {tuple(r) for r in found} == {e for e in expected if e[2] >= 5}
    assert len(sizes) == 1
    assert meetings[0] is sizes[0] and meetings[0].staged_at  # read, not counted, by the grid


def tree_removals(edges):
    """(u, v, betweenness) in order, and the best partition, of a tree: an edge carries a x b paths."""
    near = {}
    for u, v in edges:
        near.setdefault(u, set()).add(v)
        near.setdefault(v, set()).add(u)
    m, degree = len(edges), {n: len(o) for n, o in near.items()}

    def top(root):
        order, parent = [root], {root: None}
        for node in order:
            for other in near[node]:
                if other != parent[node]:
                    parent[other] = node
                    order.append(other)
        below = dict.fromkeys(order, 1)
        for node in reversed(order[1:]):
            below[parent[node]] += below[node]
        scored = [
            (-below[n] * (len(order) - below[n]), *sorted((n, parent[n]))) for n in order[1:]
        ]
        return min(scored, default=None), order

    def add(root):
        best, nodes = top(root)
        if best:
            heapq.heappush(heap, (*best, nodes))

    heap, out, parts = [], [], {0: set(near)}
    volume = {0: 2 * m}
    where = dict.fromkeys(near, 0)
    value = best_value = 0.0
    answer = [frozenset(near)]
    add(edges[0][0])
    while heap:
        b, u, v, nodes = heapq.heappop(heap)
        out.append((u, v, -b))
        near[u].remove(v)
        near[v].remove(u)
        side = set(top(u)[1])
        old, new = where[u], len(parts)
        parts[old] -= side
        parts[new] = side
        where.update(dict.fromkeys(side, new))
        volume[new] = sum(degree[n] for n in side)
        volume[old] -= volume[new]
        value += (volume[new] * volume[old] / (2 * m) - 1) / (2 * m)
        if value > best_value + 1e-12:
            best_value, answer = value, [frozenset(p) for p in parts.values()]
        add(u)
        add(v)
    return out, set(answer)


def test_a_component_of_five_thousand_edges(spark):
    """No group may take all of it: its first removals spread the roots, its parts go in parallel."""
    rng = random.Random(6)
    edges = [(f"n{rng.randrange(max(0, i - 40), i):05}", f"n{i:05}") for i in range(1, 5001)]
    removed, answer = tree_removals(edges)
    made = stage(communities.gn_removals(frame(spark, edges)), "removals")
    rows = made.orderBy("rank").collect()
    assert [(r["u"], r["v"], r["betweenness"]) for r in rows] == removed
    splits = made.where("child IS NOT NULL")
    nodes = spark.createDataFrame([(n,) for n in sorted({n for e in edges for n in e})], "node string")
    assert grouped(communities.partition_at(nodes, splits, communities.best_cut(splits))) == answer


def test_best_cut_over_several_ranges(spark):
    gains = [0.5, -0.1, 0.2, 0.0, -0.7, 0.7, 0.0, 0.1, -0.1]
    splits = spark.createDataFrame([(2 * i + 1, g) for i, g in enumerate(gains)], "rank long, gain double")
    for rows in (3, 100):
        assert communities.best_cut(splits, rows) == 15
    assert communities.best_cut(splits.where("rank = 3")) == 0
    assert communities.best_cut(splits.limit(0)) == 0


def test_partition_of_a_long_chain_of_splits(spark):
    n = 3000
    nodes = spark.range(n).select(F.col("id").alias("node"))
    splits = spark.range(1, n).select(
        F.col("id").alias("rank"), F.col("id").alias("child"), (F.col("id") - 1).alias("parent")
    )
    names = communities.partition_at(nodes, splits, 700)
    sizes = {r["community_id"]: r["count"] for r in names.groupBy("community_id").count().collect()}
    assert sizes == {i: n - 700 if i == 700 else 1 for i in range(701)}


def test_packed_searches_of_a_large_component(spark):
    """More than 20,000 edges: a row serves 64 roots, with the same result as in groups."""
    rng = random.Random(8)
    pairs = {tuple(sorted(rng.sample(range(420), 2))) for _ in range(30_000)}
    pairs |= {(i, i + 1) for i in range(419, 423)}
    edges = stage(spark.createDataFrame(sorted(pairs), "u long, v long"), "edges")
    assert edges.count() > 20_000
    search = graph.Frontier(edges)
    flow = search.flows().groupBy("u", "v").agg((F.sum("flow") / 2).alias("betweenness"))
    plain = graph.edge_betweenness(edges, small=10**9)
    both = flow.join(plain.withColumnRenamed("betweenness", "b"), ["u", "v"])
    worst = both.agg(F.count("*"), F.max(F.abs(F.col("betweenness") - F.col("b")) / F.col("b"))).first()
    assert worst[0] == edges.count() and worst[1] < 1e-9
    rows, nodes = sum(level.count() for level in search.levels), 424
    assert rows <= len(search.levels) * nodes * (nodes // 64 + 1) and rows * 8 < nodes * nodes
