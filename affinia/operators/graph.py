"""Co-activity graphs: components, shortest paths, edge betweenness and modularity.

Edges are rows (u, v) with u < v. Searches from all roots run per connected component: components
of up to ``small`` edges are copied to groups of roots, each group one bounded task; larger ones
expand packed frontiers (64 roots to a row) level by level as joins, with every level written out.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinia.functions.paths import DIGITS, Graph
from affinia.operators.itemsets import baskets
from affinia.operators.pairing import HOT, sharing_pairs
from affinia.plans.numbering import numbered
from affinia.plans.staging import has_rows, spent, stage

ONE_TASK = 200_000
SMALL_EDGES = 20_000
TASK_STEPS = 2_000_000
HUB = 20_000
LANES = 64


def coactivity_edges(
    pairs: DataFrame, at_least: int, user: str = "user_id", item: str = "business_id",
    hot: int = HOT, tasks: int | None = None,
) -> DataFrame:
    """(u, v, n_common): users with at least ``at_least`` rows that share as many items.

    ``tasks`` is the number of tasks to deal the rows of users to, where the caller knows.
    """
    if at_least < 1:
        raise ValueError("users without a common item are not linked: at_least must be 1 or more")
    rows = baskets(pairs, user, item, min_rows=at_least - 1, tasks=tasks)
    rows = rows.select("basket", "item", F.lit(at_least).cast("long").alias("need"))
    return sharing_pairs(stage(rows, "activity"), "basket", "item", hot=hot).select(
        F.col("basket1").alias("u"), F.col("basket2").alias("v"), F.col("shared").alias("n_common")
    )


def both_directions(edges: DataFrame) -> DataFrame:
    """(src, dst) for either direction of every edge, which is made once for both."""
    ways = [F.struct(F.col(a).alias("src"), F.col(b).alias("dst")) for a, b in ("uv", "vu")]
    return edges.select(F.inline(F.array(*ways)))


def degrees(edges: DataFrame) -> DataFrame:
    return both_directions(edges).groupBy(F.col("src").alias("node")).agg(
        F.count("*").alias("degree")
    )


def components(edges: DataFrame, one_task: int = ONE_TASK) -> DataFrame:
    """(node, component): every node with the smallest node it is connected to.

    The graph is contracted round by round (``contracted``) until at most ``one_task`` edges are
    left, which one task links; labels then go back through the rounds, whose tables shrink.
    """
    edges = edges.select(F.col("u").alias("a"), F.col("v").alias("b"))
    left = stage(edges.where("a <> b"), "links")
    rounds = []
    while left.count() > one_task:
        mapping, smaller = contracted(left, len(rounds))
        rounds.append(mapping)
        spent(left)
        left = smaller
    names = _linked(left)
    if not rounds:
        return names
    for mapping in reversed(rounds):
        names = stage(
            mapping.join(names.withColumnRenamed("node", "onto"), "onto", "left")
            .select("node", F.coalesce("component", "onto").alias("component")), "names",
        )
    # Clusters have arbitrary names so far: their smallest node takes over.
    least = names.groupBy("component").agg(F.min("node").alias("least"))
    return names.join(least, "component").select("node", F.col("least").alias("component"))


def contracted(links: DataFrame, seed: int) -> tuple[DataFrame, DataFrame]:
    """(node, onto) for every node of ``links`` (a, b), and the links between different ``onto``.

    A node goes onto the node of smallest hash at most two steps away. Nodes that share one are
    connected, and the link to it becomes a link between clusters, so components stay what they
    are, while hubs collapse at once and paths shrink to about a third. The hash changes with the
    round, so no order of the nodes is a bad one.
    """
    both = stage(links.union(links.select("b", "a")).distinct(), "both")

    def ranked(node: str):
        return F.struct(F.xxhash64(node, F.lit(seed)).alias("hash"), F.col(node).alias("onto"))

    one = both.groupBy("a").agg(F.min(ranked("b")).alias("near")).select(
        F.col("a").alias("b"), F.least("near", ranked("a")).alias("near")
    )
    mapping = stage(
        both.join(one, "b").groupBy("a").agg(F.min("near").alias("near"))
        .join(one.select(F.col("b").alias("a"), F.col("near").alias("own")), "a")
        .select(F.col("a").alias("node"), F.least("near", "own")["onto"].alias("onto")), "onto",
    )
    smaller = (
        links.join(mapping.select(F.col("node").alias("a"), F.col("onto").alias("_a")), "a")
        .join(mapping.select(F.col("node").alias("b"), F.col("onto").alias("_b")), "b")
        .where("_a <> _b")
        .select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b")).distinct()
    )
    smaller = stage(smaller, "links")
    spent(both)
    return mapping, smaller


def _linked(links: DataFrame) -> DataFrame:
    """(node, component) for few links, in one task."""
    node = links.schema["a"].dataType.simpleString()

    def link(pdf: pd.DataFrame) -> pd.DataFrame:
        names, flat = np.unique(pdf[["a", "b"]].to_numpy().ravel(), return_inverse=True)
        a, b = flat.reshape(-1, 2).T
        label = np.arange(len(names))
        while True:
            low = np.minimum(label[a], label[b])
            after = label.copy()
            for ends in (a, b, label[a], label[b]):
                np.minimum.at(after, ends, low)
            after = after[after]
            if np.array_equal(after, label):
                return pd.DataFrame({"node": names, "component": names[label]})
            label = after

    return links.groupBy(F.lit(0).alias("_all")).applyInPandas(link, f"node {node}, component {node}")


def shortest_path_counts(
    edges: DataFrame, small: int = SMALL_EDGES, labels: DataFrame | None = None
) -> DataFrame:
    """(root, node, dist, sigma): distance and number of shortest paths for connected pairs."""
    of_small, of_large = _by_size(_located(edges, labels), small)

    def search(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        names, graph, roots = _graph_of(pdf)
        distance, paths, _ = graph.search(roots)
        near = np.flatnonzero(distance >= 0)
        return pd.DataFrame({
            "root": names[roots[near // graph.n]], "node": names[near % graph.n],
            "dist": distance[near], "sigma": paths[near],
        })

    node = edges.schema["u"].dataType.simpleString()
    schema = f"root {node}, node {node}, dist int, sigma double"
    result = of_small.groupBy("component", "part").applyInPandas(search, schema)
    if of_large is None:
        return result
    return result.union(Frontier(of_large).path_counts())


def edge_betweenness(
    edges: DataFrame, small: int = SMALL_EDGES, labels: DataFrame | None = None
) -> DataFrame:
    """(u, v, betweenness) of every edge, exact, highest first."""
    scored = betweenness_of(_located(edges, labels), small)
    return scored.orderBy(F.desc(F.round("betweenness", DIGITS)), "u", "v")


def betweenness_of(located: DataFrame, small: int = SMALL_EDGES) -> DataFrame:
    """(u, v, betweenness) of edges given with their component, n_nodes and n_edges."""
    of_small, of_large = _by_size(located, small)

    def search(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        _, graph, roots = _graph_of(pdf)
        return pd.DataFrame({"u": pdf["u"], "v": pdf["v"], "flow": graph.flows(roots)})

    node = located.schema["u"].dataType.simpleString()
    flow = of_small.groupBy("component", "part").applyInPandas(
        search, f"u {node}, v {node}, flow double"
    )
    if of_large is not None:
        flow = flow.union(Frontier(of_large).flows())
    return flow.groupBy("u", "v").agg((F.sum("flow") / 2).alias("betweenness"))


def modularity(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """(n_communities, modularity, modularity_half) of a partition (node, component).

    ``modularity`` is the textbook value; ``modularity_half`` sums unordered pairs of different
    nodes only. Both follow from per-community totals, without listing pairs.
    """
    total = degrees(edges).join(labels, "node").groupBy("component").agg(
        F.sum("degree").cast("double").alias("volume"),
        F.sum(F.col("degree") * F.col("degree")).alias("squares"),
    )
    ends = edges.join(labels.withColumnsRenamed({"node": "u", "component": "_cu"}), "u").join(
        labels.withColumnsRenamed({"node": "v", "component": "_cv"}), "v"
    )
    inside = ends.where("_cu = _cv").groupBy(F.col("_cu").alias("component")).agg(
        F.count("*").alias("inside")
    )
    sums = total.join(inside, "component", "left").agg(
        F.count("*").alias("n_communities"),
        F.coalesce(F.sum("inside"), F.lit(0)).alias("_inside"),
        F.sum(F.col("volume") * F.col("volume")).alias("_volumes"),
        F.sum("squares").alias("_squares"),
        (F.sum("volume") / 2).alias("_m"),
    )
    m = F.col("_m")
    return sums.where("n_communities > 0").select(
        "n_communities",
        (F.col("_inside") / m - F.col("_volumes") / (4 * m * m)).alias("modularity"),
        (F.col("_inside") / (2 * m) - (F.col("_volumes") - F.col("_squares")) / (8 * m * m))
        .alias("modularity_half"),
    )


def component_sizes(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """(component, n_nodes, n_edges)."""
    nodes = labels.groupBy("component").agg(F.count("*").alias("n_nodes"))
    own = edges.join(labels.withColumnRenamed("node", "u"), "u").groupBy("component").agg(
        F.count("*").alias("n_edges")
    )
    return nodes.join(own, "component")


def _located(edges: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Edges with their component and its n_nodes and n_edges."""
    edges = edges.select("u", "v")
    labels = labels if labels is not None else components(edges)
    sizes = component_sizes(edges, labels)
    located = edges.join(labels.withColumnRenamed("node", "u"), "u").join(sizes, "component")
    return stage(located, "located")


def _by_size(located: DataFrame, small: int) -> tuple[DataFrame, DataFrame | None]:
    """Edges of small components, copied to (component, part) groups; edges of the others."""
    steps = F.col("n_nodes") * F.col("n_edges")
    parts = F.least(F.ceil(steps / TASK_STEPS), F.col("n_nodes")).cast("int")
    of_small = located.where(F.col("n_edges") <= small).withColumn("parts", parts).select(
        "component", "u", "v", "parts", F.explode(F.sequence(F.lit(1), "parts")).alias("part")
    )
    large = located.where(F.col("n_edges") > small).select("u", "v")
    return of_small, large if has_rows(large) else None


def _graph_of(pdf: pd.DataFrame) -> tuple[np.ndarray, Graph, np.ndarray]:
    """Names of the nodes, the component, and the share of its nodes that are this group's roots."""
    names, flat = np.unique(pdf[["u", "v"]].to_numpy().ravel(), return_inverse=True)
    u, v = flat.reshape(-1, 2).T
    roots = np.arange(len(names))[int(pdf["part"].iloc[0]) - 1 :: int(pdf["parts"].iloc[0])]
    return names, Graph(len(names), u, v), roots


class Frontier:
    """Breadth-first searches from all nodes, ``LANES`` of them packed into a row.

    Nodes are numbered, and root ``LANES`` x batch + lane is a lane of its batch. A level is rows
    (node, batch, reached, sigma): the bitmap of the lanes that reach the node at this level, and
    for each lane the number of its shortest paths, 0 in the others. Every level is a join of the
    one before it with the neighbours, written out; hubs' neighbours are cut into pieces.
    """

    def __init__(self, edges: DataFrame):
        adjacent = both_directions(edges)
        counted = stage(degrees(edges), "degrees")
        pieces = F.ceil(F.col("degree") / HUB).cast("int")
        cut = adjacent.join(counted.withColumnRenamed("node", "src"), "src").select(
            F.col("src").alias("node"), "dst",
            F.pmod(F.xxhash64("dst"), pieces).cast("int").alias("piece"),
        )
        self.adjacent = stage(cut, "adjacent")
        self.hubs = stage(counted.select("node", pieces.alias("pieces")).where("pieces > 1"), "hubs")
        self.roots = stage(numbered(counted.select("node"), ["node"], "number").select(
            "node", F.expr(f"number div {LANES}").alias("batch"),
            (F.col("number") % LANES).cast("int").alias("lane"),
        ), "roots")
        self.levels = self._searched()

    def _searched(self) -> list[DataFrame]:
        """A neighbour of level k lies on level k - 1, k or k + 1, so only two are excluded."""
        lanes = F.sequence(F.lit(0), F.lit(LANES - 1))
        levels = [stage(self.roots.select(
            "node", "batch", F.expr("shiftleft(1L, lane)").alias("reached"),
            F.transform(lanes, lambda i: (i == F.col("lane")).cast("double")).alias("sigma"),
        ), "frontier")]
        while True:
            met = self._step(levels[-1], "sigma").groupBy(F.col("dst").alias("node"), "batch").agg(
                *_summed("sigma")
            ).select("node", "batch", _lanes("sigma"))
            known = F.lit(0).cast("long")
            for i, level in enumerate(levels[-2:]):
                before = level.select("node", "batch", F.col("reached").alias(f"known{i}"))
                met = met.join(before, ["node", "batch"], "left")
                known = known.bitwiseOR(F.coalesce(f"known{i}", F.lit(0).cast("long")))
            fresh = F.transform(
                "sigma", lambda s, i: F.when(_bit("known", i) == 0, s).otherwise(0.0)
            )
            met = met.withColumn("known", known).select("node", "batch", fresh.alias("sigma"))
            bits = F.transform("sigma", lambda s, i: F.when(
                s > 0, F.call_function("shiftleft", F.lit(1).cast("long"), i)
            ).otherwise(F.lit(0).cast("long")))
            reached = F.aggregate(bits, F.lit(0).cast("long"), lambda x, y: x.bitwiseOR(y))
            level = stage(met.select("node", "batch", reached.alias("reached"), "sigma").where(
                "reached <> 0"
            ), "frontier")
            if not has_rows(level):
                return levels
            levels.append(level)

    def _step(self, rows: DataFrame, array: str) -> DataFrame:
        """(node, batch, dst, ``array``): rows (node, batch, ``array``) with their neighbours."""
        last = F.coalesce(F.col("pieces"), F.lit(1)) - 1
        copied = rows.select("node", "batch", array).join(self.hubs, "node", "left").select(
            "node", "batch", array, F.explode(F.sequence(F.lit(0), last)).alias("piece")
        )
        return copied.join(self.adjacent, ["node", "piece"]).select("node", "batch", "dst", array)

    def path_counts(self) -> DataFrame:
        """(root, node, dist, sigma) of all levels, one row per pair."""
        found = []
        for dist, level in enumerate(self.levels):
            lanes = level.select("node", "batch", F.posexplode("sigma").alias("lane", "sigma"))
            found.append(lanes.where("sigma > 0").withColumn("dist", F.lit(dist)))
        roots = self.roots.withColumnRenamed("node", "root")
        return reduce(DataFrame.union, found).join(roots, ["batch", "lane"]).select(
            "root", "node", "dist", "sigma"
        )

    def flows(self) -> DataFrame:
        """(u, v, flow) summed over all roots, from the deepest level up."""
        totals, received = [], None
        for above, level in zip(self.levels[-2::-1], self.levels[:0:-1]):
            if received is None:
                level = level.withColumn("received", F.lit(None).cast("array<double>"))
            else:
                level = level.join(received, ["node", "batch"], "left")
            share = F.transform("sigma", lambda s, i: F.when(
                s > 0, (1 + F.coalesce(F.get("received", i), F.lit(0.0))) / s
            ).otherwise(0.0))
            given = level.select("node", "batch", share.alias("share"))
            parents = above.select(F.col("node").alias("dst"), "batch", "sigma")
            flow = F.zip_with("share", "sigma", lambda a, b: a * b)
            sent = self._step(given, "share").join(parents, ["dst", "batch"]).select(
                "node", "dst", "batch", flow.alias("flow")
            )
            sent = stage(sent.where(F.exists("flow", lambda f: f > 0)), "flow")
            received = stage(sent.groupBy(F.col("dst").alias("node"), "batch").agg(
                *_summed("flow")
            ).select("node", "batch", _lanes("received")), "received")
            whole = F.aggregate("flow", F.lit(0.0), lambda x, y: x + y)
            totals.append(
                sent.groupBy(F.least("node", "dst").alias("u"), F.greatest("node", "dst").alias("v"))
                .agg(F.sum(whole).alias("flow"))
            )
        return reduce(DataFrame.union, totals)


def _bit(bitmap: str, i):
    return F.call_function("shiftright", F.col(bitmap), i).bitwiseAND(F.lit(1).cast("long"))


def _summed(array: str) -> list:
    """The sums of an array column, place by place."""
    return [F.sum(F.get(array, F.lit(i))).alias(f"_{i}") for i in range(LANES)]


def _lanes(name: str):
    return F.array(*[f"_{i}" for i in range(LANES)]).alias(name)
