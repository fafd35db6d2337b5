"""Girvan-Newman communities: remove the edge of highest betweenness, keep the best partition.

Removing an edge changes betweenness only inside its own connected part, so each round peels all
parts at once and scores only those. A part whose searches cost at most ``task_steps`` (nodes x
edges) is one bounded group, which removes edges until that many steps are spent; in larger parts
the roots are spread over bounded groups and one edge goes per round. The number of rounds thus
follows from the longest chain of removals inside parts, not from the edges of a component.

The order in which the definition would remove edges one by one, always the best of all parts,
needs no merging: it is the order of a key per removal, the values on the way to it (through the
parts it came from) that no later value exceeds, compared as lists.

Parts are named by their smallest node, so every node but the smallest of its component is "born"
as a name exactly once, by the split that gives it a part of its own: these rows are the merge tree
of the splits. A partition on the way is read off it without any search: a node born later than the
cut belongs to the part it was born from.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from affinia.functions.paths import DIGITS, peel
from affinia.operators.graph import (
    SMALL_EDGES, TASK_STEPS, betweenness_of, component_sizes, components, degrees,
)
from affinia.plans.numbering import numbered
from affinia.plans.staging import Appended, facts, spent, stage

RANGE_ROWS = 1_000_000

_REMOVED = ["component", "u", "v", "betweenness", "key", "gain", "parent", "child"]
_STATE = ["component", "part", "n", "m", "u", "v", "du", "dv", "alive", "key"]


def gn_removal_sequence(
    edges: DataFrame, task_steps: int = TASK_STEPS, small: int = SMALL_EDGES
) -> DataFrame:
    """(component, step, u, v, betweenness, gain, rank): the order in which edges are removed.

    ``betweenness`` is the edge's value when it goes, ``gain`` the change of ``modularity_half``
    by its removal, ``rank`` its place in the order over all components, ``step`` that inside its
    component; of equal values the smaller edge goes first.
    """
    ranked = stage(gn_removals(edges, task_steps, small), "ranked")
    placed = stage(numbered(ranked, ["component", "rank"], "_number"), "steps")
    first = placed.groupBy("component").agg(F.min("_number").alias("_first"))
    return placed.join(first, "component").select(
        "component", (F.col("_number") - F.col("_first") + 1).alias("step"), "u", "v",
        "betweenness", "gain", "rank",
    )


def gn_removals(
    edges: DataFrame, task_steps: int = TASK_STEPS, small: int = SMALL_EDGES
) -> DataFrame:
    """(component, u, v, betweenness, gain, parent, child, rank) for every edge.

    A removal that splits its part names the part (``parent``) and the half that gets a new name
    (``child``).
    """
    edges = stage(edges.select("u", "v"), "edges")
    state, n_edges = _started(edges)
    out = Appended(edges.sparkSession, "removals")
    while True:
        is_small = F.col("n") * F.col("m") <= task_steps
        rows = facts(state.agg(
            F.count_if(is_small).alias("small"), F.count_if(~is_small).alias("large")
        ))
        if not rows["small"] and not rows["large"]:
            break
        left, used = [], [state]
        if rows["small"]:
            peeled = stage(_peeled(state.where(is_small), n_edges, task_steps), "peeled")
            out.add(peeled.where("removed").select(*_REMOVED))
            left.append(peeled.where("NOT removed").select(*_STATE))
            used.append(peeled)
        if rows["large"]:
            removed, rest, tables = _one_each(state.where(~is_small), n_edges, small)
            out.add(removed.select(*_REMOVED))
            left.append(rest.select(*_STATE))
            used += tables
        state = stage(left[0] if len(left) == 1 else left[0].unionByName(left[1]), "state")
        spent(*used)
    if out.schema is None:
        out.add(_peeled(state, n_edges, task_steps).where("removed").select(*_REMOVED))
    ranked = numbered(out.rows(), ["key"], "_number")
    return ranked.select(*[c for c in _REMOVED if c != "key"], (F.col("_number") + 1).alias("rank"))


def girvan_newman(
    edges: DataFrame, task_steps: int = TASK_STEPS, small: int = SMALL_EDGES
) -> DataFrame:
    """(community_id, size, node) of the partition with the highest modularity.

    The first best partition on the way wins; the initial components if no removal improves them.
    """
    edges = stage(edges.select("u", "v"), "edges")
    removed = stage(gn_removals(edges, task_steps, small), "removals")
    splits = removed.where("child IS NOT NULL").select("rank", "gain", "parent", "child")
    names = partition_at(degrees(edges).select("node"), splits, best_cut(splits))
    sizes = names.groupBy("community_id").agg(F.count("*").alias("size"))
    return names.join(sizes, "community_id").select("community_id", "size", "node").orderBy(
        "size", "community_id", "node"
    )


def best_cut(splits: DataFrame, rows: int = RANGE_ROWS) -> int:
    """The rank of the first split at which the sum of the gains so far is highest, 0 for none.

    Sums run inside ranges of ranks and start from the totals of the ranges before.
    """
    ranged = splits.select("rank", "gain", F.expr(f"rank div {rows}").alias("_range"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy("_range").agg(F.sum("gain").alias("_gain")).select(
        "_range", F.coalesce(F.sum("_gain").over(before), F.lit(0.0)).alias("_start")
    )
    inside = F.sum("gain").over(Window.partitionBy("_range").orderBy("rank"))
    gained = ranged.withColumn("_inside", inside).join(F.broadcast(starts), "_range").select(
        F.round(F.col("_start") + F.col("_inside"), 12).alias("gained"), (-F.col("rank")).alias("r")
    )
    top = facts(gained.agg(F.max(F.struct("gained", "r")).alias("top")))["top"]
    return -top["r"] if top and top["gained"] > 0 else 0


def partition_at(nodes: DataFrame, splits: DataFrame, rank: int) -> DataFrame:
    """(node, community_id) after the removals up to ``rank``.

    A node that is born later points at the part it is born from, whose name is older; pointers are
    doubled until all point at a name that exists at the cut.
    """
    born = splits.select(F.col("child").alias("node"), "parent", (F.col("rank") > rank).alias("later"))
    names = stage(nodes.join(born, "node", "left").select(
        "node", F.when(F.col("later"), F.col("parent")).otherwise(F.col("node")).alias("to")
    ), "names")
    while True:
        further = names.select(F.col("node").alias("to"), F.col("to").alias("_next"))
        after = stage(names.join(further, "to").select(
            "node", F.col("_next").alias("to"), (F.col("_next") != F.col("to")).alias("moves")
        ), "names")
        moved = facts(after.agg(F.count_if("moves").alias("n")))["n"]
        spent(names)
        names = after
        if not moved:
            return names.select("node", F.col("to").alias("community_id"))


def _started(edges: DataFrame) -> tuple[DataFrame, int]:
    """The state before the first round, and the number of edges.

    Rows are the original edges inside the present parts, those already removed with ``alive``
    false; n and m are the nodes and live edges of the part, du and dv the original degrees, key
    that of the removal that made the part.
    """
    labels = stage(components(edges), "labels")
    sizes = component_sizes(edges, labels)
    degree = degrees(edges)
    node = edges.schema["u"].dataType.simpleString()
    state = stage(
        edges.join(labels.withColumnRenamed("node", "u"), "u").join(sizes, "component")
        .join(degree.withColumnsRenamed({"node": "u", "degree": "du"}), "u")
        .join(degree.withColumnsRenamed({"node": "v", "degree": "dv"}), "v")
        .withColumns({
            "part": F.col("component"), "n": F.col("n_nodes"), "m": F.col("n_edges"),
            "alive": F.lit(True),
            "key": F.array().cast(f"array<struct<b:double,u:{node},v:{node}>>"),
        }).select(*_STATE),
        "state",
    )
    return state, edges.count()


def _peeled(state: DataFrame, n_edges: int, budget: int) -> DataFrame:
    """Removals in small parts, one bounded group each (``removed``), and what is left of them."""
    node, key = state.schema["u"].dataType, state.schema["key"].dataType
    extra = {"removed": T.BooleanType(), "betweenness": T.DoubleType(), "gain": T.DoubleType(),
             "parent": node, "child": node}
    schema = T.StructType([
        *[T.StructField(f.name, f.dataType) for f in state.select(*_STATE).schema],
        *[T.StructField(name, kind) for name, kind in extra.items()],
    ])
    return state.select(*_STATE).groupBy("part").applyInArrow(
        _peel_group(to_arrow_schema(schema), n_edges, budget), schema
    )


def _peel_group(schema: pa.Schema, n_edges: int, budget: int) -> Callable[[pa.Table], pa.Table]:
    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        both = sorted({(r["u"], r["du"]) for r in rows} | {(r["v"], r["dv"]) for r in rows})
        names, degree = [n for n, _ in both], np.array([d for _, d in both])
        number = {n: i for i, n in enumerate(names)}
        u, v = (np.array([number[r[end]] for r in rows]) for end in ("u", "v"))
        alive = np.array([r["alive"] for r in rows])
        records = tuple((k["b"], k["u"], k["v"]) for k in rows[0]["key"])
        removed, left = peel(names, u, v, alive, degree, records, budget)

        def structs(key: tuple) -> list[dict]:
            return [{"b": b, "u": u, "v": v} for b, u, v in key]

        out = []
        for (b, first, second), key, parent, child, cut, volumes in removed:
            out.append({
                "component": rows[0]["component"], "removed": True, "u": first, "v": second,
                "betweenness": -b, "key": structs(key), "parent": parent, "child": child,
                "gain": 0.0 if child is None else _gain(volumes, cut, n_edges),
            })
        for nodes, live, inner, key in left:
            present, shared = set(live.tolist()), structs(key)
            out += [rows[i] | {
                "part": names[nodes[0]], "n": len(nodes), "m": len(live), "alive": i in present,
                "key": shared, "removed": False,
            } for i in inner.tolist()]
        blank = {f.name: None for f in schema}
        return pa.Table.from_pylist([blank | r for r in out], schema=schema)

    return run


def _gain(volumes, cut, n_edges: int):
    """The change of ``modularity_half`` by a split, from the product of the volumes of both sides."""
    return (volumes / (2 * n_edges) - cut) / (2 * n_edges)


def _one_each(
    state: DataFrame, n_edges: int, small: int
) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """The removal of one edge from every large part, what is left of them, and the tables used."""
    live = stage(state.where("alive").select(
        F.col("part").alias("component"), "u", "v", F.col("n").alias("n_nodes"),
        F.col("m").alias("n_edges"),
    ), "live")
    node = state.schema["u"].dataType.simpleString()
    value = F.struct(
        (-F.round("betweenness", DIGITS)).cast("double").alias("b"), F.col("u"), F.col("v")
    )
    scored = betweenness_of(live, small).select(
        F.col("u").alias("_u"), F.col("v").alias("_v"), "betweenness"
    )
    top = stage(
        live.join(scored, (F.col("u") == F.col("_u")) & (F.col("v") == F.col("_v")))
        .groupBy(F.col("component").alias("part")).agg(F.min(value).alias("top")), "top",
    )
    taken = (F.col("u") == F.col("top.u")) & (F.col("v") == F.col("top.v"))
    records = F.concat(
        F.filter("key", lambda r: r > F.col("_top")), F.array("_top")
    ).cast(f"array<struct<b:double,u:{node},v:{node}>>")
    after = stage(
        state.join(top, "part").withColumn("taken", taken)
        .withColumn("_top", F.col("top").cast(f"struct<b:double,u:{node},v:{node}>"))
        .withColumn("key", records)
        .withColumn("alive", F.col("alive") & ~F.col("taken"))
        .select(*_STATE, "taken", F.col("top.b").alias("b")), "after",
    )
    labels = stage(components(after.where("alive").select("u", "v")), "labels")

    def label(end: str, name: str) -> DataFrame:
        return labels.select(F.col("node").alias(end), F.col("component").alias(name))

    # A node without a live edge is a part of its own.
    moved = stage(
        after.join(label("u", "pu"), "u", "left").join(label("v", "pv"), "v", "left")
        .withColumns({"pu": F.coalesce("pu", "u"), "pv": F.coalesce("pv", "v")}), "moved",
    )
    ends = moved.select("part", F.col("u").alias("node"), F.col("du").alias("degree"), F.col("pu").alias("now")).union(
        moved.select("part", "v", "dv", "pv")
    ).distinct()
    volume = stage(ends.groupBy("part", "now").agg(
        F.sum("degree").cast("double").alias("volume"), F.count("*").alias("nodes")
    ), "volume")
    product = volume.groupBy("part").agg(F.product("volume").alias("volumes"))
    cut = moved.groupBy("part").agg(F.count_if(F.col("pu") != F.col("pv")).alias("cut"))
    splits = F.col("pu") != F.col("pv")
    removed = moved.where("taken").join(product, "part").join(cut, "part").select(
        "component", "u", "v", (-F.col("b")).alias("betweenness"), "key",
        F.when(splits, _gain(F.col("volumes"), F.col("cut"), n_edges)).otherwise(0.0).alias("gain"),
        F.when(splits, F.col("part")).alias("parent"),
        F.when(splits, F.greatest("pu", "pv")).alias("child"),
    )
    lives = moved.where("alive").groupBy(F.col("pu").alias("now")).agg(F.count("*").alias("edges"))
    rest = (
        moved.where(F.col("pu") == F.col("pv")).withColumnRenamed("pu", "now")
        .join(lives, "now").join(volume.select("now", "nodes"), "now")
        .select(
            "component", F.col("now").alias("part"), F.col("nodes").alias("n"),
            F.col("edges").alias("m"), "u", "v", "du", "dv", "alive", "key",
        )
    )
    return removed, rest, [live, top, after, labels, moved, volume]
