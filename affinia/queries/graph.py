from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinia.operators import communities, graph
from affinia.plans import views
from affinia.plans.staging import stage

AT_LEAST = 7
# A lower overlap links most users into one component, whose searches are joins of packed frontiers.
DENSE = 3


def edges(spark: SparkSession, sf: str, at_least: int = AT_LEAST) -> DataFrame:
    # Numbers are narrower than names on the way; ends are named, and ordered by name, afterwards.
    linked = graph.coactivity_edges(
        views.customer_parts(spark, sf), at_least, tasks=views.order_line_tasks(spark, sf)
    )
    u, v = F.col("u").cast("string"), F.col("v").cast("string")
    return linked.select(F.least(u, v).alias("u"), F.greatest(u, v).alias("v"), "n_common")


def _edges(spark: SparkSession, sf: str) -> DataFrame:
    return stage(edges(spark, sf), "edges")


def _paths(spark: SparkSession, sf: str) -> DataFrame:
    # By root and distance: a row per connected pair would be the square of the nodes.
    counted = graph.shortest_path_counts(_edges(spark, sf))
    return counted.groupBy("root", "dist").agg(
        F.count("*").alias("nodes"), F.sum("sigma").cast("long").alias("paths")
    )


def _betweenness(spark: SparkSession, sf: str) -> DataFrame:
    scored = graph.edge_betweenness(_edges(spark, sf))
    return scored.withColumn("betweenness", F.round("betweenness", 6))


def _dense(spark: SparkSession, sf: str) -> DataFrame:
    linked = stage(edges(spark, sf, DENSE), "edges")
    scored = graph.edge_betweenness(linked)
    return scored.withColumn("betweenness", F.round("betweenness", 6))


def _modularity(spark: SparkSession, sf: str) -> DataFrame:
    own = _edges(spark, sf)
    value = graph.modularity(own, graph.components(own))
    return value.withColumns({
        c: F.round(c, 6) for c in ("modularity", "modularity_half")
    })


def _sequence(spark: SparkSession, sf: str) -> DataFrame:
    sequence = communities.gn_removal_sequence(_edges(spark, sf))
    return sequence.select(
        "component", "step", "u", "v", F.round("betweenness", 6).alias("betweenness"), "rank"
    ).orderBy("rank")


QUERIES = {
    "coactivity_edges": edges,
    "adjacency": lambda spark, sf: graph.both_directions(edges(spark, sf)),
    "node_degree": lambda spark, sf: graph.degrees(edges(spark, sf)),
    "connected_components": lambda spark, sf: graph.components(edges(spark, sf)),
    "shortest_path_counts": _paths,
    "edge_betweenness": _betweenness,
    "edge_betweenness_dense": _dense,
    "modularity": _modularity,
    "gn_removal_sequence": _sequence,
    "gn_communities": lambda spark, sf: communities.girvan_newman(_edges(spark, sf)),
}

_EDGES = f"""
WITH RECURSIVE activity AS MATERIALIZED (
  SELECT DISTINCT o_custkey::VARCHAR AS u, l_partkey AS item
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
edges AS MATERIALIZED (
  SELECT x.u, y.u AS v, count(*) AS n_common
  FROM activity x JOIN activity y ON x.item = y.item AND x.u < y.u
  GROUP BY 1, 2 HAVING count(*) >= {AT_LEAST}),
adjacency AS MATERIALIZED (
  SELECT u AS src, v AS dst FROM edges UNION ALL SELECT v, u FROM edges)
"""

_LABELS = f"""
{_EDGES},
reach(node, other) AS (
  SELECT src, src FROM adjacency UNION SELECT node, dst FROM reach JOIN adjacency ON other = src),
labels AS MATERIALIZED (SELECT node, min(other) AS component FROM reach GROUP BY 1)
"""

_BFS = f"""
{_EDGES},
bfs(root, node, dist, sigma) USING KEY (root, node) AS (
  SELECT DISTINCT src, src, 0, 1::HUGEINT FROM adjacency
  UNION
  SELECT bfs.root, dst, bfs.dist + 1, sum(bfs.sigma)
  FROM bfs JOIN adjacency ON bfs.node = src
  LEFT JOIN recurring.bfs AS seen ON seen.root = bfs.root AND seen.node = dst
  WHERE seen.node IS NULL GROUP BY 1, 2, 3),
paths AS MATERIALIZED (SELECT root, node, dist, sigma::BIGINT AS sigma FROM bfs)
"""

ORACLES = {
    "coactivity_edges": f"{_EDGES} SELECT u, v, n_common FROM edges",
    "adjacency": f"{_EDGES} SELECT src, dst FROM adjacency",
    "node_degree": f"{_EDGES} SELECT src AS node, count(*) AS degree FROM adjacency GROUP BY 1",
    "connected_components": f"{_LABELS} SELECT node, component FROM labels",
    "shortest_path_counts": f"{_BFS} SELECT root, dist, count(*) AS nodes, sum(sigma)::BIGINT AS paths "
    "FROM paths GROUP BY 1, 2",
    "edge_betweenness": f"""
{_BFS}
SELECT e.u, e.v, round(sum(s.sigma * t.sigma / st.sigma), 6) AS betweenness
FROM edges e JOIN paths s ON s.node = e.u JOIN paths t ON t.node = e.v
JOIN paths st ON st.root = s.root AND st.node = t.root AND st.dist = s.dist + 1 + t.dist
GROUP BY 1, 2""",
    "modularity": f"""
{_LABELS},
degree AS (SELECT src AS node, count(*) AS k FROM adjacency GROUP BY 1),
m AS (SELECT count(*)::DOUBLE AS m FROM edges),
volume AS (SELECT component, sum(k)::DOUBLE AS volume, sum(k * k)::DOUBLE AS squares
           FROM degree JOIN labels USING (node) GROUP BY 1)
SELECT count(*) AS n_communities,
       round(1 - sum(volume * volume) / (4 * any_value(m.m) * any_value(m.m)), 6) AS modularity,
       round(0.5 - (sum(volume * volume) - sum(squares)) / (8 * any_value(m.m) * any_value(m.m)), 6)
         AS modularity_half
FROM volume, m""",
}
