"""Times the headline queries; prints one JSON line.

BENCH_SF_DIR names the tables (default sf0.1), BENCH_CPUS the local cores, BENCH_QUERIES an
optional comma-separated choice.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from affinia.operators import communities, graph
from affinia.plans import views
from affinia.plans.staging import stage
from affinia.queries import QUERIES

HEADLINE = [
    "review_metrics", "top_users", "state_avg_stars", "baskets_min_rows", "frequent_itemsets",
    "son_frequent", "minhash_signatures", "lsh_similar_pairs", "jaccard_pairs", "cold_users",
    "cf_item_predict", "cf_user_predict", "als_predict", "coactivity_edges",
    "connected_components", "edge_betweenness", "gn_communities",
]
# Smallest overlap that links two users; low enough to give edges at every scale.
AT_LEAST = 4


def linked(spark: SparkSession, sf_dir: str) -> dict:
    """The graph queries on one graph, which is built and written before any of them is timed."""
    def edges(spark, sf):
        return graph.coactivity_edges(views.graph_pairs(spark, sf), AT_LEAST)

    staged = stage(edges(spark, sf_dir), "edges")
    return {
        "coactivity_edges": edges,
        "connected_components": lambda *_: graph.components(staged),
        "edge_betweenness": lambda *_: graph.edge_betweenness(staged),
        "gn_communities": lambda *_: communities.girvan_newman(staged),
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", "")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("affinia-bench")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", str(max(8, int(cpus))))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    sf = os.path.basename(sf_dir)
    runs = QUERIES | linked(spark, sf_dir)
    runs["review_metrics"](spark, sf_dir).collect()
    seconds = {}
    for name in chosen.split(",") if chosen else HEADLINE:
        started = time.perf_counter()
        runs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": sf,
    }))


if __name__ == "__main__":
    main()
