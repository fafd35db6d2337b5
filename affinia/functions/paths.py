"""Shortest paths and edge removal on one small graph, in numpy: nodes are numbers, edges a pair of
arrays. The searches from several roots go level by level together."""

from __future__ import annotations

import numpy as np

DIGITS = 9
#: Searches are dealt into batches of about this many (root, edge) steps.
BATCH = 500_000


class Graph:
    """Neighbours of ``n`` nodes along the edges (u[i], v[i])."""

    def __init__(self, n: int, u: np.ndarray, v: np.ndarray):
        self.n, self.m = n, len(u)
        source = np.concatenate((u, v))
        order = np.argsort(source, kind="stable")
        self.start = np.searchsorted(source[order], np.arange(n + 1))
        self.target = np.concatenate((v, u))[order]
        self.edge = np.tile(np.arange(self.m), 2)[order]

    def search(self, roots: np.ndarray) -> tuple[np.ndarray, np.ndarray, list]:
        """Distance (-1: not reached) and number of shortest paths by (root, node), flattened; and
        level by level the arcs on shortest paths as (from, to, edge)."""
        distance = np.full(len(roots) * self.n, -1, np.int32)
        paths = np.zeros(len(roots) * self.n)
        latest = np.zeros(len(roots) * self.n, np.int64)
        front = np.arange(len(roots)) * self.n + roots
        distance[front], paths[front], arcs = 0, 1.0, []
        while len(front):
            node = front % self.n
            count = self.start[node + 1] - self.start[node]
            skipped = np.cumsum(count) - count
            at = np.arange(count.sum()) + np.repeat(self.start[node] - skipped, count)
            source = np.repeat(front, count)
            target = np.repeat(front - node, count) + self.target[at]
            new = np.flatnonzero(distance[target] < 0)
            source, target, edge = source[new], target[new], self.edge[at[new]]
            np.add.at(paths, target, paths[source])
            distance[target] = len(arcs) + 1
            if len(target):
                arcs.append((source, target, edge))
            latest[target] = np.arange(len(target))  # each target once, by the last arc to it
            front = target[latest[target] == np.arange(len(target))]
        return distance, paths, arcs

    def flows(self, roots: np.ndarray) -> np.ndarray:
        """For each edge the sum of its flows over ``roots``, every other node sending 1."""
        total = np.zeros(self.m)
        size = max(1, BATCH // max(1, self.m))
        for k in range(0, len(roots), size):
            _, paths, arcs = self.search(roots[k:k + size])
            credit = np.ones(len(paths))
            for source, target, edge in reversed(arcs):
                flow = credit[target] / paths[target] * paths[source]
                np.add.at(credit, source, flow)
                total += np.bincount(edge, flow, self.m)
        return total


def peel(
    names: list, u: np.ndarray, v: np.ndarray, alive: np.ndarray, degree: np.ndarray,
    records: tuple, budget: int,
) -> tuple[list[tuple], list[tuple]]:
    """Remove the top edge of a connected part, and so on in what is left of it, within ``budget``.

    Edges (u, v) not ``alive`` were removed before; nodes are numbered in the order of their
    ``names``. Returns the removals (value, key, parent, child, cut, volumes) and the parts not yet
    peeled to the end (nodes, live edges, inner edges, key). ``value`` is (-betweenness, u, v), with names.
    ``key`` orders removals as taking the best edge of all parts each time would: those of the
    values on the way to a removal that no later one exceeds. A removal that splits its part names
    the smallest nodes of both sides and has ``cut`` (original edges between them) and the product
    of their volumes. A removal costs nodes x edges of its part; the first is always done.
    """
    removed, left = [], []
    everything = np.arange(len(u))
    todo, spent = [(np.arange(len(degree)), everything[alive], everything, records)], 0
    while todo:
        nodes, live, inner, records = todo.pop()
        cost = len(nodes) * len(live)
        if cost == 0:
            continue
        if spent and spent + cost > budget:
            left.append((nodes, live, inner, records))
            continue
        spent += cost
        a, b = np.searchsorted(nodes, u[live]), np.searchsorted(nodes, v[live])
        value = -np.round(Graph(len(nodes), a, b).flows(np.arange(len(nodes))) / 2, DIGITS)
        top = np.lexsort((b, a, value))[0]
        first = (float(value[top]), names[u[live[top]]], names[v[live[top]]])
        records = (*(r for r in records if r > first), first)
        rest = np.delete(live, top)
        side = Graph(len(nodes), np.delete(a, top), np.delete(b, top)).search(a[top:top + 1])[0] >= 0
        if side[b[top]]:
            removed.append((first, records, None, None, 0, 0))
            todo.append((nodes, rest, inner, records))
            continue
        side = side if side[0] else ~side
        ends = side[np.searchsorted(nodes, u[inner])], side[np.searchsorted(nodes, v[inner])]
        volumes = int(degree[nodes[side]].sum()) * int(degree[nodes[~side]].sum())
        parent, child = names[nodes[side][0]], names[nodes[~side][0]]
        removed.append((first, records, parent, child, int((ends[0] != ends[1]).sum()), volumes))
        at = side[np.searchsorted(nodes, u[rest])]
        todo += [
            (nodes[side], rest[at], inner[ends[0] & ends[1]], records),
            (nodes[~side], rest[~at], inner[~ends[0] & ~ends[1]], records),
        ]
    return removed, left
