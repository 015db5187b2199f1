"""Metrics of small directed graphs, one for each key."""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterable, Sequence

import pandas as pd
from pyspark.sql import DataFrame

from gritstone.session import ship


def brandes(edges: Iterable[tuple[object, object, float]]) -> dict[object, float]:
    """Betweenness of a directed graph with weights as distances, over the number of other ordered pairs.

    A run of Dijkstra's algorithm from each node counts shortest paths, then dependencies are added up from the farthest node back.
    """
    to: dict[object, dict[object, float]] = defaultdict(dict)
    nodes: dict[object, None] = {}
    for a, b, weight in edges:
        nodes[a] = nodes[b] = None
        if a != b:
            to[a][b] = min(weight, to[a].get(b, weight))
    score = dict.fromkeys(nodes, 0.0)
    for source in nodes:
        settled: list[object] = []
        paths: dict[object, float] = defaultdict(float, {source: 1.0})
        parents: dict[object, list[object]] = defaultdict(list)
        best = {source: 0.0}
        done: set[object] = set()
        queue: list[tuple[float, int, object]] = [(0.0, 0, source)]
        tick = 0
        while queue:
            d, _, v = heapq.heappop(queue)
            if v in done:
                continue
            done.add(v)
            settled.append(v)
            for u, weight in to[v].items():
                far = d + weight
                known = best.get(u)
                if known is None or far < known - 1e-12:
                    best[u], paths[u], parents[u] = far, paths[v], [v]
                    tick += 1
                    heapq.heappush(queue, (far, tick, u))
                elif u not in done and abs(far - known) <= 1e-12:
                    paths[u] += paths[v]
                    parents[u].append(v)
        credit: dict[object, float] = defaultdict(float)
        for v in reversed(settled):
            for p in parents[v]:
                credit[p] += paths[p] / paths[v] * (1 + credit[v])
            if v != source:
                score[v] += credit[v]
    n = len(nodes)
    scale = 1 / ((n - 1) * (n - 2)) if n > 2 else 1.0
    return {v: s * scale for v, s in score.items()}


def betweenness(edges: DataFrame, keys: Sequence[str], src: str, dst: str, weight: str) -> DataFrame:
    """keys, node and betweenness (6 places). A key's graph must fit in a task's memory: the teams of a match do."""
    ship(edges.sparkSession)
    keys = list(keys)
    kinds = dict(edges.dtypes)
    shape = ", ".join(f"{k} {kinds[k]}" for k in keys) + f", node {kinds[src]}, betweenness double"

    def of(pdf: pd.DataFrame) -> pd.DataFrame:
        found = brandes(zip(pdf[src], pdf[dst], pdf[weight].astype(float)))
        out = pd.DataFrame({"node": list(found), "betweenness": [round(x, 6) for x in found.values()]})
        for i, k in enumerate(keys):
            out.insert(i, k, pdf[k].iloc[0])
        return out

    return edges.select(*keys, src, dst, weight).groupBy(*keys).applyInPandas(of, shape)
