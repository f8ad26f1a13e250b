"""Constrained agglomerative clustering, component by component.

A merge needs an allowed pair above the threshold, so no merge crosses the
connected components of the graph of those pairs: clustering each component
gives the clustering of all. Components are small; each is one group.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import graph, similarity, windows


def agglomerate(sim: np.ndarray, groups: np.ndarray, threshold: float, linkage: str = "complete") -> np.ndarray:
    """Cluster number of each row. The best allowed pair strictly above the threshold merges first, lowest indexes in a tie.

    Rows of one group never meet. 'complete' keeps the least similarity of two
    clusters, 'average' the mean of their two rows. This is the plain form on a matrix.
    """
    n = len(sim)
    label = np.arange(n)
    m = sim.astype(np.float64)
    m[groups[:, None] == groups[None, :]] = -np.inf
    for _ in range(n):
        flat = int(np.argmax(m)) if n else 0
        if not n or not m.flat[flat] > threshold:
            break
        a, b = divmod(flat, n)
        row = np.minimum(m[a], m[b]) if linkage == "complete" else (m[a] + m[b]) / 2
        m[a, :], m[:, a] = row, row
        m[a, a] = -np.inf
        m[b, :] = m[:, b] = -np.inf
        label[label == label[b]] = label[a]
    return label


def close_pairs(x: np.ndarray, groups: np.ndarray, threshold: float, block: int = 1024) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(i, j, similarity), i < j, of the allowed pairs strictly above the threshold, a block of rows at a time."""
    for at in range(0, len(x), block):
        rows = slice(at, at + block)
        sim = (x[rows] @ x[at:].T + 1) / 2
        i, j = np.nonzero((sim > threshold) & (groups[rows, None] != groups[None, at:]))
        later = j > i
        yield i[later] + at, j[later] + at, sim[i[later], j[later]]


def agglomerate_pairs(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> np.ndarray:
    """Complete linkage over the pairs that may merge, as ``agglomerate`` gives it, without a matrix.

    Two clusters may merge as long as each row of one is paired with each of the other, so a
    merged cluster keeps the neighbours that both had. Pairs wait in a heap; one that changed since is passed over.
    """
    near: list[dict[int, float]] = [{} for _ in range(n)]
    heap = []
    for some in pairs:
        for i, j, s in zip(*(v.tolist() for v in some), strict=True):
            near[i][j] = near[j][i] = s
            heap.append((-s, i, j))
    heapq.heapify(heap)
    parent = np.arange(n)
    while heap:
        s, a, b = heapq.heappop(heap)
        if near[a].get(b) != -s:
            continue
        both, parent[b] = near[a].keys() & near[b].keys(), a
        for c in (a, b):
            for d in near[c]:
                del near[d][c]
        near[a], near[b] = {d: min(near[a][d], near[b][d]) for d in both}, {}
        for d, s in near[a].items():
            near[d][a] = s
            heapq.heappush(heap, (-s, min(a, d), max(a, d)))
    for i in range(n):  # a cluster's row is its lowest, so parents come first
        parent[i] = parent[parent[i]]
    return parent


def constrained_clusters(vectors: DataFrame, threshold: float = 0.8, linkage: str = "complete") -> DataFrame:
    """(key, speaker): speakers 'spk00001' on, largest first, then by first key; from (key, grp, vec)."""
    pairs = similarity.edges(vectors, threshold)
    parts = graph.connected_components(pairs)
    member = vectors.join(parts, vectors["key"] == parts["node"], "left").select("key", "grp", "vec", F.coalesce("component", "key").alias("component"))
    alone = member.join(parts.select(F.col("node").alias("key")), "key", "left_anti").select("key", F.col("key").alias("cluster"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("key").reset_index(drop=True)
        x = np.array(pdf["vec"].tolist(), np.float64)
        groups = pd.factorize(pdf["grp"])[0]
        label = agglomerate_pairs(len(x), close_pairs(x, groups, threshold)) if linkage == "complete" else agglomerate((x @ x.T + 1) / 2, groups, threshold, linkage)
        first = pd.Series(pdf["key"]).groupby(label).transform("min")
        return pd.DataFrame({"key": pdf["key"], "cluster": first})

    kind = dict(vectors.dtypes)["key"]
    linked = member.join(parts.select(F.col("node").alias("key")), "key", "left_semi").groupBy("component").applyInPandas(run, f"key {kind}, cluster {kind}")
    every = linked.unionByName(alone)
    sizes = every.groupBy("cluster").agg(F.count("*").alias("size"))
    named = windows.numbered(sizes, [F.desc("size"), F.col("cluster")]).select("cluster", F.format_string("spk%05d", "rn").alias("speaker"))
    return every.join(named, "cluster").select("key", "speaker")
