"""Clusterings of guarded pools, and connected components at any size."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.similarity import _blockwise, _by_length
from tidemark.runtime import materialize

POOL = 50_000  # rows a pairwise clustering takes; more raise, none are dropped


def guard(df: DataFrame, most: int = POOL) -> DataFrame:
    """``df``, unless it has more rows than a pairwise method should take."""
    if df.limit(most + 1).count() > most:
        raise ValueError(f"more than {most} rows: narrow the pool first")
    return df


def connected_components(edges: DataFrame) -> DataFrame:
    """``id, component`` (the least id) for all ends of ``a, b``; nulls have no part in it.

    Alternating stars: every id is linked to the least it knows, larger ones
    hand their links on. Rounds grow with the logarithm of the longest chain;
    each is written to the shared folder. Links are reduced before a hub's
    neighbours meet, and no neighbour list is ever collected.
    """
    links = edges.where("a IS NOT NULL AND b IS NOT NULL").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    nodes = materialize(links.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "nodes")
    links = materialize(links.where("a <> b"), "links")
    while True:
        large = _star(links, both=True)
        small = materialize(_star(large, both=False), "links")
        same = small.exceptAll(links).limit(1).count() == 0 and links.exceptAll(small).limit(1).count() == 0
        links = small
        if same:
            break
    return nodes.join(links.select(F.col("a").alias("id"), F.col("b").alias("component")), "id", "left").select("id", F.coalesce("component", "id").alias("component"))


def _star(links: DataFrame, both: bool) -> DataFrame:
    """Large star (links seen from both ends, larger neighbours go to the least) or small star (smaller ones do)."""
    seen = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))) if both else links
    least = seen.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    moved = seen.join(least, "a").where(F.col("b") > F.col("a") if both else F.lit(True))
    handed = moved.select(F.col("b").alias("x"), F.col("m").alias("y"))
    own = least.select(F.col("a").alias("x"), F.col("m").alias("y"))
    merged = handed if both else handed.unionByName(own)
    return merged.where("x <> y").select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct()


def _vectors(df: DataFrame) -> DataFrame:
    return df.where("key IS NOT NULL AND vector IS NOT NULL").select(F.col("key").cast("string").alias("key"), F.lit("").alias("originator"), F.lit(0).cast("long").alias("at"), F.col("vector").cast("array<double>").alias("vector"), F.lit(0).cast("long").alias("b"))


def close_pairs(df: DataFrame, eps: float) -> DataFrame:
    """``key, other, distance`` of different rows at most ``eps`` apart, both ways; blocks of a guarded pool."""
    v = _vectors(guard(df))
    n = max(1, -(-v.count() // 4096))
    v = v.withColumns({"qb": F.lit(n), "cb": F.lit(n)})

    def meet(a: pd.DataFrame, z: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"key": [], "other": [], "distance": []})]
        for x, y, m, k in _by_length(a, z):
            for s in range(0, len(x), 256):
                d = np.sqrt(((m[s : s + 256, None, :] - k[None, :, :]) ** 2).sum(axis=2)) if m.shape[1] <= 8 else _distances(m[s : s + 256], k)
                r, c = np.nonzero((d <= eps) & (x["key"].to_numpy()[s : s + 256, None] != y["key"].to_numpy()[None, :]))
                out.append(pd.DataFrame({"key": x["key"].to_numpy()[s + r], "other": y["key"].to_numpy()[c], "distance": d[r, c]}))
        return pd.concat(out[1:] or out)

    return _blockwise(v, v, meet, "key string, other string, distance double")


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    sq = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * a @ b.T
    return np.sqrt(np.maximum(sq, 0))


def dbscan(df: DataFrame, eps: float, min_samples: int) -> DataFrame:
    """``key, cluster``: density clusters named by their least core key, null for noise.

    A row counts itself among its neighbours. A border row joins the cluster of
    its nearest core row (ties: least key).
    """
    pairs = materialize(close_pairs(df, eps), "pairs")
    degree = _vectors(df).select("key").join(pairs.groupBy("key").agg(F.count(F.lit(1)).alias("n")), "key", "left")
    core = degree.where(F.coalesce("n", F.lit(0)) + 1 >= min_samples).select("key")
    between = pairs.join(core, "key", "left_semi").join(core.select(F.col("key").alias("other")), "other", "left_semi")
    loops = core.select(F.col("key").alias("a"), F.col("key").alias("b"))
    parts = connected_components(between.select(F.col("key").alias("a"), F.col("other").alias("b")).unionByName(loops))
    border = pairs.join(core, "key", "left_anti").join(parts, F.col("other") == F.col("id")).groupBy("key").agg(F.min_by("component", F.struct("distance", "other")).alias("component"))
    labelled = parts.select(F.col("id").alias("key"), "component").unionByName(border)
    return _vectors(df).select("key").join(labelled, "key", "left").select("key", F.col("component").alias("cluster"))


def suggest_eps(df: DataFrame, min_samples: int, percentile: float = 0.9) -> float | None:
    """The 90th percentile of distances to the ``min_samples``-th nearest row, the row itself being the first."""
    v = _vectors(guard(df))
    rows = v.select("key", "vector").toPandas()
    x = np.array(rows["vector"].tolist(), dtype=np.float64)
    if len(x) < min_samples:
        return None
    kth = np.concatenate([np.partition(_distances(x[s : s + 512], x), min_samples - 1, axis=1)[:, min_samples - 1] for s in range(0, len(x), 512)])
    return float(np.percentile(kth, percentile * 100))


def hdbscan(df: DataFrame, min_cluster_size: int = 5) -> DataFrame:
    """``key, cluster`` by density hierarchy, clusters numbered from 0, -1 for noise.

    The guarded pool (at most 50,000 rows) goes to one task as bounded input:
    a minimum spanning tree of mutual reachability is inherently global.
    """
    v = _vectors(guard(df)).select("key", "vector").withColumn("one", F.lit(1))

    def run(pool: pd.DataFrame) -> pd.DataFrame:
        pool = pool.sort_values("key")
        return pd.DataFrame({"key": pool["key"], "cluster": hierarchy(np.array(pool["vector"].tolist(), dtype=np.float64), min_cluster_size)})

    return v.groupBy("one").applyInPandas(run, "key string, cluster int")


def hierarchy(x: np.ndarray, size: int) -> np.ndarray:
    """Labels of the most stable clusters of the density hierarchy of ``x``."""
    n = len(x)
    if n < max(2, size):
        return np.full(n, -1)
    core = np.concatenate([np.partition(_distances(x[s : s + 512], x), size - 1, axis=1)[:, size - 1] for s in range(0, n, 512)])
    # Prim's tree of mutual reachability
    best, source, done = np.full(n, np.inf), np.zeros(n, np.int64), np.zeros(n, bool)
    at, edges = 0, []
    for _ in range(n - 1):
        done[at] = True
        d = np.maximum(np.maximum(_distances(x[at : at + 1], x)[0], core[at]), core)
        nearer = ~done & (d < best)
        best[nearer], source[nearer] = d[nearer], at
        at = int(np.where(done, np.inf, best).argmin())
        edges.append((best[at], int(source[at]), at))
    edges.sort()
    # single linkage: node n + i joins two nodes at a distance
    root, weight, kids = list(range(2 * n - 1)), [1] * n, []

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, (dist, a, b) in enumerate(edges):
        ra, rb = find(a), find(b)
        kids.append((ra, rb, dist))
        weight.append(weight[ra] + weight[rb])
        root[ra] = root[rb] = n + i
    points = lambda node: _leaves(node, kids, n)
    # condensed clusters: name -> [birth, stability, members leaving, children]
    clusters = [{"birth": 0.0, "stability": 0.0, "kids": [], "node": 2 * n - 2}]
    todo = [(2 * n - 2, 0)]
    while todo:
        node, c = todo.pop()
        while node >= n:
            a, b, dist = kids[node - n]
            density = 1 / max(dist, 1e-12)
            big = [k for k in (a, b) if weight[k] >= size]
            small = weight[node] - sum(weight[k] for k in big)
            clusters[c]["stability"] += small * (density - clusters[c]["birth"])
            if len(big) == 2:
                clusters[c]["stability"] += (weight[a] + weight[b]) * (density - clusters[c]["birth"])
                for k in big:
                    clusters.append({"birth": density, "stability": 0.0, "kids": [], "node": k})
                    clusters[c]["kids"].append(len(clusters) - 1)
                    todo.append((k, len(clusters) - 1))
                break
            if not big:
                break
            node = big[0]
    chosen: set[int] = set()
    for c in reversed(range(1, len(clusters))):
        below = sum(clusters[k]["stability"] for k in clusters[c]["kids"])
        if clusters[c]["kids"] and below > clusters[c]["stability"]:
            clusters[c]["stability"] = below
        else:
            drop = list(clusters[c]["kids"])
            while drop:
                k = drop.pop()
                chosen.discard(k)
                drop += clusters[k]["kids"]
            chosen.add(c)
    labels = np.full(n, -1)
    for i, c in enumerate(sorted(chosen)):
        labels[points(clusters[c]["node"])] = i
    return labels


def _leaves(node: int, kids: list, n: int) -> list[int]:
    out, todo = [], [node]
    while todo:
        k = todo.pop()
        if k < n:
            out.append(k)
        else:
            todo += kids[k - n][:2]
    return out
