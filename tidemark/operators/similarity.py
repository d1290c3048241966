"""Near-duplicate joins over vectors, bounded by time, and exact nearest lists."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.runtime import broadcast_if_small

BLOCK = 4_096  # rows of either side that meet in one task


def similar_in_time(queries: DataFrame, corpus: DataFrame, threshold: float, reach: int) -> DataFrame:
    """Pairs with an inner product of at least ``threshold`` and 0 < query time - corpus time <= ``reach``.

    Both frames have ``key, originator, at`` (long) and ``vector`` of one
    length; other columns are ignored. Returns ``key, match_key,
    match_originator, similarity, age``. Equal times do not match (nor does a
    row itself); null keys, times and vectors, and vectors of another length
    than the query's, match nothing.

    Time is cut into buckets of ``reach``; a query meets its own bucket and the
    one before, whole and exact. A bucket however full is cut into blocks of at
    most 4,096 rows by hash of the key, and all blocks of queries meet all
    blocks of the corpus, each pair of blocks being one task's matrix product.
    """
    usable = lambda df: df.where(F.col("key").isNotNull() & F.col("at").isNotNull() & F.col("vector").isNotNull()).select(F.col("key").cast("string").alias("key"), F.col("originator").cast("string").alias("originator"), F.col("at").cast("long").alias("at"), F.col("vector").cast("array<double>").alias("vector"))
    own = F.floor(F.col("at") / F.lit(reach)).cast("long")
    q = usable(queries).withColumn("b", F.explode(F.array(own, own - 1)))
    c = usable(corpus).withColumn("b", own)
    sizes = q.groupBy("b").agg(F.count(F.lit(1)).alias("nq")).join(c.groupBy("b").agg(F.count(F.lit(1)).alias("nc")), "b")
    blocks = broadcast_if_small(sizes.select("b", F.ceil(F.col("nq") / BLOCK).cast("int").alias("qb"), F.ceil(F.col("nc") / BLOCK).cast("int").alias("cb")))
    return _blockwise(q.join(blocks, "b"), c.join(blocks, "b"), lambda a, z: _pairs(a, z, threshold, reach), "key string, match_key string, match_originator string, similarity double, age long")


def nearest_exact(queries: DataFrame, corpus: DataFrame, k: int) -> DataFrame:
    """The ``k`` corpus rows of highest inner product with each query, other than itself: ``key, match_key, similarity, rank``.

    Exact: every query meets every row, in blocks. Meant for a stated set of
    queries. Ties go to the smaller key; unusable rows as above.
    """
    usable = lambda df: df.where(F.col("key").isNotNull() & F.col("vector").isNotNull()).select(F.col("key").cast("string").alias("key"), F.lit("").alias("originator"), F.lit(0).cast("long").alias("at"), F.col("vector").cast("array<double>").alias("vector"), F.lit(0).cast("long").alias("b"))
    q, c = usable(queries), usable(corpus)
    qb, cb = (max(1, -(-df.count() // BLOCK)) for df in (q, c))
    count = lambda df: df.withColumns({"qb": F.lit(qb), "cb": F.lit(cb)})
    found = _blockwise(count(q), count(c), lambda a, z: _top(a, z, k), "key string, match_key string, similarity double")
    order = Window.partitionBy("key").orderBy(F.desc("similarity"), "match_key")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _blockwise(q: DataFrame, c: DataFrame, meet, schema: str) -> DataFrame:  # noqa: ANN001
    part = lambda n, salt: F.pmod(F.xxhash64(F.lit(salt), "key"), F.col(n)).cast("int")
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    columns = ("b", "i", "j", "key", "originator", "at", "vector")
    left = q.withColumn("i", part("qb", 1)).withColumn("j", spread("cb")).select(*[F.col(x).alias(x) for x in columns])
    right = c.withColumn("j", part("cb", 2)).withColumn("i", spread("qb")).select(*[F.col(x).alias(x) for x in columns])
    return left.groupBy("b", "i", "j").cogroup(right.groupBy("b", "i", "j")).applyInPandas(meet, schema)


def _by_length(a: pd.DataFrame, z: pd.DataFrame):  # noqa: ANN202
    """Blocks of equal vector length, as matrices."""
    la, lz = a["vector"].map(len).to_numpy(), z["vector"].map(len).to_numpy()
    for d in np.intersect1d(la, lz):
        x, y = a[la == d], z[lz == d]
        yield x, y, np.array(x["vector"].tolist(), dtype=np.float64).reshape(len(x), d), np.array(y["vector"].tolist(), dtype=np.float64).reshape(len(y), d)


def _pairs(a: pd.DataFrame, z: pd.DataFrame, threshold: float, reach: int) -> pd.DataFrame:
    out = [pd.DataFrame({"key": [], "match_key": [], "match_originator": [], "similarity": [], "age": []})]
    for x, y, m, n in _by_length(a, z):
        for s in range(0, len(x), 512):
            sim = m[s : s + 512] @ n.T
            age = x["at"].to_numpy()[s : s + 512, None] - y["at"].to_numpy()[None, :]
            r, c = np.nonzero((sim >= threshold - 1e-9) & (age > 0) & (age <= reach))
            exact = (m[s + r] * n[c]).cumsum(axis=1)[:, -1] if len(r) and m.shape[1] else sim[r, c]  # summed in order, as SQL does
            keep = exact >= threshold
            r, c = r[keep], c[keep]
            out.append(pd.DataFrame({"key": x["key"].to_numpy()[s + r], "match_key": y["key"].to_numpy()[c], "match_originator": y["originator"].to_numpy()[c], "similarity": exact[keep], "age": age[r, c]}))
    return pd.concat(out[1:] or out)


def _top(a: pd.DataFrame, z: pd.DataFrame, k: int) -> pd.DataFrame:
    out = [pd.DataFrame({"key": [], "match_key": [], "similarity": []})]
    for x, y, m, n in _by_length(a, z):
        keys = y["key"].to_numpy()
        for s in range(0, len(x), 512):
            sim = m[s : s + 512] @ n.T
            sim[x["key"].to_numpy()[s : s + 512, None] == keys[None, :]] = -np.inf
            for r, row in enumerate(sim):
                best = np.lexsort((keys, -row))[:k] if len(row) <= 4 * k else _best(row, keys, k)
                best = best[row[best] > -np.inf]
                out.append(pd.DataFrame({"key": x["key"].iloc[s + r], "match_key": keys[best], "similarity": row[best]}))
    return pd.concat(out[1:] or out)


def _best(row: np.ndarray, keys: np.ndarray, k: int) -> np.ndarray:
    limit = np.partition(row, len(row) - k)[len(row) - k]
    near = np.flatnonzero(row >= limit)
    return near[np.lexsort((keys[near], -row[near]))][:k]


def neardup_features(rows: DataFrame, threshold: float, windows: dict[str, int]) -> DataFrame:
    """Per row and window: earlier near-duplicates, their highest similarity and their different originators; zeros without."""
    pairs = similar_in_time(rows, rows, threshold, max(windows.values()))
    aggregates = []
    for name, width in windows.items():
        inside = F.col("age") <= width
        aggregates += [F.count_if(inside).alias(f"match_count_{name}"), F.coalesce(F.max(F.when(inside, F.col("similarity"))), F.lit(0.0)).alias(f"max_similarity_{name}"), F.count_distinct(F.when(inside, F.col("match_originator"))).alias(f"distinct_senders_{name}")]
    found = pairs.groupBy("key").agg(*aggregates)
    names = [c for c in found.columns if c != "key"]
    keys = rows.select(F.col("key").cast("string").alias("key"))
    return keys.join(found, "key", "left").fillna(0, names)


def capped(pairs: DataFrame, k: int) -> DataFrame:
    """At most ``k`` matches of each key, the most similar first (ties by match); an explicit report limit."""
    order = Window.partitionBy("key").orderBy(F.desc("similarity"), "match_key")
    return pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
