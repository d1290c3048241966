"""Isolation forest: fitted on bounded samples, applied in Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EULER = 0.5772156649015329


def expected_path(n: np.ndarray) -> np.ndarray:
    """Mean length of an unsuccessful search among ``n`` rows."""
    n = np.asarray(n, dtype=np.float64)
    out = np.where(n == 2, 1.0, 0.0)
    big = n > 2
    out[big] = 2 * (np.log(n[big] - 1) + EULER) - 2 * (n[big] - 1) / n[big]
    return out


@dataclass
class Tree:
    column: np.ndarray  # -1 at a leaf
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    depth: np.ndarray  # path length a row ending here gets
    mean: np.ndarray  # of the rows it was grown on that pass here, at the end of their paths

    def paths(self, x: np.ndarray) -> np.ndarray:
        n, width = x.shape
        if not width:
            return np.full(n, self.depth[0])
        flat, base = x.ravel(), np.arange(n) * width
        leaf, me = self.column < 0, np.arange(len(self.column))
        column = np.where(leaf, 0, self.column)
        child = np.column_stack([np.where(leaf, me, self.right), np.where(leaf, me, self.left)]).ravel()  # a leaf leads to itself
        at, before = np.zeros(n, np.int64), None
        while before is None or not np.array_equal(at, before):
            before, down = at, flat.take(base + column.take(at)) < self.cut.take(at)
            at = child.take(2 * at + down)
        return self.depth.take(at)

    def credit(self, x: np.ndarray, out: np.ndarray) -> None:
        """Add to ``out`` (rows, columns) by how much each cut on a row's path changes the mean below it."""
        at = np.zeros(len(x), np.int64)
        going = np.flatnonzero(self.column[at] >= 0)
        while len(going):
            node = at[going]
            down = x[going, self.column[node]] < self.cut[node]
            at[going] = np.where(down, self.left[node], self.right[node])
            out[going, self.column[node]] += self.mean[at[going]] - self.mean[node]
            going = going[self.column[at[going]] >= 0]


def grow(x: np.ndarray, rng: np.random.Generator) -> Tree:
    """One tree of random cuts, down to ceil(log2(rows)) levels."""
    limit = int(np.ceil(np.log2(max(len(x), 2))))
    column, cut, left, right, depth, held = [], [], [], [], [], []
    todo = [(np.arange(len(x)), 0, -1, 0)]
    while todo:
        rows, level, parent, side = todo.pop()
        me = len(column)
        if parent >= 0:
            (left if side == 0 else right)[parent] = me
        lo, hi = (x[rows].min(axis=0), x[rows].max(axis=0)) if len(rows) else (np.zeros(x.shape[1]), np.zeros(x.shape[1]))
        open_columns = np.flatnonzero(hi > lo)
        leaf = level >= limit or len(rows) <= 1 or not len(open_columns)
        c = -1 if leaf else int(rng.choice(open_columns))
        v = 0.0 if leaf else float(rng.uniform(lo[c], hi[c]))
        column.append(c)
        cut.append(v)
        left.append(-1)
        right.append(-1)
        held.append(len(rows))
        depth.append(level + float(expected_path(np.array([len(rows)]))[0]) if leaf else 0.0)
        if not leaf:
            down = x[rows, c] < v
            todo += [(rows[down], level + 1, me, 0), (rows[~down], level + 1, me, 1)]
    mean = list(depth)
    for node in reversed(range(len(column))):  # children come after their parent
        if column[node] >= 0:
            a, b = left[node], right[node]
            mean[node] = (held[a] * mean[a] + held[b] * mean[b]) / held[node]
    return Tree(*(np.array(a) for a in (column, cut, left, right, depth, mean)))


@dataclass
class IsolationForest:
    columns: list[str]
    trees: list[Tree]
    rows: int
    medians: np.ndarray  # of the rows it was fitted on

    def score(self, x: np.ndarray) -> np.ndarray:
        """Higher is stranger: 2**(-mean path / expected path) - 0.5. Rows that repeat much are scored once."""
        different, place = np.unique(x, axis=0, return_inverse=True) if x.shape[1] and len(x) else (x, None)
        if 2 * len(different) <= len(x):
            return self.score(different)[place.ravel()] if len(x) else np.zeros(0)
        mean = sum(t.paths(x) for t in self.trees) / len(self.trees)
        return 2.0 ** (-mean / float(expected_path(np.array([max(self.rows, 2)]))[0])) - 0.5


def fit_isolation_forest(df: DataFrame, columns: list[str], *, trees: int = 100, rows: int = 256, seed: int = 0, key: str | None = None) -> IsolationForest:
    """Each tree sees at most ``rows`` rows; ``trees * rows`` rows at most reach the driver (see ``draw_rows``)."""
    return grow_forest(draw_rows(df, columns, trees * rows, seed=seed, key=key), columns, trees=trees, rows=rows, seed=seed)


def draw_rows(df: DataFrame, columns: list[str], need: int, *, seed: int = 0, key: str | None = None) -> np.ndarray:
    """At most ``need`` rows of ``columns``, the first by hash of ``key``, which should be unique; nulls count as 0.

    Without a key rows are counted first, and equal ones drawn by their number
    each: by their values alone they would all be drawn, or none.
    """
    n = df.count()
    by = [key] if key else [*columns, "_many", "_one"]
    if n > need and not key:
        last = F.least(F.lit(65_535), F.col("_n") - 1 - F.col("_many") * 65_536)
        counts = df.groupBy(*dict.fromkeys(columns)).agg(F.count(F.lit(1)).alias("_n"))
        df = counts.withColumn("_many", F.explode(F.sequence(F.lit(0), F.floor((F.col("_n") - 1) / 65_536)))).withColumn("_one", F.explode(F.sequence(F.lit(0), last)))
    draw = F.pmod(F.xxhash64(F.lit(seed), *by), F.lit(1 << 30))
    picked = df.where(draw <= int(min(1.0, (1.1 * need + 100) / max(n, 1)) * (1 << 30))).orderBy(draw, *columns) if n > need else df
    return picked.select(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in columns]).limit(need).toPandas().to_numpy(dtype=np.float64)


def grow_forest(x: np.ndarray, columns: list[str], *, trees: int, rows: int, seed: int) -> IsolationForest:
    """A forest on rows in memory."""
    if not len(x):
        raise ValueError("nothing to fit on")
    rng = np.random.default_rng(seed)
    size = min(rows, len(x))
    return IsolationForest(columns, [grow(x[rng.choice(len(x), size, replace=False)], rng) for _ in range(trees)], size, np.median(x, axis=0))


def score_isolation_forest(df: DataFrame, model: IsolationForest, out: str = "anomaly_score") -> DataFrame:
    """``df`` with its anomaly scores; one narrow pass, the model (some 100 KB) travels with the tasks."""
    return score_isolation_forests(df, {out: model})


def score_isolation_forests(df: DataFrame, models: dict[str, IsolationForest]) -> DataFrame:
    """The same for several forests in one pass, each with a column of its name."""
    schema = df.drop(*models).schema
    for out in models:
        schema = schema.add(out, "double")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.assign(**{out: m.score(b[m.columns].astype(float).fillna(0.0).to_numpy()) if len(b) else [] for out, m in models.items()})

    return df.drop(*models).mapInPandas(run, schema)


def attribute(df: DataFrame, model: IsolationForest, key: str) -> DataFrame:
    """``key, feature, contribution, score, base``: contributions add up to ``score`` - ``base``.

    Path attribution: on a row's way down a tree each cut changes the mean path
    length of the rows below; the change is the cut column's. Sums over all
    trees are scaled from path lengths to scores. ``base`` is the score of the
    mean path. A feature no cut of the path uses has 0. One narrow pass.
    """
    kind = dict(df.dtypes)[key]
    scale = float(expected_path(np.array([max(model.rows, 2)]))[0])
    mean = sum(t.mean[0] for t in model.trees) / len(model.trees)
    base = 2.0 ** (-mean / scale) - 0.5

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            x = b[model.columns].astype(float).fillna(0.0).to_numpy()
            paths = np.zeros(x.shape)
            for t in model.trees:
                t.credit(x, paths)
            paths /= len(model.trees)
            score, longer = model.score(x), paths.sum(axis=1)
            rate = np.divide(score - base, longer, out=np.zeros(len(x)), where=np.abs(longer) > 1e-12)
            for i, c in enumerate(model.columns):
                yield pd.DataFrame({key: b[key], "feature": c, "contribution": paths[:, i] * rate, "score": score, "base": base})

    return df.select(key, *model.columns).mapInPandas(run, f"`{key}` {kind}, feature string, contribution double, score double, base double")


def attribute_boosted(df: DataFrame, model, columns: list[str], key: str) -> DataFrame:  # noqa: ANN001
    """The same for gradient-boosted trees (the last stage of a fitted pipeline): contributions to the margin.

    ``score`` is the margin, of which the probability is 1 / (1 + exp(-2 margin)).
    """
    fitted = model.stages[-1]
    trees = [(w, _read_tree(t._java_obj)) for t, w in zip(fitted.trees, fitted.treeWeights)]
    base = float(sum(w * t.mean[0] for w, t in trees))
    kind = dict(df.dtypes)[key]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            x = b[columns].astype(float).to_numpy()
            total = np.zeros(x.shape)
            for w, t in trees:
                part = np.zeros(x.shape)
                t.credit(x, part)
                total += w * part
            score = base + total.sum(axis=1)
            for i, c in enumerate(columns):
                yield pd.DataFrame({key: b[key], "feature": c, "contribution": total[:, i], "score": score, "base": base})

    return df.select(key, *columns).mapInPandas(run, f"`{key}` {kind}, feature string, contribution double, score double, base double")


def _read_tree(tree) -> Tree:  # noqa: ANN001
    """A fitted regression tree's cuts and means; MLlib goes left at values up to the threshold."""
    column, cut, left, right, mean = [], [], [], [], []
    todo = [(tree.rootNode(), -1, 0)]
    while todo:
        node, parent, side = todo.pop()
        me = len(column)
        if parent >= 0:
            (left if side == 0 else right)[parent] = me
        inner = node.subtreeDepth() > 0
        column.append(node.split().featureIndex() if inner else -1)
        cut.append(float(np.nextafter(node.split().threshold(), np.inf)) if inner else 0.0)
        left.append(-1)
        right.append(-1)
        mean.append(node.prediction())
        if inner:
            todo += [(node.leftChild(), me, 0), (node.rightChild(), me, 1)]
    a = [np.array(v) for v in (column, cut, left, right, mean)]
    return Tree(*a[:4], a[4], a[4])
