"""The most similar vectors of every vector, by learned partitions."""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.runtime import broadcast_if_small, materialize

SAMPLE = 16_384  # vectors the partitioner and its classifier are fitted on, at most
PART_ROWS = 2_000  # rows a part should have
BLOCK_ITEMS = 4_096  # items of one task's block
BLOCK_QUERIES = 16_384  # queries of one task's block
HELD_OUT = 400  # asking vectors, unknown to the classifier, whose true neighbours say how many parts to visit
GRAPH_BLOCK = 128  # sampled vectors compared at once with the sample, on the driver


@dataclass
class Router:
    """A one-hidden-layer classifier from unit vectors to parts."""

    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray

    @property
    def parts(self) -> int:
        return self.w2.shape[1]

    def scores(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(x @ self.w1 + self.b1, 0) @ self.w2 + self.b2

    def top(self, x: np.ndarray, probes: int) -> np.ndarray:
        s = self.scores(x)
        probes = min(probes, s.shape[1])
        best = np.argpartition(-s, probes - 1, axis=1)[:, :probes]
        return np.take_along_axis(best, np.argsort(-np.take_along_axis(s, best, 1), axis=1, kind="stable"), 1)


@dataclass
class TwoLevels:
    """A classifier to coarse parts, and one for each of these to its own parts, numbered through."""

    first: Router
    second: list[Router]

    def __post_init__(self) -> None:
        self.begin = np.concatenate([[0], np.cumsum([r.parts for r in self.second])])
        self.parts = int(self.begin[-1])

    def top(self, x: np.ndarray, probes: int) -> np.ndarray:
        """The parts of the largest product of both classifiers' probabilities, among those of the likeliest coarse parts."""
        chance = _log_softmax(self.first.scores(x))
        coarse = self.first.top(x, min(self.first.parts, 2 * probes + 8))
        widest = max(r.parts for r in self.second)
        joint = np.full((len(x), coarse.shape[1], widest), -np.inf, np.float32)
        for part in np.unique(coarse):
            row, at = np.nonzero(coarse == part)
            inner = _log_softmax(self.second[part].scores(x[row]))
            joint[row, at, : inner.shape[1]] = inner + chance[row, part][:, None]
        joint = joint.reshape(len(x), -1)
        probes = min(probes, int(np.isfinite(joint).sum(axis=1).min(initial=self.parts)))
        best = np.argpartition(-joint, probes - 1, axis=1)[:, :probes]
        best = np.take_along_axis(best, np.argsort(-np.take_along_axis(joint, best, 1), axis=1, kind="stable"), 1)
        return self.begin[np.take_along_axis(coarse, best // widest, 1)] + best % widest


def _log_softmax(s: np.ndarray) -> np.ndarray:
    s = s - s.max(axis=1, keepdims=True)
    return s - np.log(np.exp(s).sum(axis=1, keepdims=True))


def nearest_vectors(vectors: DataFrame, *, k: int = 10, min_cosine: float | None = None, queries: str | None = None, probes: int = 8, recall: float = 0.9, sample: int = SAMPLE, part_rows: int = PART_ROWS, seed: int = 5) -> DataFrame:
    """The ``k`` most similar other vectors of each query vector, by cosine.

    ``vectors`` has ``index`` (long) and ``vector`` (array of float); other
    columns are ignored. ``queries`` is a SQL condition on ``index`` that says
    which rows ask (default: all); every usable row can be found. Returns
    ``index, neighbour, cosine, rank`` (ranks from 1; equal cosines in order
    of index), of those with ``cosine >= min_cosine`` if that is given.

    Vectors that are null, hold nulls, NaN or infinities, are all zero, or are
    not of the most frequent length (of equally frequent ones the longest) have
    no neighbours; so has a null index. An index that occurs several times is
    one entry per row, and rows of the same index are not neighbours.

    A bounded sample (``sample`` rows by hash of the index) gives a neighbour
    graph, which is partitioned into equal parts: recursive median splits, then
    label propagation along edges under a size limit. A small classifier
    learns vector -> part. Every vector is indexed in its most probable part;
    a query visits its most probable parts and is reranked exactly. The loss
    is that of neighbours in parts not visited. At least ``probes`` parts are
    visited; with more parts than that, about ``HELD_OUT`` asking rows that the
    classifier has not seen are compared with every row, and as many parts are
    visited as those need to find ``recall`` of their neighbours, with two
    standard errors to spare.

    The number of parts follows the rows (``rows / part_rows``). Where that is
    more than one per 64 sampled rows, there are two levels: about the square
    root of that many coarse parts, each with a classifier of its own to as many
    parts as its rows need, fitted in parallel on at most ``sample`` of them (so
    some 130 million vectors with the defaults before parts grow). A vector
    is written once with the list of parts it visits, and copied only into
    the shuffle. Parts that turn out large, for
    example by masses of copies, are cut into blocks of at most 4,096 items and
    16,384 queries, and every block of queries meets every block of items of
    its part, so no group is ever unbounded and none is cut off.
    """
    lengths = vectors.where("vector IS NOT NULL AND index IS NOT NULL").groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    schema = "index long, neighbour long, cosine double, rank int"
    if lengths is None:
        return vectors.sparkSession.createDataFrame([], schema)
    sound = ~F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("vector", lambda x: x != 0)
    usable = materialize(vectors.where((F.size("vector") == lengths["d"]) & F.col("index").isNotNull()).where(sound).select(F.col("index").cast("long").alias("index"), F.col("vector").cast("array<float>").alias("vector")), "vectors")
    rows = usable.count()
    if rows == 0:
        return vectors.sparkSession.createDataFrame([], schema)
    ask = F.coalesce(F.expr(queries), F.lit(False)) if queries else F.lit(True)
    below = lambda salt, share: F.pmod(F.xxhash64(F.lit(salt), "index"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1
    known, held = usable, None
    if min(rows // part_rows, min(rows, sample) // 64) > probes:
        asking = usable.where(ask).count() if queries else rows
        drawn = ask & below(seed + 1, min(1.0, min(HELD_OUT, rows // 10) / max(asking, 1)))
        held, known = usable.where(drawn).limit(2 * HELD_OUT).toPandas(), usable.where(~drawn)
    share = min(1.0, sample * 0.97 / rows)
    chosen = known.where(below(seed, share)).limit(sample).select("vector").toArrow()
    x = _unit(chosen["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, lengths["d"]))
    wanted, most = max(1, rows // part_rows), max(1, len(x) // 64)
    if wanted <= most:
        router: Router | TwoLevels = fit_router(x, wanted, seed)
    else:
        router = _two_levels(known, fit_router(x, min(most, int(np.ceil(wanted**0.5))), seed), rows, sample, part_rows, seed)
    parts = router.parts
    floor = -2.0 if min_cosine is None else min_cosine
    if held is not None and len(held) and parts > probes:
        probes = max(probes, _enough_probes(usable, held, router, k, floor, recall))
    routed = materialize(_route(usable.withColumn("asks", ask), router, probes), "routed")
    visits = routed.select("index", "vector", F.posexplode("parts").alias("visit", "part"), "asks").withColumn("home", F.col("visit") == 0)

    load = visits.groupBy("part").agg(F.count(F.when(F.col("home"), 1)).alias("items"), F.count(F.when(F.col("asks"), 1)).alias("queries"))
    blocks = load.select("part", F.ceil(F.col("items") / BLOCK_ITEMS).cast("int").alias("ib"), F.ceil(F.col("queries") / BLOCK_QUERIES).cast("int").alias("qb")).where("ib > 0 AND qb > 0")
    placed = visits.join(broadcast_if_small(blocks), "part")
    of = lambda n, salt: F.pmod(F.xxhash64(F.lit(salt), "index"), F.col(n)).cast("int")
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    columns = ("part", "i", "q", "index", "vector")
    items = placed.where("home").withColumn("i", of("ib", 1)).withColumn("q", all_of("qb")).select(*[F.col(c).alias(c) for c in columns])
    asked = placed.where("asks").withColumn("q", of("qb", 2)).withColumn("i", all_of("ib")).select(*[F.col(c).alias(c) for c in columns])

    def block(a: pa.Table, b: pa.Table) -> pa.Table:
        return _rerank(a, b, k, floor)

    found = asked.groupBy("part", "i", "q").cogroup(items.groupBy("part", "i", "q")).applyInArrow(block, "index long, neighbour long, cosine double")
    order = Window.partitionBy("index").orderBy(F.desc("cosine"), "neighbour")
    once = found.groupBy("index", "neighbour").agg(F.max("cosine").alias("cosine"))
    return once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x /= np.maximum(np.abs(x).max(axis=1, keepdims=True), 1e-300)
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)


def _matrix(vectors: pa.ListArray | pa.ChunkedArray, kind: type = np.float32) -> np.ndarray:
    """Vectors of one length as rows."""
    flat = (vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors).flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(vectors), -1).astype(kind)


def _route(df: DataFrame, router: Router | TwoLevels, probes: int) -> DataFrame:
    """``index, vector, asks`` with the ``parts`` to visit, likeliest first; only the first one for rows that do not ask."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                top = router.top(_unit(_matrix(b.column("vector"))), probes).astype(np.int32)
                length = np.where(b.column("asks").to_numpy(zero_copy_only=False).astype(bool), top.shape[1], 1)
                parts = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(length)]).astype(np.int32), pa.array(top[np.arange(top.shape[1])[None, :] < length[:, None]]))
                yield pa.RecordBatch.from_arrays([b.column("index"), b.column("vector"), b.column("asks"), parts], names=["index", "vector", "asks", "parts"])

    return df.select("index", "vector", "asks").mapInArrow(run, "index long, vector array<float>, asks boolean, parts array<int>")


def _two_levels(known: DataFrame, first: Router, rows: int, sample: int, part_rows: int, seed: int) -> TwoLevels:
    """Fits one classifier for each coarse part, on at most ``sample`` of its rows each, in parallel.

    What comes to the driver is ``first.parts`` models of bounded size.
    """
    draw = lambda salt: F.pmod(F.xxhash64(F.lit(salt), "index"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    share = min(1.0, 1.2 * 64 / part_rows)
    chosen = _route(known.where(draw(seed + 2) < share).withColumn("asks", F.lit(False)), first, 1).select(F.col("parts")[0].alias("part"), "index", "vector")
    chosen = materialize(chosen, "coarse")
    sizes = chosen.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    drawn = chosen.join(broadcast_if_small(sizes), "part").where(draw(seed + 3) < F.lit(float(sample)) / F.col("n"))

    def fit(part: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        x = _unit(_matrix(t["vector"]))
        parts = max(1, min(int(np.ceil(t["n"][0].as_py() / share / part_rows)), len(x) // 64))
        return pa.table({"part": pa.array([part[0].as_py()], pa.int32()), "model": pa.array([pickle.dumps(fit_router(x, parts, seed))], pa.binary())})

    fitted = {r["part"]: pickle.loads(r["model"]) for r in drawn.groupBy("part").applyInArrow(fit, "part int, model binary").collect()}
    single = fit_router(np.zeros((1, first.w1.shape[0]), np.float32), 1, seed)
    return TwoLevels(first, [fitted.get(p, single) for p in range(first.parts)])


def _enough_probes(usable: DataFrame, held, router: Router | TwoLevels, k: int, floor: float, recall: float) -> int:  # noqa: ANN001
    """The fewest parts with which the rows of ``held`` find ``recall`` of their true neighbours; all parts if none are fewer.

    Every row meets ``held``; a batch keeps its ``k`` nearest of each, so at most
    ``k`` rows per held row and batch are shuffled. Where fewer than 100
    neighbours reach ``floor``, the nearest at any cosine count instead.
    """
    asked, same = _unit(np.array(held["vector"].tolist(), dtype=np.float32)), held["index"].to_numpy()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                ids = b.column("index").to_numpy()
                x = _unit(_matrix(b.column("vector")))
                cos = asked @ x.T
                cos[same[:, None] == ids[None, :]] = -3
                best = np.argpartition(-cos, min(k, len(ids)) - 1, axis=1)[:, :k]
                r = np.repeat(np.arange(len(same)), best.shape[1])
                c = best.ravel()
                keep = cos[r, c] > -2.5
                r, c = r[keep], c[keep]
                yield pa.RecordBatch.from_arrays([pa.array(r), pa.array(ids[c]), pa.array(cos[r, c].astype(np.float64)), pa.array(router.top(x, 1)[c, 0].astype(np.int32))], names=["held", "neighbour", "cosine", "part"])

    near = usable.mapInArrow(run, "held long, neighbour long, cosine double, part int")
    order = Window.partitionBy("held").orderBy(F.desc("cosine"), "neighbour")
    true = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).toPandas()
    parts = router.parts
    if (true["cosine"] >= floor).sum() >= 100:
        true = true[true["cosine"] >= floor]
    if not len(true):
        return parts
    order_of = router.top(asked, parts)
    visits = np.full((len(asked), parts), parts)
    np.put_along_axis(visits, order_of, np.arange(order_of.shape[1])[None, :], 1)
    at = visits[true["held"].to_numpy(), true["part"].to_numpy()]  # the visit in which each neighbour is met
    _, row = np.unique(true["held"].to_numpy(), return_inverse=True)
    n = np.bincount(row)
    for p in range(1, parts):
        met = np.bincount(row, weights=at < p)
        share = met.sum() / n.sum()
        error = np.sqrt(((met - share * n) ** 2).sum()) / n.sum()  # neighbours of one row are met together
        if share - 2 * error >= recall:
            return p
    return parts


def _rerank(asked: pa.Table, items: pa.Table, k: int, floor: float) -> pa.Table:
    """Exact top ``k`` of one block of queries in one block of items, with cosines in double."""
    if not len(asked) or not len(items):
        return pa.table({"index": pa.array([], pa.int64()), "neighbour": pa.array([], pa.int64()), "cosine": pa.array([], pa.float64())})
    items = items.sort_by("index")
    ids, askers = items["index"].to_numpy(), asked["index"].to_numpy()
    x, queries = (m / np.linalg.norm(m, axis=1, keepdims=True) for m in (_matrix(t["vector"], np.float64) for t in (items, asked)))
    x32 = x.astype(np.float32)
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for start in range(0, len(asked), 1024):
        q, qid = queries[start : start + 1024], askers[start : start + 1024]
        rough = q.astype(np.float32) @ x32.T
        rough[qid[:, None] == ids[None, :]] = -3
        # everything that may tie with the k-th stays in until cosines are exact
        limit = np.full(len(q), floor, np.float32) if len(ids) <= k else np.maximum(np.partition(rough, len(ids) - k, axis=1)[:, len(ids) - k], floor)
        r, c = np.nonzero((rough >= limit[:, None] - 1e-5) & (rough > -2.5))
        cos = np.einsum("ij,ij->i", q[r], x[c])
        keep = cos >= floor
        r, c, cos = r[keep], c[keep], cos[keep]
        by = np.lexsort((ids[c], -cos, r))
        r, c, cos = r[by], c[by], cos[by]
        nth = np.arange(len(r)) - np.searchsorted(r, r)
        first = nth < k
        out.append((qid[r[first]], ids[c[first]], cos[first]))
    return pa.table({name: np.concatenate([o[i] for o in out]) for i, name in enumerate(("index", "neighbour", "cosine"))})


def fit_router(x: np.ndarray, parts: int, seed: int, *, graph_k: int = 10, hidden: int = 128, epochs: int = 12) -> Router:
    """Partition the neighbour graph of ``x`` into ``parts`` and learn to name a vector's part."""
    dim = x.shape[1]
    if parts <= 1:
        return Router(np.zeros((dim, 1), np.float32), np.zeros(1, np.float32), np.zeros((1, 1), np.float32), np.zeros(1, np.float32))
    graph = np.concatenate([_block_knn(x, s, graph_k) for s in range(0, len(x), GRAPH_BLOCK)])
    labels = balanced_parts(x, graph, parts, seed)
    return _train(x, labels, parts, hidden, epochs, seed)


def _block_knn(x: np.ndarray, start: int, k: int) -> np.ndarray:
    s = -(x[start : start + GRAPH_BLOCK] @ x.T)
    s[np.arange(len(s)), np.arange(start, start + len(s))] = 2
    k = min(k, len(x) - 1)
    return np.argpartition(s, k - 1, axis=1)[:, :k].copy()


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, seed: int, *, slack: float = 0.1, rounds: int = 12) -> np.ndarray:
    """Labels of equal-sized parts that cut few edges of the neighbour graph."""
    labels = np.zeros(len(x), np.int64)
    stack = [(np.arange(len(x)), 0, parts)]
    rng = np.random.default_rng(seed)
    while stack:
        rows, first, n = stack.pop()
        if n == 1:
            labels[rows] = first
            continue
        centred = x[rows] - x[rows].mean(axis=0)
        axis = rng.standard_normal(x.shape[1]).astype(np.float32)
        for _ in range(8):  # power iteration: the direction of most spread
            axis = centred.T @ (centred @ axis)
            axis /= np.linalg.norm(axis) + 1e-12
        cut = len(rows) * (n // 2) // n
        order = np.argsort(centred @ axis, kind="stable")
        stack += [(rows[order[:cut]], first, n // 2), (rows[order[cut:]], first + n // 2, n - n // 2)]
    limit = int(np.ceil(len(x) / parts * (1 + slack)))
    size = np.bincount(labels, minlength=parts)
    for _ in range(rounds):
        votes = np.zeros((len(x), parts), np.int16)
        np.add.at(votes, (np.repeat(np.arange(len(x)), graph.shape[1]), labels[graph.ravel()]), 1)
        np.add.at(votes, (graph.ravel(), np.repeat(labels, graph.shape[1])), 1)
        best = votes.argmax(axis=1)
        gain = votes[np.arange(len(x)), best] - votes[np.arange(len(x)), labels]
        moved = 0
        for i in np.argsort(-gain, kind="stable"):
            if gain[i] <= 0:
                break
            if size[best[i]] < limit:
                size[labels[i]] -= 1
                size[best[i]] += 1
                labels[i] = best[i]
                moved += 1
        if moved < len(x) // 1000:
            break
    return labels


def _train(x: np.ndarray, y: np.ndarray, parts: int, hidden: int, epochs: int, seed: int) -> Router:
    rng = np.random.default_rng(seed)
    p = [rng.standard_normal((x.shape[1], hidden)).astype(np.float32) * np.sqrt(2 / x.shape[1]), np.zeros(hidden, np.float32), rng.standard_normal((hidden, parts)).astype(np.float32) * np.sqrt(1 / hidden), np.zeros(parts, np.float32)]
    m, v, step = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
    for _ in range(epochs):
        for rows in np.array_split(rng.permutation(len(x)), max(1, len(x) // 256)):
            a = x[rows] + rng.standard_normal((len(rows), x.shape[1])).astype(np.float32) * np.float32(0.02)
            h = np.maximum(a @ p[0] + p[1], 0)
            s = h @ p[2] + p[3]
            s = np.exp(s - s.max(axis=1, keepdims=True))
            s /= s.sum(axis=1, keepdims=True)
            s[np.arange(len(rows)), y[rows]] -= 1
            s /= len(rows)
            back = (s @ p[2].T) * (h > 0)
            grads = [a.T @ back, back.sum(axis=0), h.T @ s, s.sum(axis=0)]
            step += 1
            for i, g in enumerate(grads):  # Adam
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                p[i] -= (0.003 * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return Router(*p)
