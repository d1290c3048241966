"""Text vectors without a model file, and an approximate index for them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import BucketedRandomProjectionLSH
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def encode_distinct(df: DataFrame, text: str = "text", *, dim: int = 384, out: str = "vector") -> DataFrame:
    """``df`` with a unit vector per row; each different text is encoded once and joined back.

    Signed feature hashing of character 3- to 5-grams, in place of a pluggable
    encoder. Null and empty texts get the zero vector.
    """
    distinct = df.where(F.col(text).isNotNull() & (F.col(text) != "")).select(F.col(text).alias("_t")).distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 500):  # a few MB of temporary numbers at a time
                t = b.column(0).slice(at, 500)
                v = hash_vectors(t.to_pylist(), dim)
                offsets = pa.array(np.arange(len(v) + 1, dtype=np.int32) * dim)
                yield pa.RecordBatch.from_arrays([t, pa.ListArray.from_arrays(offsets, pa.array(v.ravel()))], ["_t", out])

    encoded = distinct.mapInArrow(run, f"_t string, {out} array<float>")
    zero = F.array_repeat(F.lit(0.0).cast("float"), dim)
    return df.join(encoded, F.col(text) == F.col("_t"), "left").withColumn(out, F.coalesce(out, zero)).drop("_t")


def hash_vectors(texts: list[str], dim: int) -> np.ndarray:
    """One row per text: each 3- to 5-gram's xxHash64 gives its place and, by its first bit, its sign."""
    raw = [f" {t.lower()} ".encode() for t in texts]
    data = np.frombuffer(b"".join(raw) + bytes(8), np.uint8)
    starts = np.flatnonzero((data[:-8] & 0xC0) != 0x80)  # of characters
    stops = np.cumsum([len(r) for r in raw])
    row = np.searchsorted(stops, starts, side="right")
    last = np.searchsorted(starts, stops)[row] if len(raw) else row  # where the text's characters end
    starts = np.append(starts, len(data) - 8)
    at = np.concatenate([np.flatnonzero(np.arange(len(row)) + n <= last) for n in (3, 4, 5)])
    size = np.repeat((3, 4, 5), [(np.arange(len(row)) + n <= last).sum() for n in (3, 4, 5)])
    h = _xxh64(data, starts[at], starts[at + size] - starts[at])
    sign = np.where(h >> np.uint64(63), 1.0, -1.0)
    v = np.bincount(row[at] * dim + (h % np.uint64(dim)).astype(np.int64), sign, len(raw) * dim).reshape(len(raw), dim)
    norm = np.sqrt((v * v).sum(axis=1, keepdims=True))
    return np.divide(v, norm, out=np.zeros(v.shape), where=norm > 0).astype(np.float32)


def _xxh64(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """xxHash64 (seed 0) of many pieces of fewer than 32 bytes; ``data`` has 8 bytes more than the pieces."""
    p1, p2, p3, p4, p5 = (np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
    turn = lambda v, n: (v << np.uint64(n)) | (v >> np.uint64(64 - n))
    byte = data.astype(np.uint64)
    four = byte[:-3] | byte[1:-2] << np.uint64(8) | byte[2:-1] << np.uint64(16) | byte[3:] << np.uint64(24)
    eight = four[:-4] | four[4:] << np.uint64(32)
    out = np.empty(len(start), np.uint64)
    for n in np.unique(length):
        mine = np.flatnonzero(length == n)
        at = start[mine]
        h = np.full(len(mine), p5 + np.uint64(n))
        left = int(n)
        while left >= 8:
            h = turn(h ^ turn(eight[at] * p2, 31) * p1, 27) * p1 + p4
            at, left = at + 8, left - 8
        if left >= 4:
            h = turn(h ^ four[at] * p1, 23) * p2 + p3
            at, left = at + 4, left - 4
        for i in range(left):
            h = turn(h ^ byte[at + i] * p5, 11) * p1
        h = (h ^ h >> np.uint64(33)) * p2
        h = (h ^ h >> np.uint64(29)) * p3
        out[mine] = h ^ h >> np.uint64(32)
    return out


def approximate_pairs(df: DataFrame, threshold: float, *, key: str = "key", vector: str = "vector", buckets: float = 0.5, tables: int = 8, seed: int = 1) -> DataFrame:
    """``a, b, similarity`` of unit vectors by random projections, then checked exactly; finds most pairs, not all.

    On unit vectors the distance falls as the inner product rises (d^2 = 2 - 2s),
    so the threshold carries over.
    """
    rows = df.select(F.col(key).alias("k"), F.col(vector).cast("array<double>").alias("v")).withColumn("x", array_to_vector("v"))
    model = BucketedRandomProjectionLSH(inputCol="x", outputCol="h", bucketLength=buckets, numHashTables=tables, seed=seed).fit(rows)
    near = model.approxSimilarityJoin(rows, rows, (2 - 2 * threshold) ** 0.5 + 1e-9, "d")
    pairs = near.where(F.col("datasetA.k") < F.col("datasetB.k"))
    return pairs.select(F.col("datasetA.k").alias("a"), F.col("datasetB.k").alias("b"), (1 - F.col("d") * F.col("d") / 2).alias("similarity")).where(F.col("similarity") >= threshold)
