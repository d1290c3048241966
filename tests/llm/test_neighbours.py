from __future__ import annotations

import numpy as np
import pytest

from tidemark.llm.neighbours import balanced_parts, nearest_vectors


def clustered(n, seed=0, dim=16):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((n // 8, dim))
    return centres[rng.integers(0, len(centres), n)] + 0.15 * rng.standard_normal((n, dim))


def brute(x, k):
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    c = u @ u.T
    np.fill_diagonal(c, -2)
    return np.argsort(-c, axis=1, kind="stable")[:, :k]


def test_recall_of_held_out_queries(spark):
    x = clustered(6000)
    df = spark.createDataFrame([(i, [float(v) for v in r], "clash", 1) for i, r in enumerate(x.astype(np.float32))], "index long, vector array<float>, part string, rank int")
    want = brute(x.astype(np.float32).astype(np.float64), 10)
    got = {}
    for r in nearest_vectors(df, part_rows=250, probes=6, sample=4000, queries="index % 50 = 0").collect():
        got.setdefault(r["index"], set()).add(r["neighbour"])
    assert set(got) == set(range(0, 6000, 50)) and all(len(v) == 10 for v in got.values())
    recall = np.mean([len(got[i] & set(want[i])) / 10 for i in got])
    assert recall >= 0.9, recall


def test_blocks_of_a_mass_of_copies_lose_nothing(spark, monkeypatch):
    from tidemark.llm import neighbours

    monkeypatch.setattr(neighbours, "BLOCK_ITEMS", 40)
    monkeypatch.setattr(neighbours, "BLOCK_QUERIES", 70)
    x = np.vstack([np.tile(np.arange(1, 9), (150, 1)), clustered(150, 3, 8)]).astype(np.float32)
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "index long, vector array<float>")
    rows = nearest_vectors(df, k=5).collect()
    for i in (0, 77, 149):
        assert [r["neighbour"] for r in sorted((r for r in rows if r["index"] == i), key=lambda r: r["rank"])] == [j for j in range(6) if j != i][:5]
    want = brute(x.astype(np.float64), 5)
    assert all({r["neighbour"] for r in rows if r["index"] == i} == set(want[i]) for i in range(150, 300))


def test_unusable_vectors_have_no_neighbours(spark):
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [1.0]), (6, [float("nan"), 1.0]), (None, [1.0, 0.0]), (7, [1.0, None]), (8, [0.0, -1e-30]), (9, [float("inf"), 0.0])]
    got = {(r["index"], r["neighbour"]): r["cosine"] for r in nearest_vectors(spark.createDataFrame(rows, "index long, vector array<float>"), min_cosine=-1.0).collect()}
    assert set(got) == {(1, 2), (2, 1), (1, 8), (8, 1), (2, 8), (8, 2)}
    assert got[1, 2] == 1.0 and abs(got[1, 8]) < 1e-12


def test_empty_and_useless(spark):
    assert nearest_vectors(spark.createDataFrame([], "index long, vector array<float>")).count() == 0
    assert nearest_vectors(spark.createDataFrame([(1, [0.0])], "index long, vector array<float>")).count() == 0


def test_parts_are_balanced():
    x = clustered(2000, 1).astype(np.float32)
    graph = brute(x, 10)
    labels = balanced_parts(x, graph, 16, 5)
    sizes = np.bincount(labels, minlength=16)
    assert sizes.max() <= np.ceil(2000 / 16 * 1.1) and (labels[graph] == labels[:, None]).mean() > 0.6


@pytest.mark.parametrize("sample", [4200, 1000])
def test_visits_follow_the_number_of_parts(spark, sample):
    """With 1,000 sampled vectors, 66 parts need two levels."""
    x = clustered(6000, 7).astype(np.float32)
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "index long, vector array<float>")
    want = brute(x.astype(np.float64), 10)
    got = {}
    for r in nearest_vectors(df, part_rows=90, probes=1, sample=sample, queries="index % 10 = 0").collect():
        got.setdefault(r["index"], set()).add(r["neighbour"])
    recall = np.mean([len(got[i] & set(want[i])) / 10 for i in range(0, 6000, 10)])
    assert recall >= 0.9, recall
