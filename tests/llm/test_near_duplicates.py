from __future__ import annotations

import random
import re

import numpy as np
import pytest

from tidemark.llm import near_duplicates as nd
from tidemark.llm.near_duplicates import class_links, expand_copies, near_duplicates


def words(text):
    return frozenset(w for w in re.findall("[a-z0-9]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or "")) if len(w) >= 3)


def brute(rows, limit=0.75, least=12):
    sets = sorted({(k, words(t)) for k, t in rows if k is not None and len(words(t)) >= least}, key=lambda x: x[0])
    return {(a, b) for i, (a, x) in enumerate(sets) for b, y in sets[i + 1 :] if len(x & y) >= limit * len(x | y)}


def make(rng, n, vocabulary, sizes):
    texts = []
    for i in range(n):
        if texts and rng.random() < 0.6:
            ws = list(dict.fromkeys(rng.choice(texts)))
            for _ in range(rng.randrange(0, max(2, len(ws) // 6))):
                at = rng.randrange(len(ws))
                ws[at : at + rng.randrange(2)] = rng.choice([[], [f"new{rng.randrange(10**6)}"], [rng.choice(vocabulary)]])
            rng.shuffle(ws)
        else:
            ws = rng.sample(vocabulary, rng.choice(sizes))
        texts.append(ws)
    return [(f"r{i:04d}", ", ".join(w.title() for w in ws)) for i, ws in enumerate(texts)]


@pytest.mark.parametrize("seed,sizes,vocabulary", [(1, range(12, 40), 2000), (2, range(12, 18), 60), (3, [38, 39, 40, 41, 60, 79, 80, 120], 3000), (4, [400, 900], 5000)])
def test_finds_every_link(spark, seed, sizes, vocabulary):
    rng = random.Random(seed)
    rows = make(rng, 60 if max(sizes) > 300 else 250, [f"word{i}" for i in range(vocabulary)], list(sizes))
    df = spark.createDataFrame([(k, t, "clash", 1) for k, t in rows], "record_id string, text string, ws string, n int")
    members, links = near_duplicates(df)
    got = {(r[0], r[1]) for r in expand_copies(members, links, "record_id").collect()}
    want = brute(rows)
    assert got == want and len(want) > 5


def phrases(rng, n):
    common = [f"phrase{i}" for i in range(9)]
    return [(f"r{i:03d}", " ".join(common + [f"slot{rng.randrange(12)}x{j}" for j in range(6)])) for i in range(n)]


@pytest.mark.parametrize("pairs,splits", [(3, 4), (3, 1), (0, 2)])
def test_hot_entries_are_split_without_loss(spark, monkeypatch, pairs, splits):
    monkeypatch.setattr(nd, "HOT_PAIRS", pairs)
    monkeypatch.setattr(nd, "MOST_SPLITS", splits)
    monkeypatch.setattr(nd, "BLOCK_SETS", 7)
    monkeypatch.setattr(nd, "PART_ENTRIES", 500)
    rows = phrases(random.Random(9), 150) + [(f"copy{i}", " ".join(f"same{j}" for j in range(13))) for i in range(20)]
    members, links = near_duplicates(spark.createDataFrame(rows, "record_id string, text string"))
    got = [(r[0], r[1]) for r in expand_copies(members, links, "record_id").collect()]
    assert len(got) == len(set(got)) and set(got) == brute(rows)


def test_work_stays_in_proportion(monkeypatch):
    """Entries a set, those split included, and hot keys' pairs do not grow with the number of sets."""
    from fractions import Fraction

    import pyarrow as pa

    limit, none = Fraction("0.75"), np.zeros(0, np.uint64)

    def figures(n):
        rng = np.random.default_rng(3)
        rare = rng.integers(0, 1 << 62, (n, 16))
        shared = rng.integers(0, 400, (n, 8)) + np.arange(8) * 1000  # phrases that one in 400 sets share
        shared[: n // 3] = np.arange(8)  # and one that a third share
        ws = pa.array(list(np.concatenate([rare, shared], axis=1)), pa.list_(pa.int64()))
        order = nd.rarity(ws[:2000])
        common = nd.common_keys(nd.read_sets(ws[:2000], order), limit, 1, n / 2000, 40_000 * n // 20_000)
        b = nd.read_sets(ws, order)
        keys, times = np.unique(np.concatenate([k for k, _, _ in nd.table_entries(b, limit, 1, nd.Splits(common, none, 0))]), return_counts=True)
        return times.sum() / n, times.max() / n

    (few, top_few), (many, top_many) = figures(2_000), figures(20_000)
    assert many < 1.2 * few and max(top_few, top_many) < 0.2


def test_nulls_copies_and_short_texts(spark):
    long = " ".join(f"word{i}" for i in range(13))
    rows = [("a", long), ("a", long), ("b", long.upper()), ("c", long.replace("word0", "other")), (None, long), ("d", None), ("e", ""), ("f", "too short"), ("g", "ß é 中文")]
    members, links = near_duplicates(spark.createDataFrame(rows, "record_id string, text string"))
    assert {(r[0], r[1]) for r in expand_copies(members, links, "record_id").collect()} == {("a", "b"), ("a", "c"), ("b", "c")}
    got = {r["record_id"]: (r["copies"], r["links"]) for r in class_links(members, links, "record_id").collect()}
    assert got == {"a": (2, 1), "b": (2, 1), "c": (1, 1)}


def test_empty(spark):
    members, links = near_duplicates(spark.createDataFrame([], "record_id string, text string"))
    assert members.count() == 0 and links.count() == 0


def test_most_apart_is_the_bound():
    from fractions import Fraction

    limit = Fraction("0.75")
    for n in range(12, 80):
        want = max(n + b - 2 * -(-3 * (n + b) // 7) for b in range(-(-3 * n // 4), 4 * n // 3 + 1))
        assert nd.most_apart(np.array([n]), limit)[0] >= want
