"""The general operators against brute force, with nulls, ties, copies, empties and clashing columns."""

from __future__ import annotations

import datetime as dt
import random
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions.numbers import plain_number, subscriber
from tidemark.operators.entity_features import entity_features
from tidemark.operators.trailing import TwoStackDistinct, TwoStackQueue, trailing_totals

DAY0 = dt.date(2026, 3, 1)


# --- trailing totals ---------------------------------------------------------------------


@given(st.lists(st.tuples(st.integers(0, 3), st.lists(st.integers(0, 5), max_size=4)), max_size=40), st.integers(1, 6))
@settings(max_examples=100, deadline=None)
def test_queues_agree_with_recomputation(steps, width):
    counts, kinds = TwoStackQueue(max, -1), TwoStackDistinct()
    day, log = 0, []
    for gap, items in steps:
        day += gap + 1
        counts.push(day, len(items))
        kinds.push(day, items)
        log.append((day, items))
        counts.evict_before(day - width + 1)
        kinds.evict_before(day - width + 1)
        held = [x for d, x in log if d > day - width]
        assert counts.total() == max(map(len, held))
        assert kinds.total() == len({i for x in held for i in x})


def brute_trailing(rows, periods):
    by = defaultdict(list)
    for e, d, i in rows:
        if e is not None and d is not None:
            by[e].append((d, i))
    out = {}
    for e, xs in by.items():
        day = min(d for d, _ in xs)
        while day <= max(d for d, _ in xs):
            out[e, day] = []
            for p in periods:
                held = [i for d, i in xs if day - dt.timedelta(days=p) < d <= day]
                out[e, day] += [len(held), len({i for i in held if i is not None})]
            day += dt.timedelta(days=1)
    return out


@pytest.mark.parametrize("hot_rows", [None, 2, 400])
def test_trailing_totals(spark, hot_rows):
    rng = random.Random(4)
    rows = [(rng.choice(["a", "b", None]), DAY0 + dt.timedelta(days=rng.choice([0, 0, 3, 4, 11, 50, 51])), rng.choice(["x", "y", "z", None])) for _ in range(300)]
    rows += [("hot", DAY0 + dt.timedelta(days=rng.randrange(90)), f"i{rng.randrange(200)}") for _ in range(3000)]
    rows += [("single", DAY0, "x"), ("single", DAY0, "x"), ("undated", None, "x"), ("", DAY0, "")]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "entity string, day date, item string, part string, n int")
    got = {(r[0], r[1]): list(r[2:6]) for r in trailing_totals(df, hot_rows=hot_rows).collect()}
    assert got == brute_trailing(rows, (7, 30))
    assert ("undated", DAY0) not in got


def test_trailing_totals_empty(spark):
    assert trailing_totals(spark.createDataFrame([], "entity string, day date, item string")).count() == 0


# --- entity features ---------------------------------------------------------------------


def test_entity_features(spark):
    t = dt.datetime(2026, 3, 1, 12)
    rows = [("a", "k1", t, "x"), ("a", "k1", t, "x"), ("a", "k1", None, "y"), ("a", "k2", t, None), ("a", "other", t, "z"), ("a", None, t, "z"), ("b", "k3", None, "x"), (None, "k1", t, "x"), ("", "k1", t + dt.timedelta(days=3), "")]
    df = spark.createDataFrame([(*r, 9) for r in rows], "entity string, kind string, at timestamp_ntz, item string, n int")
    got = {r["entity"]: r.asDict() for r in entity_features(df, ["k1", "k2", "k3"], "2026-03-03T12:00:00").collect()}
    assert set(got) == {"a", "b", ""}
    a = got["a"]
    assert (a["n_total"], a["n_other"], a["n_k1"], a["days_k1"], a["items_k1"]) == (6, 2, 3, 2.0, 2)
    assert (a["n_k2"], a["days_k2"], a["items_k2"], a["n_k3"], a["days_k3"]) == (1, 2.0, 0, 0, None)
    assert (got["b"]["n_k3"], got["b"]["days_k3"], got[""]["days_k1"], got[""]["items_k1"]) == (1, None, -1.0, 1)


def test_entity_features_of_many_entities_and_a_hot_one(spark):
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("e"), F.col("id") % 5000)).alias("entity"), F.concat(F.lit("k"), F.col("id") % 7).alias("kind"), F.lit("2026-03-01").cast("timestamp_ntz").alias("at"), F.col("id").cast("string").alias("item"))
    wide = entity_features(df, [f"k{i}" for i in range(7)], "2026-03-02")
    want = {(r[0], r[1]): r[2] for r in df.groupBy("entity", "kind").count().collect()}
    got = {(r["entity"], f"k{i}"): r[f"n_k{i}"] for r in wide.collect() for i in range(7) if r[f"n_k{i}"]}
    assert got == want


def test_entity_features_bounds(spark):
    df = spark.createDataFrame([], "entity string, kind string, at timestamp_ntz, item string")
    assert entity_features(df, ["k"], "2026-03-02").count() == 0
    with pytest.raises(ValueError, match="distinct"):
        entity_features(df, ["k", "k"], "2026-03-02")


# --- numbers -----------------------------------------------------------------------------


def test_numbers(spark):
    rows = [("+998 01-0", "998010"), ("00998000588960", "998000588960"), ("30018", "30018"), ("00123", "00123"), ("", None), (None, None), ("abc", None)]
    df = spark.createDataFrame(rows, "x string, want string")
    assert [(r[0], r[1]) for r in df.select(plain_number(F.col("x")), "want").collect()] == [(w, w) for _, w in rows]
    rows = [("999700010000019.0", "999700010000019"), (" 999-70-0010000019 ", "999700010000019"), ("999700010000019F", "999700010000019"), ("0" * 15, None), ("123", None), (None, None)]
    df = spark.createDataFrame(rows, "x string, want string")
    assert all(r[0] == r[1] for r in df.select(subscriber(F.col("x")), "want").collect())
