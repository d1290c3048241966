"""Point-in-time windows against a plain restatement, with ties, nulls and truncation."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import windows as w

H, M = w.HOUR, w.MINUTE


def restate(rows):
    rows = sorted((r for r in rows if r[4] is not None), key=lambda r: (r[4], r[0]))
    out, past = {}, {}
    for seq, s, d, t, at in rows:
        s, d, t = s if s is not None else "<NA>", d if d is not None else "<NA>", t or ""
        before = past.setdefault(s, [])
        v, sh, lo = ([b for b in before if at - b[0] <= x] for x in (M, 5 * M, H))
        c5 = [b[3] for b in before]
        z = None
        if len(c5) >= 2:
            mean = sum(c5) / len(c5)
            sd = math.sqrt(sum((x - mean) ** 2 for x in c5) / (len(c5) - 1))
            z = (len(sh) - mean) / sd if sd > 1e-9 else None
        ds, dl = len({b[1] for b in sh}), len({b[1] for b in lo})
        same = sum(b[2] == t for b in lo)
        out[seq] = (len(v), len(sh), len(lo), ds, dl, same / len(lo) if lo else 0.0, ds / len(sh) if sh else 0.0, dl / len(lo) if lo else 0.0, z, (at - (before[0][0] if before else at)) / w.DAY)
        before.append((at, d, t, len(sh)))
    return out


def rows_of(seed, n=500, span=4 * w.DAY):
    rng = random.Random(seed)
    start = 20_000 * w.DAY + 23 * H
    return [(i, rng.choice(["a", "a", "a", "b", None]), rng.choice(["x", "y", "z", None]), rng.choice(["hi", "yo", None, ""]), None if rng.random() < 0.02 else start + rng.choice([rng.randrange(span), rng.randrange(3) * M, w.DAY - H + rng.randrange(60) * M])) for i in range(n)]


def run(spark, rows, hot_rows=w.HOT_ROWS):
    df = spark.createDataFrame([(*r, "clash", 5) for r in rows], "seq int, sender string, destination string, text string, at long, msgs_extra string, _x int")
    cols = ["msgs_very_short", "msgs_short", "msgs_long", "dests_short", "dests_long", "repeat_ratio", "diversity_short", "diversity_long", "velocity_z", "age_days"]
    return {r["seq"]: tuple(r[c] for c in cols) for r in w.sender_window_features(df, hot_rows=hot_rows).collect()}


@pytest.mark.parametrize("seed,hot_rows", [(1, w.HOT_ROWS), (2, w.HOT_ROWS), (1, 60), (2, 0)])
def test_sender_windows(spark, seed, hot_rows):
    rows = rows_of(seed)
    got, want = run(spark, rows, hot_rows), restate(rows)
    assert got.keys() == want.keys()
    for k in want:
        assert got[k][:5] == want[k][:5], k
        for a, b in zip(got[k][5:], want[k][5:]):
            assert (a is None) == (b is None) and (a is None or abs(a - b) < 1e-6), (k, got[k], want[k])


def test_no_look_ahead(spark):
    rows = rows_of(3, 200)
    whole = run(spark, rows)
    order = sorted((r for r in rows if r[4] is not None), key=lambda r: (r[4], r[0]))
    for cut in (20, 90, 170):
        part = run(spark, order[:cut])
        last = order[cut - 1][0]
        assert part[last] == pytest.approx(whole[last], nan_ok=True)


def test_window_edges_and_empty(spark):
    rows = [(0, "a", "x", "t", 0), (1, "a", "y", "t", H), (2, "a", "x", "t", H + 1), (3, "a", "x", "t", H + 1)]
    got = run(spark, rows)
    assert got[1][2] == 1 and got[2][2] == 1 and got[3][2] == 2 and got[3][1] == 2
    assert run(spark, []) == {}


def test_distinct_behind(spark):
    rng = random.Random(6)
    rows = [(i, rng.choice(["i1", "i2", None]), rng.choice(["a", "b", "c", None]), rng.choice([None] + [rng.randrange(5 * H)] * 9)) for i in range(200)]
    df = spark.createDataFrame(rows, "seq int, imsi string, originator string, at long")
    got = {r["seq"]: r["k"] for r in w.distinct_behind(df, "imsi", "originator", out="k").collect()}
    for seq, imsi, _, at in rows:
        want = None
        if imsi is not None and at is not None:
            want = len({o or "<NA>" for s, i, o, t in rows if i == imsi and t is not None and at - H <= t and (t, s) < (at, seq)})
        assert got[seq] == want


def test_rolling_gap_sessions(spark):
    rows = [(0, "k", 1, 0), (1, "k", 2, 10 * w.SECOND), (2, "k", 2, 11 * w.SECOND), (3, "k", 3, w.DAY), (4, "k", 4, w.DAY + 30 * w.SECOND), (5, "m", 1, 5), (6, None, 1, 7), (7, None, 2, 8), (8, "k", None, w.DAY + 31 * w.SECOND)]
    df = spark.createDataFrame(rows, "seq int, key string, part int, at long")
    got = {r["seq"]: r["session"] for r in w.sessions(df, ["key"], "part").collect()}
    assert got == {0: 1, 1: 1, 2: 2, 3: 3, 4: 3, 5: 1, 6: 1, 7: 1, 8: 3}
    gaps = {r["seq"]: r["gap_s"] for r in w.gap_seconds(df, "key").collect()}
    assert gaps[0] is None and gaps[1] == 10.0 and gaps[3] == 86400 - 11 and gaps[7] == 1e-6
    n = {r["seq"]: r["c"] for r in w.rolling_count(df, "key", {"c": 10 * w.SECOND}).collect()}
    assert n[1] == 1 and n[2] == 2 and n[4] == 1


def test_ema(spark):
    rows = [("a", 1, 0, 1.0), ("a", 2, 0, None), ("a", 3, 0, 2.0), ("a", 4, 0, 0.0), ("b", 1, 0, None), ("b", 2, 0, 5.0)]
    df = spark.createDataFrame(rows, "e string, at long, seq int, v double")
    got = {(r["e"], r["at"]): (r["ema"], r["history"]) for r in w.ema_prior(df, "e", "v", alpha=0.5).collect()}
    assert got == {("a", 1): (None, 0), ("a", 2): (1.0, 1), ("a", 3): (1.0, 2), ("a", 4): (1.5, 3), ("b", 1): (None, 0), ("b", 2): (None, 1)}


def test_hot_entity_is_spread(spark):
    df = spark.range(1000).select(F.col("id").alias("seq"), F.lit("hot").alias("sender"), F.lit("d").alias("destination"), F.lit("t").alias("text"), (F.col("id") * H).alias("at"))
    assert w.with_halo(df, "at", H).select("_slab").distinct().count() > 40


def test_a_busy_day_is_spread(spark):
    """One sender with 500,000 rows in a day, in slabs of an hour and no larger than two hours' rows."""
    df = spark.range(500_000).select(F.col("id").alias("seq"), F.lit("a").alias("s"), (F.lit(20_000 * w.DAY) + F.col("id") * (w.DAY // 500_000)).alias("at"))
    slabs = w.with_halo(df, "at", H, entity="s").groupBy("_slab").agg(F.count(F.lit(1)).alias("n"), F.count_if("_own").alias("own")).collect()
    assert len(slabs) == 25 and max(r["n"] for r in slabs) < 42_000 and sum(r["own"] for r in slabs) == 500_000


def test_sender_repeats_as_in_all_features(spark):
    rows = [(i, [None, "a", "b"][i % 3], f"d{i % 4}", [None, "", "x", "y"][i % 4 if i % 5 else 2], None if i % 11 == 0 else 7 * w.MINUTE * (i // 2)) for i in range(300)]
    df = spark.createDataFrame(rows, "seq int, sender string, destination string, text string, at long")
    for hot in (w.HOT_ROWS, 5):
        whole = w.sender_window_features(df, hot_rows=hot).select("seq", "msgs_long", "repeat_ratio")
        part = w.sender_repeats(df, hot_rows=hot)
        assert part.columns == whole.columns and part.count() == whole.count() == sum(r[4] is not None for r in rows)
        assert part.exceptAll(whole).count() == 0 and part.where("repeat_ratio > 0").count() > 0
