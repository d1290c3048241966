from __future__ import annotations

from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm.nearest_time import nearest_in_time


def brute_nearest(left, right, tolerance):
    out = {}
    for i, e, t in left:
        best = None
        if e is not None and t is not None:
            for j, f, u in right:
                if f == e and u is not None and j is not None and abs(t - u) <= tolerance:
                    best = min(best or (tolerance + 1, 0, ""), (abs(t - u), u, j))
        out[i] = (best[2], best[0]) if best else (None, None)
    return out


@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(-60, 60))), max_size=12), st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(-60, 60))), max_size=12))
@settings(max_examples=8, deadline=None)
def test_nearest_in_time(spark, left, right):
    left = [(f"l{k}", *x) for k, x in enumerate(left)]
    right = [(f"r{k}", *x) for k, x in enumerate(right)]
    schema = "id string, entity string, at long, gap string, _b int"
    a = spark.createDataFrame([(*x, "clash", 7) for x in left] * 2, schema)
    b = spark.createDataFrame([(*x, "clash", 7) for x in right], schema)
    got = {r["id"]: (r["match_id"], r["gap"]) for r in nearest_in_time(a, b, 20).collect()}
    assert got == brute_nearest(left, right, 20)


def test_nearest_in_time_ties_and_edges(spark):
    schema = "id string, entity string, at long"
    left = spark.createDataFrame([("l", "e", 1000), ("far", "e", 9000), ("edge", "f", 0)], schema)
    right = spark.createDataFrame([("late", "e", 1010), ("early", "e", 990), ("early2", "e", 990), ("rim", "f", 5000), ("out", "f", -5001)], schema)
    got = {r["id"]: (r["match_id"], r["gap"]) for r in nearest_in_time(left, right, 5000).collect()}
    assert got == {"l": ("early", 10), "far": (None, None), "edge": ("rim", 5000)}


def test_nearest_in_time_empty(spark):
    empty = spark.createDataFrame([], "id string, entity string, at long")
    assert nearest_in_time(empty, empty, 10).count() == 0


def test_placeholders_match_nothing_and_are_kept(spark):
    schema = "id string, entity string, at long"
    left = spark.createDataFrame([(f"n{i}", None, i) for i in range(50)] + [("t", "e", None), (None, "e", 5), (None, "e", 5)], schema)
    right = spark.createDataFrame([("r", None, 3), ("s", "e", 7), ("s", "e", 7), (None, "e", 5), ("u", "e", None)], schema)
    got = sorted((r["id"] or "", r["match_id"], r["gap"]) for r in nearest_in_time(left, right, 100).collect())
    assert got == sorted([("", "s", 2), ("t", None, None)] + [(f"n{i}", None, None) for i in range(50)], key=lambda x: x[0])
