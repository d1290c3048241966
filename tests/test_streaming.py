"""Streams over files, drained with availableNow."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidemark.sources.files import read_online
from tidemark.streaming import live


@pytest.fixture
def feed(spark, tmp_path):
    def write(batches, schema):
        folder = tmp_path / "in"
        for i, rows in enumerate(batches):
            spark.createDataFrame(rows, schema).select("*").withColumn("timestamp", F.col("timestamp").cast("timestamp")).coalesce(1).write.mode("append").parquet(str(folder / f"b={i}"))
        fields = spark.read.parquet(str(folder / "b=0")).schema
        return spark.readStream.schema(fields).option("maxFilesPerTrigger", 1).parquet(str(folder / "b=*"))

    return write


def drain(spark, stream, name, mode="append"):
    q = stream.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination(120)
    return spark.table(name).collect()


MESSAGES = "seq int, sender string, destination string, text string, timestamp string"


def test_buckets_and_sessions(spark, feed):
    t = "2026-03-01 10:0{}:{:02d}"
    rows = [(0, "a", "x", "hi", t.format(0, 0)), (1, "a", "y", "yo", t.format(0, 20)), (2, "a", "x", None, t.format(1, 30)), (3, "a", "x", "z", "2026-03-02 10:00:00")]
    stream = feed([rows], MESSAGES)
    got = {(r["bucket"].start.minute, r["n"]) for r in drain(spark, live.bucket_counts(stream, ["sender"]), "buckets", "complete")}
    assert got == {(0, 3), (0, 1)}
    sessions = drain(spark, live.gap_sessions(stream, ["sender"]), "sessions", "complete")
    assert sorted((r["parts"], r["characters"]) for r in sessions) == [(1, 0), (1, 1), (2, 4)]
    assert len(drain(spark, live.not_from_the_future(stream), "past")) <= 4
    static = spark.createDataFrame([("a", 7)], "sender string, known int")
    assert {r["known"] for r in drain(spark, live.with_static(stream, static, ["sender"]), "joined")} == {7}
    assert len(drain(spark, live.sliding_counts(stream, ["sender"], width="10 minutes"), "slides", "complete")) >= 4


def test_sender_state_crosses_batches(spark, feed):
    a = [(0, "a", "x", "t", "2026-03-01 10:00:00"), (1, "a", "x", "t", "2026-03-01 10:01:00"), (5, None, "x", "t", "2026-03-01 10:01:00")]
    b = [(2, "a", "x", "t", "2026-03-01 10:02:00"), (3, "a", "x", "t", "2026-03-01 11:30:00")]
    got = {r["seq"]: r for r in drain(spark, live.sender_features(feed([a, b], MESSAGES)), "state")}
    assert [got[str(i)]["msgs_long"] for i in range(4)] == [0, 1, 2, 0] and got["5"]["sender"] == "<NA>"
    assert got["2"]["velocity_z"] == pytest.approx((2 - 0.5) / 0.5**0.5) and got["3"]["age_days"] == pytest.approx(1.5 / 24)


def test_stream_reassembly(spark, feed):
    schema = "originator string, destination string, concat_ref long, concat_total_parts long, concat_part_num long, text string, timestamp string"
    a = [("o", "d", 1, 2, 2, "World", "2026-03-01 10:00:01"), ("o", "d", 2, 2, 1, "half", "2026-03-01 10:00:00"), ("o", "d", 2, 2, 1, "again", "2026-03-01 10:00:02")]
    b = [("o", "d", 1, 2, 1, "Hello ", "2026-03-01 10:00:05"), ("o", "d", 9, 1, 1, "tick", "2026-03-01 14:00:00")]
    c = [("o", "d", 10, 1, 1, "tock", "2026-03-01 18:00:00")]
    got = {r["concat_ref"]: (r["text"], r["parts"], r["partial"]) for r in drain(spark, live.reassemble(feed([a, b, c], schema)), "whole")}
    assert got[1] == ("Hello World", 2, False) and got[9] == ("tick", 1, False) and got[2] == ("half", 1, True)


def test_snapshot_is_kept(spark, feed, tmp_path):
    a = [(0, "a", "x", "t", "2026-03-01 10:00:00")]
    b = [(1, "a", "x", "t", "2026-03-01 10:01:00"), (2, "b", "x", "t", "2026-03-01 10:02:00")]
    counts = feed([a, b], MESSAGES).groupBy("sender").count()
    q = live.keep_snapshot(counts, str(tmp_path / "snap"), ["sender"], str(tmp_path / "cp"))
    q.processAllAvailable()
    q.stop()
    assert sorted(map(tuple, read_online(spark, str(tmp_path / "snap")).collect())) == [("a", 2), ("b", 1)]


def test_ema_and_part_sessions_cross_batches(spark, feed):
    schema = "entity string, key string, seq int, value double, part int, timestamp string"
    t = "2026-03-01 10:00:{:02d}"
    a = [("e", "k", 0, 1.0, 1, t.format(0)), ("e", "k", 1, None, 2, t.format(5)), (None, None, 9, 1.0, 1, t.format(6))]
    b = [("e", "k", 2, 3.0, 3, t.format(20)), ("e", "k", 3, 5.0, 1, t.format(21)), ("e", "k", 4, 7.0, None, "2026-03-01 10:02:00")]
    got = {r["seq"]: (r["ema"], r["history"]) for r in drain(spark, live.ema_values(feed([a, b], schema), alpha=0.5), "ema")}
    assert {k: (None if v is None or v != v else v, n) for k, (v, n) in got.items()} == {"0": (None, 0), "1": (1.0, 1), "2": (1.0, 1), "3": (2.0, 2), "4": (3.5, 3)}


def test_part_sessions(spark, feed):
    schema = "key string, seq int, part int, timestamp string"
    t = "2026-03-01 10:00:{:02d}"
    a = [("k", 0, 1, t.format(0)), ("k", 1, 2, t.format(5)), (None, 9, 1, t.format(6))]
    b = [("k", 2, 3, t.format(20)), ("k", 3, 1, t.format(21)), ("k", 4, None, "2026-03-01 10:02:00")]
    got = {r["seq"]: r["session"] for r in drain(spark, live.part_sessions(feed([a, b], schema)), "parts")}
    assert got == {"0": 1, "1": 1, "2": 1, "3": 2, "4": 3}
