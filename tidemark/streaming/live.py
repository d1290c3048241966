"""The same features over streams: watermarked buckets, sessions, and per-sender state."""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidemark.sources.files import upsert_online


def not_from_the_future(stream: DataFrame, at: str = "timestamp", slack: str = "5 minutes") -> DataFrame:
    """Rows whose time is at most ``slack`` ahead of the clock; null times are left out."""
    return stream.where(F.col(at) <= F.current_timestamp() + F.expr(f"INTERVAL {slack}"))


def bucket_counts(stream: DataFrame, keys: list[str], *, at: str = "timestamp", width: str = "5 minutes", late: str = "1 hour") -> DataFrame:
    """Messages and (approximately) different destinations by key and tumbling window; rows later than ``late`` are dropped by the watermark."""
    return stream.withWatermark(at, late).groupBy(*keys, F.window(at, width).alias("bucket")).agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct("destination").alias("destinations"))


def sliding_counts(stream: DataFrame, keys: list[str], *, at: str = "timestamp", width: str = "1 hour", step: str = "5 minutes", late: str = "1 hour") -> DataFrame:
    """Messages by key and sliding window."""
    return stream.withWatermark(at, late).groupBy(*keys, F.window(at, width, step).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def gap_sessions(stream: DataFrame, keys: list[str], *, at: str = "timestamp", gap: str = "30 seconds", late: str = "10 minutes") -> DataFrame:
    """Parts and text lengths of each key's sessions, broken by silence."""
    return stream.withWatermark(at, late).groupBy(*keys, F.session_window(at, gap).alias("session")).agg(F.count(F.lit(1)).alias("parts"), F.sum(F.char_length(F.coalesce("text", F.lit("")))).alias("characters"))


def with_static(stream: DataFrame, static: DataFrame, keys: list[str]) -> DataFrame:
    """Requests of a stream with what a static table knows of their key; unknown keys give nulls."""
    return stream.join(static, keys, "left")


FEATURES = "seq string, sender string, at long, msgs_short long, msgs_long long, velocity_z double, age_days double"
STATE = "times array<long>, n long, total double, squares double, first long"


def sender_features(stream: DataFrame, *, late: str = "10 minutes", short: int = 300_000_000, long: int = 3_600_000_000) -> DataFrame:
    """Counts, z-score and age of the sender just before each message, kept as state per sender.

    ``stream`` has ``seq, sender`` and ``timestamp``. The state is the times of
    the last hour, exact sums for the z-score, and the first time seen. Rows of
    a micro-batch are taken in order of time and ``seq``; a row that comes after
    later ones were answered sees those no later than itself only.
    """
    keyed = stream.withWatermark("timestamp", late).where("timestamp IS NOT NULL").select(F.col("seq").cast("string").alias("seq"), "timestamp", F.coalesce("sender", F.lit("<NA>")).alias("sender"), F.unix_micros(F.col("timestamp").cast("timestamp")).alias("at"))

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        times, n, total, squares, first = state.get if state.exists else ([], 0, 0.0, 0.0, None)
        times = list(times)
        rows = pd.concat(list(batches)).sort_values(["at", "seq"])
        out = []
        for seq, at in zip(rows["seq"], rows["at"]):
            first = at if first is None else min(first, at)
            upto = bisect_right(times, at)
            in_long, in_short = upto - bisect_left(times, at - long), upto - bisect_left(times, at - short)
            z = None
            if n >= 2:
                deviation = max((squares - total * total / n) / (n - 1), 0.0) ** 0.5
                z = (in_short - total / n) / deviation if deviation > 1e-9 else None
            out.append((seq, key[0], at, in_short, in_long, z, (at - first) / 86_400_000_000))
            n, total, squares = n + 1, total + in_short, squares + in_short * in_short
            insort(times, at)
            del times[: bisect_left(times, times[-1] - long)]
        state.update((times, n, total, squares, first))
        yield pd.DataFrame(out, columns=["seq", "sender", "at", "msgs_short", "msgs_long", "velocity_z", "age_days"])

    return keyed.groupBy("sender").applyInPandasWithState(step, FEATURES, STATE, "append", GroupStateTimeout.NoTimeout)


MESSAGE = "originator string, destination string, concat_ref long, text string, parts long, partial boolean"


def reassemble(stream: DataFrame, *, late: str = "10 minutes", patience_ms: int = 600_000) -> DataFrame:
    """Logical messages from a stream of parts: whole ones at once, incomplete ones when the watermark passes their patience.

    ``stream`` has ``originator, destination, concat_ref, concat_total_parts,
    concat_part_num, text, timestamp``. A repeated part keeps its first text.
    """
    parts = stream.withWatermark("timestamp", late).where("concat_ref IS NOT NULL AND timestamp IS NOT NULL")

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        numbers, texts = (list(v) for v in state.get) if state.exists else ([], [])
        done = state.hasTimedOut
        if not done:
            rows = pd.concat(list(batches)).sort_values("timestamp")
            for number, text in zip(rows["concat_part_num"], rows["text"]):
                if number not in numbers:
                    numbers.append(int(number))
                    texts.append(text or "")
        whole = sorted(numbers) == list(range(1, int(key[3]) + 1))
        if done or whole:
            ordered = "".join(t for _, t in sorted(zip(numbers, texts)))
            state.remove()
            yield pd.DataFrame([(key[0], key[1], key[2], ordered, len(numbers), not whole)], columns=["originator", "destination", "concat_ref", "text", "parts", "partial"])
        else:
            state.update((numbers, texts))
            latest = int(pd.to_datetime(rows["timestamp"]).max().timestamp() * 1000)
            state.setTimeoutTimestamp(max(latest + patience_ms, state.getCurrentWatermarkMs() + 1))

    return parts.groupBy("originator", "destination", "concat_ref", "concat_total_parts").applyInPandasWithState(step, MESSAGE, "numbers array<long>, texts array<string>", "append", GroupStateTimeout.EventTimeTimeout)


def ema_values(stream: DataFrame, *, alpha: float = 0.1, late: str = "10 minutes") -> DataFrame:
    """Each row's exponential average of its entity's earlier values, and how many there were, kept as state per entity.

    ``stream`` has ``entity, seq, timestamp`` and ``value``; the state is two
    numbers. Null values neither change nor weigh the average; null entities and
    times are left out. Rows of a micro-batch are taken in order of time and ``seq``.
    """
    known = stream.withWatermark("timestamp", late).where("entity IS NOT NULL AND timestamp IS NOT NULL").select("entity", F.col("seq").cast("string").alias("seq"), "timestamp", F.col("value").cast("double").alias("value"))

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        level, n = state.get if state.exists else (None, 0)
        out = []
        rows = pd.concat(list(batches)).sort_values(["timestamp", "seq"])
        for seq, value in zip(rows["seq"], rows["value"]):
            out.append((key[0], seq, level, n))
            if not pd.isna(value):
                level, n = value if level is None else alpha * value + (1 - alpha) * level, n + 1
        state.update((level, n))
        yield pd.DataFrame(out, columns=["entity", "seq", "ema", "history"]).astype({"ema": "float64"})

    return known.groupBy("entity").applyInPandasWithState(step, "entity string, seq string, ema double, history long", "level double, n long", "append", GroupStateTimeout.NoTimeout)


def part_sessions(stream: DataFrame, *, gap_s: int = 30, late: str = "10 minutes", forget_s: int = 86_400) -> DataFrame:
    """Numbers the parts of each key by session, which a gap or a part number that does not rise ends.

    ``stream`` has ``key, seq, part, timestamp``. The state is the last time and
    part, and the session's number; it goes when the watermark is ``forget_s``
    past the last row, after which numbers start anew. Null keys and times are
    left out; a null part starts no session by itself.
    """
    known = stream.withWatermark("timestamp", late).where("key IS NOT NULL AND timestamp IS NOT NULL").select("key", F.col("seq").cast("string").alias("seq"), F.col("part").cast("double").alias("part"), "timestamp", F.unix_micros(F.col("timestamp").cast("timestamp")).alias("at"))

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        last, before, session = state.get if state.exists else (None, None, 0)
        out = []
        rows = pd.concat(list(batches)).sort_values(["at", "seq"])
        for seq, part, at in zip(rows["seq"], rows["part"], rows["at"]):
            part = None if pd.isna(part) else float(part)
            fell = part is not None and before is not None and part <= before
            session += last is None or fell or at - last > gap_s * 1_000_000
            last, before = at, part
            out.append((key[0], seq, session))
        state.update((last, before, session))
        state.setTimeoutTimestamp(max(last // 1000 + forget_s * 1000, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame(out, columns=["key", "seq", "session"])

    return known.groupBy("key").applyInPandasWithState(step, "key string, seq string, session long", "last long, part double, session long", "append", GroupStateTimeout.EventTimeTimeout)


def keep_snapshot(stream: DataFrame, path: str, keys: list[str], checkpoint: str, order: list[str] | None = None):  # noqa: ANN201
    """Start a query that merges each micro-batch into a keyed snapshot store; of a key's rows the largest by ``order`` stays."""
    return stream.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(lambda batch, _: upsert_online(batch.sparkSession, path, batch, keys, order)).start()
