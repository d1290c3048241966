"""Totals over trailing calendar periods, silent days included."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.runtime import broadcast_if_small, materialize, shuffle_width


class TwoStackQueue:
    """A sliding window's aggregate under any associative ``combine``; no inverse needed.

    New values go onto the back stack, whose running aggregate is kept. When
    the front stack is empty the back is turned over, each entry bearing the
    aggregate of itself and everything newer. Amortised one combine per value.
    """

    def __init__(self, combine: Callable[[Any, Any], Any], identity: Any) -> None:
        self.combine, self.identity = combine, identity
        self.front: list[tuple[int, Any]] = []
        self.back: list[tuple[int, Any]] = []
        self.back_total = identity

    def push(self, day: int, value: Any) -> None:
        self.back.append((day, value))
        self.back_total = self.combine(self.back_total, value)

    def evict_before(self, day: int) -> None:
        while True:
            if not self.front:
                if not self.back or self.back[0][0] >= day:
                    return
                total = self.identity
                while self.back:
                    d, v = self.back.pop()
                    total = self.combine(v, total)
                    self.front.append((d, total))
                self.back_total = self.identity
            if self.front[-1][0] >= day:
                return
            self.front.pop()

    def total(self) -> Any:
        return self.combine(self.front[-1][1], self.back_total) if self.front else self.back_total


class TwoStackDistinct:
    """The same queue for set union, of which only the size is asked.

    The front stack's aggregates are nested sets, so each is stored as what it
    adds to the next newer one: every element is held once per stack, and each
    push, eviction and query is amortised constant time per element.
    """

    def __init__(self) -> None:
        self.front: list[tuple[int, list]] = []
        self.back: list[tuple[int, list]] = []
        self.front_set: set = set()
        self.back_set: set = set()
        self.both = 0

    def push(self, day: int, values: list) -> None:
        self.back.append((day, values))
        new = [v for v in values if v not in self.back_set]
        self.back_set.update(new)
        if self.front_set:
            self.both += sum(1 for v in set(new) if v in self.front_set)

    def evict_before(self, day: int) -> None:
        while True:
            if not self.front:
                if not self.back or self.back[0][0] >= day:
                    return
                seen: set = set()
                while self.back:
                    d, values = self.back.pop()
                    added = [v for v in dict.fromkeys(values) if v not in seen]
                    seen.update(added)
                    self.front.append((d, added))
                self.front_set, self.back_set, self.both = seen, set(), 0
            if self.front[-1][0] >= day:
                return
            _, gone = self.front.pop()
            self.front_set.difference_update(gone)
            self.both -= sum(1 for v in gone if v in self.back_set)

    def total(self) -> int:
        return len(self.front_set) + len(self.back_set) - self.both


def trailing_totals(events: DataFrame, periods: tuple[int, ...] = (7, 30), *, hot_rows: int | None = None) -> DataFrame:
    """Events and different items of each entity over trailing periods, for every day.

    ``events`` has ``entity``, ``day`` (date) and ``item``; extra columns are
    ignored. For each entity and each day from its first to its last day,
    silent days included, returns ``entity, day`` and per period of ``p`` days
    (the day itself and the ``p-1`` before it) ``events_p``, ``items_p``
    (different non-null items) and the daily averages ``avg_events_p``,
    ``avg_items_p``, always over ``p`` days. Rows with null entity or day
    belong to no series and are left out; a null item counts as an event only.

    Events are first counted per (entity, day, item), map-side before the
    shuffle, and written once. Sorted partitions then stream through two-stack
    queues whose state crosses Arrow batches, so no entity is ever held whole.
    An entity with more than ``hot_rows`` counted rows (default: half a task's
    even share) is split by a hash of the item into parts of about that many, so
    its tasks grow in number with its rows: both totals add up over parts,
    because each item lives in one part only. There are at most twice as many
    such entities as shuffle partitions, hence a bounded broadcast. A null item
    has one counted row a day, whatever its events.
    """
    spark = events.sparkSession
    clean = events.where(F.col("entity").isNotNull() & F.col("day").isNotNull()).select("entity", "day", "item")
    daily = materialize(clean.groupBy("entity", "day", "item").agg(F.count(F.lit(1)).alias("n")), "daily")
    if hot_rows is None:
        hot_rows = max(1000, daily.count() // (2 * shuffle_width(spark)))
    seen = daily.groupBy("entity").agg(F.count(F.lit(1)).alias("rows"), F.max("day").alias("last")).where(F.col("rows") > hot_rows)
    hot = broadcast_if_small(seen.select("entity", "last", F.ceil(F.col("rows") / hot_rows).cast("int").alias("salts")))
    part = F.pmod(F.xxhash64("item"), F.col("salts")).cast("int")
    cold = daily.join(hot.select("entity"), "entity", "left_anti").select("entity", F.lit(0).alias("part"), "day", "item", "n", F.lit(None).cast("date").alias("last"))
    warm = daily.join(hot, "entity").select("entity", part.alias("part"), "day", "item", "n", "last")
    sums = [f"{k}_{p}" for p in periods for k in ("events", "items")]
    schema = f"entity {dict(events.dtypes)['entity']}, day date, " + ", ".join(f"{c} long" for c in sums)

    def stream(df: DataFrame) -> DataFrame:
        ordered = df.repartition("entity", "part").sortWithinPartitions("entity", "part", "day").withColumn("day", F.unix_date("day")).withColumn("last", F.unix_date("last"))
        return ordered.mapInPandas(lambda batches: _windows(batches, periods), schema)

    merged = stream(warm).groupBy("entity", "day").agg(*[F.sum(c).alias(c) for c in sums])
    result = stream(cold).unionByName(merged)
    averages = [(F.col(f"{k}_{p}") / F.lit(float(p))).alias(f"avg_{k}_{p}") for p in periods for k in ("events", "items")]
    return result.select("entity", "day", *sums, *averages)


def _windows(batches: Iterator[pd.DataFrame], periods: tuple[int, ...]) -> Iterator[pd.DataFrame]:
    """Stream one sorted partition; yields runs of constant totals, expanded to days."""
    runs: list[tuple] = []  # entity, first day, days, totals
    held = 0
    key: tuple | None = None
    series: _Series | None = None
    day: int | None = None
    items: list = []
    n = 0

    def flush() -> pd.DataFrame:
        days = np.array([r[2] for r in runs], dtype=np.int64)
        starts = np.repeat(np.array([r[1] for r in runs], dtype=np.int64) - (np.cumsum(days) - days), days)
        out = {"entity": np.repeat(np.array([r[0] for r in runs], dtype=object), days), "day": (starts + np.arange(days.sum())).astype("datetime64[D]").astype("datetime64[s]")}
        totals = np.array([r[3] for r in runs], dtype=np.int64)
        for j, name in enumerate(f"{k}_{p}" for p in periods for k in ("events", "items")):
            out[name] = np.repeat(totals[:, j], days)
        frame = pd.DataFrame(out)
        frame["day"] = frame["day"].dt.date
        return frame

    for batch in batches:
        for entity, part, d, item, count, last in zip(batch["entity"].tolist(), batch["part"].tolist(), batch["day"].tolist(), batch["item"].tolist(), batch["n"].tolist(), batch["last"].tolist()):
            if (entity, part) != key:
                if series is not None:
                    series.add(day, items, n, runs)
                    series.close(runs)
                key, series, day, items, n = (entity, part), _Series(entity, periods, None if last != last or last is None else int(last)), d, [], 0
            elif d != day:
                series.add(day, items, n, runs)
                day, items, n = d, [], 0
            if item is not None:
                items.append(item)
            n += count
        held = sum(r[2] for r in runs)
        if held > 50_000:
            yield flush()
            runs.clear()
    if series is not None:
        series.add(day, items, n, runs)
        series.close(runs)
    if runs:
        yield flush()


class _Series:
    """One entity's (or part's) running windows; days pass in runs between changes."""

    def __init__(self, entity: Any, periods: tuple[int, ...], last: int | None) -> None:
        self.entity, self.periods, self.last = entity, periods, last
        self.counts = [TwoStackQueue(lambda a, b: a + b, 0) for _ in periods]
        self.sets = [TwoStackDistinct() for _ in periods]
        self.at: int | None = None  # the day from which totals are not yet emitted
        self.days: list[int] = []  # active days of the longest period, for the next change

    def add(self, day: int, items: list, n: int, runs: list) -> None:
        if self.at is not None:
            self._pass(day, runs)
        for q, s in zip(self.counts, self.sets):
            q.push(day, n)
            s.push(day, items)
        self.days.append(day)
        self.at = day

    def _pass(self, until: int, runs: list) -> None:
        """Emit the days from ``at`` up to, but without, ``until``."""
        longest = max(self.periods)
        self.days = [d for d in self.days if d + longest > self.at]
        cuts = sorted({d + p for d in self.days for p in self.periods if self.at < d + p < until} | {until})
        for cut in cuts:
            totals = []
            for p, q, s in zip(self.periods, self.counts, self.sets):
                q.evict_before(self.at - p + 1)
                s.evict_before(self.at - p + 1)
                totals += [q.total(), s.total()]
            runs.append((self.entity, self.at, cut - self.at, totals))
            self.at = cut

    def close(self, runs: list) -> None:
        end = self.at if self.last is None else max(self.last, self.at)
        self._pass(end + 1, runs)
