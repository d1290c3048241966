"""What is known about senders and subscribers as of a moment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.content import entropy
from tidemark.operators.windows import DAY, HOUR, MINUTE


def sender_snapshot(messages: DataFrame, now: int, *, short: int = 5 * MINUTE, long: int = HOUR) -> DataFrame:
    """One row per sender as of ``now`` (microseconds), whether or not anything is in reach.

    ``messages`` has ``sender, destination, text, at``. Counts, different
    destinations and their ratios over the trailing windows (0 <= now - at <=
    width), and the age in days since the first message, never negative. Later
    rows are in no window but make a sender known. Rows without ``at`` count
    for nothing. Null senders and destinations are ``<NA>``. One aggregation;
    distinct counts expand rows by three before the map-side combine.
    """
    since = F.lit(now) - F.col("at")
    near = lambda width: (since >= 0) & (since <= width)
    named = messages.where(F.col("at").isNotNull()).select(F.coalesce("sender", F.lit("<NA>")).alias("sender_id"), F.coalesce("destination", F.lit("<NA>")).alias("d"), "at")
    agg = named.groupBy("sender_id").agg(
        F.count_if(near(short)).alias("msgs_short"), F.count_if(near(long)).alias("msgs_long"), F.count_distinct(F.when(near(short), F.col("d"))).alias("dests_short"), F.count_distinct(F.when(near(long), F.col("d"))).alias("dests_long"), F.min("at").alias("_first"),
    )
    ratio = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)
    age = F.greatest((F.lit(now) - F.col("_first")) / F.lit(float(DAY)), F.lit(0.0))
    return agg.select("sender_id", "msgs_short", "msgs_long", "dests_short", "dests_long", ratio("dests_short", "msgs_short").alias("diversity_short"), ratio("dests_long", "msgs_long").alias("diversity_long"), age.alias("age_days"))


def behind_snapshot(messages: DataFrame, entity: str, value: str, now: int, *, width: int = HOUR) -> DataFrame:
    """Different values behind each entity in the trailing window; null entities are left out, zeros kept."""
    since = F.lit(now) - F.col("at")
    inside = (since >= 0) & (since <= width)
    return messages.where(F.col(entity).isNotNull()).groupBy(entity).agg(F.count_distinct(F.when(inside, F.coalesce(value, F.lit("<NA>")))).alias("distinct_values"))


def top_values(df: DataFrame, entity: str, value: str, order: str, k: int = 20) -> DataFrame:
    """The ``k`` most frequent values of each entity as a JSON map, most frequent first.

    Ties go to the value seen first by ``order``, then the smaller. Counting
    comes first, so the window sorts different values only.
    """
    counts = df.groupBy(entity, F.coalesce(value, F.lit("")).alias("_v")).agg(F.count(F.lit(1)).alias("_n"), F.min(order).alias("_f"))
    rank = F.row_number().over(Window.partitionBy(entity).orderBy(F.desc("_n"), "_f", "_v"))
    best = counts.withColumn("_i", rank).where(F.col("_i") <= k)
    pairs = F.transform(F.array_sort(F.collect_list(F.struct("_i", "_v", "_n"))), lambda x: F.struct(x["_v"], x["_n"]))
    return best.groupBy(entity).agg(F.to_json(F.map_from_entries(pairs)).alias("top_values"), F.sum("_n").alias("top_rows"))


def repeat_ratio(top_json: Column, text: Column, rows: Column) -> Column:
    """Share of a text among a snapshot's rows, by its map of values; 0 for unknown texts, no rows, null or broken maps."""
    counts = F.from_json(top_json, "map<string,bigint>")
    return F.when(rows > 0, F.coalesce(F.try_element_at(counts, text), F.lit(0)) / rows).otherwise(0.0)


def entropy_baseline(messages: DataFrame, now: int, *, alpha: float = 0.1) -> DataFrame:
    """Exponential level and residual spread of each sender's hourly mean text entropy as of ``now``.

    ``messages`` has ``sender, text, at``. Texts without entropy and later rows
    do not count; null senders are ``<NA>``. Hours are folded in order; what one
    fold holds is one value per active hour of a sender.
    """
    hourly = (
        messages.where(F.col("at") <= now)
        .select(F.coalesce("sender", F.lit("<NA>")).alias("sender_id"), F.floor(F.col("at") / HOUR).alias("hour"), entropy(F.col("text")).alias("h"))
        .where("h IS NOT NULL")
        .groupBy("sender_id", "hour")
        .agg(F.avg("h").alias("h"))
    )
    steps = F.array_sort(F.collect_list(F.struct("hour", "h")))
    start = F.struct(F.lit(None).cast("double").alias("level"), F.lit(0.0).alias("spread"))
    fold = lambda a, x: F.when(a["level"].isNull(), F.struct(x["h"].alias("level"), F.lit(0.0).alias("spread"))).otherwise(
        F.struct((alpha * x["h"] + (1 - alpha) * a["level"]).alias("level"), (alpha * F.abs(x["h"] - a["level"]) + (1 - alpha) * a["spread"]).alias("spread"))
    )
    return hourly.groupBy("sender_id").agg(F.aggregate(steps, start, fold).alias("_s"), F.count(F.lit(1)).alias("hours")).select("sender_id", F.col("_s.level").alias("entropy_level"), F.col("_s.spread").alias("entropy_spread"), "hours")


def seasonal_baseline(hourly: DataFrame, entity: str, value: str, *, alpha: float = 0.1, beta: float = 0.05, gamma: float = 0.1, season: int = 24) -> DataFrame:
    """Additive level, trend and season of each entity's hourly values, folded in order of ``hour``; nulls are skipped."""
    kind = f"struct<level:double,trend:double,spread:double,season:array<double>>"  # noqa: F541
    rows = F.array_sort(F.collect_list(F.struct(F.col("hour").cast("long").alias("hour"), F.col(value).cast("double").alias("v"))))
    start = F.lit(None).cast(kind)

    def step(a: Column, x: Column) -> Column:
        i = F.pmod(x["hour"], F.lit(season)).cast("int")
        s = F.get(a["season"], i)
        level = alpha * (x["v"] - s) + (1 - alpha) * (a["level"] + a["trend"])
        new = F.transform(a["season"], lambda v, j: F.when(j == i, gamma * (x["v"] - level) + (1 - gamma) * s).otherwise(v))
        first = F.struct(x["v"].alias("level"), F.lit(0.0).alias("trend"), F.lit(0.0).alias("spread"), F.array_repeat(F.lit(0.0), season).alias("season"))
        later = F.struct(level.alias("level"), (beta * (level - a["level"]) + (1 - beta) * a["trend"]).alias("trend"), (alpha * F.abs(x["v"] - (a["level"] + a["trend"] + s)) + (1 - alpha) * a["spread"]).alias("spread"), new.alias("season"))
        return F.when(a.isNull(), first.cast(kind)).otherwise(later.cast(kind))

    folded = hourly.where(F.col(value).isNotNull()).groupBy(entity).agg(F.aggregate(rows, start, step).alias("_s"))
    return folded.select(entity, "_s.level", "_s.trend", "_s.spread", "_s.season")
