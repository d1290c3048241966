"""Queries p2 and p5: the general training-data operators on the project's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.numbers import plain_number
from tidemark.operators.entity_features import MAX_TYPES, entity_features
from tidemark.operators.trailing import trailing_totals
from tidemark.plans.registry import Registry
from tidemark.runtime import broadcast_if_small
from tidemark.sources.tables import messages, table

REGISTRY = Registry()
AS_OF = "2026-06-29T00:00:00"

SQL_PLAIN = """CASE WHEN d = '' THEN NULL WHEN length(d) > 8 AND d LIKE '00%' THEN substr(d, 3) ELSE d END"""
SQL_MESSAGES = """m AS (SELECT DISTINCT record_id, sender_id, "timestamp" AS ts, regexp_replace(destination, '[^0-9]', '', 'g') AS d FROM canonical_row WHERE record_id IS NOT NULL)"""


@REGISTRY.add(
    "p2_trailing_totals",
    f"""
WITH {SQL_MESSAGES},
e AS (SELECT sender_id AS entity, CAST(ts AS DATE) AS day, {SQL_PLAIN} AS item FROM m WHERE sender_id IS NOT NULL AND ts IS NOT NULL),
spine AS (SELECT entity, CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day FROM e GROUP BY entity),
t AS (SELECT s.entity, s.day,
  count(e.day) FILTER (e.day > s.day - 7) AS events_7, count(DISTINCT e.item) FILTER (e.day > s.day - 7) AS items_7,
  count(e.day) AS events_30, count(DISTINCT e.item) AS items_30
  FROM spine s LEFT JOIN e ON e.entity = s.entity AND e.day <= s.day AND e.day > s.day - 30 GROUP BY s.entity, s.day)
SELECT entity AS sender_id, day, events_7 AS messages_7d, items_7 AS destinations_7d, events_30 AS messages_30d, items_30 AS destinations_30d,
  events_7 / 7.0::DOUBLE AS avg_messages_7d, items_7 / 7.0::DOUBLE AS avg_destinations_7d, events_30 / 30.0::DOUBLE AS avg_messages_30d, items_30 / 30.0::DOUBLE AS avg_destinations_30d
FROM t""",
)
def p2_trailing_totals(spark: SparkSession, base: str) -> DataFrame:
    """Messages and different destinations of each sender over the last 7 and 30 days, daily."""
    m = messages(spark, base, "sender_id", "timestamp", "destination")
    events = m.select(F.col("sender_id").alias("entity"), F.col("timestamp").cast("date").alias("day"), plain_number(F.col("destination")).alias("item"))
    names = {"entity": "sender_id"}
    for p in (7, 30):
        names |= {f"events_{p}": f"messages_{p}d", f"items_{p}": f"destinations_{p}d", f"avg_events_{p}": f"avg_messages_{p}d", f"avg_items_{p}": f"avg_destinations_{p}d"}
    return trailing_totals(events).withColumnsRenamed(names)


SQL_FEATURES = f"""
WITH {SQL_MESSAGES},
e AS (SELECT sender_id, ts, {SQL_PLAIN} AS item FROM m WHERE sender_id IS NOT NULL),
k AS (SELECT e.*, n.range_code AS kind FROM e LEFT JOIN number_range n ON n.prefix = substr(e.item, 1, 6)),
f AS (SELECT sender_id, kind, count(*) AS n, date_diff('microseconds', max(ts), TIMESTAMP '2026-06-29 00:00:00') / 86400000000.0::DOUBLE AS days, count(DISTINCT item) AS items FROM k GROUP BY sender_id, kind)
"""


def _sender_features(spark: SparkSession, base: str) -> tuple[DataFrame, list[str]]:
    ranges = table(spark, base, "number_range").select("prefix", "range_code")
    types = sorted(r[0] for r in ranges.select("range_code").distinct().limit(MAX_TYPES + 1).collect() if r[0] is not None)
    m = messages(spark, base, "sender_id", "timestamp", "destination").withColumn("item", plain_number(F.col("destination")))
    known = m.join(broadcast_if_small(ranges), F.substring("item", 1, 6) == F.col("prefix"), "left")
    return entity_features(known.select(F.col("sender_id").alias("entity"), F.col("range_code").alias("kind"), F.col("timestamp").alias("at"), "item"), types, AS_OF), types


@REGISTRY.add("p5_sender_features")
def p5_sender_features(spark: SparkSession, base: str) -> DataFrame:
    """One row per sender: messages, recency and different destinations of each range code, as columns."""
    return _sender_features(spark, base)[0].withColumnRenamed("entity", "sender_id")


@REGISTRY.add(
    "p5_feature_values",
    SQL_FEATURES + "SELECT sender_id, kind AS range_code, n AS messages, days AS days_since_last, items AS destinations FROM f WHERE kind IS NOT NULL",
)
def p5_feature_values(spark: SparkSession, base: str) -> DataFrame:
    """The wide feature table read back as its non-zero cells, which SQL can state compactly."""
    wide, types = _sender_features(spark, base)
    cells = F.array(*[F.struct(F.lit(t).alias("range_code"), F.col(f"`n_{t}`").alias("messages"), F.col(f"`days_{t}`").alias("days_since_last"), F.col(f"`items_{t}`").alias("destinations")) for t in types])
    return wide.select(F.col("entity").alias("sender_id"), F.explode(cells).alias("c")).where("c.messages > 0").select("sender_id", "c.range_code", "c.messages", "c.days_since_last", "c.destinations")
