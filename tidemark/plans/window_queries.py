"""Queries of point-in-time windows, series and sessions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.numbers import plain_number, subscriber
from tidemark.operators import windows as w
from tidemark.operators.ranking import average_rank
from tidemark.plans.registry import Registry
from tidemark.sources.tables import messages, once_per_key, table

REGISTRY = Registry()

SQL_M = """m AS (SELECT DISTINCT record_id AS seq, coalesce(sender_id, '<NA>') AS s, coalesce(destination, '<NA>') AS d, coalesce(text, '') AS t, imsi, originator,
  epoch_us("timestamp") AS u FROM canonical_row WHERE record_id IS NOT NULL AND "timestamp" IS NOT NULL)"""


def frame(spark: SparkSession, base: str) -> DataFrame:
    m = messages(spark, base, "sender_id", "destination", "text", "timestamp")
    return m.select(F.col("record_id").alias("seq"), F.col("sender_id").alias("sender"), "destination", "text", w.micros(F.col("timestamp")).alias("at"))


def _sql_windows(very_short: int, short: int, long: int) -> str:
    return f"""
WITH {SQL_M},
c AS (SELECT a.seq, any_value(a.s) AS s, any_value(a.u) AS u,
  count(b.seq) FILTER (a.u - b.u <= {very_short}) AS v, count(b.seq) FILTER (a.u - b.u <= {short}) AS h, count(b.seq) AS l,
  count(DISTINCT b.d) FILTER (a.u - b.u <= {short}) AS dh, count(DISTINCT b.d) AS dl, count(b.seq) FILTER (b.t = a.t) AS same
  FROM m a LEFT JOIN m b ON b.s = a.s AND b.u <= a.u AND b.u >= a.u - {long} AND (b.u < a.u OR b.seq < a.seq) GROUP BY a.seq),
z AS (SELECT *, count(*) OVER p AS n, sum(h) OVER p AS sm, sum(h * h) OVER p AS sq, min(u) OVER (PARTITION BY s) AS f FROM c
  WINDOW p AS (PARTITION BY s ORDER BY u, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
e AS (SELECT *, CASE WHEN n >= 2 THEN sqrt(greatest((sq - sm::DOUBLE * sm / n) / (n - 1), 0)) END AS sd FROM z)
SELECT seq AS record_id, v AS msgs_very_short, h AS msgs_short, l AS msgs_long, dh AS dests_short, dl AS dests_long,
  CASE WHEN l > 0 THEN round(same / l, 6) ELSE 0.0 END AS repeat_ratio, CASE WHEN h > 0 THEN round(dh / h, 6) ELSE 0.0 END AS diversity_short, CASE WHEN l > 0 THEN round(dl / l, 6) ELSE 0.0 END AS diversity_long,
  CASE WHEN sd > 1e-9 THEN round((h - sm / n) / sd, 6) END AS velocity_z, round((u - f) / 86400000000.0::DOUBLE, 6) AS age_days
FROM e"""


def _rounded(df: DataFrame) -> DataFrame:
    real = ("repeat_ratio", "diversity_short", "diversity_long", "velocity_z", "age_days")
    counts = ("msgs_very_short", "msgs_short", "msgs_long", "dests_short", "dests_long")
    return df.select(F.col("seq").alias("record_id"), *counts, *[F.round(c, 6).alias(c) for c in real])


@REGISTRY.add("sender_window_features", _sql_windows(w.MINUTE, 5 * w.MINUTE, w.HOUR))
def sender_window_features(spark: SparkSession, base: str) -> DataFrame:
    """Counts, destinations, ratios, z-score and age of the sender just before each message."""
    return _rounded(w.sender_window_features(frame(spark, base)))


@REGISTRY.add("sender_window_features_week", _sql_windows(w.HOUR, w.DAY, 7 * w.DAY))
def sender_window_features_week(spark: SparkSession, base: str) -> DataFrame:
    """The same over an hour, a day and a week."""
    return _rounded(w.sender_window_features(frame(spark, base), very_short=w.HOUR, short=w.DAY, long=7 * w.DAY))


@REGISTRY.add(
    "imsi_distinct_originators",
    f"""
WITH {SQL_M}, k AS (SELECT seq, u, coalesce(originator, '<NA>') AS o, imsi FROM m),
c AS (SELECT a.seq, count(DISTINCT b.o) AS n FROM k a LEFT JOIN k b ON b.imsi = a.imsi AND b.u <= a.u AND b.u >= a.u - {7 * w.DAY} AND (b.u < a.u OR b.seq < a.seq) GROUP BY a.seq)
SELECT k.seq AS record_id, CASE WHEN k.imsi IS NULL THEN NULL ELSE c.n END AS distinct_originators FROM k JOIN c USING (seq)""",
)
def imsi_distinct_originators(spark: SparkSession, base: str) -> DataFrame:
    """Different originators behind the message's IMSI in the 7 days before; null without an IMSI."""
    m = messages(spark, base, "imsi", "originator", "timestamp").where("timestamp IS NOT NULL")
    rows = m.select(F.col("record_id").alias("seq"), "imsi", "originator", w.micros(F.col("timestamp")).alias("at"))
    return w.distinct_behind(rows, "imsi", "originator", width=7 * w.DAY, out="distinct_originators").select(F.col("seq").alias("record_id"), "distinct_originators")


@REGISTRY.add(
    "rolling_count_closed_right",
    f"""
WITH {SQL_M}
SELECT a.seq AS record_id, count(*) FILTER (a.u - b.u < {w.HOUR}) AS last_1h, count(*) FILTER (a.u - b.u < {6 * w.HOUR}) AS last_6h, count(*) AS last_24h
FROM m a JOIN m b ON b.s = a.s AND b.u <= a.u AND b.u > a.u - {w.DAY} AND (b.u < a.u OR b.seq <= a.seq) GROUP BY a.seq""",
)
def rolling_count_closed_right(spark: SparkSession, base: str) -> DataFrame:
    """The sender's messages in (t - W, t], the message itself included."""
    rows = frame(spark, base).withColumn("sender", F.coalesce("sender", F.lit("<NA>")))
    return w.rolling_count(rows, "sender", {"last_1h": w.HOUR, "last_6h": 6 * w.HOUR, "last_24h": w.DAY}).select(F.col("seq").alias("record_id"), "last_1h", "last_6h", "last_24h")


@REGISTRY.add("interarrival_gap", f"WITH {SQL_M} SELECT seq AS record_id, (u - lag(u) OVER (PARTITION BY s ORDER BY u, seq)) / 1000000.0::DOUBLE AS gap_s FROM m")
def interarrival_gap(spark: SparkSession, base: str) -> DataFrame:
    """Seconds since the sender's previous message."""
    rows = frame(spark, base).withColumn("sender", F.coalesce("sender", F.lit("<NA>")))
    return w.gap_seconds(rows, "sender").select(F.col("seq").alias("record_id"), "gap_s")


@REGISTRY.add(
    "gap_session_groups",
    """
WITH p AS (SELECT DISTINCT reference, calling_gt AS a, b_number AS b, coalesce(sarref, -1) AS r, msg_part AS part, time_stamp * 1000 AS u FROM ss7_transaction WHERE message_type IN (2, 3) AND reference IS NOT NULL),
q AS (SELECT *, CASE WHEN lag(u) OVER o IS NULL OR part <= lag(part) OVER o OR u - lag(u) OVER o > 30000000 THEN 1 ELSE 0 END AS n FROM p WINDOW o AS (PARTITION BY a, b, r ORDER BY u, reference))
SELECT reference, sum(n) OVER (PARTITION BY a, b, r ORDER BY u, reference ROWS UNBOUNDED PRECEDING)::BIGINT AS session FROM q""",
)
def gap_session_groups(spark: SparkSession, base: str) -> DataFrame:
    """Sessions of message parts with the same key: broken by 30 s of silence or a part number that does not rise."""
    rows = once_per_key(table(spark, base, "ss7_transaction").where("message_type IN (2, 3)"), "reference", "create_date", ("calling_gt", "b_number", "sarref", "msg_part", "time_stamp"))
    parts = rows.select(F.col("reference").alias("seq"), "calling_gt", "b_number", F.coalesce("sarref", F.lit(-1)).alias("sarref"), "msg_part", (F.col("time_stamp") * 1000).alias("at"))
    return w.sessions(parts, ["calling_gt", "b_number", "sarref"], "msg_part").select(F.col("seq").alias("reference"), "session")


@REGISTRY.add(
    "bucket_diversity_baseline",
    f"""
WITH RECURSIVE {SQL_M},
b AS (SELECT s, u // {w.DAY} AS day, count(*) AS n, count(DISTINCT d) AS k FROM m GROUP BY s, day),
r AS (SELECT s, day, row_number() OVER (PARTITION BY s ORDER BY day) AS i, CASE WHEN n >= 3 THEN k / n::DOUBLE END AS v FROM b),
f AS (SELECT s, day, i, v, NULL::DOUBLE AS prior, v AS level FROM r WHERE i = 1
  UNION ALL SELECT r.s, r.day, r.i, r.v, f.level, CASE WHEN r.v IS NULL THEN f.level WHEN f.level IS NULL THEN r.v ELSE 0.1 * r.v + (1 - 0.1::DOUBLE) * f.level END FROM f JOIN r ON r.s = f.s AND r.i = f.i + 1)
SELECT s AS sender_id, day, round(prior, 9) AS ema, i - 1 AS history FROM f""",
)
def bucket_diversity_baseline(spark: SparkSession, base: str) -> DataFrame:
    """Exponential average of each sender's daily recipient diversity, strictly before the day."""
    daily = frame(spark, base).where("at IS NOT NULL").groupBy(F.coalesce("sender", F.lit("<NA>")).alias("sender_id"), F.floor(F.col("at") / w.DAY).cast("long").alias("at")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct(F.coalesce("destination", F.lit("<NA>"))).alias("k"))
    rows = daily.select("sender_id", "at", F.lit(0).alias("seq"), F.when(F.col("n") >= 3, F.col("k") / F.col("n")).alias("v"))
    return w.ema_prior(rows, "sender_id", "v").select("sender_id", F.col("at").alias("day"), F.round("ema", 9).alias("ema"), "history")


@REGISTRY.add(
    "avg_rank",
    """SELECT doc_id, CASE WHEN n_chars IS NOT NULL THEN rank() OVER (PARTITION BY n_chars IS NULL ORDER BY n_chars) + (count(*) OVER (PARTITION BY n_chars) - 1) / 2.0::DOUBLE END AS rank FROM documents""",
)
def avg_rank(spark: SparkSession, base: str) -> DataFrame:
    """Average ranks of the documents' stated lengths."""
    return average_rank(table(spark, base, "documents").select("doc_id", "n_chars"), "n_chars").select("doc_id", "rank")


@REGISTRY.add(
    "first_row_per_group",
    f"WITH {SQL_M} SELECT s AS sender_id, seq AS record_id FROM m QUALIFY row_number() OVER (PARTITION BY s ORDER BY u, seq) = 1",
)
def first_row_per_group(spark: SparkSession, base: str) -> DataFrame:
    """Each sender's first message."""
    rows = frame(spark, base).where("at IS NOT NULL")
    return rows.groupBy(F.coalesce("sender", F.lit("<NA>")).alias("sender_id")).agg(F.min(F.struct("at", "seq")).alias("f")).select("sender_id", F.col("f.seq").alias("record_id"))


@REGISTRY.add(
    "history_length_bins",
    f"""
WITH {SQL_M}, b AS (SELECT s, u // {w.DAY} AS day FROM m GROUP BY s, day), r AS (SELECT s, row_number() OVER (PARTITION BY s ORDER BY day) - 1 AS i FROM b)
SELECT CASE WHEN i = 0 THEN '0' WHEN i < 3 THEN '1-2' WHEN i < 10 THEN '3-9' WHEN i < 30 THEN '10-29' ELSE '30+' END AS history, count(*) AS buckets FROM r GROUP BY history""",
)
def history_length_bins(spark: SparkSession, base: str) -> DataFrame:
    """How many (sender, day) buckets have how many active days before them."""
    from pyspark.sql import Window

    days = frame(spark, base).where("at IS NOT NULL").select(F.coalesce("sender", F.lit("<NA>")).alias("s"), F.floor(F.col("at") / w.DAY).alias("day")).distinct()
    i = F.row_number().over(Window.partitionBy("s").orderBy("day")) - 1
    label = F.when(F.col("i") == 0, "0").when(F.col("i") < 3, "1-2").when(F.col("i") < 10, "3-9").when(F.col("i") < 30, "10-29").otherwise("30+")
    return days.withColumn("i", i).groupBy(label.alias("history")).agg(F.count(F.lit(1)).alias("buckets"))


@REGISTRY.add(
    "destination_forms",
    """
WITH m AS (SELECT DISTINCT record_id, destination, regexp_replace(destination, '[^0-9]', '', 'g') AS d FROM canonical_row WHERE record_id IS NOT NULL)
SELECT record_id, CASE WHEN d = '' THEN NULL WHEN length(d) > 8 AND d LIKE '00%' THEN substr(d, 3) ELSE d END AS plain FROM m""",
)
def destination_forms(spark: SparkSession, base: str) -> DataFrame:
    """Destinations in plain international form."""
    return messages(spark, base, "destination").select("record_id", plain_number(F.col("destination")).alias("plain"))


@REGISTRY.add(
    "subscribers",
    """
WITH x AS (SELECT DISTINCT reference, substr(regexp_replace(imsi, '[^0-9]', '', 'g'), 1, 15) AS d FROM ss7_transaction WHERE reference IS NOT NULL)
SELECT reference, CASE WHEN length(d) = 15 AND d <> '000000000000000' THEN d END AS subscriber FROM x""",
)
def subscribers(spark: SparkSession, base: str) -> DataFrame:
    """The subscriber of each signalling record."""
    return once_per_key(table(spark, base, "ss7_transaction"), "reference", "create_date", ("imsi",)).select("reference", subscriber(F.col("imsi")).alias("subscriber"))
