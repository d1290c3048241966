"""Queries of content flags, text measures, labels and snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import content as c
from tidemark.operators import labels as lb
from tidemark.operators import snapshot as sn
from tidemark.operators import windows as w
from tidemark.plans.registry import Registry
from tidemark.plans.window_queries import SQL_M, frame
from tidemark.sources.tables import messages, table

REGISTRY = Registry()

SQL_T = "t AS (SELECT record_id, any_value(coalesce(text, '')) AS text, bool_or(text_decode_failed) AS failed FROM canonical_row WHERE record_id IS NOT NULL GROUP BY record_id)"
SQL_FLAGS = ", ".join(f"regexp_matches(text, '{c.re2(n)}')::INT AS {n}" for n in c.PATTERNS)
SQL_F = f"WITH {SQL_T}, f AS (SELECT record_id, failed, {SQL_FLAGS} FROM t)"


def flagged(spark: SparkSession, base: str) -> DataFrame:
    m = messages(spark, base, "text", "text_decode_failed")
    return m.select("record_id", "text_decode_failed", *[v.alias(k) for k, v in c.flags(F.col("text")).items()])


@REGISTRY.add("content_flags", SQL_F + " SELECT * EXCLUDE (failed) FROM f")
def content_flags(spark: SparkSession, base: str) -> DataFrame:
    """The twenty content flags of each message."""
    return flagged(spark, base).drop("text_decode_failed")


SQL_COUNT = " + ".join(c.PATTERNS)
SQL_HIGH = " OR ".join("(" + " AND ".join(f"{n} = 1" for n in g) + ")" for g in c.HIGH_CONFIDENCE)


@REGISTRY.add(
    "content_flag_meta",
    SQL_F + f" SELECT record_id, {SQL_COUNT} AS flag_count, ({SQL_COUNT}) > 0 AS any_flag, {SQL_HIGH} AS high_confidence, ({SQL_COUNT}) >= 3 AS flagged_by_count, NOT coalesce(failed, false) AS evaluated FROM f",
)
def content_flag_meta(spark: SparkSession, base: str) -> DataFrame:
    """How many flags, any, any strong combination, three or more, and whether there was text to judge."""
    count = c.flag_count()
    return flagged(spark, base).select("record_id", count.alias("flag_count"), (count > 0).alias("any_flag"), c.high_confidence().alias("high_confidence"), (count >= 3).alias("flagged_by_count"), (~F.coalesce("text_decode_failed", F.lit(False))).alias("evaluated"))


@REGISTRY.add(
    "text_measures",
    """WITH c AS (SELECT doc_id, any_value(text) AS text FROM documents GROUP BY doc_id),
x AS (SELECT doc_id, ch, count(*) AS k FROM (SELECT doc_id, unnest(string_split(text, '')) AS ch FROM c WHERE text <> '') GROUP BY ALL),
n AS (SELECT doc_id, sum(k) AS n FROM x GROUP BY doc_id),
h AS (SELECT doc_id, -sum(k / n.n * log2(k / n.n)) AS h FROM x JOIN n USING (doc_id) GROUP BY doc_id)
SELECT doc_id, round(h, 6) AS entropy, length(coalesce(text, ''))::INT AS n_chars, round(CASE WHEN length(text) > 0 THEN length(regexp_replace(text, '[^A-Za-z ]', '', 'g')) / length(text)::DOUBLE END, 9) AS letter_ratio FROM c LEFT JOIN h USING (doc_id)""",
)
def text_measures(spark: SparkSession, base: str) -> DataFrame:
    """Entropy, length and share of letters of each document."""
    d = table(spark, base, "documents")
    return d.select("doc_id", F.round(c.entropy(F.col("text")), 6).alias("entropy"), c.text_length(F.col("text")).alias("n_chars"), F.round(c.letter_ratio(F.col("text")), 9).alias("letter_ratio"))


@REGISTRY.add(
    "whitespace_agreement",
    r"""SELECT lower(trim(lang)) AS lang, round(avg((trim(regexp_replace(text, '[ \t\n\x0b\f\r]+', ' ', 'g')) = text)::INT), 9) AS unchanged FROM documents WHERE text IS NOT NULL GROUP BY 1""",
)
def whitespace_agreement(spark: SparkSession, base: str) -> DataFrame:
    """How often collapsing white space leaves a document as it is, per language."""
    d = table(spark, base, "documents").where("text IS NOT NULL")
    return d.groupBy(F.lower(F.trim("lang")).alias("lang")).agg(F.round(F.avg((c.collapse(F.col("text")) == F.col("text")).cast("int")), 9).alias("unchanged"))


@REGISTRY.add("trailing_token", r"SELECT record_id, any_value(regexp_extract(coalesce(text, ''), '([A-Za-z0-9]+)$', 1)) AS token FROM canonical_row WHERE record_id IS NOT NULL GROUP BY record_id")
def trailing_token(spark: SparkSession, base: str) -> DataFrame:
    """The last token of each message's text."""
    return messages(spark, base, "text").select("record_id", F.regexp_extract(F.coalesce("text", F.lit("")), "([A-Za-z0-9]+)$", 1).alias("token"))


@REGISTRY.add(
    "date_functions",
    """SELECT DISTINCT reference, make_timestamp(time_stamp * 1000) AS at, date_trunc('hour', make_timestamp(time_stamp * 1000)) AS hour, time_bucket(INTERVAL 5 MINUTE, make_timestamp(time_stamp * 1000)) AS bucket, hour(make_timestamp(time_stamp * 1000))::INT AS hour_of_day FROM ss7_transaction""",
)
def date_functions(spark: SparkSession, base: str) -> DataFrame:
    """Epoch milliseconds to times, hours, five-minute buckets and hours of the day."""
    at = F.timestamp_millis(F.col("time_stamp"))
    bucket = F.timestamp_millis(F.floor(F.col("time_stamp") / 300_000) * 300_000)
    return table(spark, base, "ss7_transaction").select("reference", at.cast("timestamp_ntz").alias("at"), F.date_trunc("hour", at).cast("timestamp_ntz").alias("hour"), bucket.cast("timestamp_ntz").alias("bucket"), F.hour(at).alias("hour_of_day")).distinct()


@REGISTRY.add("mixed_time_formats", "SELECT DISTINCT reference, time_stamp, CAST(CAST(time_stamp AS TIMESTAMPTZ) AS TIMESTAMP) AS at FROM smpp_transaction WHERE regexp_matches(time_stamp, '(Z|[+-][0-9:]{4,6})$') UNION ALL SELECT DISTINCT reference, time_stamp, TRY_CAST(time_stamp AS TIMESTAMP) FROM smpp_transaction WHERE NOT regexp_matches(time_stamp, '(Z|[+-][0-9:]{4,6})$')")
def mixed_time_formats(spark: SparkSession, base: str) -> DataFrame:
    """Request times in their several spellings."""
    from tidemark.operators.ingest import parse_time

    return table(spark, base, "smpp_transaction").where("time_stamp IS NOT NULL").select("reference", "time_stamp", parse_time(F.col("time_stamp")).alias("at")).distinct()


@REGISTRY.add("json_fields", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, json_object('user', user_id, 'type', event_type) AS packed FROM events")
def json_fields(spark: SparkSession, base: str) -> DataFrame:
    """A field out of JSON, and JSON out of fields."""
    return table(spark, base, "events").select("event_id", F.from_json("props", "k bigint")["k"].alias("k"), F.to_json(F.struct(F.col("user_id").alias("user"), F.col("event_type").alias("type"))).alias("packed"))


# --- labels ------------------------------------------------------------------------------

#: lineitem as rule outcomes: line numbers stand for rules, flags for decisions and types.
SQL_RULES = """r AS (SELECT l_orderkey, l_linenumber, CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 0 ELSE 6 END AS decision, CASE WHEN l_linenumber = 1 THEN 'SW_1' WHEN l_linenumber = 2 THEN NULL ELSE 'S_' || l_linenumber END AS rule, CASE WHEN l_linestatus = 'F' THEN 'spam' WHEN l_linenumber = 3 THEN NULL ELSE 'other' END AS fraud_type FROM lineitem)"""


@REGISTRY.add(
    "rule_labels",
    f"WITH {SQL_RULES}, e AS (SELECT *, decision IN (0, 1) AND NOT coalesce(starts_with(rule, 'SW_'), false) AS rule_evaluated FROM r) SELECT l_orderkey, l_linenumber, rule_evaluated, CASE WHEN rule_evaluated THEN coalesce(fraud_type = 'spam', false) END AS rule_flagged FROM e",
)
def rule_labels(spark: SparkSession, base: str) -> DataFrame:
    """Which rows a rule engine judged, and its three-valued verdict."""
    line = F.col("l_linenumber")
    rows = table(spark, base, "lineitem").select("l_orderkey", "l_linenumber", F.when(F.col("l_returnflag") == "R", 1).when(F.col("l_returnflag") == "A", 0).otherwise(6).alias("decision"), F.when(line == 1, "SW_1").when(line == 2, None).otherwise(F.concat(F.lit("S_"), line)).alias("rule"), F.when(F.col("l_linestatus") == "F", "spam").when(line == 3, None).otherwise("other").alias("fraud_type"))
    evaluated = lb.rule_evaluated(F.col("decision"), F.col("rule"))
    return rows.select("l_orderkey", "l_linenumber", evaluated.alias("rule_evaluated"), lb.rule_flagged(evaluated, F.col("fraud_type")).alias("rule_flagged"))


#: messages clustered by the first five characters of their text.
SQL_CLUSTERS = "k AS (SELECT DISTINCT record_id AS key, coalesce(text, '') AS text, originator, CASE WHEN length(text) < 5 THEN '-1' ELSE lower(substr(text, 1, 5)) END AS cluster FROM canonical_row WHERE record_id IS NOT NULL AND text IS NOT NULL)"


def clusters(spark: SparkSession, base: str) -> DataFrame:
    m = messages(spark, base, "text", "originator").where("text IS NOT NULL")
    return m.select(F.col("record_id").alias("key"), "text", "originator", F.when(F.char_length("text") < 5, "-1").otherwise(F.lower(F.substring("text", 1, 5))).alias("cluster"))


@REGISTRY.add(
    "cluster_summary",
    f"""WITH {SQL_CLUSTERS}, s AS (SELECT cluster, string_agg(text, ' ||| ' ORDER BY md5(key), key) AS sample_texts FROM (SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY cluster ORDER BY md5(key), key) <= 3) GROUP BY cluster)
SELECT cluster, count(*) AS n_rows, count(DISTINCT text) AS n_unique_texts, count(DISTINCT originator) AS n_unique_originators, any_value(sample_texts) AS sample_texts FROM k JOIN s USING (cluster) GROUP BY cluster""",
)
def cluster_summary(spark: SparkSession, base: str) -> DataFrame:
    """Size, variety and sample texts of each cluster."""
    return lb.cluster_summary(clusters(spark, base))


SQL_KEYWORDS = "CASE " + " ".join("WHEN " + " OR ".join(f"contains(x, '{k}')" for k in ks) + f" THEN '{label}'" for label, ks in c.CLUSTER_KEYWORDS) + " END"


@REGISTRY.add(
    "suggest_labels",
    f"""WITH {SQL_CLUSTERS}, g AS (SELECT cluster, count(*) AS n, count(DISTINCT text) AS t, count(DISTINCT originator) AS o, min(text) AS s, lower(min(text)) AS x FROM k GROUP BY cluster)
SELECT cluster, CASE WHEN t / n >= 0.5 AND o / n >= 0.5 THEN 'incoherent_no_pattern' ELSE coalesce({SQL_KEYWORDS}, CASE WHEN t <= 2 THEN CASE WHEN o = 1 THEN 'flooding_burst' ELSE 'templated_multi_sender_campaign' END ELSE 'unclassified_review_needed' END) END AS label FROM g""",
)
def suggest_labels(spark: SparkSession, base: str) -> DataFrame:
    """A suggested label for each cluster: coherence, keywords, shape."""
    g = clusters(spark, base).groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("text").alias("t"), F.count_distinct("originator").alias("o"), F.min("text").alias("s"))
    return g.select("cluster", lb.suggest(F.col("n"), F.col("t"), F.col("o"), F.col("s")).alias("label"))


@REGISTRY.add("cluster_label_join", f"WITH {SQL_CLUSTERS} SELECT key, trim(upper(cluster)) AS label FROM k WHERE cluster IN (SELECT cluster FROM k WHERE cluster <> '-1' GROUP BY cluster HAVING count(*) >= 20)")
def cluster_label_join(spark: SparkSession, base: str) -> DataFrame:
    """Labels of confirmed clusters on their members."""
    k = clusters(spark, base)
    template = k.where("cluster <> '-1'").groupBy("cluster").agg(F.count(F.lit(1)).alias("n")).select("cluster", F.when(F.col("n") >= 20, F.concat(F.lit(" "), F.upper("cluster"))).otherwise(" ").alias("label"))
    return lb.label_clusters(k, template).select("key", F.upper("label").alias("label"))


# --- snapshots ---------------------------------------------------------------------------

NOW = 1_780_272_000_000_000  # 2026-06-01T00:00:00
WEEK = 7 * w.DAY


@REGISTRY.add(
    "sender_snapshot",
    f"""WITH {SQL_M}, g AS (SELECT s, count(*) FILTER ({NOW} - u BETWEEN 0 AND {w.DAY}) AS a, count(*) FILTER ({NOW} - u BETWEEN 0 AND {WEEK}) AS b, count(DISTINCT d) FILTER ({NOW} - u BETWEEN 0 AND {w.DAY}) AS x, count(DISTINCT d) FILTER ({NOW} - u BETWEEN 0 AND {WEEK}) AS y, min(u) AS f FROM m GROUP BY s)
SELECT s AS sender_id, a AS msgs_short, b AS msgs_long, x AS dests_short, y AS dests_long, CASE WHEN a > 0 THEN x / a::DOUBLE ELSE 0.0 END AS diversity_short, CASE WHEN b > 0 THEN y / b::DOUBLE ELSE 0.0 END AS diversity_long, greatest(({NOW} - f) / 86400000000.0::DOUBLE, 0.0) AS age_days FROM g""",
)
def sender_snapshot(spark: SparkSession, base: str) -> DataFrame:
    """Every sender as of a fixed moment, over a day and a week."""
    return sn.sender_snapshot(frame(spark, base), NOW, short=w.DAY, long=WEEK)


@REGISTRY.add("imsi_snapshot", f"WITH {SQL_M} SELECT imsi, count(DISTINCT coalesce(originator, '<NA>')) FILTER ({NOW} - u BETWEEN 0 AND {WEEK}) AS distinct_values FROM m WHERE imsi IS NOT NULL GROUP BY imsi")
def imsi_snapshot(spark: SparkSession, base: str) -> DataFrame:
    """Different originators behind each IMSI in the week before a fixed moment."""
    m = messages(spark, base, "imsi", "originator", "timestamp").where("timestamp IS NOT NULL").withColumn("at", w.micros(F.col("timestamp")))
    return sn.behind_snapshot(m, "imsi", "originator", NOW, width=WEEK)


SQL_TOP = f"""
WITH {SQL_M}, g AS (SELECT s, t, count(*) AS n, min(u) AS f FROM m GROUP BY s, t), r AS (SELECT *, row_number() OVER (PARTITION BY s ORDER BY n DESC, f, t) AS i FROM g QUALIFY i <= 5)
"""


@REGISTRY.add("topk_texts", SQL_TOP + "SELECT s AS sender_id, to_json(map_from_entries(list({'k': t, 'v': n} ORDER BY i))) AS top_values, sum(n)::BIGINT AS top_rows FROM r GROUP BY s")
def topk_texts(spark: SparkSession, base: str) -> DataFrame:
    """The five most frequent texts of each sender, as a JSON map."""
    rows = frame(spark, base).where("at IS NOT NULL").withColumn("sender_id", F.coalesce("sender", F.lit("<NA>")))
    return sn.top_values(rows, "sender_id", "text", "at", 5)


@REGISTRY.add(
    "repeat_ratio_on_demand",
    SQL_TOP.rstrip() + f""", c AS (SELECT s, sum(n) AS n FROM r GROUP BY s)
SELECT m.seq AS record_id, coalesce(r.n, 0) / c.n::DOUBLE AS ratio FROM m JOIN c USING (s) LEFT JOIN r ON r.s = m.s AND r.t = m.t""",
)
def repeat_ratio_on_demand(spark: SparkSession, base: str) -> DataFrame:
    """How much of its sender's frequent texts each message's text makes up, looked up in the snapshot."""
    top = topk_texts(spark, base)
    rows = frame(spark, base).where("at IS NOT NULL").withColumn("sender_id", F.coalesce("sender", F.lit("<NA>")))
    return rows.join(top, "sender_id").select(F.col("seq").alias("record_id"), sn.repeat_ratio(F.col("top_values"), F.coalesce("text", F.lit("")), F.col("top_rows")).alias("ratio"))


@REGISTRY.add(
    "entropy_baseline",
    f"""WITH RECURSIVE {SQL_M},
x AS (SELECT seq, ch, count(*) AS k FROM (SELECT seq, unnest(string_split(t, '')) AS ch FROM m WHERE t <> '' AND u <= {NOW}) GROUP BY ALL), n AS (SELECT seq, sum(k) AS n FROM x GROUP BY seq),
h AS (SELECT seq, -sum(k / n.n * log2(k / n.n)) AS h FROM x JOIN n USING (seq) GROUP BY seq),
b AS (SELECT s, u // {w.HOUR} AS hour, avg(h) AS v FROM m JOIN h USING (seq) GROUP BY s, hour), r AS (SELECT s, v, row_number() OVER (PARTITION BY s ORDER BY hour) AS i, count(*) OVER (PARTITION BY s) AS n FROM b),
f AS (SELECT s, i, n, v AS level, 0.0::DOUBLE AS spread FROM r WHERE i = 1 UNION ALL SELECT r.s, r.i, r.n, 0.1::DOUBLE * r.v + 0.9::DOUBLE * f.level, 0.1::DOUBLE * abs(r.v - f.level) + 0.9::DOUBLE * f.spread FROM f JOIN r ON r.s = f.s AND r.i = f.i + 1)
SELECT s AS sender_id, round(level, 6) AS entropy_level, round(spread, 6) AS entropy_spread, n AS hours FROM f WHERE i = n""",
)
def entropy_baseline(spark: SparkSession, base: str) -> DataFrame:
    """Level and spread of each sender's hourly text entropy."""
    b = sn.entropy_baseline(frame(spark, base), NOW)
    return b.select("sender_id", F.round("entropy_level", 6).alias("entropy_level"), F.round("entropy_spread", 6).alias("entropy_spread"), "hours")


@REGISTRY.add(
    "bucket_counts",
    f"""WITH {SQL_M}, g AS (SELECT s, u // {5 * w.MINUTE} * {5 * w.MINUTE} AS u0, count(*) AS n, count(DISTINCT d) AS k FROM m GROUP BY s, u0)
SELECT s AS sender_id, make_timestamp(u0) AS bucket, n, k AS destinations, CASE WHEN n >= 3 THEN k / n::DOUBLE END AS diversity FROM g""",
)
def bucket_counts(spark: SparkSession, base: str) -> DataFrame:
    """Messages and destinations by sender and five minutes; the ratio needs three messages."""
    rows = messages(spark, base, "sender_id", "destination", "timestamp").where("timestamp IS NOT NULL")
    g = rows.groupBy(F.coalesce("sender_id", F.lit("<NA>")).alias("sender_id"), F.window("timestamp", "5 minutes").alias("win")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct(F.coalesce("destination", F.lit("<NA>"))).alias("destinations"))
    return g.select("sender_id", F.col("win.start").alias("bucket"), "n", "destinations", F.when(F.col("n") >= 3, F.col("destinations") / F.col("n")).alias("diversity"))
