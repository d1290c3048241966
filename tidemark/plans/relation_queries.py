"""Queries of joins, set operations, near-duplicate vectors and feature preparation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import features as ft
from tidemark.operators import relations as rl
from tidemark.operators import similarity as sm
from tidemark.plans.registry import Registry
from tidemark.sources.tables import messages, table

REGISTRY = Registry()


@REGISTRY.add("left_enrich", "SELECT o_orderkey, o_custkey, c_name, c_mktsegment FROM orders LEFT JOIN customer ON c_custkey = o_custkey")
def left_enrich(spark: SparkSession, base: str) -> DataFrame:
    """Orders with their customer, many to one."""
    c = table(spark, base, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment")
    return rl.enrich(table(spark, base, "orders").select("o_orderkey", "o_custkey"), c, ["o_custkey"])


@REGISTRY.add("left_one_to_one", "SELECT o_orderkey, o_totalprice::DOUBLE AS price, n FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey")
def left_one_to_one(spark: SparkSession, base: str) -> DataFrame:
    """Orders with the number of their lines, one to one."""
    n = table(spark, base, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("n"))
    return rl.one_to_one(table(spark, base, "orders").select("o_orderkey", F.col("o_totalprice").cast("double").alias("price")), n, ["o_orderkey"], "left")


@REGISTRY.add("inner_threeway", "SELECT l_orderkey, l_linenumber, s_name, p_type FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN part ON p_partkey = l_partkey")
def inner_threeway(spark: SparkSession, base: str) -> DataFrame:
    """Lines with supplier and part."""
    s = table(spark, base, "supplier").select("s_suppkey", "s_name")
    p = table(spark, base, "part").select("p_partkey", "p_type")
    return table(spark, base, "lineitem").join(s, F.col("s_suppkey") == F.col("l_suppkey")).join(p, F.col("p_partkey") == F.col("l_partkey")).select("l_orderkey", "l_linenumber", "s_name", "p_type")


@REGISTRY.add("semi_frequent", "SELECT record_id, sender_id FROM (SELECT DISTINCT record_id, sender_id FROM canonical_row) QUALIFY sender_id IS NOT NULL AND count(*) OVER (PARTITION BY sender_id) >= 50")
def semi_frequent(spark: SparkSession, base: str) -> DataFrame:
    """Messages of senders with at least 50."""
    return rl.frequent(messages(spark, base, "sender_id"), "sender_id", 50).select("record_id", "sender_id")


@REGISTRY.add("anti_unknown", "SELECT DISTINCT reference FROM smpp_transaction WHERE reference NOT IN (SELECT record_id FROM canonical_row)")
def anti_unknown(spark: SparkSession, base: str) -> DataFrame:
    """Raw references without a canonical message."""
    raw = table(spark, base, "smpp_transaction").select(F.col("reference").alias("record_id")).distinct()
    return rl.unknown_keys(raw, table(spark, base, "canonical_row"), ["record_id"]).select(F.col("record_id").alias("reference"))


@REGISTRY.add(
    "asof_ttl",
    """WITH x AS (SELECT DISTINCT reference, message_type, imsi, vlr_address, time_stamp AS u FROM ss7_transaction),
f AS (SELECT imsi, u, max(vlr_address) AS v FROM x WHERE message_type = 1 GROUP BY imsi, u)
SELECT l.reference, CASE WHEN l.u - f.u <= 21600000 THEN f.v END AS vlr FROM (SELECT * FROM x WHERE message_type = 2) l ASOF LEFT JOIN f ON f.imsi = l.imsi AND f.u <= l.u""",
)
def asof_ttl(spark: SparkSession, base: str) -> DataFrame:
    """Terminating requests with the VLR of the last routing answer of their IMSI in the six hours before."""
    x = table(spark, base, "ss7_transaction").select("reference", "message_type", "imsi", "vlr_address", F.col("time_stamp").alias("at")).distinct()
    left = x.where("message_type = 2").select("reference", "imsi", "at")
    return rl.as_of(left, x.where("message_type = 1"), "imsi", ["vlr_address"], ttl=6 * 3_600_000).select("reference", F.col("asof_vlr_address").alias("vlr"))


@REGISTRY.add("snapshot_lookup", "WITH s AS (SELECT sender_id, count(DISTINCT record_id) AS n FROM canonical_row WHERE source = 'SMPP' AND sender_id IS NOT NULL GROUP BY sender_id) SELECT d.doc_id, s.n FROM documents d LEFT JOIN s USING (sender_id)")
def snapshot_lookup(spark: SparkSession, base: str) -> DataFrame:
    """Documents with their sender's message count; unknown and null senders give null."""
    s = table(spark, base, "canonical_row").where("source = 'SMPP' AND sender_id IS NOT NULL").groupBy("sender_id").agg(F.count_distinct("record_id").alias("n"))
    return table(spark, base, "documents").select("doc_id", "sender_id").join(s, "sender_id", "left").select("doc_id", "n")


@REGISTRY.add(
    "bucket_back_join",
    """WITH e AS (SELECT event_id, user_id, ts, date_trunc('day', ts) AS b FROM events), g AS (SELECT user_id, b, count(*) AS n FROM e GROUP BY user_id, b) SELECT event_id, n FROM e JOIN g USING (user_id, b)""",
)
def bucket_back_join(spark: SparkSession, base: str) -> DataFrame:
    """Events with the size of their (user, day) bucket."""
    e = table(spark, base, "events").select("event_id", "user_id", F.date_trunc("day", "ts").alias("b"))
    return e.join(e.groupBy("user_id", "b").agg(F.count(F.lit(1)).alias("n")), ["user_id", "b"]).select("event_id", "n")


@REGISTRY.add("union_sources", "SELECT reference AS key, 'SMPP' AS source, esm_class, NULL::INT AS pid FROM smpp_transaction UNION ALL SELECT reference, 'SS7', NULL, pid FROM ss7_transaction")
def union_sources(spark: SparkSession, base: str) -> DataFrame:
    """Both protocols' records, aligned by name."""
    a = table(spark, base, "smpp_transaction").select(F.col("reference").alias("key"), F.lit("SMPP").alias("source"), "esm_class")
    b = table(spark, base, "ss7_transaction").select(F.col("reference").alias("key"), F.lit("SS7").alias("source"), "pid")
    return rl.union_all(a, b)


@REGISTRY.add("distinct_texts", "SELECT DISTINCT text FROM canonical_row WHERE text <> ''")
def distinct_texts(spark: SparkSession, base: str) -> DataFrame:
    """Different texts, as an encoder needs each once."""
    return table(spark, base, "canonical_row").where("text <> ''").select("text").distinct()


@REGISTRY.add("except_keys", "SELECT sender_id FROM documents WHERE sender_id IS NOT NULL EXCEPT SELECT sender_id FROM canonical_row")
def except_keys(spark: SparkSession, base: str) -> DataFrame:
    """Senders of documents who sent no message."""
    return table(spark, base, "documents").where("sender_id IS NOT NULL").select("sender_id").subtract(table(spark, base, "canonical_row").select("sender_id"))


@REGISTRY.add("intersect_keys", "SELECT sender_id FROM documents WHERE sender_id IS NOT NULL INTERSECT SELECT sender_id FROM canonical_row")
def intersect_keys(spark: SparkSession, base: str) -> DataFrame:
    """Senders of documents who sent messages."""
    return table(spark, base, "documents").where("sender_id IS NOT NULL").select("sender_id").intersect(table(spark, base, "canonical_row").select("sender_id"))


# --- near-duplicate vectors --------------------------------------------------------------

HOUR_MIN = 60
SQL_E = "e AS (SELECT CAST(vec_id AS VARCHAR) AS key, CAST(label AS VARCHAR) AS o, vec_id AS tm, embedding::DOUBLE[] AS v FROM embeddings)"
SQL_PAIRS = f"WITH {SQL_E}, p AS (SELECT a.key, b.key AS match_key, b.o, list_inner_product(a.v, b.v) AS s, a.tm - b.tm AS age FROM e a JOIN e b ON b.tm < a.tm AND a.tm - b.tm <= {{reach}} AND list_inner_product(a.v, b.v) >= 0.35)"


def vectors(spark: SparkSession, base: str) -> DataFrame:
    """The embeddings as a stream of one vector a minute, by label."""
    return table(spark, base, "embeddings").select(F.col("vec_id").alias("key"), F.col("label").alias("originator"), F.col("vec_id").alias("at"), F.col("embedding").alias("vector"))


@REGISTRY.add("neardup_pairs", SQL_PAIRS.format(reach=HOUR_MIN) + " SELECT key, match_key, round(s, 6) AS similarity, age FROM p")
def neardup_pairs(spark: SparkSession, base: str) -> DataFrame:
    """Similar vectors at most an hour apart, later first."""
    v = vectors(spark, base)
    return sm.similar_in_time(v, v, 0.35, HOUR_MIN).select("key", "match_key", F.round("similarity", 6).alias("similarity"), "age")


@REGISTRY.add(
    "neardup_features",
    SQL_PAIRS.format(reach=24 * HOUR_MIN)
    + """, f AS (SELECT key, count(*) FILTER (age <= 60) AS a, max(s) FILTER (age <= 60) AS b, count(DISTINCT o) FILTER (age <= 60) AS c, count(*) AS d, max(s) AS g, count(DISTINCT o) AS h FROM p GROUP BY key)
SELECT e.key, coalesce(a, 0) AS match_count_1h, round(coalesce(b, 0.0), 6) AS max_similarity_1h, coalesce(c, 0) AS distinct_senders_1h, coalesce(d, 0) AS match_count_24h, round(coalesce(g, 0.0), 6) AS max_similarity_24h, coalesce(h, 0) AS distinct_senders_24h FROM e LEFT JOIN f USING (key)""",
)
def neardup_features(spark: SparkSession, base: str) -> DataFrame:
    """Counts, similarity and senders of earlier near-duplicates over an hour and a day."""
    f = sm.neardup_features(vectors(spark, base), 0.35, {"1h": HOUR_MIN, "24h": 24 * HOUR_MIN})
    return f.withColumns({f"max_similarity_{n}": F.round(f"max_similarity_{n}", 6) for n in ("1h", "24h")})


@REGISTRY.add(
    "neardup_capped",
    SQL_PAIRS.format(reach=24 * HOUR_MIN) + " SELECT key, match_key, row_number() OVER (PARTITION BY key ORDER BY s DESC, match_key)::INT AS rank FROM p QUALIFY rank <= 2",
)
def neardup_capped(spark: SparkSession, base: str) -> DataFrame:
    """The two most similar of each vector's matches in a day."""
    v = vectors(spark, base)
    return sm.capped(sm.similar_in_time(v, v, 0.35, 24 * HOUR_MIN), 2).select("key", "match_key", "rank")


@REGISTRY.add(
    "live_lookup",
    SQL_PAIRS.format(reach=24 * HOUR_MIN) + " SELECT key, count(*) AS matches, round(max(s), 6) AS best FROM p WHERE key IN (SELECT key FROM e WHERE tm % 50 = 0) GROUP BY key",
)
def live_lookup(spark: SparkSession, base: str) -> DataFrame:
    """A set of requests against the static corpus: the same join with other queries."""
    v = vectors(spark, base)
    pairs = sm.similar_in_time(v.where("at % 50 = 0"), v, 0.35, 24 * HOUR_MIN)
    return pairs.groupBy("key").agg(F.count(F.lit(1)).alias("matches"), F.round(F.max("similarity"), 6).alias("best"))


@REGISTRY.add(
    "topk_neighbors",
    f"WITH {SQL_E} SELECT a.key, b.key AS match_key, round(list_inner_product(a.v, b.v), 6) AS similarity, row_number() OVER (PARTITION BY a.key ORDER BY list_inner_product(a.v, b.v) DESC, b.key)::INT AS rank FROM e a JOIN e b ON a.key <> b.key AND a.tm % 50 = 0 QUALIFY rank <= 5",
)
def topk_neighbors(spark: SparkSession, base: str) -> DataFrame:
    """The five nearest vectors of each query vector, exactly."""
    v = vectors(spark, base)
    return sm.nearest_exact(v.where("at % 50 = 0"), v, 5).select("key", "match_key", F.round("similarity", 6).alias("similarity"), "rank")


# --- feature preparation -----------------------------------------------------------------


@REGISTRY.add(
    "feature_frame",
    """WITH g AS (SELECT o_custkey AS id, count(*) AS n, avg(o_totalprice)::DOUBLE AS mean, max(o_orderstatus) AS source, date_diff('second', max(o_orderdate)::TIMESTAMP, TIMESTAMP '1999-01-01') / 86400.0::DOUBLE AS age, stddev_samp(o_totalprice)::DOUBLE AS z, count(DISTINCT o_orderpriority) / count(*)::DOUBLE AS ratio FROM orders GROUP BY o_custkey)
SELECT id, ln(1 + n) AS log_n, (z IS NOT NULL)::INT::DOUBLE AS z_known, round(coalesce(z, 0.0), 6) AS z, (n >= 3)::INT::DOUBLE AS ratio_known, CASE WHEN n >= 3 THEN ratio ELSE 0.0 END AS ratio,
 (source = 'F')::INT::DOUBLE AS source_F, (source = 'O')::INT::DOUBLE AS source_O, (source = 'P')::INT::DOUBLE AS source_P,
 CASE WHEN age <= 1/24.0::DOUBLE THEN '0' WHEN age <= 365 THEN '1' WHEN age <= 700 THEN '2' WHEN age <= 1200 THEN '3' ELSE '4' END AS age_bucket, round((mean - min(mean) OVER ()) / (max(mean) OVER () - min(mean) OVER ()), 9) AS mean_scaled FROM g""",
)
def feature_frame(spark: SparkSession, base: str) -> DataFrame:
    """Logs, known-flags, gated ratios, one-hot sources, right-closed buckets and range scaling."""
    day = F.date_diff(F.lit("1999-01-01").cast("date"), F.max("o_orderdate").cast("date"))
    g = table(spark, base, "orders").groupBy(F.col("o_custkey").alias("id")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.col("o_totalprice").cast("double")).alias("mean"), F.max("o_orderstatus").alias("source"), day.cast("double").alias("age"), F.stddev_samp(F.col("o_totalprice").cast("double")).alias("z"), (F.count_distinct("o_orderpriority") / F.count(F.lit(1))).alias("ratio"),
    )
    f = ft.with_known(ft.gate(g, "ratio", "n", 3), ["z", "ratio"])
    f = ft.one_hot(f, "source", ["F", "O", "P"])
    f = f.withColumn("age_bucket", ft.right_closed(F.col("age"), [1 / 24, 365, 700, 1200])).withColumn("log_n", F.log1p("n"))
    return ft.min_max(f, "mean", "mean_scaled").select("id", "log_n", "z_known", F.round("z", 6).alias("z"), "ratio_known", "ratio", "source_F", "source_O", "source_P", "age_bucket", F.round("mean_scaled", 9).alias("mean_scaled"))


@REGISTRY.add("seeded_sample", "SELECT o_orderkey FROM orders ORDER BY md5('7|' || o_orderkey), o_orderkey LIMIT 100")
def seeded_sample(spark: SparkSession, base: str) -> DataFrame:
    """A hundred rows by seeded hash: a sampling operator."""
    from tidemark.sources.files import sample_n

    return sample_n(table(spark, base, "orders").select("o_orderkey"), "o_orderkey", 100, seed=7)


@REGISTRY.add(
    "top_and_contrast",
    "WITH t AS (SELECT o_orderkey FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50) SELECT o_orderkey, 'top' AS part FROM t UNION ALL (SELECT o_orderkey, 'contrast' FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM t) ORDER BY md5('3|' || o_orderkey), o_orderkey LIMIT 50)",
)
def top_and_contrast(spark: SparkSession, base: str) -> DataFrame:
    """The 50 highest scores, and 50 of the others by seeded hash."""
    from tidemark.sources.files import sample_n

    orders = table(spark, base, "orders").select("o_orderkey", "o_totalprice")
    top = orders.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(50).select("o_orderkey")
    rest = sample_n(orders.join(F.broadcast(top), "o_orderkey", "left_anti").select("o_orderkey"), "o_orderkey", 50, seed=3)
    return top.withColumn("part", F.lit("top")).unionByName(rest.withColumn("part", F.lit("contrast")))


@REGISTRY.add("global_order", "SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS place FROM orders")
def global_order(spark: SparkSession, base: str) -> DataFrame:
    """Every row's place in a stated total order, by range partitions and prefix sums."""
    from tidemark.operators.ranking import prefix_sums

    rows = table(spark, base, "orders").select("o_orderkey", "o_totalprice", F.lit(1).alias("one"))
    return prefix_sums(rows, ["o_totalprice", "o_orderkey"], {"place": "one"}).select("o_orderkey", "place")
