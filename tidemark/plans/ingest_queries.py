"""Queries from raw records to canonical messages and logical messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import ingest as g
from tidemark.plans.registry import Registry
from tidemark.sources.tables import messages, once_per_key, table

REGISTRY = Registry()

SMPP_COLUMNS = ("time_stamp", "smpp_operation", "a_number", "b_number", "content", "dcs", "esm_class", "sar_ref", "sar_msg_parts", "sar_msg_part")
SS7_COLUMNS = ("time_stamp", "message_type", "a_number", "b_number", "calling_gt", "called_gt", "content", "dcs", "imsi", "sarref", "msg_part", "msg_parts", "vlr_address")


def smpp(spark: SparkSession, base: str) -> DataFrame:
    return g.smpp_canonical(once_per_key(table(spark, base, "smpp_transaction"), "reference", "create_date", SMPP_COLUMNS))


def ss7(spark: SparkSession, base: str) -> DataFrame:
    return g.ss7_canonical(once_per_key(table(spark, base, "ss7_transaction"), "reference", "create_date", SS7_COLUMNS))


#: The project's own canonical messages are the oracle of decoding.
SQL_DECODED = "SELECT DISTINCT record_id, originator, destination, text, \"timestamp\", text_decode_failed, dcs, is_platform_token_message FROM canonical_row WHERE record_id LIKE '{}'"


@REGISTRY.add("smpp_canonical", SQL_DECODED.format("smpp-%"))
def smpp_canonical(spark: SparkSession, base: str) -> DataFrame:
    """Canonical messages of the raw SMPP requests: filter, header, coding scheme, text and failure flag."""
    return smpp(spark, base).where("record_id LIKE 'smpp-%'").select("record_id", "originator", "destination", "text", "timestamp", "text_decode_failed", "dcs", "is_platform_token_message")


@REGISTRY.add("ss7_canonical", SQL_DECODED.format("m_-%").replace(" FROM", ", imsi FROM"))
def ss7_canonical(spark: SparkSession, base: str) -> DataFrame:
    """Canonical messages of the raw SS7 records, packed alphabets and signalling tokens included."""
    return ss7(spark, base).select("record_id", "originator", "destination", "text", "timestamp", "text_decode_failed", "dcs", "is_platform_token_message", "imsi")


@REGISTRY.add(
    "ss7_latest_routing",
    """WITH x AS (SELECT DISTINCT reference, message_type, imsi, vlr_address, time_stamp FROM ss7_transaction WHERE reference IS NOT NULL),
a AS (SELECT imsi, vlr_address FROM x WHERE message_type = 1 AND imsi IS NOT NULL QUALIFY row_number() OVER (PARTITION BY imsi ORDER BY time_stamp DESC, reference DESC) = 1)
SELECT x.reference AS record_id, a.vlr_address FROM x LEFT JOIN a USING (imsi) WHERE x.message_type = 2""",
)
def ss7_latest_routing(spark: SparkSession, base: str) -> DataFrame:
    """Each terminating request with the VLR of the latest routing answer of its IMSI."""
    return ss7(spark, base).where("record_id LIKE 'mt-%'").select("record_id", "vlr_address")


SQL_PARTS = """p AS (SELECT DISTINCT t.reference, coalesce(t.a_number, t.calling_gt) AS o, coalesce(t.b_number, t.called_gt) AS d, CASE WHEN t.msg_parts > 1 THEN t.sarref END AS ref, t.msg_parts AS total, t.msg_part AS part, c.text, c."timestamp" AS ts, c.text_decode_failed AS failed
  FROM ss7_transaction t JOIN canonical_row c ON c.record_id = t.reference WHERE t.message_type IN (2, 3))"""
SQL_LOGICAL = f"""
WITH {SQL_PARTS},
w AS (SELECT arg_min(reference, (part, reference)) AS record_id, string_agg(text, '' ORDER BY part, reference) AS text, min(ts) AS "timestamp", bool_or(failed) AS text_decode_failed, count(*) AS message_part_count, total AS message_expected_parts,
  NOT (count(DISTINCT part) = count(*) AND count(*) = total AND min(part) = 1 AND max(part) = total) AS message_partial FROM p WHERE ref IS NOT NULL GROUP BY o, d, ref, total)
"""


@REGISTRY.add("reassemble_messages", SQL_LOGICAL + "SELECT * FROM w UNION ALL SELECT reference, text, ts, failed, 1, 1, FALSE FROM p WHERE ref IS NULL")
def reassemble_messages(spark: SparkSession, base: str) -> DataFrame:
    """Logical messages of the SS7 records."""
    return g.reassemble(ss7(spark, base)).select("record_id", "text", "timestamp", "text_decode_failed", "message_part_count", "message_expected_parts", "message_partial")


@REGISTRY.add("reassembly_partial_flags", SQL_LOGICAL + "SELECT message_partial, message_expected_parts, count(*) AS messages, sum(message_part_count)::BIGINT AS parts FROM w GROUP BY ALL")
def reassembly_partial_flags(spark: SparkSession, base: str) -> DataFrame:
    """Whole and partial multipart messages by expected parts."""
    return reassemble_messages(spark, base).where("message_expected_parts > 1").groupBy("message_partial", "message_expected_parts").agg(F.count(F.lit(1)).alias("messages"), F.sum("message_part_count").alias("parts"))


@REGISTRY.add(
    "part_collisions",
    f"WITH {SQL_PARTS} SELECT o AS originator, d AS destination, ref AS concat_ref, count(*) AS parts, count(part) > count(DISTINCT part) AS collides FROM p WHERE ref IS NOT NULL GROUP BY o, d, ref",
)
def part_collisions(spark: SparkSession, base: str) -> DataFrame:
    """Part keys whose part numbers repeat: different messages under one reference."""
    return g.collisions(ss7(spark, base).where("concat_ref IS NOT NULL"), ["originator", "destination", "concat_ref"], "concat_part_num")


@REGISTRY.add("decode_coverage")
def decode_coverage(spark: SparkSession, base: str) -> DataFrame:
    """Rows, failures and mean legibility by source, scheme and codec."""
    both = smpp(spark, base).select("source", "dcs", "codec", "text", "text_decode_failed").unionByName(ss7(spark, base).select("source", "dcs", "codec", "text", "text_decode_failed"))
    ascii_share = F.length(F.regexp_replace("text", "[^A-Za-z ]", "")) / F.length("text")
    return both.groupBy("source", "dcs", "codec").agg(F.count(F.lit(1)).alias("rows"), F.count_if("text_decode_failed").alias("failed"), F.round(F.avg(F.when(F.length("text") > 0, ascii_share)), 6).alias("ascii_share"))


@REGISTRY.add("udh_headers")
def udh_headers(spark: SparkSession, base: str) -> DataFrame:
    """Payloads by user data header: with an application port, with part numbers, without."""
    kind = F.when(F.col("udh_port").isNotNull(), "port").when(F.col("concat_ref").isNotNull(), "parts").otherwise("none")
    return smpp(spark, base).groupBy(kind.alias("header")).agg(F.count(F.lit(1)).alias("rows"))


@REGISTRY.add(
    "quality_checks",
    """WITH m AS (SELECT DISTINCT record_id, source, originator, destination, text, "timestamp" AS ts, text_decode_failed AS f, is_platform_token_message AS k FROM canonical_row)
SELECT source, 'rows' AS check, count(*)::DOUBLE AS value FROM m GROUP BY source
UNION ALL SELECT source, 'null_originator', count(*) FILTER (originator IS NULL) / count(*)::DOUBLE FROM m GROUP BY source
UNION ALL SELECT source, 'null_destination', count(*) FILTER (destination IS NULL) / count(*)::DOUBLE FROM m GROUP BY source
UNION ALL SELECT source, 'null_timestamp', count(*) FILTER (ts IS NULL) / count(*)::DOUBLE FROM m GROUP BY source
UNION ALL SELECT source, 'decode_failed', count(*) FILTER (f) / count(*)::DOUBLE FROM m GROUP BY source
UNION ALL SELECT source, 'empty_text_unflagged', count(*) FILTER (coalesce(text, '') = '' AND NOT f AND NOT k) / count(*)::DOUBLE FROM m GROUP BY source
UNION ALL SELECT source, 'duplicate_keys', (count(*) - count(DISTINCT record_id))::DOUBLE FROM m GROUP BY source
UNION ALL SELECT source, 'days', (date_diff('day', min(ts)::DATE, max(ts)::DATE) + 1)::DOUBLE FROM m GROUP BY source""",
)
def quality_checks(spark: SparkSession, base: str) -> DataFrame:
    """Data-quality figures of each source, all from one aggregation."""
    m = messages(spark, base, "source", "originator", "destination", "text", "timestamp", "text_decode_failed", "is_platform_token_message")
    rate = lambda c: F.count_if(c) / F.count(F.lit(1))
    figures = {
        "rows": F.count(F.lit(1)).cast("double"), "null_originator": rate(F.col("originator").isNull()), "null_destination": rate(F.col("destination").isNull()), "null_timestamp": rate(F.col("timestamp").isNull()), "decode_failed": rate(F.col("text_decode_failed")),
        "empty_text_unflagged": rate((F.coalesce("text", F.lit("")) == "") & ~F.col("text_decode_failed") & ~F.col("is_platform_token_message")),
        "duplicate_keys": (F.count(F.lit(1)) - F.count_distinct("record_id")).cast("double"), "days": (F.datediff(F.max("timestamp"), F.min("timestamp")) + 1).cast("double"),
    }
    wide = m.groupBy("source").agg(*[c.alias(k) for k, c in figures.items()])
    return wide.select("source", F.explode(F.array(*[F.struct(F.lit(k).alias("check"), F.col(k).alias("value")) for k in figures])).alias("r")).select("source", "r.check", "r.value")


@REGISTRY.add("keep_latest", "SELECT o_custkey, o_orderkey, o_totalprice::DOUBLE AS o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1")
def keep_latest(spark: SparkSession, base: str) -> DataFrame:
    """Each customer's latest order."""
    return g.keep_latest(table(spark, base, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey", F.col("o_totalprice").cast("double").alias("o_totalprice"))


@REGISTRY.add("keep_first", "SELECT o_custkey, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1")
def keep_first(spark: SparkSession, base: str) -> DataFrame:
    """Each customer's first order."""
    return g.keep_first(table(spark, base, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey")


@REGISTRY.add(
    "label_upsert",
    "SELECT o_orderkey, CASE WHEN o_totalprice > 200000 THEN 'review' ELSE o_orderpriority END AS label FROM orders WHERE o_orderstatus = 'F' OR o_totalprice > 200000",
)
def label_upsert(spark: SparkSession, base: str) -> DataFrame:
    """Existing labels, replaced and extended by new ones."""
    orders = table(spark, base, "orders")
    old = orders.where("o_orderstatus = 'F'").select("o_orderkey", F.col("o_orderpriority").alias("label"))
    return g.upsert(old, orders.where("o_totalprice > 200000").select("o_orderkey", F.lit("review").alias("label")), ["o_orderkey"])
