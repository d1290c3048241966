"""Queries p1, p3, p4 and p6 to p9 on the project's tables, with oracle SQL where SQL can state them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.numbers import subscriber
from tidemark.llm.garbled import restore_text, train_dictionaries
from tidemark.llm.leakage import leaked_passages
from tidemark.llm.mixing import mix
from tidemark.llm.near_duplicates import class_links, expand_copies, near_duplicates
from tidemark.llm.nearest_time import nearest_in_time
from tidemark.llm.neighbours import nearest_vectors
from tidemark.llm.repetition import fertility, fertility_bands, repeated_sequences, repeated_shares
from tidemark.plans.registry import Registry
from tidemark.sources.tables import once_per_key, table

REGISTRY = Registry()
TOLERANCE_MS = 5000


SQL_NEAREST = """
WITH v AS (SELECT "index", vector::DOUBLE[] AS v FROM loaded_corpus WHERE "index" IS NOT NULL AND len(vector) = 64 AND len(list_filter(vector, lambda x: x <> 0)) > 0),
u AS (SELECT "index", list_transform(v, lambda x: x / sqrt(list_dot_product(v, v))) AS u FROM v),
c AS (SELECT a."index", b."index" AS neighbour, list_dot_product(a.u, b.u) AS cosine FROM u a JOIN u b ON a."index" <> b."index"),
r AS (SELECT *, row_number() OVER (PARTITION BY "index" ORDER BY cosine DESC, neighbour) AS rank FROM c)
"""


@REGISTRY.add("p3_found", SQL_NEAREST + 'SELECT DISTINCT least("index", neighbour) AS index_a, greatest("index", neighbour) AS index_b FROM r WHERE rank <= 10 AND cosine >= 0.90')
def p3_found(spark: SparkSession, base: str) -> DataFrame:
    """Pairs of entries of which one is among the other's 10 most similar, with a cosine of 0.90 or more."""
    near = nearest_vectors(table(spark, base, "loaded_corpus"), k=10, min_cosine=0.90)
    return near.select(F.least("index", "neighbour").alias("index_a"), F.greatest("index", "neighbour").alias("index_b")).distinct()


@REGISTRY.add("p3_search", SQL_NEAREST + 'SELECT "index", neighbour, rank::INTEGER AS rank, round(cosine, 6) AS cosine FROM r WHERE rank <= 10 AND "index" % 50 = 0')
def p3_search(spark: SparkSession, base: str) -> DataFrame:
    """The 10 most similar entries, at any cosine, of each entry whose index is divisible by 50."""
    return nearest_vectors(table(spark, base, "loaded_corpus"), k=10, queries="index % 50 = 0", probes=16).select("index", "neighbour", "rank", F.round("cosine", 6).alias("cosine"))


SQL_PAIRS = """
WITH x AS (SELECT DISTINCT reference, time_stamp AS ts, message_type, substr(regexp_replace(imsi, '[^0-9]', '', 'g'), 1, 15) AS who FROM ss7_transaction WHERE reference IS NOT NULL),
y AS (SELECT * FROM x WHERE length(who) = 15 AND who <> '000000000000000' AND ts IS NOT NULL),
r AS (SELECT l.reference AS mt_reference, s.reference AS sri_reference, abs(l.ts - s.ts) AS gap_ms,
  row_number() OVER (PARTITION BY l.reference ORDER BY abs(l.ts - s.ts), s.ts, s.reference) AS k
  FROM y l JOIN y s ON s.who = l.who AND l.message_type = 2 AND s.message_type = 1 AND s.ts BETWEEN l.ts - 5000 AND l.ts + 5000)
"""


def _requests_and_responses(spark: SparkSession, base: str) -> tuple[DataFrame, DataFrame]:
    def once(kind: int) -> DataFrame:
        rows = table(spark, base, "ss7_transaction").where(F.col("message_type") == kind)
        return once_per_key(rows, "reference", "create_date", ("time_stamp", "imsi")).select(F.col("reference").alias("id"), F.col("time_stamp").alias("at"), subscriber(F.col("imsi")).alias("entity"))

    return once(2), once(1)


@REGISTRY.add("p4_found", SQL_PAIRS + "SELECT mt_reference, sri_reference FROM r WHERE k = 1")
def p4_found(spark: SparkSession, base: str) -> DataFrame:
    """Each MT request with the routing response of its subscriber nearest in time."""
    return p4_nearest_response(spark, base).where("sri_reference IS NOT NULL").select("mt_reference", "sri_reference")


@REGISTRY.add(
    "p4_nearest_response",
    SQL_PAIRS + "SELECT q.reference AS mt_reference, r.sri_reference, r.gap_ms FROM (SELECT reference FROM x WHERE message_type = 2) q LEFT JOIN r ON r.mt_reference = q.reference AND r.k = 1",
)
def p4_nearest_response(spark: SparkSession, base: str) -> DataFrame:
    """The same for all MT requests; those without a response in reach bear nulls."""
    requests, responses = _requests_and_responses(spark, base)
    paired = nearest_in_time(requests, responses, TOLERANCE_MS)
    return paired.select(F.col("id").alias("mt_reference"), F.col("match_id").alias("sri_reference"), F.col("gap").alias("gap_ms"))


def _restored(spark: SparkSession, base: str) -> DataFrame:
    rows = table(spark, base, "smpp_transaction").where("smpp_operation = 4 AND app_dest_port IS NULL")
    records = once_per_key(rows, "reference", "create_date", ("content", "dcs"))
    return restore_text(records, train_dictionaries(rows, table(spark, base, "documents")))


@REGISTRY.add("p6_found")
def p6_found(spark: SparkSession, base: str) -> DataFrame:
    """Records whose text was read in another encoding than it was written in."""
    return _restored(spark, base).where("chain IS NOT NULL").select("reference")


@REGISTRY.add("p6_restored")
def p6_restored(spark: SparkSession, base: str) -> DataFrame:
    """The same with the declared text, the chain of encodings and the text as written."""
    return _restored(spark, base).where("chain IS NOT NULL")


SQL_W = "list_filter(string_split(lower(regexp_replace(coalesce(text, ''), '[^A-Za-z0-9]+', ' ', 'g')), ' '), lambda w: w <> '')"
SQL_RUNS = """array_to_string(ws[i:i + 11], ' ')"""
SQL_LEAKS = f"""
WITH i AS (SELECT item_id, {SQL_W} AS ws FROM eval_item WHERE item_id IS NOT NULL),
d AS (SELECT doc_id, {SQL_W} AS ws FROM documents WHERE doc_id IS NOT NULL),
iw AS (SELECT DISTINCT item_id, {SQL_RUNS} AS p FROM (SELECT item_id, ws, unnest(range(1, len(ws) - 10)) AS i FROM i WHERE len(ws) >= 12)),
dw AS (SELECT DISTINCT doc_id, {SQL_RUNS} AS p FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 10)) AS i FROM d WHERE len(ws) >= 12))
"""


@REGISTRY.add("p7_found", SQL_LEAKS + "SELECT DISTINCT item_id, doc_id FROM iw JOIN dw USING (p)")
def p7_found(spark: SparkSession, base: str) -> DataFrame:
    """Items and documents that share at least 12 consecutive words."""
    return p7_leaks(spark, base).select("item_id", "doc_id")


@REGISTRY.add(
    "p7_leaks",
    SQL_LEAKS + "SELECT item_id, doc_id, count(DISTINCT p) AS windows, count(DISTINCT p) / any_value(n)::DOUBLE AS share FROM iw JOIN dw USING (p) JOIN (SELECT item_id, count(*) AS n FROM iw GROUP BY item_id) USING (item_id) GROUP BY item_id, doc_id",
)
def p7_leaks(spark: SparkSession, base: str) -> DataFrame:
    """The same with how much of the item leaked."""
    return leaked_passages(table(spark, base, "eval_item"), table(spark, base, "documents"))


def _mix(spark: SparkSession, base: str) -> tuple[DataFrame, DataFrame]:
    return mix(table(spark, base, "documents"), table(spark, base, "mix_target"))


@REGISTRY.add("p8_mix")
def p8_mix(spark: SparkSession, base: str) -> DataFrame:
    """The mix: each used document with its tokens and repeats."""
    return _mix(spark, base)[0]


@REGISTRY.add("p8_shares")
def p8_shares(spark: SparkSession, base: str) -> DataFrame:
    """The mix's sources: target and actual shares, budgets and epochs."""
    return _mix(spark, base)[1]


SQL_REPEATS = f"""
WITH d AS (SELECT doc_id, {SQL_W} AS ws FROM documents WHERE doc_id IS NOT NULL),
g AS (SELECT doc_id, len(ws) AS n_words, array_to_string(ws[i:i + 4], ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM d WHERE len(ws) >= 5)),
s AS (SELECT doc_id, any_value(n_words) AS n_words, (count(*) - count(DISTINCT g)) / count(*)::DOUBLE AS repeated_share FROM g GROUP BY doc_id)
"""


@REGISTRY.add("p9_found", SQL_REPEATS + "SELECT doc_id FROM s WHERE n_words >= 50 AND repeated_share >= 0.3")
def p9_found(spark: SparkSession, base: str) -> DataFrame:
    """Documents of at least 50 words in which at least 0.30 of the five-word sequences are repeats."""
    return repeated_sequences(table(spark, base, "documents")).select("doc_id").distinct()


@REGISTRY.add(
    "p9_repetition",
    SQL_REPEATS + "SELECT d.doc_id, len(d.ws) AS n_words, s.repeated_share FROM d LEFT JOIN s ON s.doc_id = d.doc_id",
)
def p9_repetition(spark: SparkSession, base: str) -> DataFrame:
    """The share of repeated five-word sequences of every document, without any screening."""
    return repeated_shares(table(spark, base, "documents").where("doc_id IS NOT NULL"))


@REGISTRY.add("p9_fertility")
def p9_fertility(spark: SparkSession, base: str) -> DataFrame:
    """Tokeniser fertility of every document, with the measures outside its language's or script's band, and whether the bands reject it."""
    measured = fertility_bands(fertility(table(spark, base, "documents")))
    return measured.select("doc_id", "band", "tokens", F.round("chars_per_token", 6).alias("chars_per_token"), F.round("byte_share", 6).alias("byte_share"), F.round("token_entropy", 6).alias("token_entropy"), F.round("missing_bits", 6).alias("missing_bits"), F.round("limit", 6).alias("limit"), "rejected", F.concat_ws(",", "odd").alias("odd"))


SQL_SETS = """
WITH m AS (SELECT record_id, any_value(text) AS text FROM canonical_row WHERE record_id IS NOT NULL GROUP BY record_id),
s AS (SELECT record_id, ws FROM (SELECT record_id, list_sort(list_distinct(list_filter(string_split(lower(regexp_replace(coalesce(text, ''), '[^A-Za-z0-9]+', ' ', 'g')), ' '), lambda w: length(w) >= 3))) AS ws FROM m) WHERE len(ws) >= 12),
c AS (SELECT ws, row_number() OVER (ORDER BY ws) AS id, count(*) AS copies FROM s GROUP BY ws),
x AS (SELECT id, len(ws) AS n, unnest(ws) AS w FROM c),
f AS (SELECT w, count(*) AS df FROM x GROUP BY w),
r AS (SELECT id, n, w, row_number() OVER (PARTITION BY id ORDER BY df, w) AS k FROM x JOIN f USING (w)),
p AS (SELECT * FROM r WHERE k <= n - ceil(0.75 * n) + 1),
k AS (SELECT DISTINCT a.id AS a, b.id AS b FROM p a JOIN p b ON a.w = b.w AND a.id < b.id AND 4 * least(a.n, b.n) >= 3 * greatest(a.n, b.n)),
l AS (SELECT a, b FROM (SELECT k.a, k.b, len(list_intersect(ca.ws, cb.ws)) AS o, len(ca.ws) + len(cb.ws) AS t FROM k JOIN c ca ON ca.id = k.a JOIN c cb ON cb.id = k.b) WHERE 7 * o >= 3 * t),
h AS (SELECT record_id, id, copies FROM s JOIN c USING (ws))
"""


def _near_duplicates(spark: SparkSession, base: str) -> tuple[DataFrame, DataFrame]:
    return near_duplicates(table(spark, base, "canonical_row").where("text IS NOT NULL"), threshold="0.75")


@REGISTRY.add(
    "p1_found",
    SQL_SETS
    + """SELECT least(a.record_id, b.record_id) AS record_id_a, greatest(a.record_id, b.record_id) AS record_id_b FROM l JOIN h a ON a.id = l.a JOIN h b ON b.id = l.b
UNION ALL SELECT a.record_id, b.record_id FROM h a JOIN h b ON a.id = b.id AND a.record_id < b.record_id""",
)
def p1_found(spark: SparkSession, base: str) -> DataFrame:
    """Pairs of messages of which the common words are at least 0.75 of the words in either."""
    members, links = _near_duplicates(spark, base)
    return expand_copies(members, links, "record_id").select(F.col("a").alias("record_id_a"), F.col("b").alias("record_id_b"))


@REGISTRY.add(
    "p1_classes",
    SQL_SETS + "SELECT record_id, copies, coalesce(e.links, 0) AS links FROM h LEFT JOIN (SELECT id, count(*) AS links FROM (SELECT a AS id FROM l UNION ALL SELECT b FROM l) GROUP BY id) e USING (id)",
)
def p1_classes(spark: SparkSession, base: str) -> DataFrame:
    """Each eligible message with the copies of its class and the number of other classes alike to it."""
    members, links = _near_duplicates(spark, base)
    return class_links(members, links, "record_id").select("record_id", "copies", "links")
