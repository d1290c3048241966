"""Queries of ranking metrics, correlations and descriptive statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import evaluation as ev
from tidemark.operators import ranking as r
from tidemark.plans.registry import Registry
from tidemark.sources.tables import table

REGISTRY = Registry()

#: orders as a scored set: high totals against the label "urgent".
SQL_S = """s AS (SELECT o_orderkey AS id, o_totalprice AS score, CASE WHEN o_orderpriority LIKE '1%' THEN 1 ELSE 0 END AS y FROM orders)"""


def scored(spark: SparkSession, base: str) -> DataFrame:
    return table(spark, base, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").cast("double").alias("score"), F.col("o_orderpriority").startswith("1").cast("int").alias("y"))


@REGISTRY.add(
    "average_precision",
    f"""WITH {SQL_S}, t AS (SELECT score, count(*) AS n, sum(y) AS p FROM s GROUP BY score), c AS (SELECT *, sum(n) OVER w AS nu, sum(p) OVER w AS pu FROM t WINDOW w AS (ORDER BY score DESC))
SELECT round(sum(p * pu / nu::DOUBLE) / sum(p), 9) AS average_precision FROM c""",
)
def average_precision(spark: SparkSession, base: str) -> DataFrame:
    """Area under the precision-recall steps."""
    return r.average_precision(scored(spark, base)).select(F.round("average_precision", 9).alias("average_precision"))


@REGISTRY.add(
    "roc_auc",
    f"""WITH {SQL_S}, k AS (SELECT y, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0::DOUBLE AS r FROM s)
SELECT round((sum(r) FILTER (y = 1) - count(*) FILTER (y = 1) * (count(*) FILTER (y = 1) + 1) / 2.0::DOUBLE) / (count(*) FILTER (y = 1) * count(*) FILTER (y = 0)), 9) AS roc_auc FROM k""",
)
def roc_auc(spark: SparkSession, base: str) -> DataFrame:
    """Area under the ROC curve, by ranks."""
    return r.roc_auc(scored(spark, base)).select(F.round("roc_auc", 9).alias("roc_auc"))


@REGISTRY.add(
    "log_loss",
    f"""WITH {SQL_S}, m AS (SELECT min(score) AS lo, max(score) AS hi FROM s), p AS (SELECT y, least(greatest((score - lo) / (hi - lo), 1e-15), 1 - 1e-15) AS p FROM s, m)
SELECT round(avg(-CASE WHEN y = 1 THEN ln(p) ELSE ln(1 - p) END), 6) AS log_loss FROM p""",
)
def log_loss(spark: SparkSession, base: str) -> DataFrame:
    """Log loss of scores scaled to 0..1."""
    return r.log_loss(scored(spark, base)).select(F.round("log_loss", 6).alias("log_loss"))


@REGISTRY.add(
    "precision_at_k",
    f"""WITH {SQL_S}, k AS (SELECT y, row_number() OVER (ORDER BY score DESC, id) AS i FROM s)
SELECT w.k::BIGINT AS k, (SELECT avg(y)::DOUBLE FROM k WHERE i <= w.k AND w.k <= (SELECT count(*) FROM s)) AS precision FROM (VALUES (10), (100), (1000), (100000000)) w(k)""",
)
def precision_at_k(spark: SparkSession, base: str) -> DataFrame:
    """Precision among the k highest scores."""
    return r.precision_at_k(scored(spark, base), [10, 100, 1000, 100_000_000])


@REGISTRY.add(
    "precision_at_percentiles",
    f"""WITH {SQL_S}, k AS (SELECT y, row_number() OVER (ORDER BY score DESC, id) AS i FROM s), n AS (SELECT count(*) AS n FROM s)
SELECT w.p::DOUBLE AS percent, round_even(n * w.p / 100.0::DOUBLE, 0)::BIGINT AS k, (SELECT avg(y)::DOUBLE FROM k WHERE i <= round_even(n * w.p / 100.0::DOUBLE, 0)) AS precision FROM n, (VALUES (0.1), (0.5), (1.0), (5.0)) w(p)""",
)
def precision_at_percentiles(spark: SparkSession, base: str) -> DataFrame:
    """Precision among the top shares of scores."""
    return r.precision_at_percentiles(scored(spark, base), [0.1, 0.5, 1.0, 5.0])


SQL_RANK = lambda c: f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0::DOUBLE"


@REGISTRY.add(
    "spearman_matrix",
    f"""WITH x AS (SELECT l_quantity AS a, l_extendedprice AS b, l_discount AS c FROM lineitem), k AS (SELECT {SQL_RANK('a')} AS a, {SQL_RANK('b')} AS b, {SQL_RANK('c')} AS c FROM x)
SELECT 'l_quantity' AS a, 'l_extendedprice' AS b, round(corr(k.a, k.b), 6) AS rho FROM k UNION ALL SELECT 'l_quantity', 'l_discount', round(corr(k.a, k.c), 6) FROM k UNION ALL SELECT 'l_extendedprice', 'l_discount', round(corr(k.b, k.c), 6) FROM k""",
)
def spearman_matrix(spark: SparkSession, base: str) -> DataFrame:
    """Rank correlations of three columns."""
    pairs = ev.correlation_pairs(table(spark, base, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"])
    return pairs.select("a", "b", F.round("rho", 6).alias("rho"))


@REGISTRY.add(
    "mutual_information",
    f"""WITH {SQL_S}, k AS (SELECT y, (rank() OVER (ORDER BY score) - 1) * 10 // count(*) OVER () AS bin FROM s), c AS (SELECT bin, y, count(*)::DOUBLE AS k FROM k GROUP BY bin, y),
t AS (SELECT k, sum(k) OVER (PARTITION BY bin) AS a, sum(k) OVER (PARTITION BY y) AS b, sum(k) OVER () AS n FROM c)
SELECT round(sum(k / n * ln(k * n / (a * b))), 9) AS mi FROM t""",
)
def mutual_information(spark: SparkSession, base: str) -> DataFrame:
    """Mutual information of binned scores and labels."""
    return r.mutual_information(scored(spark, base), "score", "y").select(F.round("mi", 9).alias("mi"))


@REGISTRY.add(
    "confusion_f1",
    """WITH p AS (SELECT CAST(o_orderpriority LIKE '1%' AS VARCHAR) AS t, CAST(o_totalprice > 150000 AS VARCHAR) AS q FROM orders),
l AS (SELECT t AS label FROM p UNION SELECT q FROM p),
c AS (SELECT label, count(*) FILTER (t = label) AS support, count(*) FILTER (t = label AND q = label) AS tp, count(*) FILTER (t <> label AND q = label) AS fp, count(*) FILTER (t = label AND q <> label) AS fn FROM l, p GROUP BY label)
SELECT label, support, tp, fp, fn, CASE WHEN tp + fp > 0 THEN tp / (tp + fp)::DOUBLE ELSE 0.0 END AS precision, CASE WHEN tp + fn > 0 THEN tp / (tp + fn)::DOUBLE ELSE 0.0 END AS recall, CASE WHEN tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn)::DOUBLE ELSE 0.0 END AS f1 FROM c""",
)
def confusion_f1(spark: SparkSession, base: str) -> DataFrame:
    """Precision, recall and F1 of each class."""
    rows = table(spark, base, "orders").select(F.col("o_orderpriority").startswith("1").alias("y"), (F.col("o_totalprice") > 150000).alias("predicted"))
    return r.confusion(rows, "y", "predicted")


@REGISTRY.add(
    "accuracy_macro_f1",
    """WITH p AS (SELECT o_orderpriority LIKE '1%' AS t, o_totalprice > 150000 AS q FROM orders),
c AS (SELECT label, count(*) FILTER (t = label AND q = label) AS tp, count(*) FILTER (t <> label AND q = label) AS fp, count(*) FILTER (t = label AND q <> label) AS fn FROM (VALUES (true), (false)) l(label), p GROUP BY label)
SELECT (SELECT avg((t = q)::INT) FROM p) AS accuracy, avg(2 * tp / (2 * tp + fp + fn)::DOUBLE) AS macro_f1 FROM c""",
)
def accuracy_macro_f1(spark: SparkSession, base: str) -> DataFrame:
    """The share of right predictions, and the mean F1 of the classes."""
    from tidemark.operators.evaluation import accuracy_macro

    return accuracy_macro(confusion_f1(spark, base))


@REGISTRY.add(
    "segment_average_precision",
    """WITH s AS (SELECT o_orderstatus AS g, o_totalprice::DOUBLE AS score, (o_orderpriority LIKE '1%')::INT AS y FROM orders),
b AS (SELECT g, score, y FROM s UNION ALL SELECT 'all', score, y FROM s),
t AS (SELECT g, score, count(*) AS n, sum(y) AS p FROM b GROUP BY g, score),
u AS (SELECT g, n, p, sum(n) OVER w AS nu, sum(p) OVER w AS pu FROM t WINDOW w AS (PARTITION BY g ORDER BY score DESC))
SELECT g AS segment, round(sum(p * pu / nu::DOUBLE) / sum(p), 9) AS average_precision FROM u GROUP BY g""",
)
def segment_average_precision(spark: SparkSession, base: str) -> DataFrame:
    """Average precision overall and of each segment."""
    from tidemark.operators.evaluation import by_source

    rows = table(spark, base, "orders").select("o_orderstatus", F.col("o_totalprice").cast("double").alias("score"), F.col("o_orderpriority").startswith("1").cast("int").alias("y"))
    return by_source(rows, "o_orderstatus").select("segment", F.round("average_precision", 9).alias("average_precision"))


@REGISTRY.add(
    "source_drift",
    """WITH m AS (SELECT o_orderpriority AS source, avg(o_totalprice) FILTER (o_orderstatus = 'F') / 100000 AS shared, avg(o_totalprice) FILTER (o_orderstatus = 'O') / 100000 AS separate FROM orders GROUP BY source)
SELECT source, round(shared, 6) AS shared, round(separate, 6) AS separate, separate - shared >= 0.0 AS justified FROM m WHERE shared IS NOT NULL AND separate IS NOT NULL""",
)
def source_drift(spark: SparkSession, base: str) -> DataFrame:
    """Whether a model of its own is justified for each source, from a table of metrics."""
    from tidemark.operators.evaluation import drift

    kind = F.when(F.col("o_orderstatus") == "F", "shared").when(F.col("o_orderstatus") == "O", "separate")
    metrics = table(spark, base, "orders").select(F.col("o_orderpriority").alias("source"), kind.alias("kind"), F.col("o_totalprice").cast("double").alias("v")).where("kind IS NOT NULL").groupBy("source", "kind").agg((F.avg("v") / 100000).alias("value")).withColumn("at", F.lit(1))
    return drift(metrics, gap=0.0).withColumns({c: F.round(c, 6) for c in ("shared", "separate")})


@REGISTRY.add(
    "metrics_by_segment",
    """WITH s AS (SELECT o_orderstatus AS g, o_totalprice AS score, CASE WHEN o_orderpriority LIKE '1%' THEN 1 ELSE 0 END AS y FROM orders)
SELECT coalesce(g, 'all') AS segment, count(*) AS n, sum(y)::BIGINT AS positives, round(avg(score) FILTER (y = 1), 4) AS mean_positive, round(avg(score) FILTER (y = 0), 4) AS mean_negative FROM s GROUP BY ROLLUP (g)""",
)
def metrics_by_segment(spark: SparkSession, base: str) -> DataFrame:
    """Mean scores of both classes, per segment and overall."""
    rows = table(spark, base, "orders").select(F.col("o_orderstatus").alias("g"), F.col("o_totalprice").cast("double").alias("score"), F.col("o_orderpriority").startswith("1").cast("int").alias("y"))
    return rows.rollup("g").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("positives"), F.round(F.avg(F.when(F.col("y") == 1, F.col("score"))), 4).alias("mean_positive"), F.round(F.avg(F.when(F.col("y") == 0, F.col("score"))), 4).alias("mean_negative")).select(F.coalesce("g", F.lit("all")).alias("segment"), "n", "positives", "mean_positive", "mean_negative")


@REGISTRY.add(
    "describe_by_label",
    """SELECT l_returnflag AS label, count(l_quantity) AS n, round(avg(l_quantity), 6) AS mean, round(stddev_samp(l_quantity), 6) AS std, min(l_quantity)::DOUBLE AS min, quantile_cont(l_quantity::DOUBLE, 0.5) AS p50, quantile_cont(l_quantity::DOUBLE, 0.9) AS p90, quantile_cont(l_quantity::DOUBLE, 0.99) AS p99, max(l_quantity)::DOUBLE AS max FROM lineitem GROUP BY label""",
)
def describe_by_label(spark: SparkSession, base: str) -> DataFrame:
    """Count, moments and exact quantiles per label."""
    items = table(spark, base, "lineitem").select(F.col("l_returnflag").alias("label"), F.col("l_quantity").cast("double").alias("q"))
    stats = items.groupBy("label").agg(F.count("q").alias("n"), F.round(F.avg("q"), 6).alias("mean"), F.round(F.stddev_samp("q"), 6).alias("std"), F.min("q").alias("min"), F.max("q").alias("max"))
    at = r.exact_quantiles(items, "q", [0.5, 0.9, 0.99], ["label"]).groupBy("label").pivot("p", [0.5, 0.9, 0.99]).agg(F.first("quantile")).toDF("label", "p50", "p90", "p99")
    return stats.join(at, "label")


@REGISTRY.add("percentile_threshold", "WITH t AS (SELECT quantile_cont(o_totalprice::DOUBLE, 0.995) AS t FROM orders) SELECT o_orderkey FROM orders, t WHERE o_totalprice >= t.t")
def percentile_threshold(spark: SparkSession, base: str) -> DataFrame:
    """Rows at or above an exact percentile of their score."""
    orders = table(spark, base, "orders")
    limit = r.exact_quantiles(orders, "o_totalprice", [0.995]).select(F.col("quantile").alias("t"))
    return orders.join(F.broadcast(limit)).where("o_totalprice >= t").select("o_orderkey")


@REGISTRY.add(
    "crosstab",
    """SELECT o_orderpriority AS priority, count(*) FILTER (o_orderstatus = 'F') AS "F", count(*) FILTER (o_orderstatus = 'O') AS "O", count(*) FILTER (o_orderstatus = 'P') AS "P" FROM orders GROUP BY priority""",
)
def crosstab(spark: SparkSession, base: str) -> DataFrame:
    """Two-way counts."""
    counts = table(spark, base, "orders").groupBy(F.col("o_orderpriority").alias("priority")).pivot("o_orderstatus", ["F", "O", "P"]).count()
    return counts.fillna(0)


@REGISTRY.add("class_balance", "SELECT lower(trim(lang)) AS lang, count(*) AS n FROM documents GROUP BY 1")
def class_balance(spark: SparkSession, base: str) -> DataFrame:
    """Rows of each class, nulls included."""
    return table(spark, base, "documents").groupBy(F.lower(F.trim("lang")).alias("lang")).agg(F.count(F.lit(1)).alias("n"))


@REGISTRY.add("run_totals", 'SELECT source, count(*) AS rows, count(DISTINCT record_id) AS messages, count(*) FILTER (text_decode_failed) AS failed, max("timestamp") AS latest FROM canonical_row GROUP BY source')
def run_totals(spark: SparkSession, base: str) -> DataFrame:
    """Totals of each source: rows, messages, failures and the latest time, as a retraining check needs."""
    return table(spark, base, "canonical_row").groupBy("source").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("record_id").alias("messages"), F.count_if("text_decode_failed").alias("failed"), F.max("timestamp").alias("latest"))


@REGISTRY.add(
    "plausibility_means",
    f"""WITH {SQL_S} SELECT round(avg(score), 4) AS mean_score, round(avg(score) FILTER (y = 1), 4) AS mean_flagged, round(avg(score) FILTER (y = 0), 4) AS mean_clean, count(*) FILTER (y = 1) AS n_flagged, count(*) FILTER (y = 0) AS n_clean FROM s""",
)
def plausibility_means(spark: SparkSession, base: str) -> DataFrame:
    """Mean scores of all, flagged and clean rows."""
    return ev.plausibility(scored(spark, base)).select(*[F.round(c, 4).alias(c) for c in ("mean_score", "mean_flagged", "mean_clean")], "n_flagged", "n_clean")


@REGISTRY.add(
    "label_lift",
    f"""WITH {SQL_S}, k AS (SELECT y, row_number() OVER (ORDER BY score, id) AS i, count(*) OVER () AS n FROM s), b AS (SELECT (i - 1) * 10 // n AS bin, y FROM k)
SELECT bin, count(*) AS rows, round(avg(y) / (SELECT avg(y) FROM s), 6) AS lift FROM b GROUP BY bin""",
)
def label_lift(spark: SparkSession, base: str) -> DataFrame:
    """How much more frequent positives are in each tenth of the scores."""
    return ev.lift(scored(spark, base)).select("bin", "rows", F.round("lift", 6).alias("lift"))


@REGISTRY.add(
    "boundedness",
    """WITH x AS (SELECT l_returnflag AS g, l_quantity AS a, l_extendedprice AS b FROM lineitem), m AS (SELECT min(a) AS a0, max(a) AS a1 FROM x), i AS (SELECT x.* FROM x, m WHERE a > a0 AND a < a1),
k AS (SELECT g, rank() OVER (PARTITION BY g ORDER BY a) + (count(*) OVER (PARTITION BY g, a) - 1) / 2.0::DOUBLE AS ra, rank() OVER (PARTITION BY g ORDER BY b) + (count(*) OVER (PARTITION BY g, b) - 1) / 2.0::DOUBLE AS rb FROM i),
s AS (SELECT g, corr(ra, rb) AS rho, count(*) AS n FROM k GROUP BY g) SELECT round(sum(rho * n) / sum(n), 6) AS rho, sum(n)::BIGINT AS rows FROM s""",
)
def boundedness(spark: SparkSession, base: str) -> DataFrame:
    """Rank correlation among rows off a column's bounds, weighted over strata."""
    rows = table(spark, base, "lineitem").select(F.col("l_returnflag").alias("g"), F.col("l_quantity").alias("a"), F.col("l_extendedprice").alias("b"))
    return ev.interior_correlation(rows, "a", "b", "g").select(F.round("rho", 6).alias("rho"), "rows")


@REGISTRY.add("last_value_per_group", "SELECT o_custkey, arg_max(o_totalprice, (o_orderdate, o_orderkey))::DOUBLE AS last_price FROM orders GROUP BY o_custkey")
def last_value_per_group(spark: SparkSession, base: str) -> DataFrame:
    """The last value of each key's series."""
    return table(spark, base, "orders").groupBy("o_custkey").agg(F.max_by(F.col("o_totalprice").cast("double"), F.struct("o_orderdate", "o_orderkey")).alias("last_price"))


@REGISTRY.add(
    "redundant_groups",
    f"""WITH x AS (SELECT l_quantity AS a, l_extendedprice AS b, l_tax AS c, l_quantity + 10 * l_tax AS d FROM lineitem), k AS (SELECT {SQL_RANK('a')} AS a, {SQL_RANK('b')} AS b, {SQL_RANK('c')} AS c, {SQL_RANK('d')} AS d FROM x),
p AS (SELECT 'a' AS u, 'b' AS v, corr(a, b) AS r FROM k UNION ALL SELECT 'a', 'c', corr(a, c) FROM k UNION ALL SELECT 'a', 'd', corr(a, d) FROM k UNION ALL SELECT 'b', 'c', corr(b, c) FROM k UNION ALL SELECT 'b', 'd', corr(b, d) FROM k UNION ALL SELECT 'c', 'd', corr(c, d) FROM k),
e AS (SELECT u, v FROM p WHERE abs(r) >= 0.8 UNION SELECT v, u FROM p WHERE abs(r) >= 0.8 UNION SELECT unnest(['a', 'b', 'c', 'd']), unnest(['a', 'b', 'c', 'd']))
SELECT e1.u AS feature, min(e3.v) AS grp FROM e e1 JOIN e e2 ON e2.u = e1.v JOIN e e3 ON e3.u = e2.v GROUP BY e1.u""",
)
def redundant_groups(spark: SparkSession, base: str) -> DataFrame:
    """Columns grouped by strong rank correlation."""
    rows = table(spark, base, "lineitem").select(F.col("l_quantity").alias("a"), F.col("l_extendedprice").alias("b"), F.col("l_tax").alias("c"), (F.col("l_quantity") + 10 * F.col("l_tax")).alias("d"))
    return ev.redundant_groups(rows, ["a", "b", "c", "d"], 0.8)
