"""Queries of models, clusterings and scoring."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.ml import clusters as cl
from tidemark.ml import forest as fo
from tidemark.ml import models as md
from tidemark.operators import scoring as sc
from tidemark.operators import windows as w
from tidemark.plans.registry import Registry
from tidemark.plans.window_queries import frame
from tidemark.sources.tables import table

REGISTRY = Registry()
COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def lines(spark: SparkSession, base: str) -> DataFrame:
    """Lines as a labelled feature frame; returned ones are the positives."""
    return table(spark, base, "lineitem").select(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("id"), *[F.col(c).cast("double").alias(c) for c in COLUMNS], (F.col("l_returnflag") == "R").cast("int").alias("y"), "l_returnflag", "l_linenumber")


@REGISTRY.add("isolation_forest")
def isolation_forest(spark: SparkSession, base: str) -> DataFrame:
    """Anomaly scores of all lines."""
    df = lines(spark, base)
    return fo.score_isolation_forest(df, fo.fit_isolation_forest(df, COLUMNS, key="id")).select("id", F.round("anomaly_score", 6).alias("anomaly_score"))


@REGISTRY.add("anomaly_attribution")
def anomaly_attribution(spark: SparkSession, base: str) -> DataFrame:
    """What each feature adds to the scores of the most anomalous lines (a top-k report)."""
    df = lines(spark, base)
    model = fo.fit_isolation_forest(df, COLUMNS, key="id")
    top = fo.score_isolation_forest(df, model).orderBy(F.desc("anomaly_score"), "id").limit(20)
    return fo.attribute(top, model, "id").select("id", "feature", F.round("contribution", 6).alias("contribution"))


@REGISTRY.add("pca_reduce")
def pca_reduce(spark: SparkSession, base: str) -> DataFrame:
    """The first two principal components of four standardised columns."""
    reduced, _ = md.reduce_vectors(lines(spark, base), COLUMNS, 2)
    return reduced.select("id", *[F.round(F.abs(F.col("reduced")[i]), 6).alias(f"pc{i + 1}") for i in (0, 1)])


@REGISTRY.add("logistic_flags")
def logistic_flags(spark: SparkSession, base: str) -> DataFrame:
    """Weights of flags against a label."""
    flags = lines(spark, base).select("id", "y", *[(F.col("l_linenumber") == i).cast("int").alias(f"line_{i}") for i in range(1, 5)])
    names = [f"line_{i}" for i in range(1, 5)]
    model = md.fit_logistic(flags, names)
    return spark.createDataFrame([(n, round(float(v), 4)) for n, v in zip(names, model.coefficients.toArray())], "flag string, weight double")


@REGISTRY.add("out_of_fold")
def out_of_fold(spark: SparkSession, base: str) -> DataFrame:
    """Each line's score by the model that did not see it."""
    return md.out_of_fold(lines(spark, base), "id", COLUMNS).select("id", "y", F.round("score", 4).alias("score"))


@REGISTRY.add("boosted_trees")
def boosted_trees(spark: SparkSession, base: str) -> DataFrame:
    """Boosted trees' scores of the held-out lines."""
    split = md.stratified_split(lines(spark, base), "id", "y", 0.2)
    model = md.fit_boosted(split.where("NOT is_test"), COLUMNS)
    return md.probability(model.transform(split.where("is_test")), "score").select("id", "y", F.round("score", 4).alias("score"))


@REGISTRY.add("multiclass_trees")
def multiclass_trees(spark: SparkSession, base: str) -> DataFrame:
    """Predicted return flags of lines whose order is held out."""
    split = md.group_split(lines(spark, base).withColumn("order", F.split("id", "-")[0]), "order", 0.2)
    model = md.fit_multiclass(split.where("NOT is_test"), COLUMNS, "l_returnflag")
    labels = F.array(*[F.lit(v) for v in model.stages[0].labels])
    return model.transform(split.where("is_test")).select("id", labels[F.col("prediction").cast("int")].alias("predicted"))


@REGISTRY.add("tree_attribution")
def tree_attribution(spark: SparkSession, base: str) -> DataFrame:
    """What each column adds to every line's margin under boosted trees; with ``base`` it adds up to ``margin``."""
    df = lines(spark, base)
    return fo.attribute_boosted(df, md.fit_boosted(df, COLUMNS), COLUMNS, "id").select("id", "feature", F.round("contribution", 6).alias("contribution"), F.round("score", 6).alias("margin"), F.round("base", 6).alias("base"))


@REGISTRY.add(
    "joint_frame",
    """WITH m AS (SELECT record_id, any_value(text) AS text, any_value(source) AS source FROM canonical_row WHERE record_id IS NOT NULL GROUP BY record_id),
x AS (SELECT record_id, length(coalesce(text, ''))::DOUBLE AS chars, (source = 'SMPP')::INT::DOUBLE AS smpp FROM m)
SELECT record_id, 33 AS places, round((chars - avg(chars) OVER ()) / stddev_samp(chars) OVER (), 6) AS chars, round((smpp - avg(smpp) OVER ()) / stddev_samp(smpp) OVER (), 6) AS is_smpp FROM x""",
)
def joint_frame(spark: SparkSession, base: str) -> DataFrame:
    """Text vectors reduced to eight numbers, sender windows, length, flags and sources of every message, scaled together."""
    from tidemark.functions.content import flags
    from tidemark.ml.encoder import encode_distinct
    from tidemark.runtime import materialize
    from tidemark.sources.tables import messages

    m = materialize(messages(spark, base, "sender_id", "text", "timestamp", "source"), "messages")
    seen = w.sender_repeats(m.select(F.col("record_id").alias("seq"), F.col("sender_id").alias("sender"), "text", w.micros(F.col("timestamp")).alias("at"))).withColumnRenamed("seq", "record_id")
    known = encode_distinct(m.select("record_id", "text", "source").join(seen, "record_id", "left"), dim=64)
    read = {"chars": F.length(F.coalesce("text", F.lit("")))} | flags(F.col("text"))
    numbers = ["msgs_long", "repeat_ratio", *read]
    joint, _, names = md.joint_frame(known.withColumns(read).select("record_id", "vector", "source", *numbers), "vector", numbers, "source")
    at = lambda name: F.round(F.col("features")[names.index(name)], 6)
    return joint.select("record_id", F.size("features").alias("places"), at("chars").alias("chars"), at("is_SMPP").alias("is_smpp"))


@REGISTRY.add("flag_weights")
def flag_weights(spark: SparkSession, base: str) -> DataFrame:
    """The weights of the content flags against the source, and how many messages score at or above the 0.5 threshold."""
    from tidemark.functions.content import flags
    from tidemark.sources.tables import messages

    names = list(flags(F.col("text")))
    m = messages(spark, base, "text", "source").withColumns({n: F.coalesce(c.cast("int"), F.lit(0)) for n, c in flags(F.col("text")).items()}).withColumn("y", (F.col("source") == "SS7").cast("int"))
    model = md.fit_logistic(m, names)
    above = m.where(md.logistic_score(model, names) >= sc.THRESHOLD).count()
    return spark.createDataFrame([(n, round(float(v), 4), above) for n, v in zip(names, model.coefficients.toArray())], "flag string, weight double, above_threshold long")


@REGISTRY.add("tfidf")
def tfidf(spark: SparkSession, base: str) -> DataFrame:
    """TF-IDF vectors of the documents, as norms and sizes of the fitted vocabulary."""
    docs = table(spark, base, "documents").where("text IS NOT NULL").select("doc_id", "text")
    model = md.text_features().fit(docs)
    from pyspark.ml.functions import vector_to_array

    v = vector_to_array("tfidf")
    return md.tfidf(docs, model).select("doc_id", F.size(v).alias("terms"), F.size(F.filter(v, lambda x: x != 0)).alias("present"))


def pool(spark: SparkSession, base: str) -> DataFrame:
    """Whole vectors, all of their numbers."""
    return table(spark, base, "embeddings").select(F.col("vec_id").alias("key"), F.col("embedding").alias("vector"))


@REGISTRY.add("dbscan")
def dbscan(spark: SparkSession, base: str) -> DataFrame:
    """Density clusters of vectors at a distance suggested for them: the 30th percentile, since the 90th makes one cluster of nearly all."""
    vectors = pool(spark, base)
    return cl.dbscan(vectors, cl.suggest_eps(vectors, 4, 0.3) or 0.0, 4)


@REGISTRY.add("hdbscan")
def hdbscan(spark: SparkSession, base: str) -> DataFrame:
    """Hierarchical density clusters of vectors."""
    return cl.hdbscan(pool(spark, base))


@REGISTRY.add(
    "kdistance_eps",
    """WITH e AS (SELECT vec_id AS k, embedding::DOUBLE[] AS v FROM embeddings), d AS (SELECT a.k, list_distance(a.v, b.v) AS d FROM e a, e b QUALIFY row_number() OVER (PARTITION BY a.k ORDER BY list_distance(a.v, b.v)) = 5)
SELECT round(quantile_cont(d, 0.9), 6) AS eps FROM d""",
)
def kdistance_eps(spark: SparkSession, base: str) -> DataFrame:
    """The suggested distance for density clusters of whole vectors."""
    return spark.createDataFrame([(round(cl.suggest_eps(pool(spark, base), 5), 6),)], "eps double")


@REGISTRY.add(
    "connected_components",
    """WITH RECURSIVE e AS (SELECT DISTINCT c_custkey AS a, c_custkey + 7 * (1 + c_nationkey % 3) AS b FROM customer), u AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
r AS (SELECT a AS id, a AS c FROM u UNION SELECT u.b, r.c FROM r JOIN u ON u.a = r.id WHERE r.c < u.b)
SELECT id, min(c) AS component FROM (SELECT id, c FROM r UNION ALL SELECT a, a FROM u) GROUP BY id""",
)
def connected_components(spark: SparkSession, base: str) -> DataFrame:
    """Components of a graph of customers."""
    c = table(spark, base, "customer")
    return cl.connected_components(c.select(F.col("c_custkey").alias("a"), (F.col("c_custkey") + 7 * (1 + F.col("c_nationkey") % 3)).alias("b")))


SQL_SCORED = """s AS (SELECT l_orderkey, l_linenumber, l_discount * 10 AS pattern_score, CASE WHEN l_tax > 0.02 THEN l_tax * 10 END AS fusion_score, l_returnflag = 'N' AS cold, l_linenumber = 1 AS undecodable FROM (SELECT * REPLACE (l_discount::DOUBLE AS l_discount, l_tax::DOUBLE AS l_tax) FROM lineitem))"""


@REGISTRY.add(
    "fusion_decision",
    f"""WITH {SQL_SCORED} SELECT l_orderkey, l_linenumber, CASE WHEN coalesce(fusion_score, pattern_score) >= 0.5 THEN 'FRAUD' ELSE 'NOT_FRAUD' END AS prediction, CASE WHEN coalesce(fusion_score, pattern_score) >= 0.5 THEN 'BLOCK' ELSE 'PASS' END AS action,
 round_even(pattern_score * 100, 0)::INT AS risk_score, fusion_score IS NOT NULL AND fusion_score >= 0.5 AND pattern_score < 0.5 AS escalated, greatest(90 - CASE WHEN cold THEN 40 ELSE 0 END - CASE WHEN undecodable THEN 20 ELSE 0 END, 10) AS confidence FROM s""",
)
def fusion_decision(spark: SparkSession, base: str) -> DataFrame:
    """Verdict, action, risk and confidence from two scores."""
    s = table(spark, base, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_discount").cast("double") * 10).alias("pattern_score"), F.when(F.col("l_tax").cast("double") > 0.02, F.col("l_tax").cast("double") * 10).alias("fusion_score"), (F.col("l_returnflag") == "N").alias("cold"), (F.col("l_linenumber") == 1).alias("undecodable"))
    return sc.decide(s).select("l_orderkey", "l_linenumber", "prediction", "action", "risk_score", "escalated", sc.confidence(F.col("cold"), F.col("undecodable")).alias("confidence"))


@REGISTRY.add("pattern_scores")
def pattern_scores(spark: SparkSession, base: str) -> DataFrame:
    """From messages to windows, a logistic model on content flags, its contributions and reason codes."""
    from tidemark.functions.content import flags

    rows = frame(spark, base)
    names = {"msgs_long": "sender_msgs_last_1hr", "msgs_short": "sender_msgs_last_5min", "repeat_ratio": "sender_repeat_content_ratio_1hr"}
    f = w.sender_window_features(rows).withColumnsRenamed(names).withColumn("y", flags(F.col("text"))["has_url"])
    columns = list(names.values())
    model = md.fit_logistic(f, columns)
    cold = F.col("age_days") == 0
    reasons = sc.reason_codes(md.logistic_contributions(model, columns), cold, F.coalesce("text", F.lit("")) == "", F.lit(False))
    return f.select(F.col("seq").alias("record_id"), F.round(md.logistic_score(model, columns), 4).alias("score"), F.array_join(reasons, ",").alias("reasons"))


@REGISTRY.add("encode_texts")
def encode_texts(spark: SparkSession, base: str) -> DataFrame:
    """Messages with the vector of their text, as its number of non-zero parts; each text is encoded once."""
    from tidemark.ml.encoder import encode_distinct
    from tidemark.sources.tables import messages

    m = messages(spark, base, "text")
    return encode_distinct(m, dim=64).select("record_id", F.size(F.filter("vector", lambda x: x != 0)).alias("parts"))


@REGISTRY.add("approximate_pairs")
def approximate_pairs(spark: SparkSession, base: str) -> DataFrame:
    """Similar embeddings by locality-sensitive hashing."""
    from tidemark.ml.encoder import approximate_pairs as find

    return find(table(spark, base, "embeddings"), 0.4, key="vec_id", vector="embedding", buckets=2.0, tables=6)


@REGISTRY.add("dominance_ablation")
def dominance_ablation(spark: SparkSession, base: str) -> DataFrame:
    """How far anomaly scores follow each group of columns."""
    from tidemark.operators.evaluation import dominance

    return dominance(lines(spark, base), {"size": COLUMNS[:2], "rates": COLUMNS[2:]}, key="id").select("left_out", F.round("rho", 4).alias("rho"))


@REGISTRY.add("permutation_importance")
def permutation_importance(spark: SparkSession, base: str) -> DataFrame:
    """What average precision loses when a column is shuffled."""
    df = lines(spark, base)
    model = md.fit_logistic(df, COLUMNS)
    return md.permutation_importance(df, md.logistic_score(model, COLUMNS), COLUMNS).select("feature", F.round("drop", 4).alias("drop"))
