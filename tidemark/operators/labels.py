"""Labels from rules, content and clusters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.content import keyword_label

# --- fixed values ----------------------------------------------------------------------
WHITELIST_PREFIX = "SW_"
INCOHERENT_TEXT_RATIO = 0.5
INCOHERENT_ORIGINATOR_RATIO = 0.5
NO_FRAUD = "not_fraud"
# ---------------------------------------------------------------------------------------


def rule_evaluated(decision: Column, rule: Column) -> Column:
    """The rule engine judged the row: decision 0 or 1, and no whitelist rule."""
    return F.coalesce(decision.try_cast("double").isin(0.0, 1.0), F.lit(False)) & ~F.coalesce(F.startswith(rule, F.lit(WHITELIST_PREFIX)), F.lit(False))


def rule_flagged(evaluated: Column, fraud_type: Column) -> Column:
    """Three-valued: spam or not where evaluated, else null."""
    return F.when(evaluated, F.coalesce(fraud_type == "spam", F.lit(False)))


def confirmed(label: Column) -> Column:
    """A reviewer's label stands: not null and not blank."""
    return F.coalesce(F.trim(label) != "", F.lit(False))


def suggest(rows: Column, texts: Column, originators: Column, sample: Column) -> Column:
    """A cluster's suggested label: coherence first, then keywords, then shape."""
    incoherent = (texts / rows >= INCOHERENT_TEXT_RATIO) & (originators / rows >= INCOHERENT_ORIGINATOR_RATIO)
    shape = F.when(texts <= 2, F.when(originators == 1, "flooding_burst").otherwise("templated_multi_sender_campaign")).otherwise("unclassified_review_needed")
    return F.when((rows > 0) & incoherent, "incoherent_no_pattern").otherwise(F.coalesce(keyword_label(sample), shape))


def cluster_summary(members: DataFrame, samples: int = 3) -> DataFrame:
    """``cluster, n_rows, n_unique_texts, n_unique_originators, sample_texts`` of each cluster, noise (-1) included.

    ``members`` has ``cluster, key, text, originator``. Samples are the texts of
    the keys first by hash, joined by `` ||| ``.
    """
    stats = members.groupBy("cluster").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(F.coalesce("text", F.lit(""))).alias("n_unique_texts"), F.count_distinct("originator").alias("n_unique_originators"))
    picked = members.select("cluster", F.struct(F.md5(F.col("key").cast("string")).alias("h"), F.col("key").cast("string").alias("k"), F.coalesce("text", F.lit("")).alias("t")).alias("s"))
    first = _first_n(picked, samples)
    joined = first.select("cluster", F.array_join(F.transform("s", lambda x: x["t"]), " ||| ").alias("sample_texts"))
    return stats.join(joined, "cluster")


def _first_n(picked: DataFrame, n: int) -> DataFrame:
    ranked = picked.withColumn("_i", F.row_number().over(Window.partitionBy("cluster").orderBy("s"))).where(F.col("_i") <= n)
    return ranked.groupBy("cluster").agg(F.array_sort(F.collect_list("s")).alias("s"))


def label_clusters(members: DataFrame, template: DataFrame) -> DataFrame:
    """``key, label`` of the members of confirmed clusters.

    Raises if a confirmed cluster does not occur. Blank labels are not
    confirmed; noise is never labelled. ``template`` has one row per cluster.
    """
    sure = template.where(confirmed(F.col("label"))).select("cluster", F.trim("label").alias("label"))
    unknown = [r[0] for r in sure.join(members.select("cluster").distinct(), "cluster", "left_anti").select("cluster").limit(20).collect()]
    if unknown:
        raise ValueError(f"confirmed clusters that do not exist: {unknown}")
    return members.where("CAST(cluster AS STRING) <> '-1'").join(sure, "cluster").select("key", "label")
