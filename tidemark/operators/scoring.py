"""Combining scores into a verdict with reasons, as expressions over a scored frame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.5


def confidence(cold_start: Column, undecodable: Column) -> Column:
    """Completeness of what was known: 90, less 40 without history and 20 without text, at least 10."""
    return F.greatest(F.lit(90) - F.when(cold_start, 40).otherwise(0) - F.when(undecodable, 20).otherwise(0), F.lit(10))


def reason_codes(contributions: Column, cold_start: Column, undecodable: Column, escalated: Column, top: int = 5) -> Column:
    """Codes in fixed order; features count only with a positive contribution among the ``top`` largest."""
    positive = F.transform(F.filter(F.slice(contributions, 1, top), lambda x: x["contribution"] > 0), lambda x: x["feature"])
    has = lambda *names: F.arrays_overlap(positive, F.array(*[F.lit(n) for n in names]))
    codes = [
        F.lit("KNOWN_SPAM_PATTERN"),
        F.when(has("sender_repeat_content_ratio_1hr"), "REPEATED_CONTENT"),
        F.when(has("sender_msgs_last_1hr", "sender_msgs_last_5min"), "HIGH_SENDER_VELOCITY"),
        F.when(cold_start, "NEW_SENDER_LOW_HISTORY"),
        F.when(undecodable, "UNDECODABLE_CONTENT"),
        F.when(escalated, "ANOMALY_SIGNAL_ESCALATION"),
    ]
    return F.array_compact(F.array(*codes))


def decide(df: DataFrame) -> DataFrame:
    """Adds ``decision_score, prediction, action, risk_score, escalated`` from ``pattern_score`` and a nullable ``fusion_score``."""
    score = F.coalesce("fusion_score", "pattern_score")
    fraud = score >= THRESHOLD
    return df.withColumns({
        "decision_score": score, "prediction": F.when(fraud, "FRAUD").otherwise("NOT_FRAUD"), "action": F.when(fraud, "BLOCK").otherwise("PASS"), "risk_score": F.bround(F.col("pattern_score") * 100).cast("int"),
        "escalated": F.col("fusion_score").isNotNull() & fraud & (F.col("pattern_score") < THRESHOLD),
    })
