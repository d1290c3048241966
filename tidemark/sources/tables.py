"""Readers of the engine's tables (one Parquet file or folder per name)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """The table ``name`` below ``base``; column pruning and filters reach its scan."""
    return spark.read.parquet(f"{base}/{name}.parquet")


def messages(spark: SparkSession, base: str, *columns: str) -> DataFrame:
    """canonical_row with every message once.

    A message ingested several times bears the same values, so the row of the
    earliest ``ingested_at`` is kept (ties: any, the values being equal). Rows
    without ``record_id`` name no message and are left out. Only ``columns``
    are carried through the shuffle by ``record_id``.
    """
    return once_per_key(table(spark, base, "canonical_row"), "record_id", "ingested_at", columns)


def once_per_key(df: DataFrame, key: str, order: str, columns: tuple[str, ...]) -> DataFrame:
    """One row per non-null ``key``: that of the least ``order`` (nulls last).

    Columns other than ``key`` and ``columns`` are dropped. Aggregates map-side
    before the shuffle, so copies in one file partition never travel.
    """
    carried = [c for c in columns if c != key]
    if not carried:
        return df.where(F.col(key).isNotNull()).select(key).distinct()
    late = F.col(order).isNull().cast("int")
    best = F.min_by(F.struct(*carried), F.struct(late, order))
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(best.alias("_r")).select(key, *[F.col("_r")[c].alias(c) for c in carried])
