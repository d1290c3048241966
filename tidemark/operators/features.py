"""Preparing feature columns: logs, gates, flags, buckets, scaling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_known(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per column a ``_known`` indicator, and 0 in place of null and NaN."""
    ok = lambda c: F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    return df.withColumns({f"{c}_known": ok(c).cast("double") for c in columns} | {c: F.when(ok(c), F.col(c)).otherwise(0.0) for c in columns})


def gate(df: DataFrame, ratio: str, count: str, least: int) -> DataFrame:
    """A ratio over fewer than ``least`` rows is not known."""
    return df.withColumn(ratio, F.when(F.col(count) >= least, F.col(ratio)))


def one_hot(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    """A 0/1 column for each of a fixed list of values; null is none of them."""
    return df.withColumns({f"{column}_{v}": F.coalesce(F.col(column) == v, F.lit(False)).cast("double") for v in values})


def right_closed(value: Column, edges: list[float]) -> Column:
    """The number, as text, of the bucket (edge before, edge]; null for null."""
    out = F.lit(str(len(edges)))
    for i in reversed(range(len(edges))):
        out = F.when(value <= edges[i], str(i)).otherwise(out)
    return F.when(value.isNotNull(), out)


def min_max(df: DataFrame, column: str, out: str) -> DataFrame:
    """Scaled to 0..1 by the column's range; 0 for a constant column. The range is one broadcast row."""
    span = df.agg(F.min(column).alias("_lo"), F.max(column).alias("_hi"))
    scaled = F.when(F.col("_hi") > F.col("_lo"), (F.col(column) - F.col("_lo")) / (F.col("_hi") - F.col("_lo"))).otherwise(F.when(F.col(column).isNotNull(), 0.0))
    return df.join(F.broadcast(span)).withColumn(out, scaled).drop("_lo", "_hi")


def add_missing(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Columns that are absent, with a default."""
    return df.withColumns({c: F.lit(v) for c, v in defaults.items() if c not in df.columns})


def key_rest(key: Column) -> Column:
    """What follows the first ``|`` of a key; the whole key without one."""
    return F.regexp_replace(key, r"^[^|]*\|", "")
