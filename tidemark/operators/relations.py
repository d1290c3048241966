"""Joins and set operations with the checks and null rules they need here."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.runtime import broadcast_if_small


def require_unique(df: DataFrame, keys: list[str], what: str) -> None:
    """Raise if a key occurs twice."""
    twice = df.groupBy(*keys).count().where("count > 1").limit(5).collect()
    if twice:
        raise ValueError(f"{what} is not unique by {keys}: {[tuple(r)[:-1] for r in twice]}")


def enrich(left: DataFrame, lookup: DataFrame, keys: list[str], *, check: bool = True) -> DataFrame:
    """Left join to a lookup that has each key once; columns of the lookup replace those of the left."""
    if check:
        require_unique(lookup, keys, "the lookup")
    taken = [c for c in lookup.columns if c not in keys]
    return left.drop(*taken).join(broadcast_if_small(lookup), keys, "left")


def one_to_one(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """A join of frames that both have each key once."""
    require_unique(left, keys, "the left side")
    require_unique(right, keys, "the right side")
    return left.join(right, keys, how)


def as_of(left: DataFrame, right: DataFrame, entity: str, values: list[str], *, ttl: int) -> DataFrame:
    """Each left row with the entity's last right row at or before its time, unless older than ``ttl``.

    Both have ``entity`` and ``at`` (long, same unit). Of several right rows at
    one time the largest by values counts. Null entities and times match
    nothing. Both sides are cut into slabs of ``ttl``, so only a slab and the
    one before meet: a union ordered by time, no pairs, and no entity in one
    task.
    """
    names = [f"asof_{v}" for v in values]
    slab = lambda c: F.floor(F.col(c) / F.lit(ttl)).cast("long")
    known = F.col(entity).isNotNull() & F.col("at").isNotNull()
    facts = right.where(F.col(entity).isNotNull() & F.col("at").isNotNull()).groupBy(entity, "at").agg(F.max(F.struct(*values)).alias("_v"))
    facts = facts.select(entity, "at", F.explode(F.array(slab("at"), slab("at") + 1)).alias("_slab"), F.struct(F.col("at").alias("t"), "_v").alias("_f"), F.lit(0).alias("_kind"))
    asked = left.where(known).withColumn("_slab", slab("at")).withColumn("_kind", F.lit(1))
    both = asked.unionByName(facts, allowMissingColumns=True)
    last = F.last("_f", ignorenulls=True).over(Window.partitionBy(entity, "_slab").orderBy("at", "_kind").rowsBetween(Window.unboundedPreceding, 0))
    matched = both.withColumn("_m", last).where("_kind = 1")
    fresh = F.col("at") - F.col("_m.t") <= ttl
    found = matched.select(*left.columns, *[F.when(fresh, F.col(f"_m._v.{v}")).alias(n) for v, n in zip(values, names)])
    return found.unionByName(left.where(~known), allowMissingColumns=True)


def frequent(df: DataFrame, column: str, least: int) -> DataFrame:
    """Rows whose value occurs at least ``least`` times."""
    kept = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= least).select(column)
    return df.join(broadcast_if_small(kept), column, "left_semi")


def unknown_keys(df: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key does not occur in ``known``."""
    return df.join(known.select(*keys).distinct(), keys, "left_anti")


def union_all(*frames: DataFrame) -> DataFrame:
    """All rows, aligned by name, with nulls for absent columns."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
