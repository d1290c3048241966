"""Pairing records of two tables with the nearest in time of the same entity."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.runtime import materialize


def nearest_in_time(left: DataFrame, right: DataFrame, tolerance: int, *, rings: int = 3) -> DataFrame:
    """For each left row the right row of the same entity with the least |time difference|.

    Both frames have ``entity`` (any type), ``at`` (long, e.g. ms) and ``id``;
    other columns are ignored. Expanding-ring join: time is cut into buckets of
    ``tolerance / 2**(rings-1)``; a left row meets the right rows of its own and
    the two adjacent buckets, and a match no farther than one bucket width is
    provably the nearest, because everything outside those buckets is farther.
    Left rows without such a match go on to buckets of double width, up to
    ``tolerance``, whose ring is exact for whatever is left.

    Returns ``id, match_id, gap`` with one row per left row; ``match_id`` and
    ``gap`` are null where nothing lies within ``tolerance`` (inclusive). Of two
    equally near rows the earlier wins, then the smaller id. Rows with a null
    entity or time match nothing; a left row with a null id is kept. Repeated
    left ids are answered each on their own time; equal rows collapse.

    Scale: left rows without an entity or time are set aside and join nothing.
    Right rows are reduced to one per entity and instant and written once for
    all rings. The join key is (entity, bucket), so an entity with a third
    of all rows is spread over its time span, and within a key both sides are
    merged in order of time: each left row looks at the right row before and
    the one after it, so no pairs are made however full a bucket is.
    """
    width = max(1, -(-tolerance // 2 ** (rings - 1)))
    asked = left.select("id", "entity", F.col("at").cast("long").alias("at"))
    nobody = F.col("entity").isNull() | F.col("at").isNull()
    answered = [asked.where(nobody).distinct().select("id", F.lit(None).cast(dict(right.dtypes)["id"]).alias("match_id"), F.lit(None).cast("long").alias("gap"))]
    todo = asked.where(~nobody).distinct()
    pool = right.select("id", "entity", F.col("at").cast("long").alias("at")).where(~nobody & F.col("id").isNotNull())
    pool = materialize(pool.groupBy("entity", "at").agg(F.min("id").alias("id_r")), "pool")
    while True:
        last = width >= tolerance
        found = _ring(todo, pool, min(width, tolerance), tolerance if last else width)
        if last:
            answered.append(found)
            break
        found = materialize(found, "ring")
        answered.append(found.where("match_id IS NOT NULL"))
        todo = found.where("match_id IS NULL").select("id", "entity", "at")
        width *= 2
    result = answered[0]
    for part in answered[1:]:
        result = result.unionByName(part.select("id", "match_id", "gap"))
    return result


def _ring(todo: DataFrame, pool: DataFrame, width: int, reach: int) -> DataFrame:
    bucket = F.floor(F.col("at") / F.lit(width)).cast("long")
    beside = pool.select("entity", "at", F.explode(F.array(*[bucket + i for i in (-1, 0, 1)])).alias("b"), F.struct("at", "id_r").alias("r"))
    both = todo.select("id", "entity", "at", bucket.alias("b"), F.lit(True).alias("asks")).unionByName(beside, allowMissingColumns=True)
    # of equal times a right row counts as before: right rows (asks null) come first
    key = Window.partitionBy("entity", "b").rowsBetween(Window.unboundedPreceding, 0)
    before = F.last("r", ignorenulls=True).over(key.orderBy(F.col("at").asc(), F.col("asks").asc_nulls_first()))
    after = F.last("r", ignorenulls=True).over(key.orderBy(F.col("at").desc(), F.col("asks").desc_nulls_last()))
    met = both.withColumn("before", before).withColumn("after", after).where("asks")
    gap = lambda c: F.abs(F.col("at") - F.col(f"{c}.at"))
    near = [F.when(gap(c) <= reach, F.struct(gap(c).alias("gap"), F.col(f"{c}.at").alias("at_r"), F.col(f"{c}.id_r").alias("id_r"))) for c in ("before", "after")]
    return met.select("id", "entity", "at", F.least(*near).alias("m")).select("id", "entity", "at", F.col("m.id_r").alias("match_id"), F.col("m.gap").alias("gap"))
