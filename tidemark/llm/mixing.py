"""Mixing sources to target weights by tokens."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.tokens import TOKENIZERS, byte_bpe
from tidemark.runtime import broadcast_if_small, materialize

BUCKET_ROWS = 20_000


def source_name(source: Column) -> Column:
    """A source's name without regard to case and outer blanks; null where nothing is left."""
    name = F.lower(F.trim(source))
    return F.when(name != "", name)


def count_tokens(docs: DataFrame, key: str, *, tokenizers: str = TOKENIZERS) -> DataFrame:
    """``docs`` with ``tokens``, the length of ``text`` under a public byte-level vocabulary.

    Null and empty texts have 0 tokens; the text column is dropped. One narrow
    Arrow pass over whole texts.
    """
    kept = [c for c in docs.columns if c not in ("text", "tokens")]
    types = dict(docs.dtypes)
    schema = ", ".join(f"`{c}` {types[c]}" for c in kept) + ", tokens long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(tokenizers)
        for b in batches:
            n = [len(bpe.encode_ordinary(t)) if t else 0 for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), pa.array(n, pa.int64())], names=[*kept, "tokens"])

    return docs.select(*kept, "text").mapInArrow(run, schema)


def mix(docs: DataFrame, targets: DataFrame, *, total: int | None = None, seed: int = 17, tokenizers: str = TOKENIZERS) -> tuple[DataFrame, DataFrame]:
    """Repeat and cut documents so that sources reach their shares of ``total`` tokens.

    ``docs`` has ``doc_id, text, source``; ``targets`` has ``source,
    target_share, max_repeats``; names count without case and outer blanks, and
    further columns are ignored. ``total`` defaults to the tokens of all
    documents of listed sources. A source's budget is
    ``round(target_share * total)``, and never above ``max_repeats`` times its
    tokens; null or negative shares and repeats count as 0.

    Returns ``(picked, shares)``: ``picked`` has ``doc_id, source, tokens,
    repeats`` for each document used at least once. A source is used in whole
    epochs as far as its budget goes, and of the next epoch the documents
    whose prefix sum still fits. Documents are never cut, so a source stays
    under its budget by less than the document that would cross it. ``shares``
    has one row per listed source, also where it has no documents:
    ``source, target_share, max_repeats, documents, available_tokens,
    budget_tokens, mixed_tokens, actual_share, epochs``; ``actual_share`` is of
    all mixed tokens, null if there are none. Sources that are not listed, and
    null ones, take no part. A source listed twice counts with its first row in
    order of share and repeats. Rows with equal ``doc_id`` are documents each.

    Order within a source is by a seeded hash of the id, so it is random yet
    repeatable. The hash range is cut evenly into buckets of about 20,000 rows
    whatever the source's size; sums of buckets are prefix-summed in one tiny
    window, and rows only within their bucket. No source ever meets in a task.
    """
    wanted = targets.select(source_name(F.col("source")).alias("source"), F.greatest(F.coalesce("target_share", F.lit(0.0)), F.lit(0.0)).alias("target_share"), F.greatest(F.coalesce(F.col("max_repeats").cast("long"), F.lit(0)), F.lit(0)).alias("max_repeats"))
    wanted = wanted.where("source IS NOT NULL").groupBy("source").agg(F.min(F.struct("target_share", "max_repeats")).alias("t")).select("source", "t.target_share", "t.max_repeats")
    named = docs.select("doc_id", "text", source_name(F.col("source")).alias("source")).join(broadcast_if_small(wanted.select("source"), 10_000), "source", "left_semi")
    counted = materialize(count_tokens(named, "doc_id", tokenizers=tokenizers), "tokens")
    sizes = counted.groupBy("source").agg(F.count(F.lit(1)).alias("documents"), F.sum("tokens").alias("available_tokens"))
    if total is None:
        total = sizes.agg(F.sum("available_tokens")).first()[0] or 0
    budget = F.least(F.round(F.col("target_share") * F.lit(float(total))).cast("long"), F.col("max_repeats") * F.col("available_tokens"))
    plan = wanted.join(sizes, "source", "left").fillna(0, ["documents", "available_tokens"]).withColumn("budget_tokens", budget)
    plan = materialize(plan.withColumn("whole", F.when(F.col("available_tokens") > 0, F.floor(F.col("budget_tokens") / F.col("available_tokens"))).otherwise(0).cast("long")), "plan")

    keyed = counted.join(broadcast_if_small(plan.select("source", "documents", "available_tokens", "budget_tokens", "whole"), 10_000), "source").withColumn("_key", F.xxhash64(F.lit(seed), "doc_id"))
    buckets = F.ceil(F.col("documents") / BUCKET_ROWS)
    keyed = keyed.withColumn("_bucket", F.floor((F.col("_key").cast("double") / F.lit(2.0**64) + 0.5) * buckets).cast("long"))
    before = Window.partitionBy("source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = keyed.groupBy("source", "_bucket").agg(F.sum("tokens").alias("_sum")).withColumn("_before", F.coalesce(F.sum("_sum").over(before), F.lit(0))).drop("_sum")
    inside = Window.partitionBy("source", "_bucket").orderBy("_key", "doc_id", "tokens").rowsBetween(Window.unboundedPreceding, 0)
    summed = keyed.withColumn("_run", F.sum("tokens").over(inside)).join(offsets, ["source", "_bucket"])
    part = F.col("budget_tokens") - F.col("whole") * F.col("available_tokens")
    extra = ((part > 0) & (F.col("_before") + F.col("_run") <= part)).cast("long")
    picked = materialize(summed.select("doc_id", "source", "tokens", (F.col("whole") + extra).alias("repeats")).where("repeats > 0"), "picked")

    mixed = picked.groupBy("source").agg(F.sum(F.col("tokens") * F.col("repeats")).alias("mixed_tokens"), F.max("repeats").alias("epochs"))
    shares = plan.join(mixed, "source", "left").fillna(0, ["mixed_tokens", "epochs"])
    grand = mixed.agg(F.sum("mixed_tokens").alias("_all"))
    shares = shares.join(F.broadcast(grand)).withColumn("actual_share", F.when(F.col("_all") > 0, F.col("mixed_tokens") / F.col("_all")))
    return picked, shares.select("source", "target_share", "max_repeats", "documents", "available_tokens", "budget_tokens", "mixed_tokens", "actual_share", "epochs")
