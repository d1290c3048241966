"""Passages of held-out items that occur in a corpus."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.words import words
from tidemark.runtime import broadcast_if_small, materialize

MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
SLICE_WORDS = 200_000  # words whose shingles leave Python at once, but for a single longer text


def leaked_passages(items: DataFrame, docs: DataFrame, *, run: int = 12, n: int = 5) -> DataFrame:
    """Where a document contains ``run`` consecutive words of an item, whatever the layout.

    ``items`` has ``item_id, text`` and ``docs`` has ``doc_id, text``; other
    columns are ignored. Returns one row per (item_id, doc_id) that share such
    a passage: ``windows`` (how many of the item's ``run``-word windows the
    document contains) and ``share`` (that over all the item's windows). Ids
    that are null and texts that are null, blank or of fewer than ``run`` words
    have no windows, hence no rows. Repeated rows of an id count as one text
    each; a window counts once per pair however often it occurs.

    Prefix-filtered set join. A window is the set of its ``run-n+1`` ``n``-word
    shingles, all of which a containing document must have, so a prefix of one
    shingle is enough: the rarest in the corpus. Every document is cut once, and
    the places of items' shingles in it are written (their dictionary is
    broadcast if it is small by count, shuffled if not); frequencies are counted
    over all of them, and then only those that are some window's prefix are
    joined. A hit fixes where the window would have to lie in the document; windows
    that would overhang its ends are dropped (length and positional bounds),
    and the rest are verified word for word.
    """
    per_window = run - n + 1
    w = lambda df, k: df.where(F.col(k).isNotNull()).select(k, words(F.col("text")).alias("ws")).where(F.size("ws") >= run)
    # texts of one id are kept apart by number until the pairs
    item_words = materialize(w(items.select("item_id", "text").distinct(), "item_id").select("item_id", "ws", F.monotonically_increasing_id().alias("text_no")), "items")
    item_shingles = shingle_places(item_words, ["text_no", "ws"], n)
    known = broadcast_if_small(item_shingles.select("sh").distinct(), 1_000_000)
    doc_words = w(docs, "doc_id")

    # where the items' shingles are in the whole corpus, and how rare that makes them
    places = materialize(shingle_places(doc_words, ["doc_id"], n).join(known, "sh", "left_semi"), "places")
    rarity = places.groupBy("sh").agg(F.count(F.lit(1)).alias("df"))
    ranked = item_shingles.join(broadcast_if_small(rarity, 500_000), "sh", "left").select("text_no", "ws", "at", "sh", F.coalesce("df", F.lit(0)).alias("df"))
    starts = F.sequence(F.greatest(F.lit(0), F.col("at") - per_window + 1), F.least(F.col("at"), F.size("ws") - run))
    windows = (
        ranked.select("text_no", "at", "sh", "df", F.explode(starts).alias("start"))
        .groupBy("text_no", "start")
        .agg(F.min(F.struct("df", "at", "sh")).alias("p"))
        .where("p.df > 0")  # a shingle that no document has: the window is nowhere
        .select("text_no", "start", F.col("p.sh").alias("sh"), (F.col("p.at") - F.col("start")).alias("offset"))
    )
    passages = lambda start: F.concat_ws(" ", F.slice("ws", F.col(start) + 1, run))
    every = item_words.withColumn("start", F.explode(F.sequence(F.lit(0), F.size("ws") - run))).withColumn("passage", passages("start"))
    totals = every.groupBy("item_id").agg(F.count_distinct("passage").alias("all_windows"))
    prefixes = materialize(windows.join(every, ["text_no", "start"]).select("item_id", "sh", "offset", "passage").distinct(), "prefixes")

    met = places.join(broadcast_if_small(prefixes, 200_000), "sh")
    begin = F.col("at") - F.col("offset")
    hits = materialize(met.where((begin >= 0) & (begin + run <= F.col("n_words"))).select("doc_id", "item_id", begin.alias("begin"), "passage"), "hits")
    suspects = docs.select("doc_id", "text").join(broadcast_if_small(hits.select("doc_id").distinct(), 200_000), "doc_id", "left_semi")
    cut = suspects.select("doc_id", words(F.col("text")).alias("ws"))  # once per text that was hit, before it meets its hits
    held = cut.join(broadcast_if_small(hits, 200_000), "doc_id").where((F.col("begin") + run <= F.size("ws")) & (passages("begin") == F.col("passage")))
    pairs = held.groupBy("item_id", "doc_id").agg(F.count_distinct("passage").alias("windows"))
    return pairs.join(broadcast_if_small(totals), "item_id").select("item_id", "doc_id", "windows", (F.col("windows") / F.col("all_windows")).alias("share"))


def shingle_places(df: DataFrame, keep: list[str], n: int) -> DataFrame:
    """The ``n``-word shingles of ``ws``, one per row: ``*keep, n_words, at, sh``.

    ``sh`` is a rolling combination of the words' 64-bit hashes, computed for
    whole Arrow batches at a time and sent on in slices of bounded size. Equal
    shingles have equal ``sh``; whoever needs certainty compares the words.
    """
    types = dict(df.dtypes)
    schema = ", ".join([*(f"`{c}` {types[c]}" for c in keep), "n_words int, at int, sh long"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lengths = np.diff(b.column("_h").offsets.to_numpy()) if b.num_rows else np.zeros(0, np.int64)
            cuts = np.flatnonzero(np.diff(np.cumsum(lengths) // SLICE_WORDS)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(lengths)]):
                if hi > lo:
                    yield _roll(b.slice(lo, hi - lo), keep, n)

    return df.select(*keep, F.transform("ws", lambda w: F.xxhash64(w)).alias("_h")).mapInArrow(run, schema)


def _roll(b: pa.RecordBatch, keep: list[str], n: int) -> pa.RecordBatch:
    lists = b.column("_h")
    lengths = np.diff(lists.offsets.to_numpy()).astype(np.int64)
    words_ = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    at = np.arange(len(words_)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    starts = np.flatnonzero(at + n <= lengths[row])
    sh = np.zeros(len(starts), np.uint64)
    for j in range(n):
        sh = sh * MULTIPLIER + words_[starts + j]
    row, at = row[starts], at[starts]
    pick = pa.array(row)
    return pa.RecordBatch.from_arrays([*(b.column(c).take(pick) for c in keep), pa.array(lengths[row].astype(np.int32)), pa.array(at.astype(np.int32)), pa.array(sh.view(np.int64))], names=[*keep, "n_words", "at", "sh"])
