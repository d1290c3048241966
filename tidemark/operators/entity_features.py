"""One row per entity with features of each of hundreds of event types."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLOCK = 2048  # entities held in one dense block
MAX_TYPES = 4096  # bound of the type dictionary, which travels with the task


def entity_features(events: DataFrame, types: list[str], as_of: str) -> DataFrame:
    """Count, recency and different items of each event type, one row per entity.

    ``events`` has ``entity`` (string), ``kind`` (string), ``at`` (timestamp
    without zone) and ``item`` (string). For each type ``t`` of ``types`` (at
    most 4096, each once) returns ``n_t`` (events), ``days_t`` (days from the
    last ``at`` to ``as_of``, null without a dated event) and ``items_t``
    (different non-null items); besides ``n_total``, and ``n_other`` for events
    of a null or unlisted type, which have no columns of their own. A null
    entity has no row. Dates after ``as_of`` give negative days. An entity with
    only other events keeps its row of zeros. Columns of ``events`` beyond the
    four are ignored.

    Spark reduces events to one row per (entity, type): partial counts before
    the shuffle, different items by an even hash on (entity, type, item). What
    then meets at an entity is at most one row per type, however hot it is.
    Entities are hash-bucketed and sorted; each task encodes (entity, type)
    into indices of a dense block, fills it with ``bincount`` and a maximum
    scatter, and emits the block as Arrow feature columns.
    """
    if len(types) > MAX_TYPES or len(set(types)) != len(types):
        raise ValueError(f"types must be distinct and at most {MAX_TYPES}")
    codes = {t: i for i, t in enumerate(types)}
    width = len(types) + 1  # the last column takes other types
    known = F.when(F.col("kind").isin(types), F.col("kind"))
    pairs = (
        events.where(F.col("entity").isNotNull())
        .select("entity", known.alias("kind"), F.unix_micros(F.col("at").cast("timestamp")).alias("at"), "item")
        .groupBy("entity", "kind")
        .agg(F.count(F.lit(1)).alias("n"), F.max("at").alias("last"), F.count_distinct("item").alias("items"))
    )
    bucketed = pairs.repartition("entity").sortWithinPartitions("entity")
    end = int(np.datetime64(as_of, "us").astype(np.int64))
    fields = [T.StructField("entity", T.StringType()), T.StructField("n_total", T.LongType()), T.StructField("n_other", T.LongType())]
    for t in types:
        fields += [T.StructField(f"n_{t}", T.LongType()), T.StructField(f"days_{t}", T.DoubleType()), T.StructField(f"items_{t}", T.LongType())]
    return bucketed.mapInArrow(lambda batches: _blocks(batches, codes, width, end), T.StructType(fields))


def _blocks(batches: Iterator[pa.RecordBatch], codes: dict[str, int], width: int, end: int) -> Iterator[pa.RecordBatch]:
    """Dense blocks of whole entities; the last entity of a batch may go on in the next."""
    rest: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if not table.num_rows:
            continue
        table = pa.concat_tables([rest, table]) if rest is not None else table
        names = table["entity"].to_numpy(zero_copy_only=False)
        changes = np.flatnonzero(names[1:] != names[:-1])
        whole = int(changes[-1]) + 1 if len(changes) else 0
        if whole:
            yield from _dense(table.slice(0, whole), codes, width, end)
        rest = table.slice(whole)
    if rest is not None and rest.num_rows:
        yield from _dense(rest, codes, width, end)


def _dense(table: pa.Table, codes: dict[str, int], width: int, end: int) -> Iterator[pa.RecordBatch]:
    names = table["entity"].to_numpy(zero_copy_only=False)
    entity = np.cumsum(np.concatenate([[0], names[1:] != names[:-1]])).astype(np.int64)
    firsts = np.searchsorted(entity, np.arange(entity[-1] + 1))
    kind = np.array([codes.get(k, width - 1) for k in table["kind"].to_pylist()], dtype=np.int64)
    n = table["n"].to_numpy()
    items = table["items"].to_numpy()
    dated = table["last"].is_valid().to_numpy(zero_copy_only=False)
    last = table["last"].fill_null(0).to_numpy()
    none = np.iinfo(np.int64).min
    for start in range(0, int(entity[-1]) + 1, BLOCK):
        here = (entity >= start) & (entity < start + BLOCK)
        rows = min(BLOCK, int(entity[-1]) + 1 - start)
        at = (entity[here] - start) * width + kind[here]
        counts = np.bincount(at, weights=n[here], minlength=rows * width).astype(np.int64).reshape(rows, width)
        kinds = np.bincount(at, weights=items[here], minlength=rows * width).astype(np.int64).reshape(rows, width)
        latest = np.full(rows * width, none, dtype=np.int64)
        np.maximum.at(latest, at[dated[here]], last[here][dated[here]])
        latest = latest.reshape(rows, width)
        days = (end - latest) / 86_400_000_000.0
        columns = [pa.array(names[firsts[start : start + rows]], pa.string()), pa.array(counts.sum(axis=1)), pa.array(counts[:, width - 1])]
        titles = ["entity", "n_total", "n_other"]
        for t, i in codes.items():
            columns += [pa.array(counts[:, i]), pa.array(days[:, i], pa.float64(), mask=latest[:, i] == none), pa.array(kinds[:, i])]
            titles += [f"n_{t}", f"days_{t}", f"items_{t}"]
        yield pa.RecordBatch.from_arrays(columns, names=titles)
