"""Point-in-time windows over each entity's earlier rows.

Order is (time, seq); a row never sees itself, and of rows at the same time it
sees those of smaller ``seq``. Windows reach back ``width`` microseconds,
inclusive. Times are longs (microseconds), so frames are plain integer ranges.

Scale: windows of bounded width run per (entity, slab of time), each slab with
a halo of the rows that its windows still reach, so the busiest entity is
spread over its time span. Unbounded history is carried from slab to slab as
exact integer sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.runtime import broadcast_if_small, materialize

SECOND = 1_000_000
MINUTE = 60 * SECOND
HOUR = 60 * MINUTE
DAY = 24 * HOUR
HOT_ROWS = 100_000  # rows of an entity and day above which its slabs are as narrow as the windows allow


def micros(ts: Column) -> Column:
    """Microseconds since the epoch of a timestamp without zone, read as UTC (the session's zone must be UTC)."""
    return F.unix_micros(ts.cast("timestamp"))


def with_halo(df: DataFrame, at: str, reach: int, slab: int = DAY, *, entity: str | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Rows with ``_slab`` (its start) and ``_own``; those within ``reach`` of a slab's end occur in the next ones too.

    With ``entity``, which must not be null, the slabs of an entity and day of
    more than ``hot_rows`` rows are as narrow as ``reach`` allows, so a
    busy sender's day is spread over as many tasks as it has reaches. Counting
    takes a pass over ``df``, which should be a written table.
    """
    slab = -(-max(slab, reach) // reach) * reach
    start = lambda t, width: F.floor(t / F.lit(width)).cast("long") * width
    here, there = F.col(at), F.col(at) + reach
    if entity is not None:
        busy = df.groupBy(F.col(entity).alias("_e"), start(here, slab).alias("_day")).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_rows).select("_e", "_day")
        if not busy.isEmpty():
            busy = broadcast_if_small(busy)
            for c, t in (("_hot_here", here), ("_hot_there", there)):
                df = df.withColumn("_at_day", start(t, slab)).join(busy.withColumn(c, F.lit(True)), (F.col(entity) == F.col("_e")) & (F.col("_at_day") == F.col("_day")), "left").drop("_e", "_day", "_at_day")
            own = F.when(F.col("_hot_here"), start(here, reach)).otherwise(start(here, slab))
            next_ = F.when(F.col("_hot_there"), start(there, reach)).otherwise(start(there, slab))
            cut = df.withColumn("_mine", own).withColumn("_slab", F.explode(F.array_distinct(F.array("_mine", next_))))
            return cut.withColumn("_own", F.col("_slab") == F.col("_mine")).drop("_hot_here", "_hot_there", "_mine")
    own = start(here, slab)
    return df.withColumn("_slab", F.explode(F.array_distinct(F.array(own, start(there, slab))))).withColumn("_own", F.col("_slab") == own)


def prior_count(keys: list[str], at: str, seq: str, width: int) -> Column:
    """Earlier rows of the same ``keys`` in reach: those before in order, less those that are too old."""
    place = Window.partitionBy(*keys).orderBy(at, seq)
    older = Window.partitionBy(*keys).orderBy(at).rangeBetween(Window.unboundedPreceding, -width - 1)
    return F.row_number().over(place) - 1 - F.count(F.lit(1)).over(older)


def prior_distinct(df: DataFrame, keys: list[str], at: str, seq: str, value: str, widths: dict[str, int]) -> DataFrame:
    """Adds, per name of ``widths``, the different values among the earlier rows in reach.

    A row that repeats a value within the width is counted twice by a plain
    count from the time it comes until the earlier one leaves. So the distinct
    count is the plain count, less the repeats so far, plus the repeats whose
    earlier row has left. Leaving times are merged in as rows of their own and
    counted by a running sum: sorting is all it costs, no sets are built. Null
    values are not values.
    """
    same = Window.partitionBy(*keys, value).orderBy(at, seq)
    place = Window.partitionBy(*keys).orderBy(at, seq)
    known = F.col(value).isNotNull()
    before = place.rowsBetween(Window.unboundedPreceding, -1)
    some = F.when(known, 1)
    older = {n: Window.partitionBy(*keys).orderBy(at).rangeBetween(Window.unboundedPreceding, -w - 1) for n, w in widths.items()}
    base = df.withColumn("_prev", F.when(known, F.lag(at).over(same)))
    base = base.withColumns({f"_r_{n}": known & F.col("_prev").isNotNull() & (F.col(at) <= F.col("_prev") + w) for n, w in widths.items()})
    base = base.withColumns({n: F.count(some).over(before) - F.count(some).over(older[n]) - F.coalesce(F.sum(F.col(f"_r_{n}").cast("long")).over(before), F.lit(0)) for n in widths})
    kept = base.columns
    leaving = base
    gone = [F.struct(*[F.lit(n == name).alias(n) for n in widths], (F.col("_prev") + width).alias("at")) for name, width in widths.items()]
    flags = [F.when(F.col(f"_r_{name}"), g) for name, g in zip(widths, gone)]
    events = leaving.select(*keys, F.explode(F.array_compact(F.array(*flags))).alias("_e")).select(*keys, F.col("_e.at").alias(at), *[F.col(f"_e.{n}").cast("int").alias(f"_gone_{n}") for n in widths])
    merged = base.withColumn("_real", F.lit(True)).unionByName(events, allowMissingColumns=True)
    earlier = Window.partitionBy(*keys).orderBy(at).rangeBetween(Window.unboundedPreceding, -1)
    merged = merged.withColumns({n: F.col(n) + F.coalesce(F.sum(f"_gone_{n}").over(earlier), F.lit(0)) for n in widths})
    return merged.where("_real").select(*[c for c in kept if not c.startswith("_r_") and c != "_prev"])


def sender_window_features(messages: DataFrame, *, very_short: int = MINUTE, short: int = 5 * MINUTE, long: int = HOUR, hot_rows: int = HOT_ROWS) -> DataFrame:
    """What was known about each message's sender just before it.

    ``messages`` has ``seq`` (unique), ``sender``, ``destination``, ``text``
    and ``at`` (microseconds); other columns are kept. Adds

    * ``msgs_very_short, msgs_short, msgs_long``: earlier messages in reach;
    * ``dests_short, dests_long``: different destinations among them;
    * ``repeat_ratio``: share of those in the long window with the same text;
    * ``diversity_short, diversity_long``: destinations over messages;
    * ``velocity_z``: ``msgs_short`` against its mean and sample deviation over
      all earlier messages of the sender, null below two of them or where the
      deviation is at most 1e-9;
    * ``age_days`` since the sender's first message.

    Ratios are 0 where nothing is in reach. A null sender or destination is
    ``<NA>``, a null text is empty. Rows without ``at`` have no place in time
    and are left out; an empty frame gives an empty result. Days of a sender with
    more than ``hot_rows`` messages are cut into slabs of ``long``.
    """
    clean = messages.where(F.col("at").isNotNull()).withColumn("_s", F.coalesce("sender", F.lit("<NA>"))).withColumn("_d", F.coalesce("destination", F.lit("<NA>"))).withColumn("_t", F.xxhash64(F.coalesce("text", F.lit(""))))
    clean = materialize(clean, "messages")  # read for its windows, for what leaves them, for its totals
    counted = _counted(clean, {"msgs_very_short": very_short, "msgs_short": short, "msgs_long": long}, long, hot_rows)
    seen = prior_distinct(counted, ["_s", "_slab"], "at", "seq", "_d", {"dests_short": short, "dests_long": long}).where("_own")
    seen = seen.withColumns({"repeat_ratio": _ratio("_same", "msgs_long"), "diversity_short": _ratio("dests_short", "msgs_short"), "diversity_long": _ratio("dests_long", "msgs_long")})
    scored = expanding_z(seen, "_s", "_slab", "at", "seq", "msgs_short", "velocity_z")
    first = clean.groupBy("_s").agg(F.min("at").alias("_first"))
    aged = scored.join(first, "_s").withColumn("age_days", (F.col("at") - F.col("_first")) / F.lit(float(DAY)))
    return aged.drop("_s", "_d", "_t", "_slab", "_own", "_same", "_first")


def sender_repeats(messages: DataFrame, *, long: int = HOUR, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``seq, msgs_long, repeat_ratio`` as in ``sender_window_features``, for who needs no more: no destinations, no history."""
    clean = messages.where(F.col("at").isNotNull()).select("seq", "at", F.coalesce("sender", F.lit("<NA>")).alias("_s"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("_t"))
    counted = _counted(materialize(clean, "messages"), {"msgs_long": long}, long, hot_rows)
    return counted.where("_own").select("seq", "msgs_long", _ratio("_same", "msgs_long").alias("repeat_ratio"))


def _counted(clean: DataFrame, widths: dict[str, int], long: int, hot_rows: int) -> DataFrame:
    """Slabs with a halo, the earlier messages in reach of each width and, as ``_same``, those of the same text in the ``long`` one."""
    keys = ["_s", "_slab"]
    counted = with_halo(clean, "at", long, entity="_s", hot_rows=hot_rows).withColumns({name: prior_count(keys, "at", "seq", width) for name, width in widths.items()})
    return counted.withColumn("_same", prior_count([*keys, "_t"], "at", "seq", long))


def _ratio(a: str, b: str) -> Column:
    return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)


def expanding_z(df: DataFrame, entity: str, slab: str, at: str, seq: str, value: str, out: str, floor: float = 1e-9) -> DataFrame:
    """``value`` against all earlier values of the entity, which must be whole numbers.

    Count, sum and sum of squares run inside a slab; those of earlier slabs are
    added from one small row per (entity, slab). Integer sums make it exact.
    """
    totals = df.groupBy(entity, slab).agg(F.count(value).alias("_n0"), F.sum(value).alias("_s0"), F.sum(F.col(value) * F.col(value)).alias("_q0"))
    prior = Window.partitionBy(entity).orderBy(slab).rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(entity, slab, *[F.coalesce(F.sum(c).over(prior), F.lit(0)).alias(c) for c in ("_n0", "_s0", "_q0")])
    inside = Window.partitionBy(entity, slab).orderBy(at, seq).rowsBetween(Window.unboundedPreceding, -1)
    run = df.withColumns({"_n": F.count(value).over(inside), "_sum": F.coalesce(F.sum(value).over(inside), F.lit(0)), "_sq": F.coalesce(F.sum(F.col(value) * F.col(value)).over(inside), F.lit(0))})
    joined = run.join(carried, [entity, slab])
    n, s, q = (F.col(a) + F.col(b) for a, b in (("_n", "_n0"), ("_sum", "_s0"), ("_sq", "_q0")))
    deviation = F.sqrt(F.greatest((q - s * s / n) / (n - 1), F.lit(0.0)))
    z = F.when(n >= 2, F.when(deviation > floor, (F.col(value) - s / n) / deviation))
    return joined.withColumn(out, z).drop("_n", "_sum", "_sq", "_n0", "_s0", "_q0")


def distinct_behind(df: DataFrame, entity: str, value: str, *, width: int = HOUR, out: str = "distinct_values") -> DataFrame:
    """Different ``value`` among the entity's earlier rows in reach, for each row.

    Needs ``seq`` and ``at``. A null entity gives null and enters no history;
    rows without ``at`` get null. A null value is ``<NA>``.
    """
    known = F.col(entity).isNotNull() & F.col("at").isNotNull()
    named = df.where(known).withColumn("_v", F.coalesce(F.col(value).cast("string"), F.lit("<NA>")))
    counted = prior_distinct(with_halo(named, "at", width), [entity, "_slab"], "at", "seq", "_v", {out: width}).where("_own").drop("_v", "_slab", "_own")
    return counted.unionByName(df.where(~known).withColumn(out, F.lit(None).cast("long")))


def rolling_count(df: DataFrame, entity: str, widths: dict[str, int]) -> DataFrame:
    """Rows in ``(at - width, at]`` up to and with the row itself, ties by position."""
    halo = with_halo(df.where(F.col("at").isNotNull()), "at", max(widths.values()))
    for name, width in widths.items():
        halo = halo.withColumn(name, prior_count([entity, "_slab"], "at", "seq", width - 1) + 1)
    return halo.where("_own").drop("_slab", "_own")


def previous_row(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Adds ``_slab`` and, per column ``c``, ``_prev_c`` of the key's previous row in order of (at, seq).

    Inside a slab by ``lag``; for a slab's first row from the last row of the
    key's slab before, found among one small row per (key, slab).
    """
    cut = df.withColumn("_slab", F.floor(F.col("at") / F.lit(DAY)).cast("long"))
    inside = Window.partitionBy(*keys, "_slab").orderBy("at", "seq")
    lasts = cut.groupBy(*keys, "_slab").agg(F.max_by(F.struct(*columns), F.struct("at", "seq")).alias("_l"))
    carried = lasts.withColumn("_before", F.lag("_l").over(Window.partitionBy(*keys).orderBy("_slab"))).drop("_l")
    same = [F.col(f"l.{k}").eqNullSafe(F.col(f"c.{k}")) for k in [*keys, "_slab"]]
    lagged = cut.withColumn("_in", F.lag(F.struct(*columns)).over(inside))
    condition = same[0]
    for c in same[1:]:
        condition = condition & c
    joined = lagged.alias("l").join(carried.alias("c"), condition).select("l.*", "c._before")
    return joined.withColumns({f"_prev_{c}": F.coalesce(F.col("_in"), F.col("_before"))[c] for c in columns}).drop("_in", "_before")


def gap_seconds(df: DataFrame, entity: str, out: str = "gap_s") -> DataFrame:
    """Seconds since the entity's previous row; null for its first. Rows without ``at`` are left out."""
    seen = previous_row(df.where(F.col("at").isNotNull()), [entity], ["at"])
    return seen.withColumn(out, (F.col("at") - F.col("_prev_at")) / F.lit(float(SECOND))).drop("_slab", "_prev_at")


def sessions(df: DataFrame, keys: list[str], part: str, *, gap: int = 30 * SECOND, out: str = "session") -> DataFrame:
    """Numbers each key's rows by session, from 1.

    A new one starts where the part number does not rise, or more than ``gap``
    has passed. Every key counts for itself, so nothing is sorted globally; a
    busy key is numbered slab by slab with carried totals. Rows without ``at``
    are left out; a null part starts no session by itself.
    """
    seen = previous_row(df.where(F.col("at").isNotNull()), keys, ["at", part])
    starts = F.col("_prev_at").isNull() | (F.col(part) <= F.col(f"_prev_{part}")) | (F.col("at") - F.col("_prev_at") > gap)
    flagged = seen.withColumn("_new", F.coalesce(starts, F.lit(False)).cast("long"))
    totals = flagged.groupBy(*keys, "_slab").agg(F.sum("_new").alias("_t"))
    prior = Window.partitionBy(*keys).orderBy("_slab").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, "_slab", F.coalesce(F.sum("_t").over(prior), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*keys, "_slab").orderBy("at", "seq").rowsBetween(Window.unboundedPreceding, 0)
    run = flagged.withColumn("_run", F.sum("_new").over(inside)).alias("l")
    condition = F.lit(True)
    for k in [*keys, "_slab"]:
        condition = condition & F.col(f"l.{k}").eqNullSafe(F.col(f"c.{k}"))
    joined = run.join(offsets.alias("c"), condition).select("l.*", "c._before")
    return joined.withColumn(out, F.col("_before") + F.col("_run")).drop("_slab", "_new", "_run", "_before", "_prev_at", f"_prev_{part}")


def ema_prior(df: DataFrame, entity: str, value: str, alpha: float = 0.1, out: str = "ema") -> DataFrame:
    """Exponential average of the entity's earlier values, and how many there were.

    ``at, seq`` order the rows; nulls neither change nor weigh the average. One
    fold per entity over its ordered values, meant for bucketed series (one row
    per entity and bucket), whose length is bounded by time.
    """
    rows = F.array_sort(F.collect_list(F.struct("at", "seq", F.col(value).cast("double").alias("v"))))
    step = lambda acc, x: F.struct(
        F.when(x["v"].isNull(), acc["level"]).when(acc["level"].isNull(), x["v"]).otherwise(alpha * x["v"] + (1 - alpha) * acc["level"]).alias("level"),
        F.concat(acc["out"], F.array(F.struct(x["at"].alias("at"), x["seq"].alias("seq"), acc["level"].alias("prior"), F.size(acc["out"]).cast("long").alias("seen")))).alias("out"),
    )
    kinds = dict(df.dtypes)
    start = F.struct(F.lit(None).cast("double").alias("level"), F.array().cast(f"array<struct<at:{kinds['at']},seq:{kinds['seq']},prior:double,seen:bigint>>").alias("out"))
    folded = df.groupBy(entity).agg(F.aggregate(rows, start, step).alias("_f"))
    return folded.select(entity, F.explode("_f.out").alias("_o")).select(entity, "_o.at", "_o.seq", F.col("_o.prior").alias(out), F.col("_o.seen").alias("history"))
