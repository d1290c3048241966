"""Ranks, prefix sums and the ranking metrics built on them, without a global sort in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.runtime import materialize, shuffle_width


def prefix_sums(df: DataFrame, order: list, sums: dict[str, str]) -> DataFrame:
    """Adds running sums, each row included, over all rows in ``order`` (columns or sort expressions).

    Rows are range-partitioned and numbered by partition in a written table, so
    that partitions are the same each time. Sums of partitions are
    prefix-summed in one tiny window; rows only within their partition. Rows
    equal in ``order`` are summed in any sequence.
    """
    ranged = df.repartitionByRange(shuffle_width(df.sparkSession), *order).withColumn("_p", F.spark_partition_id())
    fixed = materialize(ranged, "ranged")
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    parts = fixed.groupBy("_p").agg(*[F.sum(c).alias(f"_{o}") for o, c in sums.items()])
    offsets = parts.select("_p", *[F.coalesce(F.sum(f"_{o}").over(before), F.lit(0)).alias(f"_b_{o}") for o in sums])
    inside = Window.partitionBy("_p").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    run = fixed.withColumns({o: F.sum(c).over(inside) for o, c in sums.items()})
    joined = run.join(F.broadcast(offsets), "_p")  # one row per partition
    return joined.withColumns({o: F.col(o) + F.col(f"_b_{o}") for o in sums}).drop("_p", *[f"_b_{o}" for o in sums])


def exact_quantiles(df: DataFrame, value: str, ps: list[float], by: list[str] | None = None) -> DataFrame:
    """``*by, p, quantile``: exact quantiles, interpolated between the two nearest ranks, per group.

    Values are counted first and then prefix-summed over (group, value), so no
    group's values meet in one task or one buffer. Null values do not count.
    """
    by = by or []
    counts = df.where(F.col(value).isNotNull()).groupBy(*by, F.col(value).cast("double").alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    summed = prefix_sums(counts, [*by, "_v"], {"_upto": "_c"})
    spans = summed.groupBy(*by).agg(F.min(F.col("_upto") - F.col("_c")).alias("_from"), F.sum("_c").alias("_n"))
    places = spans.withColumn("p", F.explode(F.array(*[F.lit(float(p)) for p in ps]))).withColumn("_at", F.col("p") * (F.col("_n") - 1))
    wanted = places.withColumn("_rank", F.explode(F.array(F.floor("_at"), F.ceil("_at")))).withColumn("_side", F.col("_rank") > F.col("_at"))
    joined = summed.alias("s").join(F.broadcast(wanted).alias("w"), [F.col(f"s.{b}").eqNullSafe(F.col(f"w.{b}")) for b in by] or F.lit(True)).where((F.col("_upto") - F.col("_c") - F.col("_from") <= F.col("_rank")) & (F.col("_rank") < F.col("_upto") - F.col("_from")))
    ends = joined.groupBy(*[F.col(f"w.{b}").alias(b) for b in by], "p", "_at").agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    return ends.select(*by, "p", (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * (F.col("_at") - F.floor("_at"))).alias("quantile"))


def average_rank(df: DataFrame, value: str, out: str = "rank") -> DataFrame:
    """The mean of the ranks that equal values share, as a rank correlation needs; null for null."""
    counts = df.where(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("_c"))
    ranked = prefix_sums(counts, [value], {"_upto": "_c"}).select(value, (F.col("_upto") - (F.col("_c") - 1) / 2).alias(out))
    return df.join(ranked, value, "left")


def by_score(scored: DataFrame) -> DataFrame:
    """Rows and positives at each score and at or above it, from ``y`` (0/1) and ``score``; null rows do not count."""
    known = scored.where("y IS NOT NULL AND score IS NOT NULL")
    tied = known.groupBy("score").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("y").cast("long")).alias("p"))
    return prefix_sums(tied, [F.desc("score")], {"n_up": "n", "p_up": "p"})


def average_precision(scored: DataFrame) -> DataFrame:
    """One row ``average_precision``: precision at each different score, weighted by the recall it adds; null with one class only."""
    steps = by_score(scored)
    total = F.sum("p")
    value = F.sum(F.col("p") * F.col("p_up") / F.col("n_up")) / total
    return steps.agg(F.when((total > 0) & (total < F.sum("n")), value).alias("average_precision"))


def roc_auc(scored: DataFrame) -> DataFrame:
    """One row ``roc_auc``: the share of (positive, negative) pairs in right order, ties half; null with one class only."""
    steps = by_score(scored)
    p, n = F.sum("p"), F.sum(F.col("n") - F.col("p"))
    # negatives below a score's positives, and half of those beside them
    beside = F.col("n") - F.col("p")
    above = F.col("n_up") - F.col("p_up") - beside
    lost = F.sum(F.col("p") * (above + beside / 2))
    return steps.agg(F.when((p > 0) & (n > 0), 1 - lost / (p * n)).alias("roc_auc"))


def log_loss(scored: DataFrame, eps: float = 1e-15) -> DataFrame:
    """One row ``log_loss`` after scaling scores to 0..1 by their range (0.5 if constant); null with one class only."""
    known = scored.where("y IS NOT NULL AND score IS NOT NULL")
    span = known.agg(F.min("score").alias("_lo"), F.max("score").alias("_hi"))
    scaled = known.join(F.broadcast(span)).withColumn("_p", F.when(F.col("_hi") > F.col("_lo"), (F.col("score") - F.col("_lo")) / (F.col("_hi") - F.col("_lo"))).otherwise(0.5))
    p = F.least(F.greatest(F.col("_p"), F.lit(eps)), F.lit(1 - eps))
    loss = -F.when(F.col("y") == 1, F.ln(p)).otherwise(F.ln(1 - p))
    return scaled.agg(F.when(F.min("y") < F.max("y"), F.avg(loss)).alias("log_loss"))


def precision_at_k(scored: DataFrame, ks: list[int], key: str = "id") -> DataFrame:
    """``k, precision`` for each k; ties by ``key``; null where k is not in 1..rows."""
    known = scored.where("y IS NOT NULL AND score IS NOT NULL").select(key, "score", F.col("y").cast("long").alias("y"), F.lit(1).alias("_1"))
    ranked = prefix_sums(known, [F.desc("score"), F.asc(key)], {"_n": "_1", "_hits": "y"})
    wanted = scored.sparkSession.createDataFrame([(int(k),) for k in ks], "k long")
    hits = ranked.where(F.col("_n").isin([int(k) for k in ks])).select(F.col("_n").alias("k"), (F.col("_hits") / F.col("_n")).alias("precision"))
    return wanted.join(hits, "k", "left")


def precision_at_percentiles(scored: DataFrame, percents: list[float], key: str = "id") -> DataFrame:
    """``percent, k, precision`` at the top shares of all rows, k rounded half to even; null where that is 0."""
    n = scored.where("y IS NOT NULL AND score IS NOT NULL").count()
    ks = {p: round(n * p / 100) for p in percents}
    at = scored.sparkSession.createDataFrame([(float(p), int(k)) for p, k in ks.items()], "percent double, k long")
    return at.join(F.broadcast(precision_at_k(scored, sorted(set(ks.values())), key)), "k", "left").select("percent", "k", "precision")


def spearman(df: DataFrame, a: str, b: str) -> DataFrame:
    """One row ``a, b, rho``: rank correlation of two columns over the rows where both are known."""
    known = df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(F.col(a).alias("_x"), F.col(b).alias("_y"))
    cells = known.groupBy("_x", "_y").agg(F.count(F.lit(1)).alias("_k"))
    margin = lambda c, o: prefix_sums(cells.groupBy(c).agg(F.sum("_k").alias("_c")), [c], {"_u": "_c"}).select(c, (F.col("_u") - (F.col("_c") - 1) / 2).alias(o))
    ranked = cells.join(margin("_x", "_rx"), "_x").join(margin("_y", "_ry"), "_y")
    w, x, y = F.col("_k"), F.col("_rx"), F.col("_ry")
    n = F.sum(w)
    cov = F.sum(w * x * y) / n - F.sum(w * x) / n * (F.sum(w * y) / n)
    var = lambda v: F.sum(w * v * v) / n - F.pow(F.sum(w * v) / n, 2)
    rho = F.when((var(x) > 0) & (var(y) > 0), cov / F.sqrt(var(x) * var(y)))
    return ranked.agg(F.lit(a).alias("a"), F.lit(b).alias("b"), rho.alias("rho"))


def mutual_information(df: DataFrame, value: str, y: str, bins: int = 10) -> DataFrame:
    """One row ``mi`` in nats between ``value`` in equal-count bins by rank and ``y``; equal values share a bin."""
    known = df.where(F.col(value).isNotNull() & F.col(y).isNotNull())
    counts = known.groupBy(value).agg(F.count(F.lit(1)).alias("_c"))
    n = known.agg(F.count(F.lit(1)).alias("_n"))
    first = prefix_sums(counts, [value], {"_u": "_c"}).join(F.broadcast(n)).select(value, F.floor((F.col("_u") - F.col("_c")) * bins / F.col("_n")).alias("_bin"))
    cells = known.join(first, value).groupBy("_bin", F.col(y).alias("_y")).agg(F.count(F.lit(1)).alias("_k"))
    by_bin, by_y, everything = (Window.partitionBy(*c) for c in (["_bin"], ["_y"], []))  # at most bins x classes rows
    share = cells.select("_k", F.sum("_k").over(by_bin).alias("_a"), F.sum("_k").over(by_y).alias("_b"), F.sum("_k").over(everything).alias("_n"))
    k, a, b, m = (F.col(c).cast("double") for c in ("_k", "_a", "_b", "_n"))
    return share.agg(F.sum(k / m * F.ln(k * m / (a * b))).alias("mi"))


def confusion(df: DataFrame, y: str, predicted: str) -> DataFrame:
    """Per class ``label, support, tp, fp, fn, precision, recall, f1``; nulls are a class of their own, undefined ratios 0."""
    pairs = df.groupBy(F.col(y).cast("string").alias("t"), F.col(predicted).cast("string").alias("p")).agg(F.count(F.lit(1)).alias("k"))
    right = F.col("t").eqNullSafe(F.col("p"))
    rows = pairs.select(F.explode(F.array(F.struct(F.col("t").alias("label"), F.when(right, F.col("k")).otherwise(0).alias("tp"), F.lit(0).cast("long").alias("fp"), F.when(right, 0).otherwise(F.col("k")).alias("fn")), F.struct(F.col("p").alias("label"), F.lit(0).cast("long").alias("tp"), F.when(right, 0).otherwise(F.col("k")).alias("fp"), F.lit(0).cast("long").alias("fn")))).alias("r")).select("r.*")
    s = rows.groupBy("label").agg(F.sum("tp").alias("tp"), F.sum("fp").alias("fp"), F.sum("fn").alias("fn"))
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return s.select("label", (tp + fn).alias("support"), "tp", "fp", "fn", ratio(tp, tp + fp).alias("precision"), ratio(tp, tp + fn).alias("recall"), ratio(2 * tp, 2 * tp + fp + fn).alias("f1"))
