"""Judging scores and features: plausibility, lift, redundancy, drift."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ranking import average_precision, prefix_sums, spearman
from tidemark.runtime import broadcast_if_small, materialize


def plausibility(scored: DataFrame) -> DataFrame:
    """One row: mean score of all, flagged and clean rows, and their numbers; a null ``y`` is in neither class."""
    flagged, clean = F.col("y") == 1, F.col("y") == 0
    return scored.agg(F.avg("score").alias("mean_score"), F.avg(F.when(flagged, F.col("score"))).alias("mean_flagged"), F.avg(F.when(clean, F.col("score"))).alias("mean_clean"), F.count_if(flagged).alias("n_flagged"), F.count_if(clean).alias("n_clean"))


def lift(scored: DataFrame, bins: int = 10, key: str = "id") -> DataFrame:
    """``bin, rows, lift``: positives of each equal-count bin of scores against all rows' share."""
    known = scored.where("y IS NOT NULL AND score IS NOT NULL").select(key, "score", "y", F.lit(1).alias("_1"))
    total = known.agg(F.count(F.lit(1)).alias("_n"), F.avg("y").alias("_base"))
    placed = prefix_sums(known, ["score", key], {"_i": "_1"}).join(F.broadcast(total))
    return placed.groupBy(F.floor((F.col("_i") - 1) * bins / F.col("_n")).alias("bin")).agg(F.count(F.lit(1)).alias("rows"), F.when(F.first("_base") > 0, F.avg("y") / F.first("_base")).alias("lift"))


def interior_correlation(df: DataFrame, a: str, b: str, stratum: str) -> DataFrame:
    """``rho, rows``: mean rank correlation over strata, weighted by rows, of rows where ``a`` is off its bounds."""
    ends = df.agg(F.min(a).alias("_lo"), F.max(a).alias("_hi"))
    inside = df.join(F.broadcast(ends)).where((F.col(a) > F.col("_lo")) & (F.col(a) < F.col("_hi")))
    sizes = inside.groupBy(stratum).agg(F.count(F.lit(1)).alias("n")).collect()  # strata are few, as with sources
    parts = None
    for row in sizes:
        one = spearman(inside.where(F.col(stratum).eqNullSafe(F.lit(row[0]))), a, b).select("rho", F.lit(row["n"]).alias("n"))
        parts = one if parts is None else parts.unionByName(one)
    if parts is None:
        return df.sparkSession.createDataFrame([(None, 0)], "rho double, rows long")
    return parts.agg((F.sum(F.col("rho") * F.col("n")) / F.sum(F.when(F.col("rho").isNotNull(), F.col("n")))).alias("rho"), F.sum("n").alias("rows"))


def correlation_pairs(df: DataFrame, columns: list[str]) -> DataFrame:
    """``a, b, rho``: rank correlations of all pairs of columns, each over the rows where both are known.

    Without nulls every column is ranked once and all pairs come from one pass.
    """
    whole = df.select(*columns).agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).first()
    if not any(whole):
        ranked = df.select(*columns)
        for c in columns:
            counts = ranked.groupBy(c).agg(F.count(F.lit(1)).alias("_c"))
            ranks = prefix_sums(counts, [c], {"_u": "_c"}).select(c, (F.col("_u") - (F.col("_c") - 1) / 2).alias(f"_r_{c}"))
            ranked = ranked.join(broadcast_if_small(ranks), c)
        pairs = list(combinations(columns, 2))
        wide = ranked.agg(*[F.corr(f"_r_{a}", f"_r_{b}").alias(f"_{i}") for i, (a, b) in enumerate(pairs)])
        cells = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"_{i}").alias("rho")) for i, (a, b) in enumerate(pairs)])
        return wide.select(F.explode(cells).alias("p")).select("p.*")
    out = None
    for a, b in combinations(columns, 2):
        one = spearman(df, a, b)
        out = one if out is None else out.unionByName(one)
    return out


def redundant_groups(df: DataFrame, columns: list[str], least: float = 0.9) -> DataFrame:
    """``feature, grp``: columns linked by |rank correlation| >= ``least``, directly or through others; named by the least."""
    group = {c: c for c in columns}
    for r in correlation_pairs(df, columns).collect():
        if r["rho"] is not None and abs(r["rho"]) >= least:
            old, new = sorted((group[r["a"]], group[r["b"]]), reverse=True)
            group = {c: new if g == old else g for c, g in group.items()}
    return df.sparkSession.createDataFrame(sorted(group.items()), "feature string, grp string")


def split_is_justified(shared: dict[str, float], separate: dict[str, float], gap: float = 0.05) -> dict[str, bool]:
    """Per source: whether its own model beats the shared one's metric by ``gap``."""
    return {s: separate[s] - shared[s] >= gap for s in sorted(set(shared) & set(separate))}


def dominance(df: DataFrame, groups: dict[str, list[str]], *, trees: int = 50, seed: int = 0, key: str | None = None) -> DataFrame:
    """``left_out, rho``: rank correlation of anomaly scores with and without a group of columns; low means it dominates.

    All forests are grown on the same rows, drawn by hash of ``key`` (see
    ``draw_rows``). Rows with equal values are counted and scored once, by all
    forests in one pass; every score is ranked once.
    """
    from tidemark.ml.forest import draw_rows, grow_forest, score_isolation_forests

    of, everything = zip(*[(name, c) for name, g in groups.items() for c in g])
    drawn = draw_rows(df, list(everything), trees * 256, seed=seed, key=key)
    rests = [[i for i, g in enumerate(of) if g != name] for name in groups]
    models = {f"_s{j}": grow_forest(drawn[:, at], [everything[i] for i in at], trees=trees, rows=256, seed=seed) for j, at in enumerate([list(range(len(everything))), *rests])}
    cells = df.groupBy(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in dict.fromkeys(everything)]).agg(F.count(F.lit(1)).alias("_k"))
    scored = materialize(score_isolation_forests(cells, models).select("_k", *models), "scores")
    ranked = scored
    for s in models:
        counts = scored.groupBy(s).agg(F.sum("_k").alias("_c"))
        ranks = prefix_sums(counts, [s], {"_u": "_c"}).select(s, (F.col("_u") - (F.col("_c") - 1) / 2).alias(f"_r{s}"))
        ranked = ranked.join(broadcast_if_small(ranks), s)
    k, n = F.col("_k"), F.sum("_k")
    cov = lambda a, b: F.sum(k * F.col(f"_r{a}") * F.col(f"_r{b}")) / n - F.sum(k * F.col(f"_r{a}")) / n * (F.sum(k * F.col(f"_r{b}")) / n)
    full, *parts = models
    rho = lambda p: F.when((cov(full, full) > 0) & (cov(p, p) > 0), cov(full, p) / F.sqrt(cov(full, full) * cov(p, p)))
    each = F.array(*[F.struct(F.lit(name).alias("left_out"), rho(p).alias("rho")) for name, p in zip(groups, parts)])
    return ranked.agg(each.alias("_e")).select(F.explode("_e").alias("_e")).select("_e.*")


def by_source(scored: DataFrame, source: str) -> DataFrame:
    """``segment, average_precision`` overall (``all``) and of each source, null being one; null with one class only.

    All segments in one order by source and score, with distributed prefix
    sums from which the segments before are taken off: no plan per segment, and
    no segment in one task.
    """
    known = scored.where("y IS NOT NULL AND score IS NOT NULL")
    tied = known.groupBy(F.col(source).cast("string").alias("segment"), "score").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("y").cast("long")).alias("p"))
    steps = prefix_sums(tied, [F.asc_nulls_first("segment"), F.desc("score")], {"n_up": "n", "p_up": "p"})
    first = steps.groupBy("segment").agg(F.min(F.struct("n_up", "n", "p_up", "p")).alias("f")).select(F.col("segment").alias("g"), (F.col("f.n_up") - F.col("f.n")).alias("n0"), (F.col("f.p_up") - F.col("f.p")).alias("p0"))
    placed = steps.join(broadcast_if_small(first), F.col("segment").eqNullSafe(F.col("g")))
    total = F.sum("p")
    value = F.sum(F.col("p") * (F.col("p_up") - F.col("p0")) / (F.col("n_up") - F.col("n0"))) / total
    each = placed.groupBy("segment").agg(F.when((total > 0) & (total < F.sum("n")), value).alias("average_precision"))
    return average_precision(scored).select(F.lit("all").alias("segment"), "average_precision").unionByName(each)


def accuracy_macro(confused: DataFrame) -> DataFrame:
    """``accuracy, macro_f1`` from :func:`tidemark.operators.ranking.confusion`; the F1 of classes counts equally, nulls without rows."""
    return confused.agg((F.sum("tp") / F.sum("support")).alias("accuracy"), F.avg("f1").alias("macro_f1"))


def drift(metrics: DataFrame, *, gap: float = 0.05) -> DataFrame:
    """From a table of ``source, kind (shared|separate), value``: each source's latest pair and whether a model of its own is justified.

    ``at`` orders repeated measurements; sources without both kinds are left out.
    """
    latest = metrics.groupBy("source").pivot("kind", ["shared", "separate"]).agg(F.max_by("value", "at"))
    return latest.where("shared IS NOT NULL AND separate IS NOT NULL").select("source", "shared", "separate", (F.col("separate") - F.col("shared") >= gap).alias("justified"))
