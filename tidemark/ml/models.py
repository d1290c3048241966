"""Supervised models, folds and feature pipelines on MLlib."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import IDF, PCA, CountVectorizer, ElementwiseProduct, IDFModel, NGram, Normalizer, RegexTokenizer, SQLTransformer, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ranking import prefix_sums
from tidemark.runtime import materialize


def reduce_vectors(df: DataFrame, columns: list[str], k: int, out: str = "reduced") -> tuple[DataFrame, PipelineModel]:
    """Standardised (population deviation) and projected on the first ``k`` principal components, as an array column."""
    stages = [VectorAssembler(inputCols=columns, outputCol="_x", handleInvalid="error"), StandardScaler(inputCol="_x", outputCol="_z", withMean=True, withStd=True), PCA(k=k, inputCol="_z", outputCol="_p")]
    model = Pipeline(stages=stages).fit(df)
    n = df.count()
    scale = (n / max(n - 1, 1)) ** 0.5  # MLlib divides by the sample deviation
    projected = model.transform(df).withColumn(out, F.transform(vector_to_array("_p"), lambda v: v * F.lit(scale))).drop("_x", "_z", "_p")
    return projected, model


def joint_frame(df: DataFrame, vector: str, numbers: list[str], source: str, *, k: int = 8, out: str = "features") -> tuple[DataFrame, PipelineModel, list[str]]:
    """What the models train on: reduced vectors, numeric columns and the source's indicator, all scaled together.

    ``vector`` (an array of one length) is standardised and projected on its
    first ``k`` principal components; ``numbers`` (behaviour and flags; null is
    0) and ``is_<source>`` follow, and everything is scaled to mean 0 and
    deviation 1 (a constant column to 0). Adds ``out`` as an array; the names of its places are
    returned, the reduced ones first (``reduced_0`` ...). ``df`` is computed once and written, since
    fitting passes over it several times.
    """
    df = materialize(df, "joint")
    names = sorted(r[0] for r in df.select(source).distinct().limit(100).collect() if r[0] is not None)
    ready = df.withColumn("_v", array_to_vector(F.col(vector).cast("array<double>"))).withColumns({f"is_{n}": F.coalesce((F.col(source) == n).cast("double"), F.lit(0.0)) for n in names} | {f"_n_{c}": F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in numbers})
    stages = [StandardScaler(inputCol="_v", outputCol="_z", withMean=True), PCA(k=k, inputCol="_z", outputCol="_p"), VectorAssembler(inputCols=["_p", *[f"_n_{c}" for c in numbers], *[f"is_{n}" for n in names]], outputCol="_all"), StandardScaler(inputCol="_all", outputCol="_f", withMean=True)]
    model = Pipeline(stages=stages).fit(ready)
    joint = model.transform(ready).withColumn(out, vector_to_array("_f"))
    return joint.drop("_v", "_z", "_p", "_all", "_f", *[f"_n_{c}" for c in numbers], *[f"is_{n}" for n in names]), model, [*[f"reduced_{i}" for i in range(k)], *numbers, *[f"is_{n}" for n in names]]


def clustering_places(names: list[str], mode: str = "all") -> list[int]:
    """Which places of a joint frame's features clusters are sought in: ``content`` (the reduced vectors) or ``all``."""
    if mode not in ("content", "all"):
        raise ValueError(f"mode must be content or all, not {mode}")
    return [i for i, n in enumerate(names) if mode == "all" or n.startswith("reduced_")]


def fit_logistic(df: DataFrame, columns: list[str], label: str = "y", *, c: float = 1.0):  # noqa: ANN201
    """Logistic regression with the objective of an inverse penalty ``c`` on summed losses; raises without both classes."""
    n, classes = df.agg(F.count(F.lit(1)), F.count_distinct(label)).first()
    if classes < 2:
        raise ValueError("both classes are needed")
    frame = VectorAssembler(inputCols=columns, outputCol="_x").transform(df.withColumn("_y", F.col(label).cast("double")))
    return LogisticRegression(featuresCol="_x", labelCol="_y", regParam=1.0 / (c * n), elasticNetParam=0.0, standardization=False, maxIter=1000).fit(frame)


def logistic_score(model, columns: list[str]) -> Column:  # noqa: ANN001
    """The model's probability as a plain expression: no UDF, and it can be pushed anywhere."""
    z = F.lit(float(model.intercept))
    for c, w in zip(columns, model.coefficients.toArray()):
        z = z + F.col(c).cast("double") * float(w)
    return 1 / (1 + F.exp(-z))


def logistic_contributions(model, columns: list[str]) -> Column:  # noqa: ANN001
    """Coefficient times value of each column, largest magnitude first: exact attributions of a linear model."""
    parts = F.array(*[F.struct(F.lit(c).alias("feature"), (F.col(c).cast("double") * float(w)).alias("contribution")) for c, w in zip(columns, model.coefficients.toArray())])
    bigger = lambda a, b: F.when(F.abs(a["contribution"]) > F.abs(b["contribution"]), -1).when(F.abs(a["contribution"]) < F.abs(b["contribution"]), 1).otherwise(0)
    return F.array_sort(parts, bigger)


def fit_fusion(df: DataFrame, scores: list[str], label: str = "y") -> PipelineModel:
    """Scaled scores into a logistic regression."""
    stages = [VectorAssembler(inputCols=scores, outputCol="_x"), StandardScaler(inputCol="_x", outputCol="_z", withMean=True), LogisticRegression(featuresCol="_z", labelCol=label)]
    return Pipeline(stages=stages).fit(df.withColumn(label, F.col(label).cast("double")))


def fit_boosted(df: DataFrame, columns: list[str], label: str = "y", *, rounds: int = 20, depth: int = 5, seed: int = 0) -> PipelineModel:
    """Gradient-boosted trees for two classes; nulls must be filled (see ``with_known``)."""
    return Pipeline(stages=[VectorAssembler(inputCols=columns, outputCol="_x"), GBTClassifier(featuresCol="_x", labelCol=label, maxIter=rounds, maxDepth=depth, seed=seed)]).fit(df.withColumn(label, F.col(label).cast("double")))


def fit_multiclass(df: DataFrame, columns: list[str], label: str, *, trees: int = 50, seed: int = 0) -> PipelineModel:
    """A random forest over string labels; ``prediction`` indexes the label indexer's labels."""
    return Pipeline(stages=[StringIndexer(inputCol=label, outputCol="_y", stringOrderType="alphabetAsc"), VectorAssembler(inputCols=columns, outputCol="_x"), RandomForestClassifier(featuresCol="_x", labelCol="_y", numTrees=trees, seed=seed)]).fit(df)


def probability(df: DataFrame, out: str) -> DataFrame:
    """The positive class's probability as a double column."""
    return df.withColumn(out, vector_to_array("probability")[1])


def text_features(text: str = "text", *, vocabulary: int = 500, min_docs: int = 5) -> Pipeline:
    """TF-IDF of word 1- to 3-grams with smoothed idf + 1 and unit length; fit it on training rows only."""
    words = RegexTokenizer(inputCol=text, outputCol="_w", pattern=r"\b\w\w+\b", gaps=False)
    grams = [NGram(n=n, inputCol="_w", outputCol=f"_g{n}") for n in (2, 3)]
    joined = SQLTransformer(statement="SELECT *, concat(_w, _g2, _g3) AS _grams FROM __THIS__")
    counted = CountVectorizer(inputCol="_grams", outputCol="_tf", vocabSize=vocabulary, minDF=min_docs)
    weighed = IDF(inputCol="_tf", outputCol="_idf")
    return Pipeline(stages=[words, *grams, joined, counted, weighed])


def tfidf(df: DataFrame, model: PipelineModel, out: str = "tfidf") -> DataFrame:
    """The fitted features as a sparse unit vector of the vocabulary's size."""
    idf = next(s for s in model.stages if isinstance(s, IDFModel)).idf.toArray()
    weigh = ElementwiseProduct(scalingVec=Vectors.dense(idf + 1), inputCol="_tf", outputCol="_sum")
    return Normalizer(inputCol="_sum", outputCol=out, p=2.0).transform(weigh.transform(model.transform(df))).drop("_w", "_g2", "_g3", "_grams", "_tf", "_idf", "_sum")


# --- folds and splits --------------------------------------------------------------------


def folds(df: DataFrame, key: str, label: str, k: int = 5, seed: int = 0, out: str = "fold") -> DataFrame:
    """Stratified folds 0..k-1, each label dealt out evenly in order of a seeded hash.

    Rows are numbered by distributed prefix sums, one per label's order, so that
    no class, however large, is sorted in one task.
    """
    keyed = df.withColumn("_h", F.md5(F.concat(F.lit(f"{seed}|"), F.col(key).cast("string")))).withColumn("_1", F.lit(1))
    numbered = prefix_sums(keyed, [label, "_h", key], {"_i": "_1"})
    return numbered.withColumn(out, F.pmod(F.col("_i"), F.lit(k)).cast("int")).drop("_h", "_1", "_i")


def stratified_split(df: DataFrame, key: str, label: str, test_share: float, seed: int = 0) -> DataFrame:
    """``is_test`` for every ``1/test_share``-th row of the label order by seeded hash."""
    k = max(2, round(1 / test_share))
    return folds(df, key, label, k, seed, "_f").withColumn("is_test", F.col("_f") == 0).drop("_f")


def group_split(df: DataFrame, group: str, test_share: float, seed: int = 0) -> DataFrame:
    """``is_test`` by hash of the group, so that no group is on both sides; null is a group."""
    draw = F.pmod(F.xxhash64(F.lit(seed), F.coalesce(F.col(group).cast("string"), F.lit("<NA>"))), F.lit(10_000)) / F.lit(10_000.0)
    return df.withColumn("is_test", draw < test_share)


def out_of_fold(df: DataFrame, key: str, columns: list[str], label: str = "y", k: int = 5, seed: int = 0) -> DataFrame:
    """``key, y, score``: each row scored by the logistic model that never saw its fold."""
    dealt = folds(df, key, label, k, seed).persist()
    out = None
    for i in range(k):
        model = fit_logistic(dealt.where(F.col("fold") != i), columns, label)
        part = dealt.where(F.col("fold") == i).select(key, F.col(label).alias("y"), logistic_score(model, columns).alias("score"))
        out = part if out is None else out.unionByName(part)
    return out


def permutation_importance(df: DataFrame, score: Column, columns: list[str], label: str = "y", seed: int = 0) -> DataFrame:
    """``feature, drop``: what average precision loses when one column is shuffled among the rows."""
    from tidemark.operators.ranking import average_precision

    spark = df.sparkSession
    base = average_precision(df.select(F.col(label).alias("y"), score.alias("score"))).first()[0]
    rows = []
    order = F.monotonically_increasing_id()
    fixed = df.withColumn("_id", order).withColumn("_1", F.lit(1)).persist()
    placed = prefix_sums(fixed, ["_id"], {"_i": "_1"})
    for c in columns:
        shuffled = prefix_sums(fixed.select(F.col(c).alias("_v"), F.xxhash64(F.lit(seed), F.lit(c), "_id").alias("_h"), "_1"), ["_h"], {"_i": "_1"}).select("_i", "_v")
        changed = placed.join(shuffled, "_i").withColumn(c, F.col("_v")).select(F.col(label).alias("y"), score.alias("score"))
        rows.append((c, base - average_precision(changed).first()[0]))
    fixed.unpersist()
    return spark.createDataFrame(rows, "feature string, drop double")


def hard_positives(unlabelled: DataFrame, score: str, threshold: float) -> DataFrame:
    """Unlabelled rows taken as positives for their high score, tagged as such."""
    return unlabelled.where(F.col(score) >= threshold).withColumn("y", F.lit(1)).withColumn("label_source", F.lit("content_flags"))
