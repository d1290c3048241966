"""Models, clusterings and folds by their properties."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.ml import clusters, forest, models
from tidemark.operators.ranking import average_precision


@pytest.fixture(scope="module")
def labelled(spark):
    rng = np.random.default_rng(0)
    x = rng.standard_normal((600, 3))
    y = (x[:, 0] + 0.3 * rng.standard_normal(600) > 0.8).astype(int)
    return spark.createDataFrame([(i, *map(float, r), int(v)) for i, (r, v) in enumerate(zip(x, y))], "id int, a double, b double, c double, y int").persist()


def test_isolation_forest(spark):
    rng = np.random.default_rng(1)
    x = np.vstack([rng.standard_normal((500, 2)), [[40, 0], [-40, 0]]])
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(x)] + [(999, None, 0.0)], "id int, a double, b double")
    model = forest.fit_isolation_forest(df, ["a", "b"], trees=50)
    scored = forest.score_isolation_forest(df, model)
    assert {r["id"] for r in scored.orderBy(F.desc("anomaly_score")).limit(10).collect()} >= {500, 501}
    again = forest.score_isolation_forest(df, forest.fit_isolation_forest(df, ["a", "b"], trees=50))
    assert scored.exceptAll(again).count() == 0
    reasons = {r["feature"]: r["contribution"] for r in forest.attribute(df.where("id = 500"), model, "id").collect()}
    assert set(reasons) == {"a", "b"} and reasons["a"] > 0.05 > reasons["b"]
    total = forest.attribute(df, model, "id").groupBy("id").agg(F.sum("contribution").alias("c"), F.first("score").alias("s"), F.first("base").alias("b"))
    assert total.where("abs(c - (s - b)) > 1e-9").count() == 0
    with pytest.raises(ValueError, match="nothing"):
        forest.fit_isolation_forest(df.where("id < 0"), ["a"])
    assert forest.score_isolation_forest(df.where("id < 0"), model).count() == 0


def test_logistic(labelled):
    model = models.fit_logistic(labelled, ["a", "b", "c"])
    scored = labelled.withColumn("score", models.logistic_score(model, ["a", "b", "c"]))
    theirs = models.probability(model.transform(models.VectorAssembler(inputCols=["a", "b", "c"], outputCol="_x").transform(scored)), "p")
    assert theirs.where(F.abs(F.col("p") - F.col("score")) > 1e-9).count() == 0
    assert average_precision(scored).first()[0] > 0.8
    first = scored.select(models.logistic_contributions(model, ["a", "b", "c"]).alias("k")).first()["k"]
    assert abs(first[0]["contribution"]) >= abs(first[1]["contribution"])
    with pytest.raises(ValueError, match="both classes"):
        models.fit_logistic(labelled.where("y = 1"), ["a"])


def test_folds_and_splits(labelled):
    dealt = models.folds(labelled, "id", "y")
    counts = {(r["y"], r["fold"]): r["count"] for r in dealt.groupBy("y", "fold").count().collect()}
    for y in (0, 1):
        sizes = [counts[y, f] for f in range(5)]
        assert max(sizes) - min(sizes) <= 1
    assert models.out_of_fold(labelled, "id", ["a", "b", "c"]).count() == 600
    split = models.group_split(labelled.withColumn("g", F.col("id") % 7), "g", 0.3)
    assert split.groupBy("g").agg(F.count_distinct("is_test").alias("n")).where("n > 1").count() == 0
    assert models.stratified_split(labelled, "id", "y", 0.2).where("is_test").count() in range(118, 123)


def test_reduction(labelled):
    reduced, _ = models.reduce_vectors(labelled, ["a", "b", "c"], 2)
    got = np.array([r["reduced"] for r in reduced.orderBy("id").collect()])
    x = np.array([tuple(r) for r in labelled.orderBy("id").select("a", "b", "c").collect()])
    z = (x - x.mean(axis=0)) / x.std(axis=0)
    _, _, v = np.linalg.svd(z, full_matrices=False)
    assert np.allclose(np.abs(got), np.abs(z @ v[:2].T), atol=1e-6)


def test_trees_and_fusion(labelled):
    boosted = models.probability(models.fit_boosted(labelled, ["a", "b", "c"], rounds=3).transform(labelled), "score")
    assert average_precision(boosted.select("y", "score")).first()[0] > 0.8
    many = models.fit_multiclass(labelled.withColumn("k", F.when(F.col("y") == 1, "one").otherwise("zero")), ["a", "b", "c"], "k", trees=5)
    assert many.stages[0].labels == ["one", "zero"]
    fused = models.fit_fusion(labelled.select("a", "b", "y"), ["a", "b"]).transform(labelled.select("a", "b", "y"))
    assert fused.count() == 600
    assert models.hard_positives(labelled, "a", 2.0).where("label_source <> 'content_flags'").count() == 0


def test_permutation(labelled):
    model = models.fit_logistic(labelled, ["a", "b", "c"])
    drop = {r["feature"]: r["drop"] for r in models.permutation_importance(labelled, models.logistic_score(model, ["a", "b", "c"]), ["a", "b"]).collect()}
    assert drop["a"] > 0.2 > abs(drop["b"])


def test_tfidf(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(["red cat", "red dog", "red fox", "", "red cat sat"])], "id int, text string")
    model = models.text_features(vocabulary=10, min_docs=1).fit(docs)
    got = {r["id"]: r["tfidf"] for r in models.tfidf(docs, model).collect()}
    vocabulary = model.stages[4].vocabulary
    idf = {"red": np.log(6 / 5) + 1, "cat": np.log(6 / 3) + 1, "red cat": np.log(6 / 3) + 1}
    want = np.array([idf.get(t, 0.0) for t in vocabulary])
    assert np.allclose(got[0].toArray(), want / np.linalg.norm(want)) and got[3].numNonzeros() == 0


def test_components(spark):
    rng = np.random.default_rng(5)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (200, 2))] + [(i, i + 1) for i in range(1000, 1060)] + [(2000, i) for i in range(2001, 2100)] + [(7000, 7000), (None, 1)]
    got = {r["id"]: r["component"] for r in clusters.connected_components(spark.createDataFrame(edges, "a int, b int")).collect()}
    parent: dict[int, int] = {}

    def find(i):
        while parent.setdefault(i, i) != i:
            i = parent[i]
        return i

    for a, b in edges:
        if a is not None and b is not None:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    assert got == {i: find(i) for i in parent}
    assert clusters.connected_components(spark.createDataFrame([], "a int, b int")).count() == 0


def blobs(spark):
    rng = np.random.default_rng(2)
    x = np.vstack([rng.normal(0, 0.1, (40, 2)), rng.normal(5, 0.1, (30, 2)), [[20, 20]]])
    return spark.createDataFrame([(f"k{i:02d}", [float(v) for v in r]) for i, r in enumerate(x)], "key string, vector array<double>")


def test_clusterings(spark, monkeypatch):
    df = blobs(spark)
    got = {r["key"]: r["cluster"] for r in clusters.dbscan(df, 0.5, 4).collect()}
    assert {got[f"k{i:02d}"] for i in range(40)} == {"k00"} and {got[f"k{i:02d}"] for i in range(40, 70)} == {"k40"} and got["k70"] is None
    tree = {r["key"]: r["cluster"] for r in clusters.hdbscan(df).collect()}
    assert len({tree[f"k{i:02d}"] for i in range(40)} - {-1}) == 1 and tree["k70"] == -1 and len(set(tree.values()) - {-1}) == 2
    assert 0 < clusters.suggest_eps(df, 4) < 0.5 and clusters.suggest_eps(df.limit(2), 4) is None
    monkeypatch.setattr(clusters.guard, "__defaults__", (10,))
    with pytest.raises(ValueError, match="10"):
        clusters.suggest_eps(df, 4)
    assert clusters.hierarchy(np.zeros((0, 2)), 5).size == 0


def test_cluster_queries_see_whole_vectors(spark, tmp_path):
    from tidemark.plans import model_queries as q

    rng = np.random.default_rng(4)
    x = 0.01 * rng.standard_normal((60, 64))
    x[:30, 6:] += 1.0  # two groups that agree in their first six numbers
    spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "vec_id long, embedding array<float>").write.parquet(str(tmp_path / "embeddings.parquet"))
    for query in (q.dbscan, q.hdbscan):
        found = {int(r["key"]): r["cluster"] for r in query(spark, str(tmp_path)).collect()}
        noise = {None, -1}
        one, two = {found[i] for i in range(30)} - noise, {found[i] for i in range(30, 60)} - noise
        assert one and two and not one & two
    d = np.sort(np.linalg.norm(x[:, None] - x[None], axis=2), axis=1)[:, 4]
    assert abs(q.kdistance_eps(spark, str(tmp_path)).first()["eps"] - np.percentile(d, 90)) < 1e-4


def test_boosted_attribution_adds_up(labelled):
    model = models.fit_boosted(labelled, ["a", "b", "c"], rounds=4, depth=3)
    each = forest.attribute_boosted(labelled, model, ["a", "b", "c"], "id")
    total = each.groupBy("id").agg((F.sum("contribution") + F.first("base")).alias("m"), F.first("score").alias("s"))
    both = models.probability(model.transform(labelled), "p").select("id", "p").join(total, "id")
    assert both.count() == 600 and both.where("abs(m - s) > 1e-9 OR abs(p - 1 / (1 + exp(-2 * s))) > 1e-9").count() == 0
    assert each.groupBy("feature").agg(F.avg(F.abs("contribution")).alias("c")).orderBy(F.desc("c")).first()["feature"] == "a"


def test_joint_frame(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(v) for v in rng.standard_normal(6)], float(i % 5) if i % 7 else None, 1, "SS7" if i % 3 else "SMPP") for i in range(200)]
    joint, _, names = models.joint_frame(spark.createDataFrame(rows, "id int, vector array<double>, n double, same int, source string"), "vector", ["n", "same"], "source", k=2)
    assert names == ["reduced_0", "reduced_1", "n", "same", "is_SMPP", "is_SS7"] and joint.columns == ["id", "vector", "n", "same", "source", "features"]
    x = np.array([r["features"] for r in joint.collect()])
    assert np.allclose(x.mean(axis=0), 0, atol=1e-9) and np.allclose(x.std(axis=0, ddof=1), [1, 1, 1, 0, 1, 1])
    assert models.clustering_places(names, "content") == [0, 1] and len(models.clustering_places(names)) == 6
    with pytest.raises(ValueError, match="mode"):
        models.clustering_places(names, "some")


def test_dominance_of_repeated_values(spark):
    from tidemark.operators.evaluation import dominance

    rows = spark.range(60_000).select("id", (F.xxhash64("id") % 900).cast("double").alias("a"), F.when(F.col("id") % 10 == 0, 5.0).otherwise(F.col("id") % 2).alias("b"))
    columns = ["a", "b"]
    for seed in range(4):  # by their values, three different rows of b are all drawn or none
        for key in ("id", None):
            x = forest.draw_rows(rows, ["b"], 512, seed=seed, key=key)
            assert len(x) == 512 and abs((x == 5.0).mean() - 0.1) < 0.06
    for key in ("id", None):
        got = {r["left_out"]: r["rho"] for r in dominance(rows, {"one": ["a"], "two": ["b"]}, trees=2, key=key).collect()}
        x = forest.draw_rows(rows, columns, 512, key=key)
        at = rows.toPandas()[columns].to_numpy()
        full = forest.grow_forest(x, columns, trees=2, rows=256, seed=0).score(at)
        for name, c in (("one", 1), ("two", 0)):
            part = forest.grow_forest(x[:, [c]], [columns[c]], trees=2, rows=256, seed=0).score(at[:, [c]])
            assert got[name] == pytest.approx(np.corrcoef(pd.Series(full).rank(), pd.Series(part).rank())[0, 1])
    assert dominance(rows, {"all": columns}, trees=2, key="id").first()["rho"] is None
    with pytest.raises(ValueError, match="nothing"):
        dominance(rows.where("id < 0"), {"one": ["a"], "two": ["b"]}, trees=2)


def test_joint_frame_computes_its_rows_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def run(batches):
        for b in batches:
            seen.add(len(b))
            yield b.assign(vector=[[float(i % 3), float(i % 5), 1.0] for i in b["id"]])

    rows = spark.range(100).withColumn("n", F.col("id") % 7).withColumn("source", F.lit("SS7")).mapInPandas(run, "id long, n long, source string, vector array<double>")
    joint, _, names = models.joint_frame(rows, "vector", ["n"], "source", k=2)
    assert joint.count() == 100 and len(joint.collect()[0]["features"]) == len(names) == 4 and seen.value == 100


def test_hashed_vectors_one_by_one():
    import xxhash

    from tidemark.ml.encoder import hash_vectors

    def one(text, dim):
        padded, v = f" {text.lower()} ", np.zeros(dim)
        for n in (3, 4, 5):
            for i in range(len(padded) - n + 1):
                h = xxhash.xxh64_intdigest(padded[i : i + n])
                v[h % dim] += 1.0 if h >> 63 else -1.0
        norm = np.linalg.norm(v)
        return (v / norm if norm else v).astype(np.float32)

    texts = ["", "a", "Free spin", "é", "\U0001f600\U0001f601\U0001f602\U0001f603\U0001f604x", "İI\0z", "紧急立即马上最后机会", "அவசரம் உடனடியாக", "x" * 5000, " \n\t "]
    for dim in (64, 384):
        assert np.array_equal(hash_vectors(texts, dim), [one(t, dim) for t in texts])
    assert hash_vectors([], 64).shape == (0, 64)
