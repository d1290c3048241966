"""File sources and sinks: typed CSV scans, verified writes, manifests and registries."""

from __future__ import annotations

import json
import uuid

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.ingest import keep_latest, upsert


def scan_csv(spark: SparkSession, folder: str, schema: T.StructType | str, *, recursive: bool = True) -> DataFrame:
    """All ``*.csv`` files below ``folder`` with an explicit schema, plus ``_file`` (stem) and ``_corrupt``.

    Nothing is inferred. Rows that do not fit bear their raw text in
    ``_corrupt`` with nulls elsewhere; unreadable files are skipped
    (``ignoreCorruptFiles``), so one bad file never stops the others.
    """
    fields = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    full = T.StructType([*fields.fields, T.StructField("_corrupt", T.StringType())])
    reader = spark.read.schema(full).option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").option("multiLine", False).option("ignoreCorruptFiles", True).option("pathGlobFilter", "*.csv").option("recursiveFileLookup", recursive)
    return reader.csv(folder).withColumn("_file", F.regexp_replace(F.col("_metadata.file_name"), r"\.csv$", ""))


def file_report(scanned: DataFrame) -> DataFrame:
    """Rows and corrupt rows of each file; evaluates the scan once."""
    return scanned.groupBy("_file").agg(F.count(F.lit(1)).alias("rows"), F.count("_corrupt").alias("corrupt"))


def repair_empty_text(df: DataFrame, text: str = "text", failed: str = "text_decode_failed") -> DataFrame:
    """CSV reads empty strings as null: text that failed to decode is ``""`` again, other nulls stay."""
    return df.withColumn(text, F.when(F.col(failed), F.coalesce(text, F.lit(""))).otherwise(F.col(text)))


def sample_rows(df: DataFrame, keys: list[str], uniform: float, chosen: str | None = None, chosen_share: float = 0.0, seed: int = 0) -> DataFrame:
    """A uniform Bernoulli sample, united with one of the rows where ``chosen`` holds; repeatable by hash of ``keys``."""
    draw = lambda salt: (F.pmod(F.xxhash64(F.lit(seed), F.lit(salt), *keys), F.lit(1 << 30)) / F.lit(float(1 << 30)))
    keep = draw(1) < uniform
    return df.where(keep | (F.expr(chosen) & (draw(2) < chosen_share)) if chosen else keep)


def sample_n(df: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """``n`` rows by a seeded hash of ``key``, the same on every run; a top-n, not a sort."""
    return df.orderBy(F.md5(F.concat(F.lit(f"{seed}|"), F.col(key).cast("string"))), key).limit(n)


def head(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """The first ``n`` rows in a stated order."""
    return df.orderBy(*order).limit(n)


def write_two(df: DataFrame, features: list[str], labels: list[str], out: str) -> None:
    """Features and labels as two Parquet tables from one evaluation of ``df``."""
    df.persist()
    try:
        df.select(*features).write.mode("overwrite").parquet(f"{out}/features")
        df.select(*labels).write.mode("overwrite").parquet(f"{out}/labels")
    finally:
        df.unpersist()


def write_verified(df: DataFrame, path: str, partition_by: list[str] | None = None) -> int:
    """Write Parquet, read the row count back, and raise unless both agree."""
    from pyspark.sql import Observation

    seen = Observation("written")
    writer = df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    back = df.sparkSession.read.parquet(path).count()
    if back != seen.get["n"]:
        raise OSError(f"{path}: wrote {seen.get['n']} rows, read {back}")
    return back


def update_manifest(spark: SparkSession, path: str, new: DataFrame, key: str = "source") -> DataFrame:
    """Replace the manifest's rows of the keys in ``new`` and keep the others. A manifest is small by nature."""
    fs, target = _hadoop(spark, path)
    kept = spark.read.parquet(path).join(F.broadcast(new.select(key).distinct()), key, "left_anti").unionByName(new, allowMissingColumns=True) if fs.exists(target) else new
    rows = spark.createDataFrame(kept.collect(), kept.schema)  # read before its files are replaced
    rows.coalesce(1).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def save_state(df: DataFrame, at: str, path: str) -> dict:
    """Row count and latest time of a stage as a JSON file."""
    n, latest = df.agg(F.count(F.lit(1)), F.max(at).cast("string")).first()
    state = {"row_count": n, "max_timestamp": latest}
    _write_text(df.sparkSession, path, json.dumps(state))
    return state


def is_due(df: DataFrame, at: str, path: str, least_rows: int) -> bool:
    """Whether ``least_rows`` more rows than in the saved state exist; true without a state."""
    fs, target = _hadoop(df.sparkSession, path)
    if not fs.exists(target):
        return True
    before = json.loads("".join(r[0] for r in df.sparkSession.read.text(path).collect()))
    return df.count() - before["row_count"] >= least_rows


def disclose(spark: SparkSession, folder: str, note: str | None) -> None:
    """A ``_SAMPLE`` note beside a table that holds a sample only; None removes it."""
    fs, target = _hadoop(spark, f"{folder}/_SAMPLE")
    if note is None:
        fs.delete(target, False)
    else:
        _write_text(spark, f"{folder}/_SAMPLE", note)


def write_vectors(df: DataFrame, path: str, key: str = "message_key", vector: str = "vector") -> None:
    """Vectors with their keys in the same row; rows cannot lose their alignment."""
    df.select(key, F.col(vector).cast("array<float>").alias(vector)).write.mode("overwrite").parquet(path)


ONLINE_BUCKETS = 64


def upsert_online(spark: SparkSession, path: str, rows: DataFrame, keys: list[str], order: list[str] | None = None) -> None:
    """Merge rows into a keyed snapshot store, as a stream's ``foreachBatch`` does; see :func:`read_online`.

    The store is cut into buckets by hash of the key. Only buckets that the rows
    touch are rewritten, beside the old ones; then a new pointer file names
    the files in force. It appears by one rename, so a reader sees the store
    before or after, never between, and a crash leaves the store as it was. Of a
    key's new rows that of the largest ``order`` wins. One writer at a time.
    """
    placed = rows.withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(ONLINE_BUCKETS)).cast("int"))
    touched = [str(r[0]) for r in placed.select("_bucket").distinct().collect()]
    number, live = _pointer(spark, path)
    old = [live[b] for b in touched if b in live]
    rest = [c for c in rows.columns if c not in keys]
    merged = upsert(spark.read.option("recursiveFileLookup", True).parquet(*old).withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(ONLINE_BUCKETS)).cast("int")), placed, [*keys, "_bucket"], order) if old else keep_latest(placed, [*keys, "_bucket"], order or rest or keys)
    version = f"{path}/v{number + 1}-{uuid.uuid4().hex}"
    merged.repartition("_bucket").write.partitionBy("_bucket").parquet(version)
    fs, target = _hadoop(spark, f"{path}/_live/{number + 1:012d}")
    _write_text(spark, f"{path}/_staged/{number + 1:012d}", json.dumps(live | {b: f"{version}/_bucket={b}" for b in touched}))
    fs.mkdirs(target.getParent())
    if not fs.rename(_hadoop(spark, f"{path}/_staged/{number + 1:012d}")[1], target):
        raise OSError(f"{path}: another writer was first")
    for b in old:  # what the pointer before the last named may go; readers of the last one may still be at work
        _write_text(spark, f"{path}/_old/{number + 1:012d}-{uuid.uuid4().hex}", b)
    _sweep(spark, path, number)


def read_online(spark: SparkSession, path: str) -> DataFrame | None:
    """The snapshot store's rows as of the last finished merge; None if there is none."""
    live = _pointer(spark, path)[1]
    return spark.read.option("recursiveFileLookup", True).parquet(*live.values()) if live else None


def _pointer(spark: SparkSession, path: str) -> tuple[int, dict[str, str]]:
    fs, folder = _hadoop(spark, f"{path}/_live")
    numbers = [int(f.getPath().getName()) for f in fs.listStatus(folder) if f.getPath().getName().isdigit()] if fs.exists(folder) else []
    if not numbers:
        return 0, {}
    text = "".join(r[0] for r in spark.read.text(f"{path}/_live/{max(numbers):012d}").collect())
    return max(numbers), json.loads(text)


def _sweep(spark: SparkSession, path: str, before: int) -> None:
    """Delete files that were replaced up to the pointer ``before``, and older pointers."""
    fs, folder = _hadoop(spark, f"{path}/_old")
    for f in fs.listStatus(folder) if fs.exists(folder) else []:
        if int(f.getPath().getName().split("-")[0]) <= before:
            fs.delete(_hadoop(spark, spark.read.text(f.getPath().toString()).first()[0])[1], True)
            fs.delete(f.getPath(), False)
    for f in fs.listStatus(_hadoop(spark, f"{path}/_live")[1]):
        if int(f.getPath().getName()) < before:
            fs.delete(f.getPath(), False)


def _hadoop(spark: SparkSession, path: str):  # noqa: ANN202
    sc: SparkContext = spark.sparkContext
    target = sc._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(sc._jsc.hadoopConfiguration()), target


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, target = _hadoop(spark, path)
    out = fs.create(target, True)
    out.write(bytearray(text.encode()))
    out.close()


# --- a model registry as a table ---------------------------------------------------------

REGISTRY_SCHEMA = "model string, version long, metric string, value double, path string, champion boolean"


def register(spark: SparkSession, path: str, model: str, metric: str, value: float, location: str, *, least_gain: float = 0.0) -> bool:
    """Record a version; it becomes champion if there is none, or if it beats the champion's metric by ``least_gain``."""
    fs, target = _hadoop(spark, path)
    rows = [tuple(r) for r in spark.read.parquet(path).collect()] if fs.exists(target) else []
    mine = [r for r in rows if r[0] == model and r[2] == metric]
    best = next((r for r in mine if r[5]), None)
    promoted = best is None or value >= best[3] + least_gain
    version = max([r[1] for r in rows if r[0] == model], default=0) + 1
    kept = [(*r[:5], r[5] and not (promoted and r in mine)) for r in rows]
    spark.createDataFrame([*kept, (model, version, metric, float(value), location, promoted)], REGISTRY_SCHEMA).coalesce(1).write.mode("overwrite").parquet(path)
    return promoted


def champion(spark: SparkSession, path: str, model: str) -> str | None:
    """Where the champion of a model is stored."""
    row = spark.read.parquet(path).where((F.col("model") == model) & F.col("champion")).select("path").first()
    return row[0] if row else None
