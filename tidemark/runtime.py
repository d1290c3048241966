"""Where intermediate tables live, and other session-level plumbing."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it in ``spark.checkpoint.dir``.

    Only where that is unset and the master is local (tests, a laptop) a temporary
    folder is made and set; on a cluster nothing is written to one machine's disk.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    app = spark.sparkContext.applicationId
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if app not in _own:
        _own[app] = "file://" + tempfile.mkdtemp(prefix="tidemark-")
        spark.sparkContext.setCheckpointDir(_own[app])
    return _own[app]


def materialize(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    This cuts the lineage in a way that survives the loss of executors. The
    table is removed when the session's driver ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    atexit.register(_remove, spark, path)
    return spark.read.schema(df.schema).parquet(path)


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # noqa: BLE001 - the session may be gone already
        pass


def broadcast_if_small(df: DataFrame, max_rows: int = 100_000, max_bytes: int = 64 << 20) -> DataFrame:
    """Hint a broadcast only after measuring that ``df`` has at most ``max_rows`` rows and ``max_bytes`` bytes.

    Beyond that the frame is returned unhinted, and the join is left to
    shuffle. Measuring stops after ``max_rows + 1`` rows.
    """
    sizes = [F.coalesce(F.octet_length(c), F.lit(0)) if t in ("string", "binary") else 8 * F.greatest(F.size(c), F.lit(0)) if t.startswith("array") else F.lit(8) for c, t in df.dtypes]
    width = sum(sizes, F.lit(8)).cast("long")
    rows, size = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
    return F.broadcast(df) if rows <= max_rows and size <= max_bytes else df


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
