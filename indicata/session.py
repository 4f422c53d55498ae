"""Session and checkpoint-directory helpers."""

from __future__ import annotations

import atexit
import os
import tempfile

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

# Defaults a user would set for these workloads; every one can be overridden.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "indicata",
                shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """Build (or reuse) a session with AQE and skew-join handling on."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in {**DEFAULT_CONF, **conf}.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    Reads ``spark.checkpoint.dir`` (or the context's directory).  Only when
    neither is set *and* the master is local (tests, laptops) does it create
    a private folder; on a cluster an unset directory is an error, because a
    machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder "
            "(HDFS/S3/...) before running operators that cut lineage")
    path = tempfile.mkdtemp(prefix="indicata-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written stage tables."""
    base = checkpoint_dir(spark)
    path = base.rstrip("/") + "/" + name + "-" + os.urandom(4).hex()
    _WRITTEN.append((spark, path))
    return path


_WRITTEN: list[tuple[SparkSession, str]] = []
_TABLES: list[tuple[SparkSession, str]] = []


@atexit.register
def _remove_scratch() -> None:
    """Remove this driver's stage tables when its Python ends."""
    for spark, table in _TABLES:
        try:
            spark.sql(f"DROP TABLE IF EXISTS {table}")
        except Exception:  # noqa: BLE001 - the session may have ended before
            break
    for spark, path in _WRITTEN:
        try:
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
        except Exception:  # noqa: BLE001 - the session may have ended before
            return


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a table or a partition's folder, in whatever store it lies."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def path_state(spark: SparkSession, path: str) -> tuple[int, int, int]:
    """Bytes, files and time of the last change of a table, which tell two versions apart."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    held = fs.getContentSummary(target)
    return held.getLength(), held.getFileCount(), fs.getFileStatus(target).getModificationTime()


def bucket_keys(spark: SparkSession, n: int) -> list[int]:
    """``n`` numbers that the hash of ``n`` buckets puts into one bucket each, so that no bucket
    gets two of them (one row a bucket is fetched)."""
    number = F.col("id").cast("int")
    found = (spark.range(20 * n + 64).groupBy(F.pmod(F.hash(number), F.lit(n)).alias("bucket"))
             .agg(F.min(number).alias("key")).orderBy("bucket").collect())
    return [r["key"] for r in found]


def bucketed(df, column: str, buckets: int, name: str = "bucketed"):
    """``df`` as a written table bucketed by ``column``: groups, windows and joins on it need no
    shuffle.  The table leaves the catalog when this driver's Python ends."""
    spark = df.sparkSession
    table = f"indicata_{name}_{os.urandom(8).hex()}"
    _TABLES.append((spark, table))
    (df.write.bucketBy(buckets, column).option("path", scratch_path(spark, name))
       .saveAsTable(table))
    return spark.table(table)


def materialize(df, *, how: str = "table"):
    """Cut lineage of an intermediate read by several branches of one job.

    ``how="table"`` (default) writes Parquet into the shared checkpoint
    folder and reads it back: every branch then gets column pruning and
    predicate pushdown on the intermediate, and a lost executor does not
    force recomputing the upstream joins.  ``how="checkpoint"`` is Spark's
    reliable checkpoint (same folder), which also keeps the physical
    partitioning (used where partition ids must stay fixed).  Never a
    machine-local cache or folder.
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    if how == "checkpoint":
        return df.checkpoint(eager=True)
    path = scratch_path(spark, "stage")
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
