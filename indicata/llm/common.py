"""Helpers shared by the operators: input, stage tables, text expressions."""

from __future__ import annotations

import atexit
import ctypes
import gc
import string
import sys
import types
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from indicata.session import checkpoint_dir

#: Bytes of input in a bucket, the greatest number of buckets.
BUCKET_BYTES, MAX_BUCKETS = 32 << 20, 50_000

_WRITTEN: list[tuple[SparkSession, str]] = []
_TABLES: list[tuple[SparkSession, str]] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage_path(spark: SparkSession, name: str) -> str:
    """A new folder for one intermediate table, in the folder of ``spark.checkpoint.dir``.

    It goes when the driver's Python ends; a killed driver leaves it.
    """
    path = f"{checkpoint_dir(spark).rstrip('/')}/indicata-llm/{name}-{uuid.uuid4().hex}"
    _WRITTEN.append((spark, path))
    return path


def stage(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to shared storage and read again.

    This cuts the lineage: a lost executor costs the rereading of files, not
    the work before them.
    """
    path = stage_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, name: str, col: str, size: int) -> DataFrame:
    """``df`` written as a table bucketed by ``col``, so that joins on it move only the other side.

    There are as many buckets as shuffle partitions at least (Spark deals a
    table with fewer anew), and more where ``size`` bytes ask for it.  The
    table leaves the catalog with its files, when the driver's Python ends.
    """
    spark = df.sparkSession
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = min(MAX_BUCKETS, max(1, least, -(-size // BUCKET_BYTES)))
    full = f"indicata_{name}_{uuid.uuid4().hex}"
    (df.write.bucketBy(buckets, col).option("path", stage_path(spark, name)).saveAsTable(full))
    _TABLES.append((spark, full))
    return spark.table(full)


@atexit.register
def _remove_stages() -> None:
    for spark, name in _TABLES:
        try:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        except Exception:  # noqa: BLE001 - the session may have ended before
            break
    for spark, path in _WRITTEN:
        try:
            jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(conf).delete(target, True)
        except Exception:  # noqa: BLE001 - the session may have ended before
            return


def ascii_lower(c: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return (F.when(F.octet_length(c) == F.char_length(c), F.lower(c))
            .otherwise(F.translate(c, string.ascii_uppercase, string.ascii_lowercase)))


def id_text(c: Column) -> Column:
    """An id as text for hashing; null hashes as the empty text."""
    return F.coalesce(c.cast("string"), F.lit(""))


def new_columns(df: DataFrame, names: list[str], text_col: str | None = None) -> list[Column]:
    """The columns of ``df`` that no name in ``names`` replaces."""
    return [F.col(f"`{c}`") for c in df.columns if c not in names]


def worker_slot(key, make: Callable[[], object]):
    """What ``make`` gives for ``key``, kept from task to task in a reused Python worker.

    A worker keeps one thing: another key's replaces it, and the memory goes
    back to the system first.  So an operator's memo does not stay beside the
    next one's.
    """
    name = "_indicata_worker_slot"
    store = sys.modules.setdefault(name, types.ModuleType(name)).__dict__
    if store.get("key") != key:
        store.pop("value", None)
        release()
        store["key"], store["value"] = key, make()
    return store["value"]


def release() -> None:
    """Give unused memory of this process back to the system, where it can be."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not this C library
        pass
