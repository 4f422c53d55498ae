"""Operator 5, exact dedup: an extendible-hash index on shared files.

DataFrame functions only.

1. *Directory.*  From the 64-bit keys of the normalised texts, of which only
   counts are moved.  It starts with ``2**g`` slots and doubles while a bucket
   holds more keys than ``bucket_capacity``; only overfull buckets are split,
   the others are shared by several slots.
2. *Entries.*  A row's key names its slot, and the slot its bucket.  Rows are
   grouped by bucket, key and normalised text, which compares the texts' bytes:
   two texts with one key are two entries.  Spark combines copies before the
   shuffle, so a hot group sends one row per task.
3. *Index files.*  Buckets are prefixes of the key, so a range of keys is a run
   of buckets: each owner task gets one range, chains the entries that share a
   key and writes them in order.
4. *Probe.*  A row looks its bucket up in the directory again, and there its
   key and the digest of its normalised text name its entry.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from indicata.llm.common import ascii_lower, new_columns, stage

COLUMNS = ["keep_id", "group_size", "kept", "text_sha256"]
MAX_DEPTH = 48
#: A directory of at most so many slots (16 bytes each) is broadcast; beyond it the join shuffles.
BROADCAST_SLOTS = 1 << 20


def _prefix(key: Column, depth: int) -> Column:
    return F.shiftrightunsigned(key, 64 - depth) if depth else F.lit(0).cast("long")


def directory(keys: DataFrame, bucket_capacity: int) -> DataFrame:
    """Slots of the directory over distinct keys: slot, bucket, depth, global depth.

    A bucket at the greatest depth is not split further and keeps its overflow.
    """
    total = keys.count()
    depth = max(0, math.ceil(math.log2(max(1, total) / bucket_capacity)))
    leaves, rest = None, keys
    while True:
        cells = stage(rest.groupBy(_prefix(F.col("key"), depth).alias("prefix"))
                      .agg(F.count(F.lit(1)).alias("n"))
                      .withColumn("depth", F.lit(depth)), "directory")
        last = depth >= MAX_DEPTH
        full = F.col("n") > (float("inf") if last else bucket_capacity)
        settled = cells.filter(~full)
        leaves = settled if leaves is None else leaves.unionByName(settled)
        over = cells.filter(full)
        if last or over.isEmpty():
            break
        rest = rest.join(over.select("prefix"), _prefix(F.col("key"), depth) == F.col("prefix"),
                         "left_semi")
        depth += 1
    span = F.pow(F.lit(2.0), F.lit(depth) - F.col("depth")).cast("long")
    slots = F.sequence(F.col("prefix") * span, (F.col("prefix") + 1) * span - 1)
    return leaves.select(F.explode(slots).alias("slot"),
                         (F.col("prefix") * span).alias("bucket"), "depth",
                         F.lit(depth).alias("global_depth"))


def located(rows: DataFrame, slots: DataFrame) -> DataFrame:
    """``rows`` with the bucket that the directory names for their ``key``."""
    size, depth = slots.agg(F.count(F.lit(1)), F.max("global_depth")).first()
    known = slots.select("slot", "bucket")
    known = F.broadcast(known) if size <= BROADCAST_SLOTS else known
    return rows.withColumn("slot", _prefix(F.col("key"), depth or 0)).join(known, "slot") \
        .drop("slot")


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                bucket_capacity: int = 200_000,
                key: Callable[[Column], Column] = F.xxhash64) -> tuple[DataFrame, DataFrame]:
    """The directory, and the index as a table of shared files, ordered by bucket and key.

    Columns of the index: bucket, key, chain (place among the entries of one
    key), text_sha256, keep_id, group_size.
    """
    norm = ascii_lower(F.coalesce(F.col(text_col), F.lit("")))
    rows = docs.select(F.col(id_col).alias("id"), norm.alias("norm"))
    rows = rows.select("id", "norm", key(F.col("norm")).cast("long").alias("key"))
    keys = stage(rows.select("key").distinct(), "keys")
    slots = stage(directory(keys, bucket_capacity), "slots")
    entries = (located(rows, slots).groupBy("bucket", "key", "norm")
               .agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
               .select("bucket", "key", F.sha2("norm", 256).alias("text_sha256"), "keep_id",
                       "group_size"))
    entries = stage(entries, "entries")
    chain = F.row_number().over(Window.partitionBy("bucket", "key").orderBy("text_sha256"))
    owned = entries.repartitionByRange(F.col("bucket"), F.col("key")).withColumn("chain", chain)
    return slots, stage(owned.sortWithinPartitions("bucket", "key", "chain"), "index")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                bucket_capacity: int = 200_000,
                key: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """Every row of ``docs`` with keep_id, group_size, kept and text_sha256.

    Texts are equal when identical after lower-casing A-Z; null counts as
    empty.  The largest id of a group stays; rows that repeat that id stay
    together.  A null id is less than any other, and stays where its group has
    no other.  Input columns with the names of the new ones are replaced.  An
    empty table gives an empty result.
    """
    slots, index = build_index(docs, id_col, text_col, bucket_capacity, key)
    norm = ascii_lower(F.coalesce(F.col(text_col), F.lit("")))
    kept = new_columns(docs, [c for c in COLUMNS if c != id_col])
    rows = docs.select(F.struct(*kept).alias("__row"), norm.alias("norm"))
    rows = located(rows.select("__row", key(F.col("norm")).cast("long").alias("key"),
                               F.sha2("norm", 256).alias("text_sha256")), slots)
    found = index.select("bucket", "key", "text_sha256", "keep_id", "group_size")
    return (rows.join(found, ["bucket", "key", "text_sha256"])
            .select("__row.*", "keep_id", "group_size", "text_sha256")
            .withColumn("kept", F.col(id_col).eqNullSafe(F.col("keep_id"))))
