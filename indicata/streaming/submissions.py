"""Incremental ingestion of partner submission folders with Structured Streaming.

The reference re-reads every submission file each quarter and rebuilds the
history (S4 + S7).  Here a file-stream source picks up only new files, each
micro-batch is aligned to the canonical contract and written into the
period-partitioned history with dynamic partition overwrite (so a re-run of
a quarter replaces exactly that quarter), and the checkpoint in the shared
checkpoint folder makes the job restartable after a lost executor or driver.

Each micro-batch lands in its own ``(period, batch)`` partitions: several
partner files of one quarter may arrive in different batches and must all
be kept, while a retried batch (same id after a failure) overwrites exactly
what its first attempt wrote, so the sink is idempotent.

A partner may hand a submission in again.  Every batch also writes a manifest
of (period, submission, file, version): rows are never removed from the
history, and a reader takes the newest version of each submission by an
anti-join with the older ones.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from indicata.operators.union import Contract, align
from indicata.sources.files import READ_NULL, write_stage


BATCH_COL = "ingest_batch"
VERSION_COLS = "submission string, submission_file string, submitted_at timestamp"


def manifest_path(history: str) -> str:
    return history.rstrip("/") + "_manifest"


def read_manifest(spark: SparkSession, history: str, *, period: str = "period") -> DataFrame:
    """Every version of every submission, and whether it is the newest (``newest``).

    A version is newer that its file changed later; of equal times that of the
    later batch, then of the greater file name.
    """
    schema = f"{period} string, {VERSION_COLS}, {BATCH_COL} bigint"
    rows = spark.read.schema(schema).parquet(manifest_path(history))
    version = F.struct("submitted_at", BATCH_COL, "submission_file")
    top = rows.groupBy(F.col(period).alias("p"), F.col("submission").alias("s")) \
        .agg(F.max(version).alias("top"))
    same = F.col(period).eqNullSafe(F.col("p")) & F.col("submission").eqNullSafe(F.col("s"))
    return rows.join(top, same).withColumn("newest", version == F.col("top")).drop("p", "s", "top")


def read_history(spark: SparkSession, history: str, contract: Contract | None = None, *,
                 period: str = "period", versions: bool = False) -> DataFrame:
    """The history written by :func:`ingest_submissions`, with the newest version of every
    submission only; ``versions`` gives all of them, with the columns that tell them apart.

    With ``contract`` the files are read by its schema, without one their
    schemas are merged.
    """
    if contract is None:
        rows = spark.read.option("mergeSchema", True).parquet(history)
    else:
        rows = spark.read.schema(_stored(contract, period)).parquet(history)
    if versions:
        return rows
    old = read_manifest(spark, history, period=period).filter(~F.col("newest")).select(
        F.col(period).alias("p"), F.col("submission").alias("s"), F.col(BATCH_COL).alias("b"),
        F.col("submission_file").alias("f"))
    # a file may hold several submissions
    gone = F.col(period).eqNullSafe(F.col("p")) & F.col("submission").eqNullSafe(F.col("s")) \
        & (F.col(BATCH_COL) == F.col("b")) & (F.col("submission_file") == F.col("f"))
    # replaced versions only, a row per period and file
    return rows.join(F.broadcast(old), gone, "left_anti").drop(
        BATCH_COL, "submission", "submission_file", "submitted_at")


def _stored(contract: Contract, period: str) -> T.StructType:
    """The history's columns: the contract's, the version's, and those of the partitions."""
    return T.StructType([*[f for f in contract.schema.fields if f.name != period],
                         *T.StructType.fromDDL(VERSION_COLS).fields,
                         T.StructField(period, T.StringType()),
                         T.StructField(BATCH_COL, T.LongType())])


def submission_stream(spark: SparkSession, folder: str, file_schema: T.StructType, *,
                      sep: str = "\t", pattern: str = "*.txt",
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame over delimited submission files in ``folder``.

    ``file_schema`` is the header layout of the files (a stream needs a fixed
    layout; folders with several layouts are read per layout).  Files of
    subfolders count as well; two columns more name a row's file and when it
    changed.
    """
    r = (spark.readStream.option("header", True).option("sep", sep)
         .option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True)
         .option("nullValue", READ_NULL).option("pathGlobFilter", pattern)
         .option("recursiveFileLookup", True)
         .schema(file_schema))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.csv(folder).select(
        "*", F.col("_metadata.file_path").alias("submission_file"),
        F.col("_metadata.file_modification_time").alias("submitted_at"))


def ingest_submissions(spark: SparkSession, folder: str, file_schema: T.StructType,
                       contract: Contract, history: str, checkpoint: str, *,
                       period: str = "period", sep: str = "\t", pattern: str = "*.txt",
                       submission: Sequence[str] = (),
                       available_now: bool = True) -> StreamingQuery:
    """Stream new submission files into the period-partitioned history table.

    Each micro-batch is aligned to ``contract`` and upserted by period.  What
    has the same values in the columns ``submission`` (the partner, say) is one
    submission, which a later file replaces period by period; without such
    columns, files of one name in different folders are its versions.  With
    ``available_now`` the query processes what is there and stops (a
    scheduled quarterly run); otherwise it keeps watching the folder.
    """
    stream = submission_stream(spark, folder, file_schema, sep=sep, pattern=pattern)

    extra = T.StructType.fromDDL(VERSION_COLS).fields[1:]
    wanted = replace(contract, schema=T.StructType([*contract.schema.fields, *extra]))
    name = (F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in submission])
            if submission else F.element_at(F.split("submission_file", "/"), -1))

    def upsert(batch: DataFrame, epoch: int) -> None:
        rows = align(batch, wanted).withColumns({"submission": name,
                                                 BATCH_COL: F.lit(epoch).cast("long")})
        rows = rows.select(*_stored(contract, period).names)
        write_stage(rows, history, partition_by=(period, BATCH_COL))
        kept = spark.read.schema(_stored(contract, period)).parquet(history) \
            .filter(F.col(BATCH_COL) == epoch)
        write_stage(kept.select(period, "submission", "submission_file", "submitted_at", BATCH_COL)
                    .distinct(), manifest_path(history), partition_by=(BATCH_COL,))

    w = (stream.writeStream.foreachBatch(upsert)
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
