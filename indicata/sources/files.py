"""Readers and writers: delimited text, stage tables, submission folders,
period-partitioned history.

Reads always take an explicit schema (no inference pass over the data);
writes go through executors (``df.write``), never through the driver.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from indicata.operators.joins import refresh_attrs
from indicata.operators.union import Contract, align
from indicata.session import materialize
from indicata.sources.headers import header_rows, list_files, served

# R's read_tsv reads both "NA" and empty fields as missing.
READ_NULL = "NA"

WRITERS_CONF = "spark.sql.maxConcurrentOutputFileWriters"


def read_tsv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str, *,
             sep: str = "\t", null_value: str = READ_NULL) -> DataFrame:
    """Header, whitespace-trimmed, typed delimited scan (``read_delim``).

    "NA" and empty fields read as null; quoted fields use ``"``, a doubled
    quote stands for one, and a backslash is an ordinary character.
    Unparsable values become null (PERMISSIVE) rather than failing the job;
    :func:`bad_rows` lists the lines they came from.  The columns are the scan's
    own, so a filter on one is applied in parsing and the other fields of the
    lines it drops are not converted.
    """
    return (spark.read.option("header", True).option("sep", sep)
            .option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True)
            # an empty field in quotes is read as the null value, one without quotes is null
            .option("nullValue", null_value).option("emptyValue", null_value)
            .option("escape", '"').option("quote", '"').option("mode", "PERMISSIVE")
            .schema(schema).csv(path if isinstance(path, str) else list(path)))


def bad_rows(spark: SparkSession, path: str, schema: T.StructType, *,
             sep: str = "\t", null_value: str = READ_NULL) -> DataFrame:
    """The lines that do not fit ``schema`` (a value of another type, a wrong number of
    fields), as a QA table of one column ``line``; header lines are left out."""
    marked = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    options = {"sep": sep, "nullValue": null_value, "escape": '"', "quote": '"',
               "ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true"}
    parsed = F.from_csv("value", ", ".join(f"`{f.name}` {f.dataType.simpleString()}"
                                           for f in marked.fields), options)
    heads = sorted(set(file_headers(spark, path).values()))
    lines = spark.read.text(path).filter(~F.col("value").isin(heads))
    return lines.filter(parsed["_corrupt_record"].isNotNull()).select(F.col("value").alias("line"))


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Comma-separated variant of :func:`read_tsv`."""
    return read_tsv(spark, path, schema, sep=",")


def write_tsv(df: DataFrame, path: str, *, na: str = "NA", sep: str = "\t",
              mode: str = "overwrite", partition_by: Sequence[str] = ()) -> None:
    """Delimited sink with the reference's null policy.

    ``na="NA"`` is R's default (``write_tsv``); ``na=""`` writes empty
    fields.  Executors write part files in parallel.
    """
    w = (df.write.mode(mode).option("header", True).option("sep", sep)
         .option("nullValue", na).option("emptyValue", ""))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)


def file_headers(spark: SparkSession, pattern: str) -> dict[str, str]:
    """First line of every file matching ``pattern``, in one distributed job.

    Where Arrow opens the store, a task reads each of its files up to the first
    newline (:mod:`indicata.sources.headers`).  In other stores only Spark's
    readers can, which read first blocks: a file's first split (block start 0) is read by one task in line order,
    and ``monotonically_increasing_id`` grows within a task, so the header is
    the line with the smallest id among that file's block-0 lines.  One row
    per file reaches the driver.
    """
    paths = list_files(spark, pattern)
    if served(paths):
        return {r.path: r.header for r in header_rows(spark, paths).collect()}
    lines = (spark.read.text(pattern)
             .select(F.input_file_name().alias("path"),
                     F.input_file_block_start().alias("block"),
                     F.monotonically_increasing_id().alias("i"), "value")
             .filter(F.col("block") == 0))
    first = lines.groupBy("path").agg(F.min_by("value", "i").alias("header"))
    return {r.path: r.header for r in first.collect()}


def read_folder(spark: SparkSession, pattern: str, contract: Contract, *,
                sep: str = "\t", null_value: str = READ_NULL) -> DataFrame:
    """Read every delimited file matching ``pattern`` and row-bind them by name.

    Spark's multi-file CSV read aligns columns by position, so files are
    grouped by header layout (all headers come from one distributed job,
    :func:`file_headers`), each group is read in a single scan, aligned to
    ``contract`` by name, and the groups are unioned.
    """
    groups: dict[tuple[str, ...], list[str]] = {}
    for path, header in sorted(file_headers(spark, pattern).items()):
        cols = tuple(h.strip().strip('"') for h in header.split(sep))
        groups.setdefault(cols, []).append(path)
    if not groups:
        return spark.createDataFrame([], contract.schema)
    parts = []
    for header, paths in groups.items():
        raw_schema = T.StructType([T.StructField(h, T.StringType()) for h in header])
        parts.append(align(read_tsv(spark, paths, raw_schema, sep=sep, null_value=null_value),
                           contract))
    return reduce(lambda a, b: a.unionByName(b), parts)


@contextmanager
def open_writers(spark: SparkSession, n: int) -> Iterator[None]:
    """Partitioned writes inside need no sort of their rows up to ``n`` partitions a task."""
    if not n:
        yield
        return
    was = spark.conf.get(WRITERS_CONF, None)
    spark.conf.set(WRITERS_CONF, str(n))
    try:
        yield
    finally:
        if was is None:
            spark.conf.unset(WRITERS_CONF)
        else:
            spark.conf.set(WRITERS_CONF, was)


def write_stage(df: DataFrame, path: str, *, partition_by: Sequence[str] = ("fy",),
                mode: str = "overwrite", open_files: int = 0) -> None:
    """Persist an intermediate fact as Parquet, partitioned (default by fy).

    Dynamic partition overwrite replaces only the partitions present in
    ``df``, so re-running one year leaves the others untouched.  A task sorts its
    rows by partition; with ``open_files`` it holds that many files open instead
    and sorts only the rows of further partitions.
    """
    with open_writers(df.sparkSession, open_files):
        (df.write.mode(mode).option("partitionOverwriteMode", "dynamic")
           .partitionBy(*partition_by).parquet(path))


def read_stage(spark: SparkSession, path: str,
               schema: T.StructType | str | None = None) -> DataFrame:
    """Read a stage table; filters on partition columns prune directories.

    Partitions written at different times may differ in columns: with a
    declared ``schema`` absent ones read as null, without one the files'
    schemas are merged, so no column is lost.
    """
    if schema is not None:
        return spark.read.schema(schema).parquet(path)
    return spark.read.option("mergeSchema", True).parquet(path)


def load_dim(spark: SparkSession, path: str, columns: Sequence[str], *,
             fmt: str = "parquet", schema: T.StructType | None = None) -> DataFrame:
    """A dimension table reduced to the columns a pipeline needs."""
    if fmt == "parquet":
        df = spark.read.parquet(path)
    else:
        df = read_tsv(spark, path, schema, sep="\t" if fmt == "tsv" else ",")
    return df.select(*columns)


def upsert_period(df: DataFrame, table: str, *, period: str = "period",
                  schema: T.StructType | str | None = None) -> DataFrame:
    """Write this batch's periods into a history table and return the full history.

    Only the partitions of the periods present in ``df`` are replaced
    (dynamic overwrite), so re-running a quarter is idempotent.  With the
    history's contract as ``schema``, a column that it does not name is an
    error; without one, a quarter may add columns, which read as null in the
    quarters before it.
    """
    if schema is not None:
        known = (T.StructType.fromDDL(schema) if isinstance(schema, str) else schema).names
        extra = [c for c in df.columns if c not in known]
        if extra:
            raise ValueError(f"columns outside the history's contract: {', '.join(extra)}")
    write_stage(df, table, partition_by=(period,))
    return read_stage(df.sparkSession, table, schema)


def refresh_history(spark: SparkSession, table: str, old_master: DataFrame,
                    new_master: DataFrame, on: str, attrs: Sequence[str], *,
                    period: str = "period") -> list[str]:
    """Bring a stored history's attributes from one master list to the next.

    Only periods that hold a site whose attributes differ between the two lists
    (or that only one of them has) are read in full and written again; the
    others keep their files.  Returns the periods that were rewritten.  A master
    list has one row per site; running it again changes nothing.
    """
    def side(master: DataFrame, name: str) -> DataFrame:
        return master.select(F.col(on), F.struct(*attrs).alias(name))

    both = side(old_master, "old").join(side(new_master, "new"), on, "full_outer")
    changed = both.filter(~F.col("old").eqNullSafe(F.col("new"))).select(on)
    history = spark.read.parquet(table)
    held = history.select(on, period).distinct().join(changed, on, "left_semi")
    periods = [r[0] for r in held.select(period).distinct().collect()]  # bounded by the periods
    if periods:
        here = F.col(period).isin([p for p in periods if p is not None])
        rows = history.filter(here | F.col(period).isNull() if None in periods else here)
        fresh = refresh_attrs(rows, new_master, on, attrs).select(*history.columns)
        write_stage(materialize(fresh), table, partition_by=(period,))
    return sorted(periods, key=lambda p: (p is not None, p))


def export_period(df: DataFrame, directory: str, *, period: str = "period",
                  fmt: str = "tsv", na: str = "") -> None:
    """Write one folder per period (``period=2024 Q4``), so the file name
    carries the period as in the reference's period-named outputs."""
    if fmt == "tsv":
        write_tsv(df, directory, na=na, partition_by=(period,))
    else:
        write_stage(df, directory, partition_by=(period,))


def with_source_file(df: DataFrame, name: str = "source_file") -> DataFrame:
    """Tag rows with the file they came from (QA of submissions)."""
    return df.withColumn(name, F.input_file_name())
