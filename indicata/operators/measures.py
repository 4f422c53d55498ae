"""Aggregations: null-safe sums, conditional sums, frequency tables, bounds,
shares and the distributed cumulative share."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from indicata.functions.expressions import ratio
from indicata.session import bucket_keys, bucketed


def group_sum(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """``summarize(across(cols, sum, na.rm=TRUE))``: a group's sum of nothing is 0.

    Hash aggregation with map-side partial sums, so a hot key costs one
    partial row per map task, not a third of the data in one task.
    """
    return df.groupBy(*keys).agg(*[
        F.coalesce(F.sum(c), F.lit(0).cast("double")).alias(c) for c in columns])


def group_sum_rest(df: DataFrame, part: str) -> DataFrame:
    """Group by every column that is not a measure, summing the measures.

    Measures are the columns whose name contains ``part`` anywhere, case
    ignored (as ``contains``); all other columns are keys.
    """
    measures = [c for c in df.columns if part.lower() in c.lower()]
    keys = [c for c in df.columns if c not in measures]
    return group_sum(df, keys, measures)


def freq(df: DataFrame, keys: Sequence[str], sort: bool = False, name: str = "n") -> DataFrame:
    """Row count per key combination (``count(..., sort=TRUE)``)."""
    out = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    return out.orderBy(F.col(name).desc(), *keys) if sort else out


def distinct_values(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct key combinations (partial aggregation before the shuffle)."""
    return df.select(*keys).distinct()


def sum_when(df: DataFrame, keys: Sequence[str],
             measures: Mapping[str, tuple[Column, Column | str | float]]) -> DataFrame:
    """Conditional sums: ``{name: (condition, value)}``, 0 where nothing matches."""
    aggs = []
    for name, (cond, value) in measures.items():
        v = F.col(value) if isinstance(value, str) else (
            value if isinstance(value, Column) else F.lit(value))
        aggs.append(F.coalesce(F.sum(F.when(cond, v).otherwise(F.lit(0))),
                               F.lit(0)).alias(name))
    return df.groupBy(*keys).agg(*aggs)


def fetch_scalars(one_row: DataFrame) -> dict[str, Column]:
    """Run a one-row aggregate and return its values as typed literal Columns.

    For bounds that many expressions reference: one small job computes them
    and every later expression carries a constant.  (A scalar sub-query
    Column referenced in many expressions is planned once per reference.)
    Only the single aggregate row reaches the driver.
    """
    row = one_row.first()
    return {f.name: F.lit(None if row is None else row[f.name]).cast(f.dataType)
            for f in one_row.schema.fields}


def period_bounds(df: DataFrame, *, date: str = "date", period: str = "period",
                  where: Column | None = None) -> dict[str, Column]:
    """Reporting bounds ``{"min_date", "max_date", "max_period"}`` as literals.

    One aggregate job over the (filtered) input; see :func:`fetch_scalars`.
    """
    base = df.filter(where) if where is not None else df
    return fetch_scalars(base.agg(F.min(date).alias("min_date"), F.max(date).alias("max_date"),
                                  F.max(period).alias("max_period")))


def share_of_total(df: DataFrame, measure: str, name: str) -> DataFrame:
    """measure / grand total, with the total as a scalar sub-query."""
    total = df.agg(F.sum(measure)).scalar()
    return df.withColumn(name, ratio(F.col(measure), total))


def cumulative_share(df: DataFrame, measure: str, tie_keys: Sequence[str], *,
                     cum_col: str | None = None, share_col: str | None = None,
                     num_partitions: int | None = None,
                     zero_total_share: float | None = None) -> DataFrame:
    """Running sum of ``measure`` in descending order, and its share of the total.

    Order: ``measure`` descending, then ``tie_keys`` ascending with nulls
    last (a total order
    when the tie keys are unique, which makes the result deterministic).

    It scales: range-partition on the sort keys (balanced even when many rows
    share a value, because the tie keys split them) and write that as a table
    bucketed by the partition number, the one shuffle of the rows.  Sums per
    partition (one row each) become offsets on a tiny table, and each row's
    in-partition running sum, a window that the buckets already serve, is added
    to its partition's offset.
    """
    cum_col = cum_col or f"{measure}_cum"
    share_col = share_col or f"{measure}_cum_per"
    # ties follow the key order with nulls last, as R sorts groups
    order = [F.col(measure).desc()] + [F.col(k).asc_nulls_last() for k in tie_keys]
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *order).withColumns({
        "_pid": F.spark_partition_id(),
        "_slot": F.element_at(F.lit(bucket_keys(spark, n)), F.spark_partition_id() + 1)})
    ranged = bucketed(ranged, "_slot", n, "share")   # each range is a bucket of its own
    part = ranged.groupBy("_slot").agg(F.min("_pid").alias("_pid"),
                                       F.coalesce(F.sum(measure), F.lit(0.0)).alias("_psum"))
    # `part` has one row per range partition (bounded by n): the window
    # over it and the broadcast below are small by construction.
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = part.select(
        "_slot",
        F.coalesce(F.sum("_psum").over(before), F.lit(0.0)).alias("_offset"),
        F.sum("_psum").over(Window.partitionBy()).alias("_total"))
    local = Window.partitionBy("_slot").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    out = (ranged.withColumn("_local", F.sum(measure).over(local))
                 .join(F.broadcast(offsets), "_slot")
                 .withColumn(cum_col, F.col("_local") + F.col("_offset"))
                 .drop("_pid", "_slot", "_local", "_offset"))
    share = ratio(F.col(cum_col), F.col("_total"))
    if zero_total_share is not None:
        share = F.when((F.col("_total") == 0) & (F.col(cum_col) == 0),
                       F.lit(zero_total_share)).otherwise(share)
    return out.withColumn(share_col, share).drop("_total")
