"""Wide/long reshaping without shuffles where the semantics allow it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Measure columns of a wide-by-quarter extract and their (period_type, quarter).
QUARTER_COLUMNS = [("qtr1", "results", 1), ("qtr2", "results", 2), ("qtr3", "results", 3),
                   ("qtr4", "results", 4), ("cumulative", "cumulative", None),
                   ("targets", "targets", None)]


def reshape_long(df: DataFrame, *, fiscal_year: str = "fiscal_year",
                 measures: Sequence[tuple[str, str, int | None]] = QUARTER_COLUMNS,
                 keep_null: bool = False, quarter: str | None = None) -> DataFrame:
    """Wide-by-quarter extract -> long (``period_type``, ``period``, ``value``).

    ``period`` is "FY24Q2" for quarter columns and "FY24" for cumulative and
    targets, so only quarter rows carry a quarter.  One ``Generate`` over an
    array of structs: a narrow, single-scan operator.  Null measures are
    dropped (zeros kept) unless ``keep_null``.  ``quarter`` names a column for
    the quarter's number in place of ``period``, null where the year is.
    """
    present = [(c, t, q) for c, t, q in measures if c in df.columns]
    ids = [c for c in df.columns if c not in {m[0] for m in measures}]
    yy = F.lpad(F.pmod(F.col(fiscal_year).cast("int"), F.lit(100)).cast("string"), 2, "0")
    structs = []
    for c, t, q in present:
        if quarter:
            period = F.when(F.col(fiscal_year).isNotNull(), F.lit(q)).cast("int").alias(quarter)
        else:
            period = F.concat(F.lit("FY"), yy, F.lit(f"Q{q}" if q else "")).alias("period")
        structs.append(F.struct(F.lit(t).alias("period_type"), period,
                                F.col(c).cast("double").alias("value")))
    out = df.select(*ids, F.inline(F.array(*structs)))
    return out if keep_null else out.filter(F.col("value").isNotNull())


def listed(df: DataFrame, key: str, names: Sequence[str]) -> DataFrame:
    """The rows as they are; a ``key`` outside ``names`` fails the query."""
    known = F.col(key).isNull() | F.col(key).isin(list(names))
    return df.filter(F.when(known, F.lit(True)).otherwise(F.raise_error(F.concat(
        F.lit(f"spread: {key} is not a listed name: "), F.col(key).cast("string")))
        .cast("boolean")))


def spread(df: DataFrame, key: str, value: str, names: Sequence[str], *,
           drop: bool = True, strict: bool = True) -> DataFrame:
    """Long -> one-hot wide, row-preserving (``pivot_wider`` on a row id).

    Each row keeps its identity; column ``n`` holds ``value`` where
    ``key == n`` and null elsewhere.  A projection: no row id, no shuffle.
    ``names`` come from the rule set, never from a scan of the data; a row
    with a key outside them fails the query, as its value would be lost
    (``strict=False`` lets such rows pass with nulls).
    """
    if strict:
        df = listed(df, key, names)
    cols = [F.when(F.col(key) == F.lit(n), F.col(value)).alias(n) for n in names]
    base = [c for c in df.columns if not (drop and c in (key, value)) and c not in names]
    return df.select(*base, *cols)


def gather(df: DataFrame, ids: Sequence[str], columns: Sequence[str], *,
           names_to: str = "indicator", values_to: str = "value",
           drop_null: bool = True) -> DataFrame:
    """Wide -> long over ``columns`` (``pivot_longer``), nulls dropped by default.

    An absent column is an error, as it is in ``all_of``.
    """
    absent = [c for c in columns if c not in df.columns]
    if absent or not columns:
        raise ValueError(f"gather: absent columns: {', '.join(absent) or 'none given'}")
    out = df.unpivot(list(ids), list(columns), names_to, values_to)
    return out.filter(F.col(values_to).isNotNull()) if drop_null else out


def pivot_sum(df: DataFrame, keys: Sequence[str], key: str, value: str,
              names: Sequence[str], *, fill_zero: bool = True) -> DataFrame:
    """Sum ``value`` per ``keys`` with one column per ``key`` value.

    ``fill_zero=True`` is pivot-then-sum (a missing side is 0);
    ``fill_zero=False`` is sum-then-pivot (a missing side stays null).
    Only keys having at least one row of any of ``names`` appear.
    """
    rows = df.filter(F.col(key).isin(list(names)))
    out = rows.groupBy(*keys).pivot(key, list(names)).agg(F.sum(value))
    if fill_zero:
        out = out.fillna(0, subset=list(names))
    return out
