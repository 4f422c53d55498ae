"""Cohort operators: quarter shifts, trailing windows on anchors, rolling sums.

The reference builds each shifted or windowed cohort as a filtered copy of
the fact and appends it (3 + 5 + 7 copies, each a rescan).  Here every
family is one scan: each row generates the copies it belongs to with
``explode`` over a small, literal (bounded) array, and window labels come
from a grouped aggregate joined back on the anchor.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from indicata.functions.periods import shifted
from indicata.session import materialize


def shift_period(df: DataFrame, shifts: Sequence[tuple[int, Mapping[str, str]]], *,
                 indicator: str = "indicator", fy: str = "fy", q: str = "q",
                 keep_original: bool = True) -> DataFrame:
    """Append copies of rows moved by k quarters and relabelled.

    ``shifts`` is ``[(k, {indicator: new_label}), ...]``: a row whose
    indicator is a key of a shift's mapping gets a copy with ``(fy, q)``
    moved by ``k`` quarters and the new label.  A null quarter (cumulative
    or target rows) gives a null fy and quarter on the copy.
    """
    by_indicator: dict[str, list[tuple[int, str]]] = {}
    for k, mapping in shifts:
        for src, label in mapping.items():
            by_indicator.setdefault(src, []).append((k, label))
    struct_t = "struct<k:int,label:string>"
    entries = []
    for src, targets in by_indicator.items():
        entries += [F.lit(src), F.array(*[F.struct(F.lit(k).cast("int").alias("k"),
                                                   F.lit(lab).alias("label"))
                                          for k, lab in targets])]
    lookup = F.create_map(*entries)
    copies = F.coalesce(F.try_element_at(lookup, F.col(indicator)),
                        F.array().cast(f"array<{struct_t}>"))
    if keep_original:
        copies = F.concat(F.array(F.struct(F.lit(0).alias("k"),
                                           F.col(indicator).alias("label"))), copies)
    out = df.withColumn("__s", F.explode(copies))
    new_fy, new_q = shifted(F.col(fy), F.col(q), F.col("__s.k"))
    return (out.withColumns({
        fy: F.when(F.col("__s.k") == 0, F.col(fy)).otherwise(new_fy),
        q: F.when(F.col("__s.k") == 0, F.col(q)).otherwise(new_q),
        indicator: F.col("__s.label")}).drop("__s"))


def anchor_windows(df: DataFrame, date: str, anchors: Sequence[str], months_back: int, *,
                   anchor_col: str = "anchor", lower_strict: bool = False) -> DataFrame:
    """Copy each row to every trailing window (anchor - months_back .. anchor)
    that contains its date.  Both edges inclusive unless ``lower_strict``.

    ``anchors`` is a literal list (bounded): each row builds the array of
    anchors whose window holds its date and explodes it.  No nested-loop
    join, no cross join, one scan.
    """
    d = F.col(date)
    hits = []
    for a in anchors:
        a_c = F.to_date(F.lit(a))
        lo = F.add_months(a_c, -months_back)
        lower = (d > lo) if lower_strict else (d >= lo)
        hits.append(F.when(lower & (d <= a_c), a_c))
    return df.withColumn(anchor_col, F.explode(F.array_compact(F.array(*hits))))


def relative_windows(df: DataFrame, date: str, base: Column,
                     windows: Sequence[tuple[int, int, int | None]], *,
                     window_col: str = "window") -> DataFrame:
    """Copy each row to every window defined relative to a bound date.

    ``windows`` is ``[(k, lo_months, hi_months)]``: window ``k`` holds dates
    in ``[base - lo, base - hi]``; ``hi=None`` means no upper bound and a
    strict lower bound (``date > base - lo``).  ``base`` is usually a scalar
    sub-query (e.g. the latest reporting date), evaluated once per query.
    """
    d = F.col(date)
    hits = []
    for k, lo, hi in windows:
        lo_d = F.add_months(base, -lo)
        cond = (d > lo_d) if hi is None else d.between(lo_d, F.add_months(base, -hi))
        hits.append(F.when(cond, F.lit(k).cast("int")))
    return df.withColumn(window_col, F.explode(F.array_compact(F.array(*hits))))


def label_windows(df: DataFrame, window_col: str, *, date: str = "date",
                  period: str = "period", fixed: Mapping | None = None) -> DataFrame:
    """Re-date each window's rows to the window's own max date and max period.

    The per-window maxima are a grouped aggregate (partial aggregation, one
    row per window) joined back on the window key; the window count is
    bounded by the anchor list, so that side is broadcast.  ``fixed`` maps a
    window key to ``(date_column, period_column)`` used instead (e.g. the
    latest window takes the global bounds).
    """
    labels = df.groupBy(window_col).agg(F.max(date).alias("__ld"), F.max(period).alias("__lp"))
    out = df.join(F.broadcast(labels), window_col)
    new_date, new_period = F.col("__ld"), F.col("__lp")
    for key, (fd, fp) in (fixed or {}).items():
        is_key = F.col(window_col) == F.lit(key)
        new_date = F.when(is_key, fd).otherwise(new_date)
        new_period = F.when(is_key, fp).otherwise(new_period)
    return out.withColumns({date: new_date, period: new_period}).drop("__ld", "__lp")


def _relabelled(rows: DataFrame, marked: Callable[[DataFrame], DataFrame], key: str, date: str,
                period: str, fixed: Mapping) -> DataFrame:
    """Copies of ``rows`` per window, re-dated by labels from the grid of reporting days.

    ``rows`` is a written table.  Its grid has one row per date with the greatest
    period of the date, so a window's label is a maximum over the days that it
    holds, and one row per window is fetched; the copies are then made in one
    scan that carries the labels as literals.
    """
    grid = rows.groupBy(date).agg(F.max(period).alias(period))
    labels = marked(grid).groupBy(key).agg(F.max(date).alias("d"), F.max(period).alias("p")).collect()
    new_date, new_period = F.lit(None).cast("date"), F.lit(None).cast("string")
    for r in labels:
        here = F.col(key) == F.lit(r[key])
        d, p = fixed.get(r[key], (F.lit(r["d"]), F.lit(r["p"])))
        new_date, new_period = F.when(here, d).otherwise(new_date), F.when(here, p).otherwise(new_period)
    kinds = dict(rows.dtypes)
    return marked(rows).withColumns({date: new_date.cast(kinds[date]),
                                     period: new_period.cast(kinds[period])})


def trailing_cohort(df: DataFrame, *, date: str, anchors: Sequence[str], months_back: int,
                    period: str = "period", label: tuple[str, str] | None = None,
                    anchor_col: str = "anchor", keep_anchor: bool = False,
                    lower_strict: bool = False, stored: bool = False) -> DataFrame:
    """Rows of each trailing window, re-dated to the window's max date/period.

    ``label=(column, value)`` also overwrites a label column (e.g. the
    indicator) on the copies.  The input is computed once, into a written table,
    unless it is one (``stored``); the labels come from its grid of dates.
    """
    rows = df if stored else materialize(df)
    out = _relabelled(rows, lambda d: anchor_windows(d, date, anchors, months_back,
                                                     anchor_col=anchor_col,
                                                     lower_strict=lower_strict),
                      anchor_col, date, period, {})
    if label is not None:
        out = out.withColumn(label[0], F.lit(label[1]))
    return out if keep_anchor else out.drop(anchor_col)


def relative_cohort(df: DataFrame, *, date: str, base: Column,
                    windows: Sequence[tuple[int, int, int | None]], period: str = "period",
                    fixed: Mapping | None = None, window_col: str = "__window",
                    keep_window: bool = False) -> DataFrame:
    """As :func:`trailing_cohort` for windows relative to ``base``; ``fixed`` maps a window to
    the (date, period) columns it takes instead.  ``df`` is a selection of a written table."""
    out = _relabelled(df, lambda d: relative_windows(d, date, base, windows, window_col=window_col),
                      window_col, date, period, fixed or {})
    return out if keep_window else out.drop(window_col)


def rolling_sum(df: DataFrame, keys: Sequence[str], order: str, value: str, n: int = 4, *,
                name: str | None = None) -> DataFrame:
    """Sum over the current and previous ``n-1`` rows per key, null until ``n`` rows.

    The input is first aggregated to one row per (keys, order), so each
    window partition holds one row per period of one key: its size is
    bounded by the number of periods, however hot the key is.
    """
    name = name or f"{value}_roll{n}"
    grain = df.groupBy(*keys, order).agg(F.sum(value).alias(value))
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(-(n - 1), Window.currentRow)
    return grain.withColumn(name, F.when(F.count(F.lit(1)).over(w) == n, F.sum(value).over(w)))
