"""C3 as a stored table that later reports read, rebuilt where a quarter changed.

A store is a folder of Parquet tables:

- ``long``    the long fact by source year, a row's quarters still side by side: rows
              by quarter and their shifted copies are projections of it, made where
              it is read, so each of its labels is written once
- ``grid``    one row per output partition and source quarter: its date, and
              whether it has rows that set the bounds or feed the cohorts
- ``wide``    the results table's rows without site attributes, by output partition;
              their indicator columns and the derived ones are projections of a
              row, made where they are read, so a report computes those it names
- ``volume``  the site volume at the latest date
- ``state``   the bounds, the names and rules of the columns, and what the last
              update rebuilt

An output partition is a period, or a fiscal year for cumulative rows.  A
source quarter reaches the partitions of its own period and of the shifted
cohorts (D3), and through the trailing windows (D8) those of the windows that
hold one of these dates.  Bounds and window labels are maxima over the grid, a
few rows per quarter, so no update reads the whole fact.  An update replaces
only what its quarters reach, and running it again gives the same store.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from indicata.functions.periods import suffix_denominator
from indicata.operators.cohorts import relative_windows
from indicata.operators.reshape import QUARTER_COLUMNS
from indicata.plans import reports as P
from indicata.plans import rules as R
from indicata.session import materialize, remove_path
from indicata.sources.files import write_stage

GRID = "part string, src string, date date, period string, bounds boolean, cohort boolean"
#: Files that a task holds open in writing the long fact and the table: their partitions are a few
#: per year, and a sort of all their rows would spill.
OPEN_FILES = 200
STATE = "min_date date, max_date date, max_period string, volume string, rebuilt array<string>, " \
        "names array<string>, derived string"


MEASURES = [c for c, _, _ in QUARTER_COLUMNS]


def _part(period: Column, src_fy: Column) -> Column:
    """Name of the output partition: "2000Q4", or "FY2000" where there is no period."""
    return F.coalesce(F.replace(period, F.lit(" "), F.lit("")),
                      F.concat(F.lit("FY"), F.coalesce(src_fy.cast("string"), F.lit("none"))))


def _months_back(d: date, months: int) -> date:
    at = d.year * 12 + d.month - 1 - months
    return date(at // 12, at % 12 + 1, d.day)  # reporting days are in every month


class _State:
    """Bounds, windows and their labels, from the rows of the grid."""

    def __init__(self, grid: Sequence, cohort: Mapping):
        self.dates = {r["part"]: r["date"] for r in grid if r["date"] is not None}
        self.parts = {r["part"] for r in grid}
        marks = [(r["date"], r["period"]) for r in grid if r["bounds"] and r["date"] is not None]
        self.low = min((d for d, _ in marks), default=None)
        self.high = max((d for d, _ in marks), default=None)
        self.last = max((p for _, p in marks), default=None)
        self.windows = {}
        rows = [r for r in grid if r["cohort"] and r["date"] is not None]
        for k, lo, hi in cohort["windows"] if self.high else ():
            first = _months_back(self.high, lo)
            held = [r for r in rows if (r["date"] > first if hi is None else
                                        first <= r["date"] <= _months_back(self.high, hi))]
            if held:
                label = ((self.high, self.last) if k == 0 else
                         (max(r["date"] for r in held), max(r["period"] for r in held)))
                self.windows[k] = (label, frozenset(r["part"] for r in held))

    def inside(self, part: str) -> bool:
        d = self.dates.get(part)
        return d is None or (self.low is not None and self.low <= d <= self.high)

    def bounds(self) -> dict[str, Column]:
        return _bounds(self.low, self.high, self.last)


def _bounds(low: date | None, high: date | None, last: str | None) -> dict[str, Column]:
    return {"min_date": F.lit(low).cast("date"), "max_date": F.lit(high).cast("date"),
            "max_period": F.lit(last).cast("string")}


def _wide(spark: SparkSession, store: str, names: Sequence[str], derived,
          bounds: Mapping[str, Column]) -> DataFrame:
    """The stored rows with their indicator columns and the derived ones."""
    rows = spark.read.parquet(f"{store}/wide")
    return P.results_measures(P.results_wide(rows, names, bounds), derived)


def _label_part(window) -> str:
    return window[0][1].replace(" ", "")


def _reached(old: _State | None, new: _State, touched: set[str]) -> set[str]:
    """Output partitions that a change of the partitions ``touched`` in the long fact reaches."""
    if old is None:
        return new.parts | {_label_part(w) for w in new.windows.values()}
    out = set(touched)
    out |= {p for p in old.parts | new.parts if old.inside(p) != new.inside(p)}
    for k in old.windows.keys() | new.windows.keys():
        a, b = old.windows.get(k), new.windows.get(k)
        if a != b or touched & b[1]:
            out |= {_label_part(w) for w in (a, b) if w}
    return out


def _year(fy: Column) -> Column:
    """Partition of the long fact: "s2000", or "snone" where there is no year."""
    return F.concat(F.lit("s"), F.coalesce(fy.cast("string"), F.lit("none")))


def _source(extract: DataFrame, dedup_map: DataFrame, site_partner: DataFrame) -> DataFrame:
    """The extract's rows as the long fact keeps them, with every measure."""
    df = P.results_source(extract, dedup_map, site_partner).drop("partner_pepfar_clinical")
    df = df.withColumns({c: (F.col(c) if c in df.columns else F.lit(None)).cast("double")
                         for c in MEASURES})
    return df.withColumn("src", _year(F.col("fy")))


def _reported(held: DataFrame) -> DataFrame:
    """Rows by the quarter they were reported for, ``src`` (quarter 0 for cumulative rows)."""
    return P.results_reported(held).withColumn("src", F.concat(
        "src", F.lit("q"), F.coalesce("q", F.lit(0)).cast("string")))


def _dated(reported: DataFrame) -> DataFrame:
    """Rows with the shifted cohorts, by output partition."""
    df = P.results_shifted(reported.withColumn("src_fy", F.col("fy")))
    return df.withColumn("part", _part(F.col("period"), F.col("src_fy"))).drop("src_fy")


def _before_shifts(indicator: str) -> list[str]:
    """The indicators whose rows or shifted copies carry this one's name."""
    return [indicator, *[was for _, names in R.COHORT_SHIFTS for was, name in names.items()
                         if name == indicator]]


def _put_source(spark: SparkSession, path: str, source: DataFrame,
                quarters: Sequence[tuple[int, int]]) -> None:
    """Replace the values of these quarters, and their years' cumulative values and targets, in the
    long fact.  Its other values stay: a row whose values are replaced in part becomes two."""
    def replaced(c: str) -> Column:
        years = {fy for fy, q in quarters if c in (f"qtr{q}", "cumulative", "targets")}
        return F.col("fy").isin(sorted(years))

    years = sorted({fy for fy, _ in quarters})
    found = F.coalesce(*MEASURES).isNotNull()
    came = source.filter(F.col("fy").isin(years)).withColumns(
        {c: F.when(replaced(c), F.col(c)) for c in MEASURES}).filter(found)
    held = spark.read.schema(source.schema).parquet(path).filter(
        F.col("src").isin([f"s{fy}" for fy in years]))
    kept = materialize(held.withColumns(
        {c: F.when(~replaced(c), F.col(c)) for c in MEASURES}).filter(found))
    for fy in years:
        remove_path(spark, f"{path}/src=s{fy}")
    write_stage(kept.unionByName(came), path, partition_by=("src",), open_files=OPEN_FILES)


def _grid(spark: SparkSession, store: str) -> list:
    return spark.read.schema(GRID).parquet(f"{store}/grid").collect()  # a few rows per quarter


def read_state(spark: SparkSession, store: str) -> dict:
    """min_date, max_date, max_period, and the partitions that the last update rebuilt."""
    return spark.read.schema(STATE).parquet(f"{store}/state").first().asDict()


def update_results(store: str, extract: DataFrame, dedup_map: DataFrame, site_partner: DataFrame,
                   indicator_names: Sequence[str], *,
                   quarters: Sequence[tuple[int, int]] | None = None,
                   cohort: Mapping = R.PMTCT_ART_COHORT, derived=R.DERIVED_INDICATORS,
                   facility: str = "Facility") -> dict:
    """Put an extract into the store and rebuild what it reaches; returns the state.

    Without ``quarters`` the store is built from the whole extract.  With
    ``quarters`` (fiscal year, quarter) the store's rows of these quarters, and
    the cumulative rows of their years, are replaced by those of ``extract``,
    which needs the rows of these fiscal years only; other quarters of it are
    ignored.
    """
    spark = extract.sparkSession
    old_grid = _grid(spark, store) if quarters is not None else []
    source = _source(extract, dedup_map, site_partner)
    if quarters is None:
        for name in ("long", "grid", "wide", "volume"):
            remove_path(spark, f"{store}/{name}")
        write_stage(source, f"{store}/long", partition_by=("src",), open_files=OPEN_FILES)
    else:
        sources = sorted({f"s{fy}q{x}" for fy, q in quarters for x in (q, 0)})
        _put_source(spark, f"{store}/long", source, quarters)
        for src in sources:
            remove_path(spark, f"{store}/grid/src={src}")
    whole = spark.read.schema(source.schema).parquet(f"{store}/long")
    fresh = whole if quarters is None else whole.filter(
        F.col("src").isin(sorted({f"s{fy}" for fy, _ in quarters})))
    # a few kinds of rows per quarter, then their copies
    kinds = _reported(fresh).select("fy", "q", "src", "indicator_temp", "period_type").distinct()
    if quarters is not None:
        kinds = kinds.filter(F.col("src").isin(sources))
    grid = _dated(kinds).groupBy("part", "src", "date", "period").agg(
        F.max((F.col("indicator_temp") == "TX_CURR") & (F.col("period_type") == "results"))
         .alias("bounds"),
        F.max(F.col("indicator_temp") == cohort["indicator"]).alias("cohort"))
    write_stage(grid, f"{store}/grid", partition_by=("src",))

    rows = _grid(spark, store)
    new = _State(rows, cohort)
    old = _State(old_grid, cohort) if quarters is not None else None
    touched = set() if old is None else \
        {r["part"] for r in [*old_grid, *rows] if r["src"] in sources}
    reached = sorted(_reached(old, new, touched))

    b = new.bounds()

    def of_parts(held: DataFrame, parts) -> DataFrame:
        """Rows of these output partitions, from the years that reach them."""
        years = sorted({r["src"].split("q")[0] for r in rows if r["part"] in parts})
        found = _dated(_reported(held.filter(F.col("src").isin(years)))).drop(
            "src", "numeratordenom")
        return found if new.parts <= set(parts) else found.filter(F.col("part").isin(sorted(parts)))

    full = of_parts(whole, reached)
    wanted = {k: w for k, w in new.windows.items() if _label_part(w) in reached}
    if wanted:
        named = suffix_denominator("indicator", "numeratordenom").isin(
            _before_shifts(cohort["indicator"]))
        art = of_parts(whole.filter(named), set().union(*(w[1] for w in wanted.values()))).filter(
            F.col("indicator_temp") == cohort["indicator"])
        spans = [w for w in cohort["windows"] if w[0] in wanted]
        art = relative_windows(art, "date", b["max_date"], spans, window_col="__k")

        def of(value):
            return F.create_map(*[F.lit(x) for k, w in wanted.items() for x in (k, value(w))])[
                F.col("__k")]

        art = art.withColumns({"date": of(lambda w: w[0][0]), "period": of(lambda w: w[0][1]),
                               "part": of(_label_part),
                               "indicator_temp": F.lit(cohort["label"])}).drop("__k")
        full = full.unionByName(art)
    for part in reached:
        remove_path(spark, f"{store}/wide/part={part}")
    write_stage(P.results_rows(full, indicator_names, b), f"{store}/wide", partition_by=("part",),
                open_files=OPEN_FILES)

    latest = sorted({p for p, d in new.dates.items() if d == new.high})
    volume = f"{store}/volume"
    if old is None or old.high != new.high or set(latest) & set(reached):
        stored = _wide(spark, store, indicator_names, derived, b)
        P.results_volume(stored.filter(F.col("part").isin(latest)), b["max_date"], facility,
                         site="datim_uid").write.mode("overwrite").parquet(volume)
    state = {"min_date": new.low, "max_date": new.high, "max_period": new.last, "volume": volume,
             "rebuilt": reached, "names": list(indicator_names), "derived": json.dumps(list(derived))}
    spark.createDataFrame([tuple(state.values())], STATE).write.mode("overwrite") \
        .parquet(f"{store}/state")
    return state


def read_results(spark: SparkSession, store: str, site_map: DataFrame) -> DataFrame:
    """The results table of the store with the site map's attributes, as ``reports.results_table``
    gives it; a filter on ``part`` reads only those partitions."""
    at = read_state(spark, store)
    wide = _wide(spark, store, at["names"], json.loads(at["derived"]),
                 _bounds(at["min_date"], at["max_date"], at["max_period"]))
    volume = spark.read.parquet(f"{store}/volume")
    return P.results_with_sites(wide.drop("part"), volume, site_map)
