"""Reshape, union, frequency, rolling and bound queries."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from indicata.functions.periods import split_period, suffix_denominator
from indicata.operators.cohorts import rolling_sum
from indicata.operators.derive import derive_long
from indicata.operators.joins import keep_with_any, restrict_to
from indicata.operators.measures import (distinct_values, freq, group_sum, group_sum_rest,
                                         period_bounds)
from indicata.operators.reshape import gather, pivot_sum, reshape_long, spread
from indicata.operators.union import Contract, align, union_all
from indicata.plans import proxy
from indicata.plans.registry import PERIOD, register

IND = proxy.INDICATORS


# ---------------------------------------------------------------------------
# Wide-by-quarter extract -> long
# ---------------------------------------------------------------------------

def _wide_extract(f):
    """Aggregate the fact into a wide-by-quarter extract (the R1 input)."""
    q = F.col("q")
    return f.groupBy("site_uid", "indicator", "fy").agg(
        *[F.sum(F.when(q == i, F.col("value"))).alias(f"qtr{i}") for i in range(1, 5)],
        F.sum("value").alias("cumulative"),
        F.sum(F.when(F.col("numeratordenom") == "D", F.col("value"))).alias("targets"))


def _sql_long_part(col: str, ptype: str, qn: int | None) -> str:
    suffix = f" || 'Q{qn}'" if qn else ""
    return (f"SELECT site_uid, indicator, fy, '{ptype}' AS period_type, "
            f"'FY' || lpad(CAST(fy % 100 AS VARCHAR), 2, '0'){suffix} AS period, "
            f"{col} AS value FROM wide")


@register("reshape_long", """
, wide AS (
  SELECT site_uid, indicator, fy,
         sum(CASE WHEN q = 1 THEN value END) AS qtr1, sum(CASE WHEN q = 2 THEN value END) AS qtr2,
         sum(CASE WHEN q = 3 THEN value END) AS qtr3, sum(CASE WHEN q = 4 THEN value END) AS qtr4,
         sum(value) AS cumulative,
         sum(CASE WHEN numeratordenom = 'D' THEN value END) AS targets
  FROM dated GROUP BY site_uid, indicator, fy),
long AS (""" + "\n  UNION ALL ".join(
    [_sql_long_part(f"qtr{i}", "results", i) for i in range(1, 5)]
    + [_sql_long_part("cumulative", "cumulative", None),
       _sql_long_part("targets", "targets", None)]) + """)
SELECT * FROM long WHERE value IS NOT NULL
""")
def reshape_long_q(spark, sf_dir):
    return reshape_long(_wide_extract(proxy.fact(spark, sf_dir)), fiscal_year="fy")


# ---------------------------------------------------------------------------
# R2 + A2: one-hot spread, then null-safe sums per site and period
# ---------------------------------------------------------------------------

@register("spread_sum", """
SELECT site_uid, period,
""" + ",\n".join(f"  coalesce(sum(CASE WHEN indicator = '{i}' THEN value END), 0) AS {i}"
                 for i in IND) + """
FROM dated GROUP BY site_uid, period
""")
def spread_sum(spark, sf_dir):
    f = proxy.fact(spark, sf_dir, with_sites=False).select("site_uid", "period", "indicator",
                                                           "value")
    return restrict_to(group_sum(spread(f, "indicator", "value", IND), ["site_uid", "period"], IND),
                       proxy.site_keys(spark, sf_dir), "site_uid")


# ---------------------------------------------------------------------------
# Spread then gather is the identity on rows
# ---------------------------------------------------------------------------

@register("spread_gather", """
SELECT site_uid, period, indicator, count(*) AS n, sum(value) AS v
FROM dated GROUP BY site_uid, period, indicator
""")
def spread_gather(spark, sf_dir):
    f = proxy.fact(spark, sf_dir).select("site_uid", "period", "order_key", "indicator", "value")
    wide = spread(f, "indicator", "value", IND)
    long = gather(wide, ["site_uid", "period", "order_key"], IND)
    return (long.groupBy("site_uid", "period", "indicator")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("v")))


# ---------------------------------------------------------------------------
# Pivot to site grain; missing side null (sum then pivot)
# ---------------------------------------------------------------------------

@register("pivot_null_side", f"""
SELECT site_uid,
       sum(CASE WHEN indicator = 'TX_PVLS' THEN value END) AS TX_PVLS,
       sum(CASE WHEN indicator = 'TX_PVLS_D' THEN value END) AS TX_PVLS_D
FROM dated WHERE period = '{PERIOD}' AND standardizeddisaggregate = '1-URGENT'
  AND indicator IN ('TX_PVLS', 'TX_PVLS_D')
GROUP BY site_uid
""")
def pivot_null_side(spark, sf_dir):
    f = proxy.fact(spark, sf_dir, periods=[PERIOD]).filter(
        F.col("standardizeddisaggregate") == "1-URGENT")
    return pivot_sum(f, ["site_uid"], "indicator", "value", ["TX_PVLS", "TX_PVLS_D"],
                     fill_zero=False)


# ---------------------------------------------------------------------------
# C7 (R4, D4, D12, J4): targets table
# ---------------------------------------------------------------------------

PROXY_LONG_DERIVED = [
    {"label": "TX_CURR_URGENT", "src": "TX_CURR", "match_col": "indicator",
     "when": [[("standardizeddisaggregate", "==", "1-URGENT")]]},
    {"label": "TX_CURR_D_HIGH", "src": "TX_CURR_D", "match_col": "indicator_temp",
     "when": [[("standardizeddisaggregate", "==", "2-HIGH")]]},
    {"label": "TX_PVLS_NODIS", "src": "TX_PVLS", "match_col": "indicator_temp",
     "when": [[("standardizeddisaggregate", "is_null")]]},
]


@register("targets_table", """
, base AS (
  SELECT *, indicator || CASE WHEN numeratordenom = 'D' THEN '_D' ELSE '' END AS indicator_temp,
         CASE WHEN numeratordenom = 'D' AND indicator <> 'TX_PVLS' THEN 'targets'
              ELSE 'cumulative' END AS period_type
  FROM dated),
copies AS (
  SELECT indicator_temp AS ind, period_type, value FROM base
  UNION ALL SELECT CASE WHEN indicator_temp = 'TX_CURR' THEN 'TX_CURR_URGENT' ELSE indicator_temp END,
         period_type, value FROM base
         WHERE indicator = 'TX_CURR' AND standardizeddisaggregate = '1-URGENT'
  UNION ALL SELECT 'TX_CURR_D_HIGH', period_type, value FROM base
         WHERE indicator_temp = 'TX_CURR_D' AND standardizeddisaggregate = '2-HIGH'
  UNION ALL SELECT 'TX_PVLS_NODIS', period_type, value FROM base
         WHERE indicator_temp = 'TX_PVLS' AND standardizeddisaggregate IS NULL),
wide AS (
  SELECT ind AS indicator, CASE WHEN period_type = 'cumulative' THEN value END AS cumulative,
         CASE WHEN period_type = 'targets' THEN value END AS targets FROM copies)
SELECT indicator, count(*) AS n, sum(cumulative) AS cumulative, sum(targets) AS targets
FROM wide WHERE indicator IN (SELECT indicator FROM wide WHERE targets IS NOT NULL)
GROUP BY indicator
""")
def targets_table(spark, sf_dir):
    f = proxy.fact(spark, sf_dir).withColumns({
        "indicator_temp": suffix_denominator("indicator", "numeratordenom"),
        "period_type": F.when((F.col("numeratordenom") == "D") & (F.col("indicator") != "TX_PVLS"),
                              F.lit("targets")).otherwise(F.lit("cumulative"))})
    copies = derive_long(f, PROXY_LONG_DERIVED)
    wide = spread(copies, "period_type", "value", ["cumulative", "targets"]) \
        .drop("indicator").withColumnRenamed("indicator_temp", "indicator")
    kept = keep_with_any(wide, "indicator", "targets")
    return kept.groupBy("indicator").agg(F.count(F.lit(1)).alias("n"),
                                         F.sum("cumulative").alias("cumulative"),
                                         F.sum("targets").alias("targets"))


# ---------------------------------------------------------------------------
# Split period into fiscal year and quarter
# ---------------------------------------------------------------------------

@register("split_period", """
SELECT DISTINCT period, CAST(split_part(period, ' ', 1) AS INT) AS fy,
       split_part(period, ' ', 2) AS quarter
FROM dated
""")
def split_period_q(spark, sf_dir):
    periods = distinct_values(proxy.fact(spark, sf_dir), ["period"])
    return split_period(periods, "period", "fy", "quarter")


# ---------------------------------------------------------------------------
# Yearly extracts with drifting schemas, aligned and unioned by name
# ---------------------------------------------------------------------------

CANONICAL = T.StructType([
    T.StructField("site_uid", T.LongType()), T.StructField("psnu", T.StringType()),
    T.StructField("mech_name", T.StringType()), T.StructField("indicator", T.StringType()),
    T.StructField("fy", T.IntegerType()), T.StructField("value", T.DoubleType()),
])
# Three layouts: the district column is named differently per era and one era
# carries the fiscal year as text.
LAYOUTS = [
    ("fy <= 1997", Contract(CANONICAL, drop=["psnu"], rename={"snu2": "psnu"})),
    ("fy BETWEEN 1998 AND 1999", Contract(CANONICAL, drop=["psnu"],
                                          rename={"cop22_psnu": "psnu"})),
    ("fy >= 2000", Contract(CANONICAL, drop=["mech_name"])),
]


def _yearly_extract(f, era: int):
    if era == 0:
        return f.filter(F.col("fy") <= 1997).select(
            "site_uid", "psnu", F.col("psnu").alias("snu2"), "mech_name", "indicator", "fy", "value")
    if era == 1:
        return f.filter(F.col("fy").between(1998, 1999)).select(
            "site_uid", F.col("psnu").alias("cop22_psnu"), "mech_name", "indicator",
            F.col("fy").cast("string").alias("fy"), "value")
    return f.filter(F.col("fy") >= 2000).select(
        "site_uid", "psnu", "mech_name", "indicator", "fy", "value")


@register("union_drift", """
, u AS (
  SELECT site_uid, psnu, mech_name, indicator, fy, value FROM dated WHERE fy <= 1997
  UNION ALL SELECT site_uid, psnu, mech_name, indicator, fy, value FROM dated
            WHERE fy BETWEEN 1998 AND 1999
  UNION ALL SELECT site_uid, psnu, CAST(NULL AS VARCHAR), indicator, fy, value FROM dated
            WHERE fy >= 2000)
SELECT fy, psnu, mech_name, count(*) AS n, sum(value) AS v FROM u GROUP BY fy, psnu, mech_name
""")
def union_drift(spark, sf_dir):
    f = proxy.fact(spark, sf_dir)
    parts = [align(_yearly_extract(f, i), c) for i, (_, c) in enumerate(LAYOUTS)]
    return (union_all(parts).groupBy("fy", "psnu", "mech_name")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("v")))


# ---------------------------------------------------------------------------
# A4, A5, A3: frequency table, distinct values, group by the complement
# ---------------------------------------------------------------------------

@register("freq", """
SELECT standardizeddisaggregate, mech_name, count(*) AS n FROM dated
GROUP BY standardizeddisaggregate, mech_name
""")
def freq_q(spark, sf_dir):
    return freq(proxy.fact(spark, sf_dir), ["standardizeddisaggregate", "mech_name"], sort=True)


@register("distinct_values", """
SELECT DISTINCT period, mech_name, standardizeddisaggregate FROM dated
""")
def distinct_q(spark, sf_dir):
    return distinct_values(proxy.fact(spark, sf_dir),
                           ["period", "mech_name", "standardizeddisaggregate"])


@register("group_sum_rest", """
SELECT snu1, period, mech_name,
""" + ",\n".join(f"  coalesce(sum(CASE WHEN indicator = '{i}' THEN value END), 0) AS {i}"
                 for i in IND) + """
FROM dated GROUP BY snu1, period, mech_name
""")
def group_sum_rest_q(spark, sf_dir):
    f = proxy.fact(spark, sf_dir).select("snu1", "period", "mech_name", "indicator", "value")
    return group_sum_rest(spread(f, "indicator", "value", IND), "TX_")


# ---------------------------------------------------------------------------
# Rolling four-quarter sum per site (null until four quarters)
# ---------------------------------------------------------------------------

@register("rolling_sum", """
, g AS (SELECT site_uid, date, sum(value) AS value FROM dated WHERE indicator = 'TX_CURR'
        GROUP BY site_uid, date)
SELECT site_uid, date, value,
       CASE WHEN count(*) OVER w = 4 THEN sum(value) OVER w END AS value_roll4
FROM g
WINDOW w AS (PARTITION BY site_uid ORDER BY date ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)
""")
def rolling_sum_q(spark, sf_dir):
    f = proxy.fact(spark, sf_dir, with_sites=False).filter(F.col("indicator") == "TX_CURR")
    # per-site windows: dropping unlisted sites after the window changes nothing else
    return restrict_to(rolling_sum(f, ["site_uid"], "date", "value", 4),
                       proxy.site_keys(spark, sf_dir), "site_uid")


# ---------------------------------------------------------------------------
# Reporting bounds
# ---------------------------------------------------------------------------

_TXC = "FROM dated WHERE indicator = 'TX_CURR'"


@register("period_bounds", f"""
SELECT (SELECT min(date) {_TXC}) AS min_date, (SELECT max(date) {_TXC}) AS max_date,
       (SELECT max(period) {_TXC}) AS max_period, count(*) AS n_latest
{_TXC} AND date = (SELECT max(date) {_TXC})
""")
def period_bounds_q(spark, sf_dir):
    f = proxy.fact(spark, sf_dir)
    b = period_bounds(f, where=F.col("indicator") == "TX_CURR")
    latest = f.filter((F.col("indicator") == "TX_CURR") & (F.col("date") == b["max_date"]))
    return latest.agg(F.count(F.lit(1)).alias("n_latest")).select(
        b["min_date"].alias("min_date"), b["max_date"].alias("max_date"),
        b["max_period"].alias("max_period"), "n_latest")


# ---------------------------------------------------------------------------
# Delimited files with drifting column order -> history
# ---------------------------------------------------------------------------

SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
SUBMISSION = T.StructType([
    T.StructField("datim_uid", T.LongType()), T.StructField("period", T.StringType()),
    T.StructField("mech_name", T.StringType()), T.StructField("disagg", T.StringType()),
    T.StructField("TX_CURR", T.DoubleType()), T.StructField("TX_PVLS", T.DoubleType()),
])


@register("sources_roundtrip", """
SELECT mech_name, period, count(*) AS n, sum(TX_CURR) AS TX_CURR, sum(TX_PVLS) AS TX_PVLS,
       count(disagg) AS n_disagg
FROM (SELECT site_uid, period, mech_name, standardizeddisaggregate AS disagg,
             sum(CASE WHEN indicator = 'TX_CURR' THEN value END) AS TX_CURR,
             sum(CASE WHEN indicator = 'TX_PVLS' THEN value END) AS TX_PVLS
      FROM dated GROUP BY site_uid, period, mech_name, standardizeddisaggregate) s
GROUP BY mech_name, period
""")
def sources_roundtrip(spark, sf_dir):
    from indicata.session import materialize, scratch_path
    from indicata.sources.files import read_folder, upsert_period, write_tsv
    f = proxy.fact(spark, sf_dir)
    sums = f.groupBy(F.col("site_uid").alias("datim_uid"), "period", "mech_name",
                     F.col("standardizeddisaggregate").alias("disagg")).agg(
        F.sum(F.when(F.col("indicator") == "TX_CURR", F.col("value"))).alias("TX_CURR"),
        F.sum(F.when(F.col("indicator") == "TX_PVLS", F.col("value"))).alias("TX_PVLS"))
    sums = materialize(sums)                      # six writes read it: compute once
    folder = scratch_path(spark, "submissions")
    names = [fld.name for fld in SUBMISSION.fields]
    for i, seg in enumerate(SEGMENTS):            # one partner file per mechanism,
        order = names[i:] + names[:i]             # each with its own column order
        write_tsv(sums.filter(F.col("mech_name") == seg).select(*order), f"{folder}/{seg}",
                  na="NA")
    rest = sums.filter(~F.col("mech_name").isin(SEGMENTS) | F.col("mech_name").isNull())
    write_tsv(rest.select(*names), f"{folder}/OTHER", na="")
    history = upsert_period(read_folder(spark, f"{folder}/*/*.csv", Contract(SUBMISSION)),
                            scratch_path(spark, "history"))
    return history.groupBy("mech_name", "period").agg(
        F.count(F.lit(1)).alias("n"), F.sum("TX_CURR").alias("TX_CURR"),
        F.sum("TX_PVLS").alias("TX_PVLS"), F.count("disagg").alias("n_disagg"))


# ---------------------------------------------------------------------------
# Trailing windows on a daily (non-quarter) series, re-dated per window
# ---------------------------------------------------------------------------

DAILY_ANCHORS = ["2000-12-20", "2001-03-20", "2001-06-20", "2001-09-20"]


@register("daily_windows", """
, daily AS (SELECT site_uid, ship_date AS date,
                   CAST(year(ship_date + INTERVAL 3 MONTH) AS VARCHAR) || ' Q'
                     || CAST(quarter(ship_date + INTERVAL 3 MONTH) AS VARCHAR) AS period,
                   sum(value) AS value
            FROM dated WHERE indicator = 'TX_PVLS_D' GROUP BY site_uid, ship_date),
anchors AS (SELECT CAST(a AS DATE) AS anchor FROM (VALUES """
          + ", ".join(f"('{a}')" for a in DAILY_ANCHORS) + """) t(a)),
win AS (SELECT a.anchor, d.* FROM daily d JOIN anchors a
        ON d.date >= a.anchor - INTERVAL 11 MONTH AND d.date <= a.anchor),
lab AS (SELECT anchor, max(period) AS lp, max(date) AS ld FROM win GROUP BY anchor)
SELECT lab.lp AS period, lab.ld AS date, count(*) AS n, sum(win.value) AS v
FROM win JOIN lab ON win.anchor = lab.anchor GROUP BY lab.lp, lab.ld
""")
def daily_windows(spark, sf_dir):
    from indicata.functions.periods import fiscal_quarter, fiscal_year, period_label
    from indicata.operators.cohorts import trailing_cohort
    f = proxy.fact(spark, sf_dir).filter(F.col("indicator") == "TX_PVLS_D")
    daily = f.groupBy("site_uid", F.col("ship_date").alias("date")).agg(F.sum("value").alias("value"))
    daily = daily.withColumn("period", period_label(fiscal_year("date"), fiscal_quarter("date")))
    w = trailing_cohort(daily, date="date", anchors=DAILY_ANCHORS, months_back=11)
    return w.groupBy("period", "date").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("v"))
