"""Registered queries over the test tables, each with a DuckDB oracle.

Every query reads the given tables (through the proxy fact or directly),
so its work grows with them; none is restricted to an id subset or capped.
Aggregates are aliased identically on both sides.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from indicata.functions.domain import site_type
from indicata.functions.expressions import band_score, not_in, ratio, recode
from indicata.operators.cohorts import (anchor_windows, label_windows, relative_windows,
                                        shift_period)
from indicata.operators.joins import map_indicator, restrict_to
from indicata.operators.measures import cumulative_share, group_sum, period_bounds
from indicata.plans import reports as P
from indicata.operators.reshape import pivot_sum
from indicata.plans import proxy
from indicata.plans import rules as R
from indicata.session import materialize
from indicata.plans.registry import (ORACLE, PERIOD, PROXY_PARTNER, QUERIES,  # noqa: F401
                                     _sql_band, _sql_ratio, _sql_recode, _sql_values,
                                     register)

# ---------------------------------------------------------------------------
# Fiscal period and reporting date
# ---------------------------------------------------------------------------

@register("fiscal_dates", """
SELECT period, date, count(*) AS n, sum(value) AS v FROM dated GROUP BY period, date
""")
def fiscal_dates(spark, sf_dir):
    return (proxy.fact(spark, sf_dir).groupBy("period", "date")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("v")))


# ---------------------------------------------------------------------------
# Minimum slice: P7, R3, A8, D18, J1 — viral-load coverage score per site
# ---------------------------------------------------------------------------

@register("coverage_score", f"""
, per_site AS (
  SELECT site_uid,
         coalesce(sum(CASE WHEN indicator = 'TX_PVLS_D' THEN value END), 0) AS num,
         coalesce(sum(CASE WHEN indicator = 'TX_CURR' THEN value END), 0) AS den
  FROM dated WHERE period = '{PERIOD}' AND indicator IN ('TX_PVLS_D', 'TX_CURR')
  GROUP BY site_uid),
scored AS (SELECT *, {_sql_ratio('num', 'den')} AS value_vlc FROM per_site)
SELECT d.site_uid, d.sitename, s.num, s.den, s.value_vlc,
       {_sql_band('s.value_vlc', R.BANDS_VLC)} AS score_vlc
FROM site_dim d LEFT JOIN scored s ON d.site_uid = s.site_uid
""")
def coverage_score(spark, sf_dir):
    # per-site sums straight from the lines; the left join from the site
    # list below keeps exactly the listed sites, so no per-line site join
    f = proxy.fact(spark, sf_dir, periods=[PERIOD], with_sites=False)
    sides = pivot_sum(f, ["site_uid"], "indicator", "value", ["TX_PVLS_D", "TX_CURR"],
                      fill_zero=True)
    scored = sides.select("site_uid", F.col("TX_PVLS_D").alias("num"),
                          F.col("TX_CURR").alias("den"),
                          ratio("TX_PVLS_D", "TX_CURR").alias("value_vlc"))
    dim = proxy.sites(spark, sf_dir).select("site_uid", "sitename")
    return (dim.join(scored, "site_uid", "left")
               .withColumn("score_vlc", band_score("value_vlc", R.BANDS_VLC)))


# ---------------------------------------------------------------------------
# Cumulative share (site grain and order grain)
# ---------------------------------------------------------------------------

@register("cumulative_share", """
, s AS (SELECT site_uid, sum(value) AS v FROM dated GROUP BY site_uid)
SELECT site_uid, v,
       sum(v) OVER (ORDER BY v DESC, site_uid ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
         AS v_cum,
       sum(v) OVER (ORDER BY v DESC, site_uid ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
         / sum(v) OVER () AS v_cum_per
FROM s
""")
def cumulative_share_sites(spark, sf_dir):
    # sum the lines per site first; the semi-join keeps the fact's inner-join
    # semantics (only listed sites) on one row per site
    s = group_sum(proxy.fact(spark, sf_dir, with_sites=False), ["site_uid"], ["value"])
    s = restrict_to(s, proxy.site_keys(spark, sf_dir), "site_uid").withColumnRenamed("value", "v")
    return cumulative_share(s, "v", ["site_uid"], cum_col="v_cum", share_col="v_cum_per")


@register("cumulative_share_orders", """
, s AS (SELECT order_key, sum(value) AS v FROM dated GROUP BY order_key)
SELECT order_key, v,
       sum(v) OVER (ORDER BY v DESC, order_key ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
         AS v_cum,
       sum(v) OVER (ORDER BY v DESC, order_key ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
         / sum(v) OVER () AS v_cum_per
FROM s
""")
def cumulative_share_orders(spark, sf_dir):
    s = group_sum(proxy.fact(spark, sf_dir), ["order_key"], ["value"]).withColumnRenamed("value", "v")
    return cumulative_share(s, "v", ["order_key"], cum_col="v_cum", share_col="v_cum_per")


# ---------------------------------------------------------------------------
# D3: cohort shifts in one scan
# ---------------------------------------------------------------------------

PROXY_SHIFTS = [
    (1, {"TX_CURR": "TX_CURR_3MO_PRIOR"}),
    (2, {"TX_CURR": "TX_CURR_6MO_PRIOR", "TX_PVLS_D": "TX_PVLS_D_6MO_PRIOR"}),
    (-2, {"TX_PVLS": "TX_PVLS_6MO_AFTER"}),
]


def _sql_shift(k: int, src: str, label: str) -> str:
    idx = f"(fy * 4 + q - 1 + ({k}))"
    return (f"SELECT '{label}' AS indicator, CAST(floor({idx} / 4) AS INT) AS fy, "
            f"CAST({idx} % 4 + 1 AS INT) AS q, value FROM dated WHERE indicator = '{src}'")


@register("shift_period", """
, expanded AS (
  SELECT indicator, fy, q, value FROM dated
  UNION ALL """ + "\n  UNION ALL ".join(_sql_shift(k, s, lab) for k, m in PROXY_SHIFTS
                                         for s, lab in m.items()) + """)
SELECT indicator, fy, q, count(*) AS n, sum(value) AS v FROM expanded GROUP BY indicator, fy, q
""")
def shift_period_q(spark, sf_dir):
    f = proxy.fact(spark, sf_dir).select("indicator", "fy", "q", "value")
    return (shift_period(f, PROXY_SHIFTS).groupBy("indicator", "fy", "q")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("v")))


# ---------------------------------------------------------------------------
# Trailing 12-month windows on literal anchors
# ---------------------------------------------------------------------------

PROXY_ANCHORS = ["2000-03-20", "2000-06-20", "2000-09-20", "2000-12-20", "2001-03-20"]
# Ship dates whose reporting date can be in a window: a quarter more on either side.
TRAILING_SHIP = ("1998-12-20", "2001-06-20")


def _dated_sums(f, keys):
    return f.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("v"))


@register("trailing_12m", """
, anchors AS (SELECT CAST(a AS DATE) AS anchor FROM (VALUES """
          + ", ".join(f"('{a}')" for a in PROXY_ANCHORS) + """) t(a)),
win AS (SELECT a.anchor, d.period, d.date, d.value FROM dated d JOIN anchors a
        ON d.date > a.anchor - INTERVAL 12 MONTH AND d.date <= a.anchor)
SELECT anchor, max(period) AS period, max(date) AS date, count(*) AS n, sum(value) AS v
FROM win GROUP BY anchor
""")
def trailing_12m(spark, sf_dir):
    # one pass over the lines: every line within a quarter of a window, summed to one row per
    # reporting date, which the windows and their labels both read
    f = proxy.fact(spark, sf_dir, ship_from=TRAILING_SHIP[0], ship_to=TRAILING_SHIP[1])
    days = materialize(_dated_sums(f, ["period", "date"]))
    w = anchor_windows(days, "date", PROXY_ANCHORS, 12, lower_strict=True)
    return (label_windows(w, "anchor").groupBy("anchor", "period", "date")
            .agg(F.sum("n").alias("n"), F.sum("v").alias("v")))


# ---------------------------------------------------------------------------
# 12-month cohorts on windows relative to the latest reporting date
# ---------------------------------------------------------------------------

def _sql_cohort_window(k: int, lo: int, hi: int | None) -> str:
    cond = (f"d.date > b.mx - INTERVAL {lo} MONTH" if hi is None else
            f"d.date BETWEEN b.mx - INTERVAL {lo} MONTH AND b.mx - INTERVAL {hi} MONTH")
    return (f"SELECT {k} AS k, d.period, d.date, d.value FROM dated d, bounds b "
            f"WHERE d.indicator = 'TX_PVLS' AND {cond}")


@register("pmtct_cohorts", """
, bounds AS (SELECT max(date) AS mx, max(period) AS mp FROM dated WHERE indicator = 'TX_CURR'),
w AS (""" + "\n  UNION ALL ".join(_sql_cohort_window(*w) for w in R.PMTCT_ART_COHORT["windows"])
          + """)
SELECT k,
       CASE WHEN k = 0 THEN (SELECT mp FROM bounds) ELSE max(period) END AS period,
       CASE WHEN k = 0 THEN (SELECT mx FROM bounds) ELSE max(date) END AS date,
       count(*) AS n, sum(value) AS v
FROM w GROUP BY k
""")
def pmtct_cohorts(spark, sf_dir):
    f = materialize(_dated_sums(proxy.fact(spark, sf_dir), ["indicator", "period", "date"]))
    b = period_bounds(f, where=F.col("indicator") == "TX_CURR")
    mx, mp = b["max_date"], b["max_period"]
    src = f.filter(F.col("indicator") == "TX_PVLS")
    w = relative_windows(src, "date", mx, R.PMTCT_ART_COHORT["windows"], window_col="k")
    labelled = label_windows(w, "k", fixed={0: (mx, mp)})
    return (labelled.groupBy("k", "period", "date")
            .agg(F.sum("n").alias("n"), F.sum("v").alias("v")))


# ---------------------------------------------------------------------------
# Regional roll-up of site support types
# ---------------------------------------------------------------------------

@register("regional_rollup", f"""
, typed AS (
  SELECT site_uid, snu1, value,
         CASE WHEN p IN ({', '.join(repr(x) for x in R.CLINICAL_PARTNERS_SITE_TYPE)}) THEN '99-AJUDA'
              WHEN p = 'MISAU' THEN '01-Sustainability' ELSE 'non-clinical' END AS site_type
  FROM (SELECT *, {_sql_recode('mech_name', PROXY_PARTNER)} AS p FROM dated
        WHERE period = '{PERIOD}' AND indicator = 'TX_CURR') x),
site AS (SELECT site_uid, snu1, site_type, sum(value) AS TX_CURR FROM typed
         WHERE site_type <> 'non-clinical' GROUP BY site_uid, snu1, site_type),
agg AS (
  SELECT snu1, sum(TX_CURR) AS TX_CURR,
         sum(CASE WHEN site_type = '01-Sustainability' THEN TX_CURR ELSE 0 END) AS TX_CURR_SUS,
         sum(CASE WHEN site_type = '99-AJUDA' THEN TX_CURR ELSE 0 END) AS TX_CURR_AJUDA,
         sum(CASE WHEN site_type = '01-Sustainability' THEN CAST(1 AS DOUBLE) ELSE 0 END) AS SITE_SUS,
         sum(CASE WHEN site_type = '99-AJUDA' THEN CAST(1 AS DOUBLE) ELSE 0 END) AS SITE_AJUDA
  FROM site WHERE TX_CURR > 0 GROUP BY snu1)
SELECT *, SITE_SUS + SITE_AJUDA AS SITE_TOTAL,
       {_sql_ratio('TX_CURR_AJUDA', 'TX_CURR')} AS TX_CURR_AJUDA_PER,
       {_sql_ratio('SITE_AJUDA', 'SITE_SUS + SITE_AJUDA')} AS SITE_AJUDA_PER
FROM agg
""")
def regional_rollup(spark, sf_dir):
    f = (proxy.fact(spark, sf_dir, periods=[PERIOD])
         .filter(F.col("indicator") == "TX_CURR")
         .withColumn("site_type", site_type(recode("mech_name", PROXY_PARTNER))))
    per_site = group_sum(f.filter(F.col("site_type") != "non-clinical"),
                         ["site_uid", "snu1", "site_type"], ["value"]) \
        .withColumnRenamed("value", "TX_CURR")
    return P.regional_rollup(per_site)


# ---------------------------------------------------------------------------
# Null-safe indicator mapping with fan-out
# ---------------------------------------------------------------------------

PROXY_DEDUP_MAP = [
    ("TX_CURR", None, "TX_CURR"),
    ("TX_CURR", "1-URGENT", "TX_CURR"),
    ("TX_CURR", "1-URGENT", "TX_CURR_URGENT"),
    ("TX_PVLS_D", "2-HIGH", "TX_PVLS_D"),
    ("TX_PVLS", "3-MEDIUM", None),
    ("TX_PVLS", "5-LOW", "TX_PVLS"),
]


@register("indicator_map", f"""
, m(indicator, standardizeddisaggregate, indicator_new) AS (VALUES {_sql_values(PROXY_DEDUP_MAP)})
SELECT m.indicator_new AS indicator, count(*) AS n, sum(d.value) AS v
FROM dated d JOIN m ON d.indicator IS NOT DISTINCT FROM m.indicator
  AND d.standardizeddisaggregate IS NOT DISTINCT FROM m.standardizeddisaggregate
WHERE m.indicator_new IS NOT NULL
GROUP BY m.indicator_new
""")
def indicator_map(spark, sf_dir):
    m = spark.createDataFrame(PROXY_DEDUP_MAP, "indicator string, standardizeddisaggregate "
                                               "string, indicator_new string")
    f = proxy.fact(spark, sf_dir).select("indicator", "standardizeddisaggregate", "value")
    return (map_indicator(f, m).groupBy("indicator")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("v")))


# ---------------------------------------------------------------------------
# Non-membership that keeps nulls
# ---------------------------------------------------------------------------

@register("not_in", """
SELECT standardizeddisaggregate, count(*) AS n, sum(value) AS v FROM dated
WHERE NOT coalesce(standardizeddisaggregate IN ('1-URGENT', '2-HIGH'), false)
GROUP BY standardizeddisaggregate
""")
def not_in_q(spark, sf_dir):
    f = proxy.fact(spark, sf_dir)
    return (f.filter(not_in("standardizeddisaggregate", ["1-URGENT", "2-HIGH"]))
            .groupBy("standardizeddisaggregate")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("v")))


# Further query families register themselves on import.
from indicata.plans import catalog_reshape  # noqa: E402,F401
from indicata.plans import catalog_rules  # noqa: E402,F401
from indicata.plans import catalog_scores  # noqa: E402,F401
from indicata.plans import catalog_reports  # noqa: E402,F401
from indicata.plans import catalog_files  # noqa: E402,F401
from indicata.plans import catalog_derived  # noqa: E402,F401
