"""Composite report queries (C1, C3-C8, C10, C11, C17) on the canonical extract derived
from the test tables.

The Spark side runs the library report functions unchanged
(:mod:`indicata.plans.reports`); the DuckDB oracle re-states the whole
chain step by step (map, attribute, reshape, exclude, shift, date, bound,
cohort, spread, filter, volume, derive, enrich) so every stage is checked.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from indicata.plans import reports as P
from indicata.plans import proxy
from indicata.plans import results_store as S
from indicata.plans import rules as R
from indicata.plans.proxy import ORACLE_CTE
from indicata.plans.registry import (ORACLE, QUERIES, _sql_band, _sql_in, _sql_lookup,
                                     _sql_recode, _sql_values)

# ---------------------------------------------------------------------------
# Spark side
# ---------------------------------------------------------------------------

RT_MEASURES = ["TX_CURR", "TX_CURR_D", "TX_ML", "TX_PVLS", "TX_PVLS_D", "PMTCT_ART",
               "TX_CURR_3MO_PRIOR", "TX_ML_3MO_PRIOR", "TX_CURR_6MO_PRIOR", "PMTCT_ART_12MO",
               "TX_ML_IIT", "TX_ML_IIT_3_Months_Less", "TX_PatientLoss", "TX_CURR_FemaleAdult",
               "PMTCT_ART_Already", "TX_CIRA", "TX_CURR_Expected", "his_epts"]
RT_KEYS = ["period_type", "period", "date", "partner_recode", "site_volume"]
WATERFALL_START = "2000-06-20"
SHARE_MEASURES_PROXY = ["TX_CURR", "TX_ML", "PMTCT_ART_Already"]
WATERFALL_PLUS = ["2000 Q4", "2001 Q1", "2001 Q2"]


def _dedup_map(spark):
    return spark.createDataFrame(proxy.PROXY_DEDUP, "indicator string, standardizeddisaggregate "
                                                    "string, indicator_new string")


def _put(spark, sf_dir, store, extract, quarters=None):
    partner = proxy.site_map(spark, sf_dir).select("datim_uid", "partner_pepfar_clinical")
    return S.update_results(store, extract, _dedup_map(spark), partner, proxy.PROXY_NAMES,
                            quarters=quarters)


def results_store(spark, sf_dir):
    """Folder of the stored results table (C3), which C4-C8, C11, C15 and C17 read."""
    return proxy.staged(spark, sf_dir, "results", lambda store: _put(
        spark, sf_dir, store, proxy.canonical_extract(spark, sf_dir)))


def results_table_proxy(spark, sf_dir):
    return S.read_results(spark, results_store(spark, sf_dir), proxy.site_map(spark, sf_dir))


def _nsum(df, keys, measures):
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"),
                                 *[F.sum(c).alias(c) for c in measures])


def q_results_table(spark, sf_dir):
    rt = P.results_table(proxy.canonical_extract(spark, sf_dir), _dedup_map(spark),
                         proxy.site_map(spark, sf_dir), proxy.PROXY_NAMES)
    return _nsum(rt, RT_KEYS, RT_MEASURES)


RESUBMITTED = (2000, 2)


def q_results_resubmitted(spark, sf_dir):
    """The stored results table after one quarter came in again: one mechanism withdrew it, the
    others reported twice as much."""
    from indicata.session import scratch_path
    e = proxy.canonical_extract(spark, sf_dir)
    store = scratch_path(spark, "resubmitted")
    _put(spark, sf_dir, store, e)
    year, quarter = RESUBMITTED
    was = F.col(f"qtr{quarter}")
    now = F.when(F.col("mech_name") != "MACHINERY", 2 * was)
    again = e.filter(F.col("fiscal_year") == year).withColumns({
        "cumulative": F.col("cumulative") - F.coalesce(was, F.lit(0)) + F.coalesce(now, F.lit(0)),
        f"qtr{quarter}": now})
    _put(spark, sf_dir, store, again, [RESUBMITTED])
    return _nsum(S.read_results(spark, store, proxy.site_map(spark, sf_dir)), RT_KEYS, RT_MEASURES)


def q_tb_summary(spark, sf_dir):
    return P.tb_summary(results_table_proxy(spark, sf_dir), measures=("TX_CURR", "TX_PVLS"))


def q_supply_triangulation(spark, sf_dir):
    return P.supply_triangulation(results_table_proxy(spark, sf_dir), _last_date(spark, sf_dir))


def _last_date(spark, sf_dir):
    """The last reporting date, from the state of the stored table."""
    return F.lit(S.read_state(spark, results_store(spark, sf_dir))["max_date"]).cast("date")


def q_waterfall(spark, sf_dir):
    wf = P.waterfall(results_table_proxy(spark, sf_dir), start=WATERFALL_START,
                     plus_periods=WATERFALL_PLUS)
    return wf.groupBy("period", "indicator", "ageasentered").agg(
        F.count(F.lit(1)).alias("n"), F.sum("value").alias("v"))


def q_running_share(spark, sf_dir):
    r = results_table_proxy(spark, sf_dir)
    partner = proxy.site_map(spark, sf_dir).select(
        "datim_uid", F.col("partner_pepfar_clinical").alias("mech_name"))
    g = P.running_share(r, "2000 Q4", measures=SHARE_MEASURES_PROXY, share_measure="TX_CURR",
                        site_partner=partner)
    return g.drop("partner_alt")


# ---------------------------------------------------------------------------
# Oracle: the results-table chain in SQL
# ---------------------------------------------------------------------------

K = ["orgunituid", "sitename", "snu1", "psnu", "mech_name", "indicator", "numeratordenom",
     "standardizeddisaggregate", "fiscal_year", "otherdisaggregate", "sex", "ageasentered",
     "sitetype", "trendscoarse", "partner_recode"]


def _long_part(col, ptype, q, labels=()) -> str:
    qexpr = str(q) if q else "CAST(NULL AS INTEGER)"
    return (f"SELECT {', '.join([*K, *labels])}, '{ptype}' AS period_type, {qexpr} AS q, "
            f"{col} AS value FROM attr")


def _shift_part(k, src, label) -> str:
    idx = f"(fy * 4 + q - 1 + ({k}))"
    return (f"SELECT * REPLACE ('{label}' AS indicator_temp, CAST(floor({idx} / 4) AS INT) AS fy, "
            f"CAST({idx} % 4 + 1 AS INT) AS q) FROM excl WHERE indicator_temp = '{src}'")


def _excl_sql(rule) -> str:
    terms = []
    for c, op, *arg in rule[0]:
        a = arg[0] if arg else None
        if op == "==":
            terms.append(f"{c} = {repr(a) if isinstance(a, str) else a}")
        elif op == "in":
            terms.append(f"{c} IN ({_sql_in(a)})")
        elif op == "not_in":
            terms.append(f"NOT coalesce({c} IN ({_sql_in(a)}), false)")
        else:
            raise ValueError(op)
    return "NOT coalesce(" + " AND ".join(terms) + ", false)"


def _cohort_part(k, lo, hi) -> str:
    cond = (f"d2.date > b.mx - INTERVAL {lo} MONTH" if hi is None else
            f"d2.date BETWEEN b.mx - INTERVAL {lo} MONTH AND b.mx - INTERVAL {hi} MONTH")
    return f"SELECT d2.*, {k} AS k FROM d2, b WHERE d2.indicator_temp = 'PMTCT_ART' AND {cond}"


_IIT_ALL = ["IIT 0-3m ART", "IIT 3-5m ART", "IIT 6+m ART", "IIT 3+m ART"]


def _results_chain(extract: str = "ext3", dealt: str = "", labels=(), dedup=proxy.PROXY_DEDUP,
                   names=proxy.PROXY_NAMES, derived: str | None = None) -> str:
    """The chain over ``extract``, a CTE that ``dealt`` may define; ``labels`` are further label
    columns of it, ``derived`` the steps from ``wide`` to ``dv3`` in place of those below."""
    more = "".join(f", {c}" for c in labels)
    shifts = [_shift_part(k, s, lab) for k, m in R.COHORT_SHIFTS for s, lab in m.items()]
    onehot = ", ".join(f"CASE WHEN indicator_temp = '{n}' THEN value END AS {n}"
                       for n in names)
    recode = ("CASE otherdisaggregate " + " ".join(
        f"WHEN '{k}' THEN '{v}'" for k, v in R.OTHERDISAGGREGATE_RECODE.items())
        + " ELSE otherdisaggregate END")
    if derived is None:
        derived = f"""\
dv1 AS (SELECT * REPLACE ({recode} AS otherdisaggregate) FROM wide),
dv2 AS (
  SELECT *,
         CASE WHEN sex = 'Female' AND agecoarse = '15+' THEN TX_CURR END AS TX_CURR_FemaleAdult,
         CASE WHEN otherdisaggregate IN ({_sql_in(_IIT_ALL)}) THEN TX_ML END AS TX_ML_IIT,
         CASE WHEN otherdisaggregate = 'IIT 0-3m ART' THEN TX_ML END AS TX_ML_IIT_3_Months_Less,
         CASE WHEN otherdisaggregate <> 'Transferred Out' THEN TX_ML END AS TX_PatientLoss,
         CASE WHEN otherdisaggregate = 'Life-long ART, Already' THEN PMTCT_ART END
           AS PMTCT_ART_Already,
         TX_CURR AS TX_CURR_Expected,
         CAST(NULL AS DOUBLE) AS TX_NEW, CAST(NULL AS DOUBLE) AS TX_RTT,
         CAST(NULL AS DOUBLE) AS TX_NET_NEW
  FROM dv1),
dv3 AS (SELECT *, TX_ML_IIT AS TX_CIRA FROM dv2),"""
    return f"""
, ext AS (
  SELECT CAST(site_uid AS VARCHAR) AS orgunituid, sitename, snu1, psnu, mech_name, indicator,
         numeratordenom, standardizeddisaggregate, fy AS fiscal_year,
         sum(CASE WHEN q = 1 THEN value END) AS qtr1, sum(CASE WHEN q = 2 THEN value END) AS qtr2,
         sum(CASE WHEN q = 3 THEN value END) AS qtr3, sum(CASE WHEN q = 4 THEN value END) AS qtr4,
         sum(value) AS cumulative, sum(CASE WHEN numeratordenom = 'D' THEN value END) AS targets
  FROM dated
  GROUP BY site_uid, sitename, snu1, psnu, mech_name, indicator, numeratordenom,
           standardizeddisaggregate, fy),
ext2 AS (
  SELECT *, {_sql_lookup('standardizeddisaggregate', proxy.PROXY_OTHERDISAGG)} AS otherdisaggregate,
         CASE WHEN numeratordenom = 'D' THEN 'Female' ELSE 'Male' END AS sex,
         {_sql_lookup('mech_name', proxy.PROXY_AGE)} AS ageasentered,
         CASE WHEN snu1 = 'MIDDLE EAST' THEN 'Community' ELSE 'Facility' END AS sitetype
  FROM ext),
ext3 AS (
  SELECT *, CASE WHEN ageasentered IN ({_sql_in(R.AGES_UNDER_15)}) THEN '<15'
                 WHEN ageasentered = 'Unknown' THEN 'Unknown Age' ELSE '15+' END AS trendscoarse
  FROM ext2),{dealt}
dmap(indicator, standardizeddisaggregate, indicator_new) AS (VALUES {_sql_values(dedup)}),
mapped AS (
  SELECT e.* EXCLUDE (indicator), m.indicator_new AS indicator
  FROM {extract} e JOIN dmap m ON e.indicator IS NOT DISTINCT FROM m.indicator
   AND e.standardizeddisaggregate IS NOT DISTINCT FROM m.standardizeddisaggregate
  WHERE m.indicator_new IS NOT NULL),
smap AS (
  SELECT CAST(site_uid AS VARCHAR) AS datim_uid,
         {_sql_lookup('snu1', proxy.PROXY_SITE_PARTNER)} AS partner_pepfar_clinical,
         CASE WHEN acctbal > 5000 THEN CAST(1 AS DOUBLE) END AS his_epts
  FROM site_dim),
attr AS (
  SELECT mp.*,
         CASE WHEN mp.indicator IN ({_sql_in(R.CLINICAL_INDICATORS)})
                   AND s.partner_pepfar_clinical IS NOT NULL THEN s.partner_pepfar_clinical
              WHEN mp.indicator IN ({_sql_in(R.CLINICAL_INDICATORS)}) THEN 'MISAU'
              ELSE mp.mech_name END AS partner_recode
  FROM mapped mp LEFT JOIN smap s ON mp.orgunituid = s.datim_uid),
long AS (
  {_long_part('qtr1', 'results', 1, labels)}
  UNION ALL {_long_part('qtr2', 'results', 2, labels)}
  UNION ALL {_long_part('qtr3', 'results', 3, labels)}
  UNION ALL {_long_part('qtr4', 'results', 4, labels)}
  UNION ALL {_long_part('cumulative', 'cumulative', None, labels)}
  UNION ALL {_long_part('targets', 'targets', None, labels)}),
long2 AS (
  SELECT *, indicator || CASE WHEN numeratordenom = 'D' THEN '_D' ELSE '' END AS indicator_temp,
         fiscal_year AS fy, CASE WHEN q IS NOT NULL THEN 'Q' || CAST(q AS VARCHAR) END AS quarter
  FROM long WHERE value IS NOT NULL),
excl AS (
  SELECT * FROM long2 WHERE {' AND '.join(_excl_sql(r) for r in R.EXCLUSIONS)}),
sh AS (
  SELECT * FROM excl
  UNION ALL {chr(10).join('  UNION ALL ' + s if i else s for i, s in enumerate(shifts))}),
d2 AS (
  SELECT *, CAST(fy AS VARCHAR) || ' Q' || CAST(q AS VARCHAR) AS period,
         make_date(CASE WHEN q = 1 THEN fy - 1 ELSE fy END,
                   CASE q WHEN 1 THEN 12 WHEN 2 THEN 3 WHEN 3 THEN 6 WHEN 4 THEN 9 END, 20) AS date
  FROM sh),
b AS (SELECT min(date) AS mn, max(date) AS mx, max(period) AS mp FROM d2
      WHERE indicator_temp = 'TX_CURR' AND period_type = 'results'),
cw AS (
  {chr(10).join(('  UNION ALL ' if i else '') + _cohort_part(*w)
                for i, w in enumerate(R.PMTCT_ART_COHORT['windows']))}),
cl AS (SELECT k, max(date) AS ld, max(period) AS lp FROM cw GROUP BY k),
co AS (
  SELECT cw.* EXCLUDE (k, date, period, indicator_temp), 'PMTCT_ART_12MO' AS indicator_temp,
         CASE WHEN cw.k = 0 THEN (SELECT mx FROM b) ELSE cl.ld END AS date,
         CASE WHEN cw.k = 0 THEN (SELECT mp FROM b) ELSE cl.lp END AS period
  FROM cw JOIN cl ON cw.k = cl.k),
allrows AS (SELECT * FROM d2 UNION ALL BY NAME SELECT * FROM co),
flt AS (
  SELECT a.* FROM allrows a, b WHERE (a.date >= b.mn AND a.date <= b.mx) OR a.period IS NULL),
wide AS (
  SELECT orgunituid, sitename, snu1, psnu, mech_name, standardizeddisaggregate,
         fy AS fiscal_year, otherdisaggregate, sex, ageasentered, sitetype,
         trendscoarse AS agecoarse, partner_recode, period_type, period, date{more}, {onehot}
  FROM flt),
vol AS (
  SELECT orgunituid,
         {_sql_band('s', R.SITE_VOLUME_BANDS, R.SITE_VOLUME_DEFAULT)} AS site_volume
  FROM (SELECT orgunituid, coalesce(sum(TX_CURR), 0) AS s FROM wide, b
        WHERE sitetype = 'Facility' AND date = b.mx GROUP BY orgunituid)),
{derived}
rt AS (
  SELECT d.* EXCLUDE (orgunituid), d.orgunituid AS datim_uid, v.site_volume,
         s.partner_pepfar_clinical, coalesce(s.his_epts, 0) AS his_epts
  FROM dv3 d LEFT JOIN vol v ON d.orgunituid = v.orgunituid
  LEFT JOIN smap s ON d.orgunituid = s.datim_uid
  WHERE d.period_type IN ('results', 'cumulative'))
"""


RESULTS_CHAIN = _results_chain()


def _register(name, fn, sql):
    QUERIES[name] = fn
    if sql is not None:
        ORACLE[name] = ORACLE_CTE + RESULTS_CHAIN + sql


_register("results_table", q_results_table, f"""
SELECT {', '.join(RT_KEYS)}, count(*) AS n, {', '.join(f'sum({m}) AS {m}' for m in RT_MEASURES)}
FROM rt GROUP BY {', '.join(RT_KEYS)}
""")

def _resubmitted_chain() -> str:
    """The chain on an extract whose rows of RESUBMITTED were replaced."""
    year, quarter = RESUBMITTED
    was, here = f"qtr{quarter}", f"fiscal_year = {year}"
    now = f"CASE WHEN mech_name <> 'MACHINERY' THEN 2 * {was} END"
    again = (f"(SELECT * REPLACE (CASE WHEN {here} THEN {now} ELSE {was} END AS {was}, "
             f"CASE WHEN {here} THEN cumulative - coalesce({was}, 0) + coalesce({now}, 0) "
             f"ELSE cumulative END AS cumulative) FROM ext)")
    assert RESULTS_CHAIN.count("FROM ext)") == 1
    return RESULTS_CHAIN.replace("FROM ext)", f"FROM {again})")


QUERIES["results_resubmitted"] = q_results_resubmitted
ORACLE["results_resubmitted"] = ORACLE_CTE + _resubmitted_chain() + f"""
SELECT {', '.join(RT_KEYS)}, count(*) AS n, {', '.join(f'sum({m}) AS {m}' for m in RT_MEASURES)}
FROM rt GROUP BY {', '.join(RT_KEYS)}
"""

_register("tb_summary", q_tb_summary, """
SELECT snu1, date, partner_pepfar_clinical AS partner, period,
       coalesce(sum(TX_CURR), 0) AS TX_CURR, coalesce(sum(TX_PVLS), 0) AS TX_PVLS
FROM rt WHERE period_type = 'results' GROUP BY snu1, date, partner_pepfar_clinical, period
""")

_register("supply_triangulation", q_supply_triangulation, """
SELECT period, datim_uid, snu1, psnu, sitename, coalesce(sum(TX_CURR), 0) AS tx_curr
FROM rt WHERE date = (SELECT max(date) FROM rt) AND TX_CURR IS NOT NULL
GROUP BY period, datim_uid, snu1, psnu, sitename
""")

_WF_KEYS = ["datim_uid", "period", "partner_recode", "snu1", "psnu", "sitename", "sex",
            "ageasentered", "agecoarse", "otherdisaggregate"]
_WF_COLS = (["TX_NEW", "TX_RTT", "TX_ML", "TX_NET_NEW"]
            + [name for name, _ in R.WATERFALL_LOSSES])


def _wf_ctes() -> str:
    losses = ", ".join(f"CASE WHEN otherdisaggregate = '{lab}' THEN TX_ML END AS {name}"
                       for name, lab in R.WATERFALL_LOSSES)
    parts = " UNION ALL ".join(
        f"SELECT datim_uid, period, ageasentered, '{c}' AS indicator, {c} AS value FROM w"
        for c in _WF_COLS if c != "TX_ML")
    return f"""
, w0 AS (
  SELECT * REPLACE (CASE WHEN period IN ({_sql_in(WATERFALL_PLUS)})
                          AND ageasentered IN ({_sql_in(R.AGES_50_PLUS)}) THEN '50+'
                         ELSE ageasentered END AS ageasentered)
  FROM rt WHERE date >= DATE '{WATERFALL_START}' AND date IS NOT NULL
    AND NOT coalesce(ageasentered IN ({_sql_in(R.WATERFALL_EXCLUDED_AGES)}), false)),
w AS (SELECT *, {losses} FROM w0),
g AS ({parts})
"""


_WF_SQL = _wf_ctes() + """
SELECT period, indicator, ageasentered, count(*) AS n, sum(value) AS v
FROM g WHERE value IS NOT NULL GROUP BY period, indicator, ageasentered
"""


_register("waterfall", q_waterfall, _WF_SQL)

_register("running_share", q_running_share, f"""
, s AS (
  SELECT datim_uid, snu1, psnu, sitename, coalesce(sum(TX_CURR), 0) AS TX_CURR,
         coalesce(sum(TX_ML), 0) AS TX_ML,
         coalesce(sum(PMTCT_ART_Already), 0) AS PMTCT_ART_Already
  FROM rt WHERE period = '2000 Q4' AND period_type = 'results'
    AND sitetype IN ('Facility', 'Military')
  GROUP BY datim_uid, snu1, psnu, sitename),
k AS (SELECT * FROM s WHERE datim_uid NOT IN (
        SELECT datim_uid FROM s WHERE TX_CURR = 0 AND TX_ML = 0 AND PMTCT_ART_Already = 0)),
c AS (
  SELECT *, sum(TX_CURR) OVER (ORDER BY TX_CURR DESC, datim_uid
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS TX_CURR_cum,
         sum(TX_CURR) OVER () AS tot FROM k)
SELECT c.datim_uid, snu1, psnu, sitename, TX_CURR, TX_ML, PMTCT_ART_Already, TX_CURR_cum,
       CASE WHEN tot = 0 AND TX_CURR_cum = 0 THEN 1.0::DOUBLE
            WHEN tot <> 0 THEN TX_CURR_cum / tot
            WHEN TX_CURR_cum > 0 THEN 'Infinity'::DOUBLE END AS TX_CURR_cum_per,
       CAST(0 AS DOUBLE) AS PMTCT_HEI_POS_per,
       CASE m.partner_pepfar_clinical WHEN 'MISAU' THEN 'MISAU Graduation'
            ELSE m.partner_pepfar_clinical END AS mech_name,
       CASE WHEN m.partner_pepfar_clinical IN ({_sql_in(R.CLINICAL_PARTNERS_SITE_TYPE)})
            THEN '99-AJUDA' ELSE '01-Sustainability' END AS site_type
FROM c LEFT JOIN smap m ON c.datim_uid = m.datim_uid
""")


# ---------------------------------------------------------------------------
# C17: viral-load crosswalk of three sources (programme, supplemental, lab)
# ---------------------------------------------------------------------------

VL_START = "1999-12-20"
VL_ANCHORS = ["1999-12-20", "2000-03-20", "2000-06-20", "2000-09-20", "2000-12-20",
              "2001-03-20", "2001-06-20"]
SUP_AGE = {"AUTOMOBILE": "Unknown", "BUILDING": "All", "FURNITURE": "60-64",
           "HOUSEHOLD": "25-29", "MACHINERY": "10-14"}
SUP_SUBTYPE = {"1-URGENT": "PW", "2-HIGH": "LW"}
SUP_SOURCE = {"AUTOMOBILE": "Clinical Module", "BUILDING": "Lab Module",
              "HOUSEHOLD": "Clinical Module", "MACHINERY": "Lab Module"}
LAB_GROUP = {"1-URGENT": "PW", "5-LOW": "LW"}
VL_KEYS = ["source", "period", "date", "indicator", "pop_type", "ageasentered", "sex", "psnuuid"]


def _vl_inputs(spark, sf_dir):
    from indicata.functions.expressions import lookup
    # aggregate the lines first, then attach site attributes to the aggregates
    f = proxy.daily_lines(spark, sf_dir)
    site_attrs = proxy.sites(spark, sf_dir).drop("acctbal")
    uid = F.col("site_uid").cast("string").alias("datim_uid")
    # by the reporting day itself: the series' own filter reads it out of the summed period again
    s0 = f.filter(F.col("date") >= F.to_date(F.lit(VL_START))).groupBy(
        "site_uid", "period", "mech_name", "numeratordenom",
        "standardizeddisaggregate", "indicator").agg(
        F.sum("value").alias("value")).join(site_attrs, "site_uid")
    sup = s0.select(
        uid, lookup("snu1", proxy.PROXY_SITE_PARTNER).alias("partner_pepfar_clinical"),
        F.col("snu1").alias("snu"), "psnu", "sitename", "period",
        F.when(F.col("numeratordenom") == "D", F.lit("Unknown")).otherwise(F.lit("Female"))
         .alias("sex"),
        lookup("mech_name", SUP_AGE).alias("age"),
        F.when(F.col("mech_name") == "FURNITURE", F.lit("KeyPop")).otherwise(F.lit("Age"))
         .alias("pop_type"),
        lookup("standardizeddisaggregate", SUP_SUBTYPE).alias("pop_subtype"),
        lookup("mech_name", SUP_SOURCE).alias("source"),
        F.when(F.col("indicator") == "TX_PVLS", F.lit("TX_PVLS_N")).otherwise(F.col("indicator"))
         .alias("indicator"), "value")
    ind = F.col("indicator")
    d0 = f.groupBy("site_uid", "ship_date", "mech_name", "standardizeddisaggregate").agg(
        F.coalesce(F.sum(F.when(ind == "TX_PVLS_D", F.col("value"))), F.lit(0.0)).alias("VL"),
        F.coalesce(F.sum(F.when(ind == "TX_PVLS", F.col("value"))), F.lit(0.0)).alias("VLS")
    ).join(site_attrs, "site_uid")
    disa = d0.select(
        uid, F.col("mech_name").alias("partner"), F.col("snu1").alias("snu"), "psnu", "sitename",
        F.col("ship_date").alias("period"), lookup("mech_name", proxy.PROXY_AGE).alias("age"),
        F.coalesce(lookup("standardizeddisaggregate", LAB_GROUP), F.lit("Age")).alias("group"),
        F.when(F.col("mech_name") == "BUILDING", F.lit("Female")).otherwise(F.lit("Male"))
         .alias("sex"), "VL", "VLS")
    sites = proxy.sites(spark, sf_dir).select(
        uid, "sitename", "psnu", F.col("snu1").alias("snu"),
        lookup("snu1", proxy.PROXY_SITE_PARTNER).alias("partner_pepfar_clinical"))
    nation = proxy.table(spark, sf_dir, "nation").select(
        F.col("n_name").alias("psnu"), F.col("n_nationkey").cast("string").alias("psnuuid"))
    return sup, disa, sites, nation


def q_vl_crosswalk(spark, sf_dir):
    sup, disa, sites, nation = _vl_inputs(spark, sf_dir)
    out = P.vl_crosswalk(results_table_proxy(spark, sf_dir), sup, disa, sites, nation,
                         anchors=VL_ANCHORS, months_back=R.VL_MONTHS_BACK, start=VL_START,
                         max_date=_last_date(spark, sf_dir))
    return out.groupBy(*VL_KEYS).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("v"))


def _vl_sql() -> str:
    age50 = _sql_in(R.AGES_50_PLUS)
    mer_parts = " UNION ALL ".join(
        f"SELECT datim_uid, period, date, sex, ageasentered, otherdisaggregate, "
        f"'{c}' AS indicator, {c} AS value FROM m0" for c in
        ("TX_CURR_6MO_PRIOR", "TX_PVLS", "TX_PVLS_D"))
    anchors = ", ".join(f"('{a}')" for a in VL_ANCHORS)
    return f"""
, m0 AS (SELECT * FROM rt WHERE date >= DATE '{VL_START}' AND partner_recode <> 'MISAU'),
m1 AS ({mer_parts}),
mer AS (
  SELECT datim_uid, period, date, sex,
         CASE WHEN ageasentered IN ({age50}) THEN '50+' ELSE ageasentered END AS ageasentered,
         replace(indicator, '_PLW', '') AS indicator,
         CASE WHEN otherdisaggregate LIKE '%Breastfeeding%' THEN 'LW'
              WHEN otherdisaggregate LIKE '%Pregnant%' THEN 'PW' ELSE 'Age/Sex' END AS pop_type,
         '{R.VL_SOURCE_PROGRAMME}' AS source, value
  FROM m1 WHERE value IS NOT NULL),
s0 AS (SELECT site_uid, period, mech_name, numeratordenom, standardizeddisaggregate, indicator,
              sum(value) AS value
       FROM dated GROUP BY site_uid, snu1, psnu, sitename, period, mech_name, numeratordenom,
                           standardizeddisaggregate, indicator),
s1 AS (
  SELECT CAST(site_uid AS VARCHAR) AS datim_uid, period,
         CASE WHEN numeratordenom = 'D' THEN 'Unknown' ELSE 'Female' END AS sex,
         {_sql_lookup('mech_name', SUP_AGE)} AS age,
         CASE WHEN mech_name = 'FURNITURE' THEN 'KeyPop' ELSE 'Age' END AS pop_type0,
         {_sql_lookup('standardizeddisaggregate', SUP_SUBTYPE)} AS pop_subtype,
         {_sql_lookup('mech_name', SUP_SOURCE)} AS source0,
         CASE WHEN indicator = 'TX_PVLS' THEN 'TX_PVLS_N' ELSE indicator END AS indicator0, value
  FROM s0),
sup AS (
  SELECT datim_uid, period,
         make_date(CASE WHEN q = 1 THEN fy - 1 ELSE fy END,
                   CASE q WHEN 1 THEN 12 WHEN 2 THEN 3 WHEN 3 THEN 6 WHEN 4 THEN 9 END, 20) AS date,
         CASE WHEN sex = 'Unknown' THEN 'Unknown Sex' ELSE sex END AS sex,
         CASE WHEN age = 'Unknown' THEN 'Unknown Age' WHEN age = 'All' THEN NULL
              WHEN age IN ({age50}) THEN '50+' ELSE age END AS ageasentered,
         CASE WHEN indicator0 = 'TX_PVLS_N' THEN 'TX_PVLS' ELSE indicator0 END AS indicator,
         coalesce(pop_subtype, 'Age/Sex') AS pop_type,
         CASE source0 WHEN 'Clinical Module' THEN 'EPTS-Clinical' WHEN 'Lab Module' THEN 'EPTS-Lab'
              ELSE source0 END AS source,
         value
  FROM (SELECT *, CAST(split_part(period, ' ', 1) AS INTEGER) AS fy,
               CAST(regexp_extract(period, 'Q([1-4])', 1) AS INTEGER) AS q FROM s1)
  WHERE pop_type0 <> 'KeyPop'),
sup2 AS (SELECT * FROM sup WHERE date >= DATE '{VL_START}'),
sm AS (SELECT CAST(site_uid AS VARCHAR) AS datim_uid, psnu FROM site_dim),
pm AS (SELECT n_name AS psnu, CAST(n_nationkey AS VARCHAR) AS psnuuid FROM nation),
l0 AS (SELECT site_uid, ship_date, mech_name, standardizeddisaggregate,
              coalesce(sum(CASE WHEN indicator = 'TX_PVLS_D' THEN value END), 0) AS VL,
              coalesce(sum(CASE WHEN indicator = 'TX_PVLS' THEN value END), 0) AS VLS
       FROM dated GROUP BY site_uid, snu1, psnu, sitename, ship_date, mech_name,
                           standardizeddisaggregate),
l1 AS (SELECT CAST(site_uid AS VARCHAR) AS datim_uid, ship_date AS date,
              {_sql_lookup('mech_name', proxy.PROXY_AGE)} AS age,
              coalesce({_sql_lookup('standardizeddisaggregate', LAB_GROUP)}, 'Age') AS grp,
              CASE WHEN mech_name = 'BUILDING' THEN 'Female' ELSE 'Male' END AS sex0, VL, VLS
       FROM l0),
l2 AS (SELECT datim_uid, date, age, grp, sex0, 'TX_PVLS_D' AS indicator, VL AS value FROM l1
       UNION ALL SELECT datim_uid, date, age, grp, sex0, 'TX_PVLS' AS indicator, VLS AS value FROM l1),
l3 AS (
  SELECT datim_uid, date, indicator, value,
         CASE WHEN grp IN ('PW', 'LW') THEN NULL ELSE age END AS ageasentered,
         CASE WHEN grp = 'Age' THEN 'Age/Sex' ELSE grp END AS pop_type,
         CASE WHEN grp IN ('PW', 'LW') THEN NULL ELSE sex0 END AS sex,
         CAST(year(date + INTERVAL 3 MONTH) AS VARCHAR) || ' Q'
           || CAST(quarter(date + INTERVAL 3 MONTH) AS VARCHAR) AS period
  FROM l2
  WHERE date >= DATE '{VL_START}' - INTERVAL {R.VL_MONTHS_BACK} MONTH
    AND date <= (SELECT max(date) FROM rt) AND value > 0
    AND datim_uid IN (SELECT datim_uid FROM sm)),
anchors AS (SELECT CAST(a AS DATE) AS anchor FROM (VALUES {anchors}) t(a)),
lw AS (SELECT a.anchor, l3.* FROM l3 JOIN anchors a
       ON l3.date >= a.anchor - INTERVAL {R.VL_MONTHS_BACK} MONTH AND l3.date <= a.anchor),
ll AS (SELECT anchor, max(period) AS lp, max(date) AS ld FROM lw GROUP BY anchor),
lab AS (SELECT lw.datim_uid, ll.lp AS period, ll.ld AS date, lw.sex, lw.ageasentered,
               lw.indicator, lw.pop_type, '{R.VL_SOURCE_LAB}' AS source, lw.value
        FROM lw JOIN ll ON lw.anchor = ll.anchor),
allv AS (
  SELECT datim_uid, period, date, sex, ageasentered, indicator, pop_type, source, value FROM mer
  UNION ALL SELECT datim_uid, period, date, sex, ageasentered, indicator, pop_type, source, value
            FROM sup2
  UNION ALL SELECT datim_uid, period, date, sex, ageasentered, indicator, pop_type, source, value
            FROM lab),
fin AS (SELECT a.*, pm.psnuuid FROM allv a LEFT JOIN sm ON a.datim_uid = sm.datim_uid
        LEFT JOIN pm ON sm.psnu = pm.psnu)
SELECT {', '.join(VL_KEYS)}, count(*) AS n, sum(value) AS v FROM fin GROUP BY {', '.join(VL_KEYS)}
"""


_register("vl_crosswalk", q_vl_crosswalk, _vl_sql())


# ---------------------------------------------------------------------------
# Running share, first version, from the site-level extract
# ---------------------------------------------------------------------------

V1_OVERRIDES = {"1": "ICAP", "2": "FGH"}
V1_MEASURES = ["HTS_TST_POS", "TX_CURR", "PMTCT_STAT", "PMTCT_STAT_POS", "PMTCT_HEI_POS",
               "PMTCT_EID_D"]


def _partner_alt(spark, sf_dir):
    s = proxy.sites(spark, sf_dir).filter(F.col("acctbal") > 5000)
    return s.select(F.col("site_uid").cast("string").alias("datim_uid"),
                    F.lit("GF").alias("partner_alt"))


def q_running_share_v1(spark, sf_dir):
    from indicata.functions.expressions import recode
    dg = proxy.canonical_extract(spark, sf_dir).withColumn(
        "mech_name", recode("mech_name", proxy.PROXY_MECH_PARTNER))
    m = spark.createDataFrame(proxy.PROXY_DEDUP, "indicator string, standardizeddisaggregate "
                                                 "string, indicator_new string")
    return P.running_share_v1(dg, m, _partner_alt(spark, sf_dir), period="FY00Q4",
                              mech_overrides=V1_OVERRIDES)


def _v1_sql() -> str:
    mech = ("CASE mech_name " + " ".join(f"WHEN '{k}' THEN '{v}'"
                                         for k, v in proxy.PROXY_MECH_PARTNER.items())
            + " ELSE mech_name END")
    override = ("CASE " + " ".join(f"WHEN orgunituid = '{k}' THEN '{v}'"
                                   for k, v in V1_OVERRIDES.items()) + " ELSE mech_name END")
    onehot = ", ".join(f"CASE WHEN ind2 = '{c}' THEN value END AS {c}" for c in V1_MEASURES)
    sums = ", ".join(f"coalesce(sum(coalesce({c}, 0)), 0) AS {c}" for c in V1_MEASURES)
    keys = "datim_uid, snu1, psnu, sitename, site_type, mech_name, partner_alt"
    return f"""
, v0 AS (SELECT * REPLACE ({mech} AS mech_name) FROM ext3
         WHERE indicator IN ({_sql_in(R.V1_INDICATORS)})),
vm AS (SELECT e.* EXCLUDE (indicator), m.indicator_new AS indicator
       FROM v0 e JOIN dmap m ON e.indicator IS NOT DISTINCT FROM m.indicator
        AND e.standardizeddisaggregate IS NOT DISTINCT FROM m.standardizeddisaggregate
       WHERE m.indicator_new IS NOT NULL),
vl AS (SELECT *, indicator || CASE WHEN numeratordenom = 'D' THEN '_D' ELSE '' END AS ind2,
              qtr4 AS value
       FROM vm WHERE fiscal_year = 2000 AND qtr4 IS NOT NULL
         AND sitetype IN ('Facility', 'Military')),
vl2 AS (SELECT * REPLACE ({override} AS mech_name) FROM vl),
vl3 AS (SELECT *, CASE WHEN mech_name IN ({_sql_in(R.CLINICAL_PARTNERS_SITE_TYPE)}) THEN '99-AJUDA'
                       WHEN mech_name = 'MISAU' THEN '01-Sustainability'
                       ELSE 'non-clinical' END AS site_type FROM vl2),
pa AS (SELECT CAST(site_uid AS VARCHAR) AS datim_uid, 'GF' AS partner_alt FROM site_dim
       WHERE acctbal > 5000),
vl4 AS (SELECT vl3.orgunituid AS datim_uid, snu1, psnu, sitename, site_type, mech_name,
               pa.partner_alt, {onehot}
        FROM vl3 LEFT JOIN pa ON vl3.orgunituid = pa.datim_uid
        WHERE site_type <> 'non-clinical'),
g AS (SELECT {keys}, {sums} FROM vl4 GROUP BY {keys}),
c AS (SELECT *, sum(TX_CURR) OVER (ORDER BY TX_CURR DESC, {keys.replace(', ', ' ASC NULLS LAST, ')}
                                      ASC NULLS LAST
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS TX_CURR_cum,
              sum(TX_CURR) OVER () AS tot FROM g)
SELECT * EXCLUDE (tot),
       CASE WHEN tot <> 0 THEN TX_CURR_cum / tot WHEN tot = 0 AND TX_CURR_cum > 0
            THEN 'Infinity'::DOUBLE END AS TX_CURR_cum_per,
       coalesce(CASE WHEN PMTCT_EID_D <> 0 THEN PMTCT_HEI_POS / PMTCT_EID_D
                     WHEN PMTCT_EID_D = 0 AND PMTCT_HEI_POS > 0 THEN 'Infinity'::DOUBLE END, 0)
         AS PMTCT_HEI_POS_per
FROM c
"""


_register("running_share_v1", q_running_share_v1, _v1_sql())


# ---------------------------------------------------------------------------
# Yearly extracts with drifting layouts -> one site fact (recodes, corrections)
# ---------------------------------------------------------------------------

LONG_MECH = {"AUTOMOBILE": "Efficiencies for Clinical HIV Outcomes (ECHO)",
             "BUILDING": "Friends in Global Health", "FURNITURE": "Ministry of Health Mozambique",
             "HOUSEHOLD": "JHPIEGO CORPORATION", "MACHINERY": "SCIP Zambezia"}
PROXY_FACT_CORRECTIONS = [
    ({"orgunituid": "3", "mech_name": "FGH"}, {"orgunituid": "5", "sitename": "Corrected 5"}),
    ({"orgunituid": "5", "mech_name": "MISAU"}, {"orgunituid": "3", "psnu": "SWAPPED"}),
]


def _year(e, layout, years):
    """The extract's rows of ``years`` in the layout of a yearly file: renamed columns under
    their old names, and filler in the columns that the layout leaves out."""
    d = e.filter(years).withColumnsRenamed({new: old for old, new in layout["rename"].items()})
    return d.withColumns({c: F.lit("filler") for c in layout["drop"] if c not in d.columns})


def _extract_columns(e, *more):
    from indicata.functions.expressions import lookup
    return e.select(
        *more, "psnu", F.concat(F.lit("P-"), "psnu").alias("psnuuid"),
        lookup("mech_name", LONG_MECH).alias("mech_name"),
        F.when(F.col("indicator") == "TX_PVLS", F.lit("Index"))
         .when(F.col("indicator") == "TX_PVLS_D", F.lit("IndexMod")).alias("modality"),
        "fiscal_year", "cumulative")


def q_site_fact_union(spark, sf_dir):
    from pyspark.sql import types as T
    e = _extract_columns(proxy.canonical_extract(spark, sf_dir), "orgunituid", "sitename")
    canon = T.StructType.fromDDL(
        "orgunituid string, sitename string, psnu string, psnuuid string, mech_name string, "
        "modality string, fiscal_year int, cumulative double")
    fy, lay = F.col("fiscal_year"), R.SITE_LAYOUTS
    years = {"2021": _year(e, lay["2021"], fy <= 1997),
             "2022": _year(e, lay["2022"], fy.between(1998, 1999))
                     .withColumn("fiscal_year", fy.cast("string")),
             "2023": _year(e, lay["2023"], fy == 2000),
             "2024_2025": _year(e, lay["2024_2025"], fy >= 2001)}
    out = P.union_extracts(P.yearly_extracts(years, lay, canon),
                           corrections=PROXY_FACT_CORRECTIONS)
    return (out.groupBy("orgunituid", "sitename", "psnu", "psnuuid", "mech_name", "modality",
                        "fiscal_year")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("cumulative").alias("v")))


def _c1_sql() -> str:
    longm = _sql_lookup("mech_name", LONG_MECH)
    rec = ("CASE mech0 " + " ".join(f"WHEN '{k.replace(chr(39), chr(39) * 2)}' THEN '{v}'"
                                    for k, v in R.MECH_NAME_RECODE.items()) + " ELSE mech0 END")
    return f"""
, u0 AS (SELECT orgunituid, sitename, psnu, 'P-' || psnu AS psnuuid, {longm} AS mech0,
                CASE WHEN indicator = 'TX_PVLS' THEN 'Index'
                     WHEN indicator = 'TX_PVLS_D' THEN 'IndexMod' END AS modality0,
                fiscal_year, cumulative FROM ext3),
u1 AS (SELECT orgunituid, sitename, psnu, psnuuid, {rec} AS mech_name,
              CASE modality0 WHEN 'Index' THEN 'Index Facility' WHEN 'IndexMod' THEN 'Index Community'
                   ELSE modality0 END AS modality, fiscal_year, cumulative FROM u0),
u2 AS (SELECT * REPLACE (
         CASE WHEN orgunituid = '3' AND mech_name = 'FGH' THEN '5' ELSE orgunituid END AS orgunituid,
         CASE WHEN orgunituid = '3' AND mech_name = 'FGH' THEN 'Corrected 5' ELSE sitename END
           AS sitename) FROM u1),
u3 AS (SELECT * REPLACE (
         CASE WHEN orgunituid = '5' AND mech_name = 'MISAU' THEN '3' ELSE orgunituid END AS orgunituid,
         CASE WHEN orgunituid = '5' AND mech_name = 'MISAU' THEN 'SWAPPED' ELSE psnu END AS psnu)
       FROM u2)
SELECT orgunituid, sitename, psnu, psnuuid, mech_name, modality, fiscal_year, count(*) AS n,
       sum(cumulative) AS v
FROM u3 GROUP BY orgunituid, sitename, psnu, psnuuid, mech_name, modality, fiscal_year
"""


_register("site_fact_union", q_site_fact_union, _c1_sql())


# ---------------------------------------------------------------------------
# The district extracts of three layouts -> one fact
# ---------------------------------------------------------------------------


def q_psnu_fact_union(spark, sf_dir):
    from pyspark.sql import types as T
    districts = proxy.canonical_extract(spark, sf_dir).groupBy(
        "psnu", "mech_name", "indicator", "numeratordenom", "standardizeddisaggregate",
        "fiscal_year").agg(F.sum("cumulative").alias("cumulative"))
    e = _extract_columns(districts, "numeratordenom", "standardizeddisaggregate")
    canon = T.StructType.fromDDL(
        "psnu string, psnuuid string, mech_name string, modality string, numeratordenom string, "
        "standardizeddisaggregate string, fiscal_year int, cumulative double")
    fy, lay = F.col("fiscal_year"), R.PSNU_LAYOUTS
    years = {"2022": _year(e, lay["2022"], fy <= 1998),
             "2023": _year(e, lay["2023"], fy.between(1999, 2000)),
             "2024_2025": _year(e, lay["2024_2025"], fy >= 2001)}
    out = P.union_extracts(P.yearly_extracts(years, lay, canon))
    return (out.groupBy("psnu", "psnuuid", "mech_name", "modality", "numeratordenom", "fiscal_year")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("cumulative").alias("v")))


def _c2_sql() -> str:
    return f"""
, p0 AS (SELECT psnu, {_sql_lookup("mech_name", LONG_MECH)} AS mech0, indicator, numeratordenom,
                standardizeddisaggregate, fiscal_year, sum(cumulative) AS cumulative
         FROM ext3 GROUP BY psnu, mech_name, indicator, numeratordenom, standardizeddisaggregate,
                            fiscal_year)
SELECT psnu, 'P-' || psnu AS psnuuid, {_sql_recode("mech0", R.MECH_NAME_RECODE)} AS mech_name,
       CASE indicator WHEN 'TX_PVLS' THEN 'Index Facility' WHEN 'TX_PVLS_D' THEN 'Index Community'
       END AS modality, numeratordenom, fiscal_year, count(*) AS n, sum(cumulative) AS v
FROM p0 GROUP BY ALL
"""


_register("psnu_fact_union", q_psnu_fact_union, _c2_sql())


# ---------------------------------------------------------------------------
# Site scores with the bundled score rule set, on the results table
# ---------------------------------------------------------------------------

SCORE_PERIOD = "2000 Q4"


def q_site_scores_bundled(spark, sf_dir):
    from indicata.functions.columns import with_null_measures
    from indicata.functions.expressions import recode
    r = results_table_proxy(spark, sf_dir).withColumn(
        "mech_name", recode("mech_name", proxy.PROXY_MECH_PARTNER))
    sites = proxy.site_map(spark, sf_dir).select("datim_uid", "partner_pepfar_clinical")
    # the TPT completion rate per site is a series of its own; some sites have none
    tpt = proxy.site_map(spark, sf_dir).select(
        F.col("datim_uid").alias("orgunituid"),
        F.when(F.col("latitude") >= 0, F.col("latitude") / 10000).alias("TPT_CUM_PER"))
    # indicators that the proxy extract does not have are declared as null measures
    return P.site_scores(with_null_measures(r, R.SCORE_INDICATORS), sites, SCORE_PERIOD,
                         extra=P.tpt_scores(tpt))


def _c8_sql() -> str:
    from indicata.plans.catalog_scores import _sql_score_cte
    present = [c for c in R.SCORE_INDICATORS if c in proxy.PROXY_NAMES]
    mech = ("CASE mech_name " + " ".join(f"WHEN '{k}' THEN '{v}'"
                                         for k, v in proxy.PROXY_MECH_PARTNER.items())
            + " ELSE mech_name END")
    parts = " UNION ALL ".join(
        f"SELECT datim_uid, period, date, agecoarse, {mech} AS mech, '{c}' AS indicator, "
        f"{c} AS value FROM rt WHERE period_type = 'results'" for c in present)
    names = [s["name"] for s in R.SITE_SCORES]
    sub = [f"score_{n}" for n in [*names, "tpt"] if any(p in f"score_{n}" for p in R.SCORE_WO_VOLUME_PATTERNS)]
    ctes = ",\n".join(_sql_score_cte(s) for s in R.SITE_SCORES)
    joins = "\n".join(f"LEFT JOIN s_{n} ON st.site_uid = s_{n}.site_uid" for n in names)
    values = ", ".join(f"s_{n}.value_{n}" for n in names)
    bands = ", ".join(f"{_sql_band(f's_{n}.value_{n}', s['bands'])} AS score_{n}"
                      for n, s in zip(names, R.SITE_SCORES))
    return f"""
, base AS (
  SELECT datim_uid AS site_uid, indicator, value, period, date, agecoarse
  FROM ({parts}) x
  WHERE value IS NOT NULL AND mech IN ({_sql_in(R.SCORE_PARTNERS)})),
mx AS (SELECT max(date) AS d FROM base WHERE period = '{SCORE_PERIOD}'),
wmx AS (SELECT max(date) AS d FROM base),
{ctes},
st AS (SELECT datim_uid AS site_uid FROM smap WHERE partner_pepfar_clinical <> 'MISAU'),
tp AS (SELECT CAST(site_uid AS VARCHAR) AS site_uid, acctbal / 10000 AS value_tpt
       FROM site_dim WHERE acctbal >= 0),
j AS (SELECT st.site_uid AS datim_uid, {values}, {bands}, tp.value_tpt,
             {_sql_band('tp.value_tpt', R.BANDS_TPT)} AS score_tpt
      FROM st
{joins}
LEFT JOIN tp ON st.site_uid = tp.site_uid)
SELECT *, {' + '.join(f'score_{n}' for n in [*names, 'tpt'])} AS score_clin,
       {' + '.join(sub) if sub else '0'} AS score_clin_wo_volume,
       '{SCORE_PERIOD}' AS period
FROM j
"""


_register("site_scores_bundled", q_site_scores_bundled, _c8_sql())


# ---------------------------------------------------------------------------
# Transfer-in submission history in long form with harmonised labels
# ---------------------------------------------------------------------------

TRN_AGE = {"AUTOMOBILE": "05-09", "BUILDING": "Unknown", "FURNITURE": "25-29",
           "HOUSEHOLD": "10-14", "MACHINERY": "65+"}
TRN_REMOVED = ["7"]
TRN_KEYS = ["indicator", "funding_agency", "agecoarse", "ageasentered", "sex", "partner_recode"]


def _trn_history(spark, sf_dir):
    from indicata.functions.expressions import lookup, recode
    f = proxy.fact(spark, sf_dir)
    ind = F.col("indicator")
    return f.groupBy(
        F.when(F.col("standardizeddisaggregate").isNotNull(), F.col("site_uid").cast("string"))
         .alias("datim_uid"),
        F.col("snu1").alias("snu"), "psnu", "sitename", "period",
        recode("mech_name", proxy.PROXY_MECH_PARTNER).alias("partner"),
        F.when(F.col("numeratordenom") == "D", F.lit("Unknown")).otherwise(F.lit("Male"))
         .alias("sex"),
        lookup("mech_name", TRN_AGE).alias("ageasentered")).agg(
        F.sum(F.when(ind == "TX_PVLS", F.col("value"))).alias("TX_RTT"),
        F.sum(F.when(ind == "TX_CURR", F.col("value"))).alias("TX_NEW"))


def q_transfer_in(spark, sf_dir):
    out = P.transfer_in(_trn_history(spark, sf_dir), site_removal=TRN_REMOVED)
    return out.groupBy(*TRN_KEYS).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("v"))


def _trn_ctes() -> str:
    mech = ("CASE mech_name " + " ".join(f"WHEN '{k}' THEN '{v}'"
                                         for k, v in proxy.PROXY_MECH_PARTNER.items())
            + " ELSE mech_name END")
    return f"""
, h AS (
  SELECT CASE WHEN standardizeddisaggregate IS NOT NULL THEN CAST(site_uid AS VARCHAR) END
           AS datim_uid,
         snu1 AS snu, psnu, sitename, period, {mech} AS partner,
         CASE WHEN numeratordenom = 'D' THEN 'Unknown' ELSE 'Male' END AS sex,
         {_sql_lookup('mech_name', TRN_AGE)} AS ageasentered,
         sum(CASE WHEN indicator = 'TX_PVLS' THEN value END) AS TX_RTT,
         sum(CASE WHEN indicator = 'TX_CURR' THEN value END) AS TX_NEW
  FROM dated GROUP BY ALL),
l AS (SELECT *, 'TX_RTT' AS indicator, TX_RTT AS value FROM h
      UNION ALL SELECT *, 'TX_NEW' AS indicator, TX_NEW AS value FROM h),
t AS (
  SELECT datim_uid, period, CASE WHEN indicator = 'TX_RTT' THEN 'TX_RTT_SUP' ELSE indicator END AS indicator,
         CASE WHEN partner = 'ECHO' THEN 'USAID' WHEN partner = 'JHPIEGO-DoD' THEN 'DOD'
              ELSE 'HHS/CDC' END AS funding_agency,
         CASE WHEN ageasentered IN ({_sql_in(R.AGES_UNDER_15)}) THEN '<15'
              WHEN ageasentered = 'Unknown' THEN 'Unknown Age' ELSE '15+' END AS agecoarse,
         CASE WHEN ageasentered = 'Unknown' THEN 'Unknown Age' ELSE ageasentered END
           AS ageasentered,
         CASE WHEN sex = 'Unknown' THEN 'Unknown Sex' ELSE sex END AS sex,
         partner AS partner_recode, value
  FROM l
  WHERE value IS NOT NULL AND datim_uid IS NOT NULL
    AND NOT coalesce(datim_uid IN ({_sql_in(TRN_REMOVED)}), false))
"""


MILITARY_PROXY = ("3", "_Military")


def full_site_map(spark, sf_dir):
    """The site map with every attribute of the final tables."""
    uid, lat = F.col("datim_uid"), F.col("latitude")
    flag = {"his_emr": lat <= 0, "his_idart": lat > 2000, "his_disa": lat > 8000}
    return proxy.site_map(spark, sf_dir).select(
        "datim_uid", F.concat(F.lit("S"), uid).alias("sisma_uid"),
        (uid.cast("long") % 100).alias("site_nid"), (lat > 0).alias("grm_sernap"), "latitude",
        "partner_pepfar_clinical", "his_epts",
        *[F.when(c, F.lit(1.0)).alias(n) for n, c in flag.items()])


def _places(spark, sf_dir):
    return proxy.sites(spark, sf_dir).select(F.col("site_uid").cast("string").alias("datim_uid"),
                                             "snu1", "psnu", "sitename")


def _placed_site_map(spark, sf_dir):
    """The site map with places and the security flag, as a table of its own.

    Read from files, its size is known before the job: a history takes a small one by a broadcast,
    unshuffled.  With a large one each side of the join is one plain shuffle, so that AQE can deal
    out the many rows without a site uid; joins left in the map's plan would keep them in one task.
    """
    from indicata.session import materialize
    return materialize(full_site_map(spark, sf_dir).withColumn(
        "security_insecure", F.col("latitude") < 0).join(
        _places(spark, sf_dir).withColumnRenamed("snu1", "snu"), "datim_uid"))


def q_waterfall_final(spark, sf_dir):
    wf = P.waterfall(results_table_proxy(spark, sf_dir), start=WATERFALL_START,
                     plus_periods=WATERFALL_PLUS)
    trn = P.transfer_in(_trn_history(spark, sf_dir), site_removal=TRN_REMOVED)
    out = P.waterfall_final(wf, trn, _places(spark, sf_dir), full_site_map(spark, sf_dir),
                            site_removal=TRN_REMOVED, military=MILITARY_PROXY)
    return out.groupBy("indicator", "period", "ageasentered", "snu1", "his_epts").agg(
        F.count(F.lit(1)).alias("n"), F.sum("value").alias("v"))


_register("waterfall_final", q_waterfall_final, _wf_ctes() + _trn_ctes() + f"""
, u AS (SELECT datim_uid, period, indicator, ageasentered, value FROM g
        WHERE value IS NOT NULL AND NOT coalesce(datim_uid IN ({_sql_in(TRN_REMOVED)}), false)
        UNION ALL SELECT datim_uid, period, indicator, ageasentered, value FROM t),
uf AS (
  SELECT u.*, CASE WHEN u.datim_uid = '{MILITARY_PROXY[0]}' THEN '{MILITARY_PROXY[1]}'
                   ELSE s.snu1 END AS snu1,
         CASE WHEN s.acctbal > 5000 THEN CAST(1 AS DOUBLE) END AS his_epts
  FROM u LEFT JOIN site_dim s ON u.datim_uid = CAST(s.site_uid AS VARCHAR))
SELECT indicator, period, ageasentered, snu1, his_epts, count(*) AS n, sum(value) AS v
FROM uf GROUP BY indicator, period, ageasentered, snu1, his_epts
""")


QUERIES["transfer_in"] = q_transfer_in
ORACLE["transfer_in"] = ORACLE_CTE + _trn_ctes() + f"""
SELECT {', '.join(TRN_KEYS)}, count(*) AS n, sum(value) AS v FROM t GROUP BY {', '.join(TRN_KEYS)}
"""


# ---------------------------------------------------------------------------
# C14: key-population submissions summed per quarter, attributes refreshed
# ---------------------------------------------------------------------------

KEYPOP = {"AUTOMOBILE": "MSM", "BUILDING": "FSW", "FURNITURE": "PWID", "HOUSEHOLD": "TG",
          "MACHINERY": "PRI"}


def _kp_rows(spark, sf_dir):
    from indicata.functions.expressions import lookup
    f = proxy.fact(spark, sf_dir)
    ind = F.col("indicator")
    return f.select(
        F.when(F.col("standardizeddisaggregate").isNotNull(), F.col("site_uid").cast("string"))
         .alias("datim_uid"),
        F.col("snu1").alias("snu"), "psnu", "sitename", "period",
        F.lit("KeyPop").alias("pop_type"), lookup("mech_name", KEYPOP).alias("keypop"),
        lookup("mech_name", TRN_AGE).alias("age"),
        F.when(ind == "TX_CURR", F.col("value")).alias("TX_CURR"),
        F.when(ind == "TX_PVLS", F.col("value")).alias("TX_PVLS"))


def q_kp_history(spark, sf_dir):
    summed, _uncoded = P.kp_quarter(_kp_rows(spark, sf_dir))
    site_map = proxy.sites(spark, sf_dir).select(
        F.col("site_uid").cast("string").alias("datim_uid"), F.col("snu1").alias("snu"),
        "psnu", "sitename")
    hist = P.refreshed_history(summed, site_map)
    return hist.groupBy("snu", "period", "keypop").agg(
        F.count(F.lit(1)).alias("n"), F.sum("TX_CURR").alias("TX_CURR"),
        F.sum("TX_PVLS").alias("TX_PVLS"))


def _kp_sql() -> str:
    return f"""
, sub AS (
  SELECT CASE WHEN standardizeddisaggregate IS NOT NULL THEN CAST(site_uid AS VARCHAR) END
           AS datim_uid,
         snu1 AS snu, psnu, sitename, period, 'KeyPop' AS pop_type,
         {_sql_lookup('mech_name', KEYPOP)} AS keypop, {_sql_lookup('mech_name', TRN_AGE)} AS age,
         CASE WHEN indicator = 'TX_CURR' THEN value END AS TX_CURR,
         CASE WHEN indicator = 'TX_PVLS' THEN value END AS TX_PVLS
  FROM dated),
summed AS (
  SELECT datim_uid, snu, psnu, sitename, period, pop_type, keypop, age,
         coalesce(sum(TX_CURR), 0) AS TX_CURR, coalesce(sum(TX_PVLS), 0) AS TX_PVLS
  FROM sub GROUP BY datim_uid, snu, psnu, sitename, period, pop_type, keypop, age),
sm AS (SELECT CAST(site_uid AS VARCHAR) AS datim_uid, snu1 AS snu, psnu, sitename FROM site_dim),
hist AS (SELECT s.period, s.keypop, s.TX_CURR, s.TX_PVLS, sm.snu
         FROM summed s LEFT JOIN sm ON s.datim_uid = sm.datim_uid)
SELECT snu, period, keypop, count(*) AS n, sum(TX_CURR) AS TX_CURR, sum(TX_PVLS) AS TX_PVLS
FROM hist GROUP BY snu, period, keypop
"""


QUERIES["kp_history"] = q_kp_history
ORACLE["kp_history"] = ORACLE_CTE + _kp_sql()

KP_SUBMISSION = ("datim_uid string, snu string, psnu string, sitename string, period string, "
                 "pop_type string, keypop string, age string, TX_CURR double, TX_PVLS double")
KP_AGAIN = "2000 Q4"


def q_kp_submissions(spark, sf_dir):
    """C14 from the submission folder to the history; one quarter is handed in twice."""
    from pyspark.sql import types as T

    from indicata.operators.union import Contract
    from indicata.session import scratch_path
    from indicata.sources.files import read_folder, write_tsv
    folder, table = scratch_path(spark, "kp-submissions"), scratch_path(spark, "kp-history")
    write_tsv(_kp_rows(spark, sf_dir), folder, na="NA")
    sub = read_folder(spark, f"{folder}/*.csv", Contract(T.StructType.fromDDL(KP_SUBMISSION)))
    site_map = _placed_site_map(spark, sf_dir).drop("security_insecure")
    P.kp_report(sub, table, site_map, schema=KP_SUBMISSION)
    hist, _uncoded = P.kp_report(sub.filter(F.col("period") == KP_AGAIN), table, site_map,
                                 schema=KP_SUBMISSION)
    return hist.groupBy("snu", "period", "keypop").agg(
        F.count(F.lit(1)).alias("n"), F.sum("TX_CURR").alias("TX_CURR"),
        F.sum("TX_PVLS").alias("TX_PVLS"))


QUERIES["kp_submissions"] = q_kp_submissions
ORACLE["kp_submissions"] = ORACLE_CTE + _kp_sql()


# ---------------------------------------------------------------------------
# MI series, long form since a start date, enriched from site and district maps
# ---------------------------------------------------------------------------

MI_START = "2000-01-01"


def q_mi_extract(spark, sf_dir):
    from indicata.functions.expressions import lookup
    f = proxy.fact(spark, sf_dir)
    ind = F.col("indicator")
    mi = f.groupBy(F.col("site_uid").cast("string").alias("datim_uid"),
                   F.col("ship_date").cast("string").alias("period"), "psnu",
                   lookup("mech_name", TRN_AGE).alias("age"),
                   F.col("numeratordenom").alias("numdenom")).agg(
        F.sum(F.when(ind == "TX_CURR", F.col("value"))).alias("cv_tx"),
        F.sum(F.when(ind == "TX_PVLS", F.col("value"))).alias("cv_pvls"))
    s = proxy.sites(spark, sf_dir)
    site_map = s.select(F.col("site_uid").cast("string").alias("datim_uid"),
                        F.concat(F.lit("S"), F.col("site_uid").cast("string")).alias("sisma_uid"))
    psnu_map = proxy.table(spark, sf_dir, "nation").select(
        F.col("n_name").alias("psnu"), F.col("n_nationkey").cast("string").alias("psnuuid"))
    out = P.mi_extract(mi, site_map, psnu_map, start=MI_START)
    return out.groupBy("indicator", "ageasentered", "psnuuid", "source",
                       F.year("period").cast("int").alias("yr")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("value").alias("v"),
        F.count("sisma_uid").alias("n_sisma"))


def _mi_sql() -> str:
    parts = " UNION ALL ".join(
        f"SELECT datim_uid, CAST(period AS DATE) AS period, psnu, age AS ageasentered, "
        f"'{c}' AS indicator, {c} AS value FROM mi" for c in ("cv_tx", "cv_pvls"))
    return f"""
, mi AS (
  SELECT CAST(site_uid AS VARCHAR) AS datim_uid, CAST(ship_date AS VARCHAR) AS period, psnu,
         {_sql_lookup('mech_name', TRN_AGE)} AS age, numeratordenom AS numdenom,
         sum(CASE WHEN indicator = 'TX_CURR' THEN value END) AS cv_tx,
         sum(CASE WHEN indicator = 'TX_PVLS' THEN value END) AS cv_pvls
  FROM dated GROUP BY ALL),
ml AS ({parts}),
mf AS (SELECT * FROM ml WHERE value IS NOT NULL AND period >= DATE '{MI_START}'),
smi AS (SELECT CAST(site_uid AS VARCHAR) AS datim_uid,
               'S' || CAST(site_uid AS VARCHAR) AS sisma_uid FROM site_dim),
pm AS (SELECT n_name AS psnu, CAST(n_nationkey AS VARCHAR) AS psnuuid FROM nation)
SELECT mf.indicator, mf.ageasentered, pm.psnuuid, '{R.VL_SOURCE_MI}' AS source,
       CAST(year(mf.period) AS INTEGER) AS yr, count(*) AS n, sum(mf.value) AS v,
       count(smi.sisma_uid) AS n_sisma
FROM mf LEFT JOIN smi ON mf.datim_uid = smi.datim_uid LEFT JOIN pm ON mf.psnu = pm.psnu
GROUP BY mf.indicator, mf.ageasentered, pm.psnuuid, CAST(year(mf.period) AS INTEGER)
"""


QUERIES["mi_extract"] = q_mi_extract
ORACLE["mi_extract"] = ORACLE_CTE + _mi_sql()


# ---------------------------------------------------------------------------
# Viral-load submissions of a quarter; QA of sites missing from the site map
# ---------------------------------------------------------------------------


def q_vl_orphans(spark, sf_dir):
    f = proxy.fact(spark, sf_dir, periods=[SCORE_PERIOD])
    sub = f.select(F.col("site_uid").cast("string").alias("datim_uid"),
                   F.col("snu1").alias("snu"), "psnu", "sitename", "indicator", "value")
    site_map = proxy.sites(spark, sf_dir).filter(F.col("acctbal") >= 0).select(
        F.col("site_uid").cast("string").alias("datim_uid"))
    _rows, orphan_sites = P.vl_quarter(sub, site_map)
    return orphan_sites


_VL_ORPHANS_SQL = f"""
SELECT DISTINCT CAST(site_uid AS VARCHAR) AS datim_uid, snu1 AS snu, psnu, sitename
FROM dated
WHERE period = '{SCORE_PERIOD}'
  AND CAST(site_uid AS VARCHAR) NOT IN (SELECT CAST(site_uid AS VARCHAR) FROM site_dim
                                        WHERE acctbal >= 0)
"""

QUERIES["vl_orphans"] = q_vl_orphans
ORACLE["vl_orphans"] = ORACLE_CTE + _VL_ORPHANS_SQL


VL_SUBMISSION = ("datim_uid string, snu string, psnu string, sitename string, period string, "
                 "sex string, age string, pop_type string, pop_subtype string, keypop string, "
                 "motive string, source string, indicator string, value double")


def _vl_rows(spark, sf_dir):
    from indicata.functions.expressions import lookup
    key = F.col("mech_name") == "FURNITURE"
    return proxy.fact(spark, sf_dir).select(
        F.when(F.col("standardizeddisaggregate").isNotNull(), F.col("site_uid").cast("string"))
         .alias("datim_uid"),
        F.col("snu1").alias("snu"), "psnu", "sitename", "period",
        F.when(F.col("numeratordenom") == "D", F.lit("F")).otherwise(F.lit("M")).alias("sex"),
        lookup("mech_name", SUP_AGE).alias("age"),
        F.when(key, F.lit("KeyPop")).otherwise(F.lit("Age")).alias("pop_type"),
        lookup("standardizeddisaggregate", SUP_SUBTYPE).alias("pop_subtype"),
        F.when(key, lookup("mech_name", KEYPOP)).alias("keypop"), F.lit("Routine").alias("motive"),
        lookup("mech_name", SUP_SOURCE).alias("source"), "indicator", "value")


def q_vl_submissions(spark, sf_dir):
    """C16 from the submission folder to the history; one quarter is handed in twice."""
    from pyspark.sql import types as T

    from indicata.operators.union import Contract
    from indicata.session import scratch_path
    from indicata.sources.files import read_folder, write_tsv
    folder, table = scratch_path(spark, "vl-submissions"), scratch_path(spark, "vl-history")
    write_tsv(_vl_rows(spark, sf_dir), folder, na="NA")
    sub = read_folder(spark, f"{folder}/*.csv", Contract(T.StructType.fromDDL(VL_SUBMISSION)))
    site_map = _placed_site_map(spark, sf_dir)
    P.vl_report(sub, table, site_map, schema=VL_SUBMISSION)
    hist, _orphans = P.vl_report(sub.filter(F.col("period") == KP_AGAIN), table, site_map,
                                 schema=VL_SUBMISSION)
    return hist.groupBy("snu", "period", "source", "age", "pop_subtype", "indicator",
                        "security_insecure").agg(
        F.count(F.lit(1)).alias("n"), F.sum("value").alias("v"))


QUERIES["vl_submissions"] = q_vl_submissions
ORACLE["vl_submissions"] = ORACLE_CTE + f"""
, s AS (
  SELECT CASE WHEN standardizeddisaggregate IS NOT NULL THEN site_uid END AS site_uid, period,
         {_sql_lookup('mech_name', SUP_SOURCE)} AS source,
         {_sql_lookup('mech_name', SUP_AGE)} AS age,
         {_sql_lookup('standardizeddisaggregate', SUP_SUBTYPE)} AS pop_subtype, indicator, value
  FROM dated)
SELECT d.snu1 AS snu, s.period, s.source, s.age, s.pop_subtype, s.indicator,
       d.acctbal < 0 AS security_insecure, count(*) AS n, sum(s.value) AS v
FROM s LEFT JOIN site_dim d ON s.site_uid = d.site_uid
GROUP BY ALL
"""


# ---------------------------------------------------------------------------
# Targets table through the report function (cumulative and targets per row)
# ---------------------------------------------------------------------------


def q_targets_report(spark, sf_dir):
    from indicata.plans.catalog_reshape import PROXY_LONG_DERIVED
    dg = proxy.canonical_extract(spark, sf_dir)
    m = spark.createDataFrame(proxy.PROXY_DEDUP, "indicator string, standardizeddisaggregate "
                                                 "string, indicator_new string")
    t = P.targets_table(dg, m, long_rules=PROXY_LONG_DERIVED)
    return t.groupBy("indicator", "fiscal_year", "period").agg(
        F.count(F.lit(1)).alias("n"), F.sum("cumulative").alias("cumulative"),
        F.sum("targets").alias("targets"))


_TARGETS_SQL = """
, tmap AS (SELECT e.* EXCLUDE (indicator), m.indicator_new AS indicator
           FROM {extract} e JOIN dmap m ON e.indicator IS NOT DISTINCT FROM m.indicator
            AND e.standardizeddisaggregate IS NOT DISTINCT FROM m.standardizeddisaggregate
           WHERE m.indicator_new IS NOT NULL),
tl AS (SELECT indicator, numeratordenom, standardizeddisaggregate, fiscal_year,
              'cumulative' AS period_type, cumulative AS value FROM tmap
       UNION ALL SELECT indicator, numeratordenom, standardizeddisaggregate, fiscal_year,
              'targets' AS period_type, targets AS value FROM tmap),
tl2 AS (SELECT *, indicator || CASE WHEN numeratordenom = 'D' THEN '_D' ELSE '' END AS indicator_temp
        FROM tl WHERE value IS NOT NULL),
tc AS (
  SELECT indicator_temp AS ind, fiscal_year, period_type, value FROM tl2
  UNION ALL SELECT CASE WHEN indicator_temp = 'TX_CURR' THEN 'TX_CURR_URGENT' ELSE indicator_temp END,
         fiscal_year, period_type, value FROM tl2
         WHERE indicator = 'TX_CURR' AND standardizeddisaggregate = '1-URGENT'
  UNION ALL SELECT 'TX_CURR_D_HIGH', fiscal_year, period_type, value FROM tl2
         WHERE indicator_temp = 'TX_CURR_D' AND standardizeddisaggregate = '2-HIGH'
  UNION ALL SELECT 'TX_PVLS_NODIS', fiscal_year, period_type, value FROM tl2
         WHERE indicator_temp = 'TX_PVLS' AND standardizeddisaggregate IS NULL),
tw AS (SELECT ind AS indicator, fiscal_year,
              CASE WHEN period_type = 'cumulative' THEN value END AS cumulative,
              CASE WHEN period_type = 'targets' THEN value END AS targets FROM tc)
SELECT indicator, fiscal_year, 'FY' || lpad(CAST(fiscal_year % 100 AS VARCHAR), 2, '0') AS period,
       count(*) AS n, sum(cumulative) AS cumulative, sum(targets) AS targets
FROM tw WHERE indicator IN (SELECT indicator FROM tw WHERE targets IS NOT NULL)
GROUP BY indicator, fiscal_year
"""

_register("targets_report", q_targets_report, _TARGETS_SQL)
