"""Site score queries.

The Spark side computes every score in one aggregation
(``operators.scoring.score_sites``); the DuckDB oracle is written the way
the reference computes them — one filtered aggregation per score, joined to
the site list — so the check also proves the two formulations equal.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from indicata.functions.expressions import is_in, lookup, recode
from indicata.operators.joins import enrich
from indicata.operators.scoring import composite, score_sites
from indicata.plans import proxy
from indicata.plans import reports as P
from indicata.plans import rules as R
from indicata.plans.registry import (PERIOD, PROXY_PARTNER, _sql_band, _sql_in, _sql_lookup,
                                     _sql_ratio, _sql_recode, pick, register)
from indicata.session import materialize, scratch_path
from indicata.sources.files import upsert_period

# Proxy age split: the two highest priorities stand for the "<15" band.
PED_PRIORITIES = ["1-URGENT", "2-HIGH"]

# Every indicator that the scores read, dealt to the lines of the proxy fact.
_INDICATOR, _INDICATOR_SQL = pick(R.SCORE_INDICATORS, 5, 3)


def score_base(spark, sf_dir):
    """Long scoring base: results rows of scored partners, null values removed."""
    f = proxy.fact(spark, sf_dir)
    partner = recode("mech_name", PROXY_PARTNER)
    return (f.filter(is_in(partner, R.SCORE_PARTNERS) & F.col("value").isNotNull())
             .select("site_uid", F.expr(_INDICATOR).alias("indicator"), "value", "period", "date",
                     F.when(is_in("standardizeddisaggregate", PED_PRIORITIES), F.lit("<15"))
                      .otherwise(F.lit("15+")).alias("agecoarse")))


def scored_sites(spark, sf_dir):
    """Site list: sites whose clinical partner is known and not the ministry."""
    s = proxy.sites(spark, sf_dir)
    partner = lookup("snu1", proxy.PROXY_SITE_PARTNER)
    return s.filter(partner != "MISAU").select("site_uid")


@register("site_scores", None)
def site_scores(spark, sf_dir):
    base = score_base(spark, sf_dir)
    scores = score_sites(base, site="site_uid", period=PERIOD, scores=R.SITE_SCORES,
                         window_months=R.SCORE_WINDOW_MONTHS)
    out = enrich(scored_sites(spark, sf_dir), scores, "site_uid")
    out = composite(out, subset_patterns=R.SCORE_WO_VOLUME_PATTERNS)
    return out.withColumn("period", F.lit(PERIOD))


def _sql_score_cte(s, period: str = PERIOD) -> str:
    name, num = s["name"], s["num"]
    rows = {"period": f"period = '{period}'",
            "window": "date BETWEEN (SELECT d FROM wmx) - INTERVAL 9 MONTH AND (SELECT d FROM wmx)",
            "txtb": ("date = (SELECT d FROM mx)" if period.endswith(("Q2", "Q4"))
                     else "date = (SELECT d FROM mx) - INTERVAL 3 MONTH")}[s["rows"]]
    if s.get("ped"):
        rows += " AND agecoarse = '<15'"
    if s["kind"] == "sum":
        return (f"s_{name} AS (SELECT site_uid, sum(value) AS value_{name} FROM base "
                f"WHERE indicator = '{num}' AND {rows} GROUP BY site_uid)")
    den = s["den"]
    if s.get("fill0", True):
        n = f"coalesce(sum(CASE WHEN indicator = '{num}' THEN value END), 0)"
        d = f"coalesce(sum(CASE WHEN indicator = '{den}' THEN value END), 0)"
    else:
        n = f"sum(CASE WHEN indicator = '{num}' THEN value END)"
        if s.get("num_fill0"):
            n = f"coalesce({n}, 0)"
        d = f"sum(CASE WHEN indicator = '{den}' THEN value END)"
    return (f"s_{name} AS (SELECT site_uid, {_sql_ratio(n, d)} AS value_{name} FROM base "
            f"WHERE indicator IN ('{num}', '{den}') AND {rows} GROUP BY site_uid)")


def _site_scores_sql(period: str = PERIOD) -> str:
    names = [s["name"] for s in R.SITE_SCORES]
    sub = [f"score_{n}" for n in names
           if any(p in f"score_{n}" for p in R.SCORE_WO_VOLUME_PATTERNS)]
    ctes = ",\n".join(_sql_score_cte(s, period) for s in R.SITE_SCORES)
    joins = "\n".join(f"LEFT JOIN s_{n} ON st.site_uid = s_{n}.site_uid" for n in names)
    values = ", ".join(f"s_{n}.value_{n}" for n in names)
    bands = ", ".join(f"{_sql_band(f's_{n}.value_{n}', s['bands'])} AS score_{n}"
                      for n, s in zip(names, R.SITE_SCORES))
    site_partner = _sql_lookup("snu1", proxy.PROXY_SITE_PARTNER)
    return f"""
, base AS (
  SELECT site_uid, {_INDICATOR_SQL} AS indicator, value, period, date,
         CASE WHEN standardizeddisaggregate IN ({_sql_in(PED_PRIORITIES)}) THEN '<15' ELSE '15+' END
           AS agecoarse
  FROM dated
  WHERE {_sql_recode('mech_name', PROXY_PARTNER)} IN ({_sql_in(R.SCORE_PARTNERS)})
    AND value IS NOT NULL),
mx AS (SELECT max(date) AS d FROM base WHERE period = '{period}'),
wmx AS (SELECT max(date) AS d FROM base),
{ctes},
st AS (SELECT site_uid FROM site_dim WHERE {site_partner} <> 'MISAU'),
j AS (SELECT st.site_uid, {values}, {bands} FROM st
{joins})
SELECT *, {' + '.join(f'score_{n}' for n in names)} AS score_clin,
       {' + '.join(sub) if sub else '0'} AS score_clin_wo_volume,
       '{period}' AS period
FROM j
"""


from indicata.plans.proxy import ORACLE_CTE  # noqa: E402
from indicata.plans.registry import ORACLE  # noqa: E402

ORACLE["site_scores"] = ORACLE_CTE + _site_scores_sql()


# ---------------------------------------------------------------------------
# Scores of several quarters, kept as a history and shown with the sites' names
# ---------------------------------------------------------------------------

HISTORY_PERIODS = ["2000 Q3", PERIOD]


@register("score_history", None)
def score_history(spark, sf_dir):
    base = materialize(score_base(spark, sf_dir))     # every quarter's scores read it
    table = scratch_path(spark, "score-history")
    for period in HISTORY_PERIODS:
        scores = score_sites(base, site="site_uid", period=period, scores=R.SITE_SCORES,
                             window_months=R.SCORE_WINDOW_MONTHS)
        out = composite(enrich(scored_sites(spark, sf_dir), scores, "site_uid"),
                        subset_patterns=R.SCORE_WO_VOLUME_PATTERNS)
        history = upsert_period(
            out.withColumn("datim_uid", F.col("site_uid").cast("string")).drop("site_uid")
               .withColumn("period", F.lit(period)), table)
    sites = proxy.sites(spark, sf_dir).select(F.col("site_uid").cast("string").alias("datim_uid"),
                                              F.col("snu1").alias("snu"), "psnu", "sitename")
    return P.score_history(history, sites)


def _score_history_sql() -> str:
    parts = [f"h{i} AS (WITH {_site_scores_sql(p).strip()[1:]})"
             for i, p in enumerate(HISTORY_PERIODS)]
    every = " UNION ALL ".join(f"SELECT * FROM h{i}" for i in range(len(parts)))
    scores = ", ".join(f"h.score_{s['name']}" for s in R.SITE_SCORES)
    return ", " + ",\n".join(parts) + f"""
SELECT d.snu1 AS snu, d.psnu, d.sitename, CAST(h.site_uid AS VARCHAR) AS datim_uid, h.period,
       {scores}, h.score_clin, h.score_clin_wo_volume
FROM ({every}) h LEFT JOIN site_dim d ON h.site_uid = d.site_uid
"""


ORACLE["score_history"] = ORACLE_CTE + _score_history_sql()
