"""The results table (C3) with every derived indicator at work.

The canonical extract holds three indicators and few labels, so most derived
columns of ``results_table`` are constant.  Here its rows are dealt the measures
and labels that the rules read, before the whole chain (map, attribute,
reshape, exclude, shift, bound, cohort, spread, volume, derive, enrich) runs.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from indicata.functions.domain import age_coarse
from indicata.plans import catalog_reports as C
from indicata.plans import proxy
from indicata.plans import reports as P
from indicata.plans import rules as R
from indicata.plans.catalog_rules import (DERIVED_OUT, DERIVED_SOURCES, DERIVED_WHEN,
                                          sql_derived_steps)
from indicata.plans.registry import ORACLE, ORACLE_CTE, QUERIES, _sql_in, _sql_value, label_pool

LABELS = ["modality", "statushiv", "statustb"]
KEYS = ["period_type", "period", "site_volume"]


def _measures() -> tuple[list[str], list[str]]:
    """Indicators to deal, and every name the chain makes of them."""
    shifts = [(src, label) for _, m in R.COHORT_SHIFTS for src, label in m.items()]
    made = dict((label, src) for src, label in shifts)
    dealt = list(dict.fromkeys(made.get(s, s).removesuffix("_D") for s in DERIVED_SOURCES))
    named = [n + d for n in dealt for d in ("", "_D")]
    named += [label for src, label in shifts if src in named]
    return dealt, [*named, R.PMTCT_ART_COHORT["label"]]


DEALT_INDICATORS, NAMES = _measures()
# Column, its values, and the factors of the year's sum, the site and the year that choose one.
DEALT = [("indicator", DEALT_INDICATORS, (1, 1, 0)),
         ("otherdisaggregate", [*R.OTHERDISAGGREGATE_RECODE,
                                *label_pool(DERIVED_WHEN, "otherdisaggregate")], (1, 3, 1)),
         ("sex", label_pool(DERIVED_WHEN, "sex"), (1, 1, 1)),
         ("ageasentered", [*label_pool(DERIVED_WHEN, "ageasentered"), "25-29"], (1, 2, 1)),
         *[(c, label_pool(DERIVED_WHEN, c), (1, 1 + i, 2)) for i, c in enumerate(LABELS)]]
#: Some rules change in fiscal year 2024.
YEARS_LATER = 24
WHOLE = [*proxy.PROXY_OTHERDISAGG, None]
SAME = [(i, d, i) for i in DEALT_INDICATORS for d in WHOLE]


def _at(values, factors) -> str:
    total, site, year = factors
    return (f"CAST((CAST(cumulative AS BIGINT) * {total} + CAST(orgunituid AS INT) * {site} "
            f"+ fiscal_year * {year}) % {len(values)} AS INT) + 1")


def dealt_extract(spark, sf_dir):
    e = proxy.canonical_extract(spark, sf_dir)
    e = e.withColumns({
        c: F.expr(f"element_at(array({', '.join(map(_sql_value, v))}), {_at(v, f)})")
        for c, v, f in DEALT} | {"fiscal_year": F.col("fiscal_year") + YEARS_LATER})
    return e.withColumn("trendscoarse", age_coarse("ageasentered"))


def same_names(spark):
    return spark.createDataFrame(SAME, "indicator string, standardizeddisaggregate string, "
                                       "indicator_new string")


def q_results_derived(spark, sf_dir):
    rt = P.results_table(dealt_extract(spark, sf_dir), same_names(spark),
                         proxy.site_map(spark, sf_dir), NAMES)
    return C._nsum(rt, KEYS, DERIVED_OUT)


def _sql() -> str:
    # the fiscal year is dealt last: the choices read the year of the extract
    new = {c: f"([{', '.join(map(_sql_value, v))}])[{_at(v, f)}]" for c, v, f in DEALT}
    old = ["indicator", "otherdisaggregate", "sex", "ageasentered"]
    replaced = ", ".join([*[f"{new[c]} AS {c}" for c in old],
                          f"fiscal_year + {YEARS_LATER} AS fiscal_year"])
    dealt = f"""
ext4 AS (SELECT * REPLACE ({replaced}), {', '.join(f'{new[c]} AS {c}' for c in LABELS)} FROM ext3),
ext5 AS (
  SELECT * REPLACE (CASE WHEN ageasentered IN ({_sql_in(R.AGES_UNDER_15)}) THEN '<15'
                         WHEN ageasentered = 'Unknown' THEN 'Unknown Age' ELSE '15+' END
                    AS trendscoarse) FROM ext4),"""
    steps = ["m0 AS (SELECT * FROM wide)",
             *sql_derived_steps([*NAMES, "otherdisaggregate"]),
             f"dv3 AS (SELECT * FROM m{len(R.DERIVED_INDICATORS)})"]
    chain = C._results_chain("ext5", dealt, LABELS, SAME, NAMES, ",\n".join(steps) + ",")
    return chain + (f"SELECT {', '.join(KEYS)}, count(*) AS n, "
                    f"{', '.join(f'sum({m}) AS {m}' for m in DERIVED_OUT)} "
                    f"FROM rt GROUP BY {', '.join(KEYS)}")


QUERIES["results_derived"] = q_results_derived
ORACLE["results_derived"] = ORACLE_CTE + _sql()
