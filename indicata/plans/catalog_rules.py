"""Rule-driven queries: exclusions, corrections, recodes, derived indicators,
partner attribution, dimension joins and QA (P11, D4-D7, D10-D17, F3, F17,
J1, J3, J5, J8, D21)."""

from __future__ import annotations

from pyspark.sql import functions as F

from indicata.functions.domain import (age_band_50plus, age_coarse, funding_agency, pop_type,
                                       site_type, support_class, unknown_label)
from indicata.functions.expressions import is_in, lookup, recode
from indicata.functions.periods import suffix_denominator
from indicata.operators.derive import apply_corrections, derive_indicators, derive_long
from indicata.operators.joins import (enrich, keep_with_any, orphans, qa_missing_key, refresh_attrs,
                                      restrict_to)
from indicata.operators.measures import group_sum, period_bounds
from indicata.operators.reshape import spread
from indicata.operators.scoring import site_volume
from indicata.operators.select import apply_exclusions
from indicata.plans import proxy
from indicata.plans import rules as R
from indicata.plans.registry import (PERIOD, PROXY_PARTNER, _sql_band, _sql_in, _sql_lookup,
                                     _sql_predicate, _sql_recode, _sql_value, label_pool, pick,
                                     register)

IND = proxy.INDICATORS


def _nv(df, *keys):
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("v"))


# ---------------------------------------------------------------------------
# Exclusion rules (a null condition keeps the row)
# ---------------------------------------------------------------------------

def _dealt(columns: dict, *keep: str):
    """The proxy fact with each column of ``columns`` dealt from its pool: a function of the
    fact's frame, and the CTE body in SQL."""
    picked = {c: pick(v, 5 + 2 * i, 3 + 4 * i) for i, (c, v) in enumerate(columns.items())}
    sql = (f"SELECT {', '.join(keep)}, "
           + ", ".join(f"{x[1]} AS {c}" for c, x in picked.items()) + " FROM dated")
    return (lambda f: f.selectExpr(*keep, *[f"{x[0]} AS {c}" for c, x in picked.items()]),
            sql)


_EXCLUDED = [list(rule) for rule in R.EXCLUSIONS]
_EXCLUDE_COLUMNS = {c: label_pool(_EXCLUDED, c)
                    for c in ("mech_name", "partner_recode", "indicator", "orgunituid")}
_EXCLUDE_FRAME, _EXCLUDE_SQL = _dealt(_EXCLUDE_COLUMNS, "fy + 24 AS fy",
                                      "concat('Q', CAST(q AS STRING)) AS quarter", "value")


@register("exclude_where", f"""
, x AS ({_EXCLUDE_SQL})
SELECT mech_name, partner_recode, fy, quarter, orgunituid, count(*) AS n, sum(value) AS v FROM x
WHERE {' AND '.join(f'NOT coalesce({_sql_predicate(r)}, false)' for r in _EXCLUDED)}
GROUP BY mech_name, partner_recode, fy, quarter, orgunituid
""")
def exclude_where_q(spark, sf_dir):
    x = _EXCLUDE_FRAME(proxy.fact(spark, sf_dir))
    return _nv(apply_exclusions(x, R.EXCLUSIONS), "mech_name", "partner_recode", "fy", "quarter",
               "orgunituid")


# ---------------------------------------------------------------------------
# Ordered corrections (a later rule matches values set by an earlier one)
# ---------------------------------------------------------------------------

_CORRECTED = {c: label_pool([[[(c, "in", [m[c] for m, _ in R.CORRECTIONS if c in m])]]], c)
              for c in ("orgunituid", "mech_name")}
_CORRECT_FRAME, _CORRECT_SQL = _dealt(_CORRECTED, "sitename", "snu1", "psnu",
                                      "'uid' AS psnuuid", "value")
_CORRECT_KEYS = ["orgunituid", "mech_name", "sitename", "snu1", "psnu", "psnuuid"]


def _sql_corrections() -> str:
    """One step per rule, each over the step before it."""
    steps = [f"c0 AS ({_CORRECT_SQL})"]
    for i, (match, sets) in enumerate(R.CORRECTIONS):
        cond = " AND ".join(f"{c} = {_sql_value(v)}" for c, v in match.items())
        new = ", ".join(f"CASE WHEN {cond} THEN {_sql_value(v)} ELSE {c} END AS {c}"
                        for c, v in sets.items())
        steps.append(f"c{i + 1} AS (SELECT * REPLACE ({new}) FROM c{i})")
    keys = ", ".join(_CORRECT_KEYS)
    return (", " + ",\n".join(steps) + f"\nSELECT {keys}, count(*) AS n, sum(value) AS v "
            f"FROM c{len(R.CORRECTIONS)} GROUP BY {keys}")


@register("corrections", _sql_corrections())
def corrections_q(spark, sf_dir):
    return _nv(apply_corrections(_CORRECT_FRAME(proxy.fact(spark, sf_dir)), R.CORRECTIONS),
               *_CORRECT_KEYS)


# ---------------------------------------------------------------------------
# Recodes, age bands, population type, funding agency, site type
# ---------------------------------------------------------------------------

# Proxy fine age band from part size: (largest size, band).
AGE_FROM_SIZE = [(2, "<01"), (5, "01-04"), (10, "05-09"), (15, "10-14"), (20, "15-19"),
                 (25, "20-24"), (30, "25-29"), (35, "30-34"), (38, "35-39"), (41, "40-44"),
                 (43, "45-49"), (45, "50-54"), (47, "55-59"), (48, "60-64"), (49, "65+"),
                 (50, "Unknown")]
PROXY_DISAGG = {"PROMO": "Breastfeeding", "SMALL": "Pregnant", "LARGE": "Pregnant/Breastfeeding"}


def _age_expr():
    expr = None
    for hi, label in AGE_FROM_SIZE:
        c = F.col("p_size") <= hi
        expr = F.when(c, F.lit(label)) if expr is None else expr.when(c, F.lit(label))
    return expr


def _sql_age() -> str:
    return "CASE " + " ".join(f"WHEN p_size <= {hi} THEN '{lab}'" for hi, lab in AGE_FROM_SIZE) + " END"


@register("recodes", f"""
, j AS (
  SELECT d.value, d.mech_name, p.p_type, p.p_size, {_sql_age()} AS age
  FROM dated d JOIN part p ON d.part_key = p.p_partkey),
r AS (
  SELECT value,
         CASE WHEN age IN ({_sql_in(R.AGES_50_PLUS)}) THEN '50+' ELSE age END AS ageasentered,
         CASE WHEN age IN ({_sql_in(R.AGES_UNDER_15)}) THEN '<15'
              WHEN age = 'Unknown' THEN 'Unknown Age' ELSE '15+' END AS agecoarse,
         CASE WHEN age = 'Unknown' THEN 'Unknown Age' ELSE age END AS age_label,
         {_sql_recode('p_type', PROXY_DISAGG)} AS disagg,
         {_sql_recode('mech_name', PROXY_PARTNER)} AS partner
  FROM j)
SELECT ageasentered, agecoarse, age_label,
       CASE WHEN disagg LIKE '%Breastfeeding%' THEN 'LW' WHEN disagg LIKE '%Pregnant%' THEN 'PW'
            ELSE 'Age/Sex' END AS pop_type,
       CASE WHEN partner = 'ECHO' THEN 'USAID' WHEN partner = 'JHPIEGO-DoD' THEN 'DOD'
            ELSE 'HHS/CDC' END AS funding_agency,
       CASE WHEN partner IN ({_sql_in(R.CLINICAL_PARTNERS_SITE_TYPE)}) THEN '99-AJUDA'
            ELSE '01-Sustainability' END AS site_type,
       count(*) AS n, sum(value) AS v
FROM r GROUP BY ALL
""")
def recodes_q(spark, sf_dir):
    part = proxy.table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_size")
    f = proxy.fact(spark, sf_dir).select("part_key", "mech_name", "value")
    j = f.join(part, f.part_key == part.p_partkey).withColumn("age", _age_expr())
    r = j.select(
        "value",
        age_band_50plus("age").alias("ageasentered"),
        age_coarse("age").alias("agecoarse"),
        unknown_label("age", "Unknown Age").alias("age_label"),
        pop_type(recode("p_type", PROXY_DISAGG)).alias("pop_type"),
        funding_agency(recode("mech_name", PROXY_PARTNER)).alias("funding_agency"),
        site_type(recode("mech_name", PROXY_PARTNER), variant=2).alias("site_type"))
    return _nv(r, "ageasentered", "agecoarse", "age_label", "pop_type", "funding_agency",
               "site_type")


# ---------------------------------------------------------------------------
# Site support classification
# ---------------------------------------------------------------------------

def _site_partners(spark, sf_dir):
    """Site dimension with a clinical partner (by province) and a second
    donor (sites with a large balance); either may be null."""
    s = proxy.sites(spark, sf_dir)
    return s.select("site_uid", "acctbal",
                    lookup("snu1", proxy.PROXY_SITE_PARTNER).alias("partner_pepfar_clinical"),
                    F.when(F.col("acctbal") > 5000, F.lit("GF")).alias("partner_nonpepfar_sustain"))


@register("support_class", f"""
, tx AS (SELECT site_uid, sum(value) AS TX_CURR FROM dated
         WHERE period = '{PERIOD}' AND indicator = 'TX_CURR' GROUP BY site_uid),
sp AS (SELECT site_uid, acctbal, {_sql_lookup('snu1', proxy.PROXY_SITE_PARTNER)} AS partner_pepfar_clinical,
              CASE WHEN acctbal > 5000 THEN 'GF' END AS partner_nonpepfar_sustain FROM site_dim)
SELECT tx.site_uid, tx.TX_CURR, sp.partner_pepfar_clinical, sp.partner_nonpepfar_sustain,
       round_even(sp.acctbal / 1000, 0) + CAST(0 AS DOUBLE) AS cfp,  -- no negative zero
       CASE WHEN partner_pepfar_clinical IS NULL AND partner_nonpepfar_sustain IS NULL THEN 'No Support'
            WHEN partner_pepfar_clinical IS NULL AND partner_nonpepfar_sustain IS NOT NULL
              THEN 'Other Donor Support'
            WHEN partner_pepfar_clinical IN ({_sql_in(R.CLINICAL_PARTNERS_SUPPORT)}) THEN 'AJUDA'
       END AS partner_code
FROM tx LEFT JOIN sp ON tx.site_uid = sp.site_uid
""")
def support_class_q(spark, sf_dir):
    from indicata.plans import reports as P
    f = proxy.fact(spark, sf_dir, periods=[PERIOD]).filter(F.col("indicator") == "TX_CURR")
    tx = group_sum(f, ["site_uid"], ["value"]).withColumnRenamed("value", "TX_CURR")
    sp = _site_partners(spark, sf_dir)
    tx = enrich(tx, sp.select("site_uid", "partner_pepfar_clinical"), "site_uid")
    other = sp.select("site_uid", "partner_nonpepfar_sustain")
    # the case-finding sheet carries its number as text
    cf = sp.select(F.col("site_uid").alias("orgunituid"),
                   (F.col("acctbal") / 1000).cast("string").alias("Case Finding Potential"))
    out = P.support_list(tx.withColumnRenamed("site_uid", "datim_uid"),
                         other.withColumnRenamed("site_uid", "datim_uid"), cf)
    return out.withColumnRenamed("datim_uid", "site_uid")


# ---------------------------------------------------------------------------
# Master-list restriction, orphans, attribute refresh
# ---------------------------------------------------------------------------

def _master(spark, sf_dir):
    """Master site list: sites in good standing (non-negative balance)."""
    return proxy.sites(spark, sf_dir).filter(F.col("acctbal") >= 0).drop("acctbal")


@register("restrict_to", """
SELECT snu1, count(*) AS n, sum(value) AS v FROM dated
WHERE site_uid IN (SELECT site_uid FROM site_dim WHERE acctbal >= 0)
GROUP BY snu1
""")
def restrict_to_q(spark, sf_dir):
    f = proxy.fact(spark, sf_dir)
    return _nv(restrict_to(f, _master(spark, sf_dir).select("site_uid"), "site_uid"), "snu1")


@register("orphans", """
SELECT site_uid, count(*) AS n, sum(value) AS v FROM dated
WHERE site_uid NOT IN (SELECT site_uid FROM site_dim WHERE acctbal >= 0)
GROUP BY site_uid
""")
def orphans_q(spark, sf_dir):
    f = proxy.fact(spark, sf_dir)
    return _nv(orphans(f, _master(spark, sf_dir).select("site_uid"), "site_uid"), "site_uid")


OVERRIDES = {1: {"psnu": "_Military", "snu1": "_Military"}}


@register("refresh_attrs", """
, m AS (SELECT site_uid, psnu, snu1 FROM site_dim WHERE acctbal >= 0),
j AS (SELECT d.site_uid, d.value,
             CASE WHEN d.site_uid = 1 THEN '_Military' ELSE m.psnu END AS psnu,
             CASE WHEN d.site_uid = 1 THEN '_Military' ELSE m.snu1 END AS snu1
      FROM dated d LEFT JOIN m ON d.site_uid = m.site_uid)
SELECT site_uid, psnu, snu1, count(*) AS n, sum(value) AS v FROM j GROUP BY site_uid, psnu, snu1
""")
def refresh_attrs_q(spark, sf_dir):
    f = proxy.fact(spark, sf_dir).select("site_uid", "psnu", "snu1", "value")
    out = refresh_attrs(f, _master(spark, sf_dir), "site_uid", ["psnu", "snu1"],
                        overrides=OVERRIDES)
    return _nv(out, "site_uid", "psnu", "snu1")


# ---------------------------------------------------------------------------
# Enrichment with differently named keys
# ---------------------------------------------------------------------------

@register("enrich", """
, s AS (SELECT site_uid AS orgunituid, sum(value) AS v FROM dated
        WHERE indicator = 'TX_CURR' GROUP BY site_uid)
SELECT s.orgunituid, s.v, d.sitename, d.psnu, d.snu1
FROM s LEFT JOIN site_dim d ON s.orgunituid = d.site_uid
""")
def enrich_q(spark, sf_dir):
    f = proxy.fact(spark, sf_dir, with_sites=False).filter(F.col("indicator") == "TX_CURR")
    s = restrict_to(group_sum(f, ["site_uid"], ["value"]), proxy.site_keys(spark, sf_dir),
                    "site_uid").select(F.col("site_uid").alias("orgunituid"),
                                       F.col("value").alias("v"))
    dim = proxy.sites(spark, sf_dir).select("site_uid", "sitename", "psnu", "snu1")
    return enrich(s, dim, "site_uid", left_on="orgunituid")


# ---------------------------------------------------------------------------
# Denominator suffix, partner attribution, site volume class
# ---------------------------------------------------------------------------

@register("partner_attribution", f"""
, sp AS (SELECT site_uid, {_sql_lookup('snu1', proxy.PROXY_SITE_PARTNER)} AS partner_clinical
         FROM site_dim),
mx AS (SELECT max(date) AS d FROM dated WHERE indicator = 'TX_CURR'),
vol AS (SELECT site_uid, {_sql_band('coalesce(sum(value), 0)', R.SITE_VOLUME_BANDS, R.SITE_VOLUME_DEFAULT)} AS site_volume
        FROM dated WHERE indicator = 'TX_CURR' AND date = (SELECT d FROM mx) GROUP BY site_uid),
a AS (
  SELECT d.value,
         d.indicator || CASE WHEN d.numeratordenom = 'D' THEN '_D' ELSE '' END AS indicator_temp,
         CASE WHEN d.indicator IN ({_sql_in(R.CLINICAL_INDICATORS)}) AND sp.partner_clinical IS NOT NULL
                THEN sp.partner_clinical
              WHEN d.indicator IN ({_sql_in(R.CLINICAL_INDICATORS)}) THEN 'MISAU'
              ELSE d.mech_name END AS partner_recode,
         vol.site_volume
  FROM dated d JOIN sp ON d.site_uid = sp.site_uid LEFT JOIN vol ON d.site_uid = vol.site_uid)
SELECT indicator_temp, partner_recode, site_volume, count(*) AS n, sum(value) AS v
FROM a GROUP BY indicator_temp, partner_recode, site_volume
""")
def partner_attribution_q(spark, sf_dir):
    f = proxy.fact(spark, sf_dir)
    sp = _site_partners(spark, sf_dir).select(
        "site_uid", F.col("partner_pepfar_clinical").alias("partner_clinical"))
    b = period_bounds(f, where=F.col("indicator") == "TX_CURR")
    latest = f.filter((F.col("indicator") == "TX_CURR") & (F.col("date") == b["max_date"]))
    vol = site_volume(latest, site="site_uid", value="value", bands=R.SITE_VOLUME_BANDS,
                      default=R.SITE_VOLUME_DEFAULT)
    clinical = is_in("indicator", R.CLINICAL_INDICATORS)
    a = (enrich(f, sp, "site_uid")
         .withColumns({
             "indicator_temp": suffix_denominator("indicator", "numeratordenom"),
             "partner_recode": F.when(clinical & F.col("partner_clinical").isNotNull(),
                                      F.col("partner_clinical"))
                                .when(clinical, F.lit("MISAU")).otherwise(F.col("mech_name"))}))
    return _nv(enrich(a, vol, "site_uid"), "indicator_temp", "partner_recode", "site_volume")


# ---------------------------------------------------------------------------
# Rows with a null key
# ---------------------------------------------------------------------------

@register("missing_key_qa", """
SELECT mech_name, count(*) AS n, sum(value) AS v FROM dated
WHERE standardizeddisaggregate IS NULL GROUP BY mech_name
""")
def missing_key_q(spark, sf_dir):
    return _nv(qa_missing_key(proxy.fact(spark, sf_dir), "standardizeddisaggregate"), "mech_name")


# ---------------------------------------------------------------------------
# half-to-even rounding
# ---------------------------------------------------------------------------

@register("bround", """
SELECT round_even(value / 2, 0) AS half_rounded, count(*) AS n FROM dated GROUP BY ALL
""")
def bround_q(spark, sf_dir):
    f = proxy.fact(spark, sf_dir)
    return (f.select(F.bround(F.col("value") / 2).alias("half_rounded"))
             .groupBy("half_rounded").agg(F.count(F.lit(1)).alias("n")))


# ---------------------------------------------------------------------------
# Derived indicator columns with sequential semantics
# ---------------------------------------------------------------------------

def _sources() -> list[str]:
    """Measures that the derived-indicator rules read and that no earlier rule makes."""
    made, out = set(), []
    for r in R.DERIVED_INDICATORS:
        reads = [r["src"]] if "src" in r else [c for c, _ in r.get("coalesce", [])]
        out += [c for c in reads if c not in made and c not in out]
        made.add(r["out"])
    return out


DERIVED_SOURCES = _sources()
DERIVED_WHEN = [r.get("when") for r in R.DERIVED_INDICATORS]
_DERIVE_COLUMNS = {"indicator": DERIVED_SOURCES} | {
    c: label_pool(DERIVED_WHEN, c) for c in ("sex", "agecoarse", "ageasentered", "modality",
                                             "statushiv", "statustb")}
_DERIVE_COLUMNS["otherdisaggregate"] = [*R.OTHERDISAGGREGATE_RECODE,
                                        *label_pool(DERIVED_WHEN, "otherdisaggregate")]
_DERIVE_FRAME, _DERIVE_SQL = _dealt(_DERIVE_COLUMNS, "fy + 24 AS fiscal_year", "value")
DERIVED_OUT = list(dict.fromkeys(r["out"] for r in R.DERIVED_INDICATORS if "recode" not in r))


def sql_derived_steps(known) -> list[str]:
    """The derived-indicator rules as CTEs ``m1``, ``m2``, ...: one step per rule, each over the
    step before it, from ``m0`` with the columns ``known``."""
    known, steps = set(known), []
    for i, r in enumerate(R.DERIVED_INDICATORS):
        if "recode" in r:
            expr = _sql_recode(r["col"], r["recode"])
        elif "coalesce" in r:
            expr = "coalesce(" + ", ".join(f"{'-' if k < 0 else ''}{c}"
                                           for c, k in r["coalesce"]) + ")"
        elif r["when"] is None:
            expr = r["src"]
        else:
            expr = f"CASE WHEN {_sql_predicate(r['when'])} THEN {r['src']} END"
        new = f"* REPLACE ({expr} AS {r['out']})" if r["out"] in known else f"*, {expr} AS {r['out']}"
        known.add(r["out"])
        steps.append(f"m{i + 1} AS (SELECT {new} FROM m{i})")
    return steps


def _sql_derived() -> str:
    wide = ", ".join(f"CASE WHEN indicator = '{c}' THEN value END AS {c}" for c in DERIVED_SOURCES)
    steps = [f"x AS ({_DERIVE_SQL})", f"m0 AS (SELECT *, {wide} FROM x)",
             *sql_derived_steps({*_DERIVE_COLUMNS, *DERIVED_SOURCES})]
    sums = ", ".join(f"sum({c}) AS {c}" for c in DERIVED_OUT)
    return (", " + ",\n".join(steps) + f"\nSELECT fiscal_year, {sums} "
            f"FROM m{len(R.DERIVED_INDICATORS)} GROUP BY fiscal_year")


@register("derive_indicators", _sql_derived())
def derive_indicators_q(spark, sf_dir):
    wide = spread(_DERIVE_FRAME(proxy.fact(spark, sf_dir)), "indicator", "value", DERIVED_SOURCES)
    wide = derive_indicators(wide, R.DERIVED_INDICATORS)
    return wide.groupBy("fiscal_year").agg(*[F.sum(c).alias(c) for c in DERIVED_OUT])


# ---------------------------------------------------------------------------
# The bundled long-form rules, on dealt labels
# ---------------------------------------------------------------------------

_LONG_WHEN = [r["when"] for r in R.LONG_DERIVED]
# Pools of lengths without a common factor where a rule reads both, so that their values meet.
_LONG_COLUMNS = {"indicator": ["TB_STAT", "TX_TB", "TB_PREV", "TX_CURR"],
                 "period_type": ["cumulative", "targets", "cumulative"]} | {
    c: (2 * label_pool(_LONG_WHEN, c))[:n] for c, n in (
        ("statushiv", 3), ("statustb", 5), ("otherdisaggregate", 7), ("hiv_treatment_status", 7))}
_LONG_FRAME, _LONG_SQL = _dealt(_LONG_COLUMNS, "numeratordenom", "value")


def _sql_long_derived() -> str:
    """One copy after another, as the rules are listed."""
    copies = ["SELECT indicator_temp AS ind, period_type, value FROM b"] + [
        f"SELECT CASE WHEN indicator_temp = '{r['src']}' THEN '{r['label']}' ELSE indicator_temp END, "
        f"period_type, value FROM b WHERE {r['match_col']} = '{r['src']}' "
        f"AND ({_sql_predicate(r['when'])})" for r in R.LONG_DERIVED]
    return f""", x AS ({_LONG_SQL}),
b AS (SELECT *, indicator || CASE WHEN numeratordenom = 'D' THEN '_D' ELSE '' END AS indicator_temp
      FROM x),
c AS ({" UNION ALL ".join(copies)}),
w AS (SELECT ind AS indicator, CASE WHEN period_type = 'cumulative' THEN value END AS cumulative,
             CASE WHEN period_type = 'targets' THEN value END AS targets FROM c)
SELECT indicator, count(*) AS n, sum(cumulative) AS cumulative, sum(targets) AS targets
FROM w WHERE indicator IN (SELECT indicator FROM w WHERE targets IS NOT NULL) GROUP BY indicator"""


@register("targets_bundled", _sql_long_derived())
def targets_bundled(spark, sf_dir):
    f = _LONG_FRAME(proxy.fact(spark, sf_dir)).withColumn(
        "indicator_temp", suffix_denominator("indicator", "numeratordenom"))
    wide = spread(derive_long(f, R.LONG_DERIVED), "period_type", "value", ["cumulative", "targets"]) \
        .drop("indicator").withColumnRenamed("indicator_temp", "indicator")
    return keep_with_any(wide, "indicator", "targets").groupBy("indicator").agg(
        F.count(F.lit(1)).alias("n"), F.sum("cumulative").alias("cumulative"),
        F.sum("targets").alias("targets"))
