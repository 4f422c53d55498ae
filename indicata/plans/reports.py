"""Composite report tables over canonical schemas.

Each is a function of DataFrames (plus rule data) returning a DataFrame;
callers persist with :mod:`indicata.sources.files`.  Column names follow the
canonical extract (``orgunituid``, ``indicator``, ``numeratordenom``,
``standardizeddisaggregate``, ``otherdisaggregate``, ``fiscal_year``,
``qtr1..qtr4``, ``cumulative``, ``targets``, ...).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from indicata.functions.columns import cols, ordered, relocate
from indicata.functions.domain import (age_band_50plus, age_coarse, funding_agency,
                                       null_for_pregnancy, pop_type, support_class,
                                       unknown_label)
from indicata.functions.expressions import band_score, is_in, not_in, ratio, recode
from indicata.functions.periods import (fiscal_period_columns, period_date, period_label,
                                        suffix_denominator)
from indicata.operators.cohorts import relative_cohort, shift_period, trailing_cohort
from indicata.operators.derive import apply_corrections, derive_indicators, derive_long
from indicata.operators.joins import (enrich, keep_with_any, map_indicator, orphans,
                                      qa_missing_key, refresh_attrs)
from indicata.operators.measures import (cumulative_share, group_sum, group_sum_rest,
                                         period_bounds, sum_when)
from indicata.operators.reshape import gather, listed, reshape_long, spread
from indicata.operators.scoring import composite, score_sites, site_volume
from indicata.operators.select import apply_exclusions, drop_all_zero, fill_zero
from indicata.operators.union import Contract, align, union_all
from indicata.plans import rules as R
from indicata.session import materialize
from indicata.sources.files import upsert_period

# ---------------------------------------------------------------------------
# Yearly extracts -> one fact
# ---------------------------------------------------------------------------


def union_extracts(extracts: Sequence[tuple[DataFrame, Contract]], *,
                   mech_recode: Mapping[str, str] = R.MECH_NAME_RECODE,
                   modality_recode: Mapping[str, str] = R.MODALITY_RECODE,
                   corrections=None) -> DataFrame:
    """Align each year's extract to the contract, bind, recode, correct."""
    df = union_all([align(d, c) for d, c in extracts])
    df = df.withColumn("mech_name", recode("mech_name", mech_recode))
    if "modality" in df.columns:
        df = df.withColumn("modality", recode("modality", modality_recode))
    return apply_corrections(df, corrections) if corrections else df


def yearly_extracts(extracts: Mapping[str, DataFrame], layouts: Mapping[str, Mapping],
                    schema: T.StructType) -> list[tuple[DataFrame, Contract]]:
    """Each year's extract with its bundled layout (``R.SITE_LAYOUTS``, ``R.PSNU_LAYOUTS``)
    as a contract to ``schema``, for :func:`union_extracts`.

    A year without a layout, or an extract without a column that its layout
    renames, is an error.
    """
    out = []
    for year, df in extracts.items():
        layout = layouts[year]
        absent = [c for c in layout["rename"] if c not in df.columns]
        if absent:
            raise ValueError(f"extract {year}: absent columns: {', '.join(absent)}")
        out.append((df, Contract(schema, drop=layout["drop"], rename=layout["rename"])))
    return out


# ---------------------------------------------------------------------------
# Results table
# ---------------------------------------------------------------------------


RESULT_TYPES = ("results", "cumulative")


def attribute_partner(df: DataFrame, *, clinical: Sequence[str] = R.CLINICAL_INDICATORS,
                      site_partner: str = "partner_pepfar_clinical",
                      indicator: str = "indicator", mech: str = "mech_name") -> Column:
    """Clinical indicators take the site's clinical partner (or the ministry
    when the site has none); others keep the mechanism (D5)."""
    is_clin = is_in(indicator, clinical)
    return (F.when(is_clin & F.col(site_partner).isNotNull(), F.col(site_partner))
             .when(is_clin, F.lit("MISAU")).otherwise(F.col(mech)))


def results_source(dg: DataFrame, dedup_map: DataFrame, site_partner: DataFrame) -> DataFrame:
    """Mapped and attributed rows of the extract, their quarters still side by side."""
    df = map_indicator(dg, dedup_map)
    df = enrich(df, site_partner, "datim_uid", left_on="orgunituid")
    df = df.withColumn("partner_recode", attribute_partner(df)).drop("datim_uid")
    return df.withColumn("fy", F.col("fiscal_year").cast("int")).drop("fiscal_year")


def results_reported(source: DataFrame, exclusions=R.EXCLUSIONS) -> DataFrame:
    """Long, de-noised fact by the fiscal year ``fy`` and quarter ``q`` it was reported for."""
    df = reshape_long(source, fiscal_year="fy", quarter="q")
    df = df.withColumns({"quarter": F.concat(F.lit("Q"), F.col("q").cast("string")),
                         "indicator_temp": suffix_denominator("indicator", "numeratordenom")})
    return apply_exclusions(df, exclusions).drop("indicator", "quarter")


def results_shifted(reported: DataFrame, shifts=R.COHORT_SHIFTS) -> DataFrame:
    """The fact with its shifted cohorts, dated."""
    df = shift_period(reported, shifts, indicator="indicator_temp", fy="fy", q="q")
    return (df.withColumns({"period": period_label("fy", "q"), "date": period_date("fy", "q")})
              .drop("q"))


def results_long(dg: DataFrame, dedup_map: DataFrame, site_partner: DataFrame, *,
                 exclusions=R.EXCLUSIONS, shifts=R.COHORT_SHIFTS) -> DataFrame:
    """Mapped, attributed, long, de-noised, cohort-shifted and dated fact."""
    df = results_reported(results_source(dg, dedup_map, site_partner), exclusions)
    return results_shifted(df, shifts).drop("partner_pepfar_clinical")


def results_table(dg: DataFrame, dedup_map: DataFrame, site_map: DataFrame,
                  indicator_names: Sequence[str], *, cohort=R.PMTCT_ART_COHORT,
                  derived=R.DERIVED_INDICATORS, facility: str = "Facility",
                  materialize_long: bool = True) -> DataFrame:
    """The wide results table.

    ``indicator_names`` lists every ``indicator_temp`` value to spread into a
    column (from the rule set: mapped indicators, their ``_D`` forms, shift
    and cohort labels) so no scan is needed to discover them.
    """
    long = results_long(dg, dedup_map, site_map.select("datim_uid", "partner_pepfar_clinical"))
    if materialize_long:
        # read by the bounds, the cohort windows, their labels and the main
        # branch: write it once instead of re-running the joins per branch
        long = materialize(long)
    b = period_bounds(long, where=(F.col("indicator_temp") == "TX_CURR")
                      & (F.col("period_type") == "results"))
    # PMTCT_ART 12-month cohorts, one scan, labelled per window
    art = long.filter(F.col("indicator_temp") == cohort["indicator"])
    cohorts = relative_cohort(art, date="date", base=b["max_date"], windows=cohort["windows"],
                              fixed={0: (b["max_date"], b["max_period"])}) \
        .withColumn("indicator_temp", F.lit(cohort["label"]))
    full = long.unionByName(cohorts)
    wide = results_wide(full, indicator_names, b)
    vol = results_volume(wide, b["max_date"], facility)
    return results_with_sites(results_measures(wide, derived),
                              vol.withColumnRenamed("orgunituid", "datim_uid"), site_map)


def results_wide(full: DataFrame, indicator_names: Sequence[str],
                 bounds: Mapping[str, Column]) -> DataFrame:
    """One column per indicator; rows dated outside the bounds are left out."""
    wide = spread(full, "indicator_temp", "value", indicator_names)
    return (wide.withColumnsRenamed({"fy": "fiscal_year", "trendscoarse": "agecoarse"})
                .drop("numeratordenom").filter(_within(bounds)))


def _within(bounds: Mapping[str, Column]) -> Column:
    return (((F.col("date") >= bounds["min_date"]) & (F.col("date") <= bounds["max_date"]))
            | F.col("period").isNull())


def results_rows(full: DataFrame, indicator_names: Sequence[str],
                 bounds: Mapping[str, Column]) -> DataFrame:
    """The long rows that :func:`results_wide` and :func:`results_measures` make rows of the
    results table of, one each; an indicator that is not listed fails the query."""
    return listed(full, "indicator_temp", indicator_names).filter(
        _within(bounds) & F.col("period_type").isin(*RESULT_TYPES))


def results_volume(wide: DataFrame, max_date: Column, facility: str = "Facility", *,
                   site: str = "orgunituid") -> DataFrame:
    """Site volume at the latest period, facilities only."""
    rows = wide.filter((F.col("sitetype") == facility) & (F.col("date") == max_date))
    return site_volume(rows, site=site, value="TX_CURR", bands=R.SITE_VOLUME_BANDS,
                       default=R.SITE_VOLUME_DEFAULT)


def results_measures(wide: DataFrame, derived=R.DERIVED_INDICATORS) -> DataFrame:
    """Derived indicators; result and cumulative rows, by site uid."""
    wide = derive_indicators(wide, derived)
    return (wide.filter(F.col("period_type").isin(*RESULT_TYPES))
                .drop(*[c for c in ("statushiv", "statustb", "statuscx", "hiv_treatment_status")
                        if c in wide.columns])
                .withColumnRenamed("orgunituid", "datim_uid"))


def results_with_sites(out: DataFrame, volume: DataFrame, site_map: DataFrame) -> DataFrame:
    """Site attributes and volume, families filled, identifiers first."""
    out = enrich(out, site_map, "datim_uid")
    out = enrich(out, volume, "datim_uid")
    fam = cols(out, starts=["his_", "grm_", "security_", "program_"])
    out = fill_zero(out, fam)
    front = (cols(out, contains="_uid") + ["funding_agency", "mech_name"]
             + cols(out, starts="partner_") + cols(out, starts="snu") + cols(out, starts="psnu")
             + ["sitename", "period_type", "fiscal_year", "period", "date", "site_volume"])
    front = [c for i, c in enumerate(front) if c in out.columns and c not in front[:i]]
    return out.select(*front, *[c for c in out.columns if c not in front])


# ---------------------------------------------------------------------------
# Tables derived from the results table
# ---------------------------------------------------------------------------


def tb_summary(results: DataFrame, measures: Sequence[str] = ("TB_STAT", "TB_STAT_POS")) -> DataFrame:
    """C4: TB measures summed by province, date, partner and period."""
    r = results.filter(F.col("period_type") == "results").select(
        "snu1", "date", F.col("partner_pepfar_clinical").alias("partner"), "period", *measures)
    return group_sum(r, ["snu1", "date", "partner", "period"], list(measures))


def supply_triangulation(results: DataFrame, max_date: Column) -> DataFrame:
    """TX_CURR per site at the latest date, lower-case columns."""
    r = results.filter((F.col("date") == max_date) & F.col("TX_CURR").isNotNull())
    g = group_sum(r, ["period", "datim_uid", "snu1", "psnu", "sitename"], ["TX_CURR"])
    return g.toDF(*[c.lower() for c in g.columns])


def waterfall(results: DataFrame, *, start: str = R.WATERFALL_START_DATE,
              losses=R.WATERFALL_LOSSES, plus_periods=R.WATERFALL_50_PLUS_PERIODS,
              measures: Sequence[str] = ("TX_NEW", "TX_RTT", "TX_ML", "TX_NET_NEW")) -> DataFrame:
    """Treatment cascade in long form with TX_ML split by outcome."""
    keys = ["datim_uid", "period", "funding_agency", "partner_recode", "snu1", "psnu",
            "sitename", "sex", "ageasentered", "agecoarse", "otherdisaggregate"]
    r = results.filter((F.col("date") >= F.to_date(F.lit(start))) & F.col("date").isNotNull()
                       & not_in("ageasentered", R.WATERFALL_EXCLUDED_AGES))
    r = r.select(*keys, *measures)
    r = r.withColumn("ageasentered", age_band_50plus("ageasentered", period="period",
                                                     only_periods=plus_periods))
    r = r.withColumns({name: F.when(F.col("otherdisaggregate") == label, F.col("TX_ML"))
                       for name, label in losses})
    tx = [c for c in r.columns if c.startswith("TX_")]
    long = gather(r, keys, tx, names_to="indicator", values_to="value")
    return long.filter(F.col("indicator") != "TX_ML")


# ---------------------------------------------------------------------------
# Site scores
# ---------------------------------------------------------------------------


def site_scores(results: DataFrame, sites: DataFrame, period: str, *,
                scores=R.SITE_SCORES, partners=R.SCORE_PARTNERS, extra: DataFrame | None = None,
                wo_volume=R.SCORE_WO_VOLUME_PATTERNS) -> DataFrame:
    """Banded scores per site, one aggregation; ``extra`` adds scores
    computed elsewhere (e.g. TPT, keyed by datim_uid)."""
    ids = ["datim_uid", "snu1", "psnu", "sitename", "funding_agency", "mech_name", "period",
           "date", "sex", "ageasentered", "agecoarse", "standardizeddisaggregate",
           "otherdisaggregate"]
    base = results.filter(F.col("period_type") == "results")
    kept = [c for c in ids if c in base.columns]
    long = gather(base, kept, R.SCORE_INDICATORS)
    long = long.filter(is_in("mech_name", partners))
    sc = score_sites(long, site="datim_uid", period=period, scores=scores,
                     window_months=R.SCORE_WINDOW_MONTHS)
    site_list = (sites.filter(F.col("partner_pepfar_clinical") != "MISAU")
                      .withColumnRenamed("partner_pepfar_clinical", "partner"))
    out = enrich(site_list, sc, "datim_uid")
    if extra is not None:
        out = enrich(out, extra, "datim_uid")
    out = composite(out, subset_patterns=wo_volume).withColumn("period", F.lit(period))
    out = relocate(out, cols(out, starts="score"))
    out = relocate(out, ["period"], after="datim_uid")
    return out.drop("snu", "psnu", "sitename", "partner").orderBy("score_clin")


def tpt_scores(tpt: DataFrame, *, bands=R.BANDS_TPT) -> DataFrame:
    """C8 (TPT): completion rate per site from its own series, banded; sites
    without a value are dropped (then score 0 after the join)."""
    t = tpt.select(F.col("orgunituid").alias("datim_uid"),
                   F.col("TPT_CUM_PER").cast("double").alias("value_tpt")).dropna(subset=["value_tpt"])
    return t.withColumn("score_tpt", band_score("value_tpt", bands))


# ---------------------------------------------------------------------------
# Running share of patients and the regional roll-up
# ---------------------------------------------------------------------------

def running_share(results: DataFrame, period: str, *, measures=R.SHARE_MEASURES,
                  share_measure: str = "TX_CURR",
                  site_partner: DataFrame | None = None) -> DataFrame:
    """C11: site sums in a period, all-zero sites removed, cumulative share
    of ``share_measure`` (0/0 -> 1), HEI positivity (0/0 -> 0), site type."""
    r = results.filter((F.col("period") == period) & (F.col("period_type") == "results")
                       & F.col("sitetype").isin("Facility", "Military"))
    absent = [m for m in measures if m not in r.columns]
    if absent:
        raise ValueError(f"running_share: absent measures: {', '.join(absent)}")
    g = drop_all_zero(group_sum(r, ["datim_uid", "snu1", "psnu", "sitename"], measures), measures,
                      "datim_uid")
    g = cumulative_share(g, share_measure, ["datim_uid"], zero_total_share=1.0)
    hei = (ratio("PMTCT_HEI_POS", "PMTCT_EID_D")
           if {"PMTCT_HEI_POS", "PMTCT_EID_D"} <= set(g.columns) else F.lit(None).cast("double"))
    g = g.withColumn("PMTCT_HEI_POS_per", F.coalesce(hei, F.lit(0.0)))
    if site_partner is not None:
        site_partner = site_partner.withColumn("mech_name",
                                               recode("mech_name", R.V2_SITE_PARTNER_RECODE))
        g = enrich(g, site_partner, "datim_uid")
        g = g.withColumn("site_type", F.when(is_in("mech_name", R.CLINICAL_PARTNERS_SITE_TYPE),
                                             F.lit("99-AJUDA")).otherwise(F.lit("01-Sustainability")))
    return g.withColumn("partner_alt", F.lit(None).cast("string"))


def regional_rollup(site_level: DataFrame) -> DataFrame:
    """Patients and sites by province and support type, with shares."""
    sus = F.col("site_type") == "01-Sustainability"
    aj = F.col("site_type") == "99-AJUDA"
    out = sum_when(site_level.filter(F.col("TX_CURR") > 0), ["snu1"], {
        "TX_CURR": (F.lit(True), "TX_CURR"), "TX_CURR_SUS": (sus, "TX_CURR"),
        "TX_CURR_AJUDA": (aj, "TX_CURR"), "SITE_SUS": (sus, 1.0), "SITE_AJUDA": (aj, 1.0)})
    out = out.withColumn("SITE_TOTAL", F.col("SITE_SUS") + F.col("SITE_AJUDA"))
    return out.withColumns({"TX_CURR_AJUDA_PER": ratio("TX_CURR_AJUDA", "TX_CURR"),
                            "SITE_AJUDA_PER": ratio("SITE_AJUDA", "SITE_TOTAL")})


# ---------------------------------------------------------------------------
# C14-C17: supplemental submissions and the viral-load crosswalk
# ---------------------------------------------------------------------------


def transfer_in(history: DataFrame, site_removal: Sequence[str] = ()) -> DataFrame:
    """C15 (head): transfer-in history in long form with harmonised labels."""
    ids = [c for c in history.columns if not c.startswith("TX_")]
    long = gather(history, ids, [c for c in history.columns if c.startswith("TX_")])
    long = long.withColumns({
        "indicator": recode("indicator", R.TRN_INDICATOR_RECODE),
        "funding_agency": funding_agency("partner"),
        "agecoarse": age_coarse("ageasentered"),
        "ageasentered": unknown_label("ageasentered", "Unknown Age"),
        "sex": unknown_label("sex", "Unknown Sex")})
    long = long.withColumnsRenamed({"snu": "snu1", "partner": "partner_recode"})
    return long.filter(not_in("datim_uid", site_removal) & F.col("datim_uid").isNotNull())


def waterfall_final(cascade: DataFrame, transfers: DataFrame, org_units: DataFrame,
                    site_map: DataFrame, *, site_removal: Sequence[str] = R.SITE_REMOVAL,
                    military: tuple[str, str] = R.MILITARY_SITE,
                    columns: Sequence[str] = R.WATERFALL_COLUMNS) -> DataFrame:
    """The treatment cascade (C6) and the transfer-in history as one table.

    Bound by name, place names taken from the organisation units (one site
    carries a fixed label instead), site attributes from the site map, rows
    without a value left out before the joins.
    """
    places = ["snu1", "psnu", "sitename"]
    both = union_all([cascade.filter(not_in("datim_uid", site_removal)), transfers])
    uid, label = military
    both = refresh_attrs(both.filter(F.col("value").isNotNull()), org_units, "datim_uid", places,
                         overrides={uid: dict.fromkeys(places, label)})
    attrs = [c for c in site_map.columns if c not in both.columns]
    return ordered(enrich(both, site_map.select("datim_uid", *attrs), "datim_uid"), columns)


def vl_crosswalk(mer: DataFrame, sup: DataFrame, disa: DataFrame, sites: DataFrame,
                 psnu_map: DataFrame, *, anchors=R.VL_ANCHORS, months_back=R.VL_MONTHS_BACK,
                 start=R.VL_PROGRAMME_START, max_date: Column | None = None) -> DataFrame:
    """C17: programme, supplemental and laboratory viral-load series on one grain.

    ``max_date`` is the last date of ``mer``, where it is known (a stored
    results table has it in its state).  The laboratory series is copied to every trailing window of the anchor
    list and re-dated to the window's own last period/date (one scan, not
    one filtered copy per anchor).
    """
    start_c = F.to_date(F.lit(start))
    m = mer.filter((F.col("date") >= start_c) & (F.col("partner_recode") != "MISAU"))
    tx = ["TX_CURR_6MO_PRIOR", "TX_PVLS", "TX_PVLS_D", "TX_PVLS_PLW", "TX_PVLS_PLW_D"]
    ids = ["datim_uid", "partner_recode", "snu1", "psnu", "sitename", "period", "date", "sex",
           "ageasentered", "otherdisaggregate"]
    m = gather(m.select(*ids, *[t for t in tx if t in m.columns]), ids,
               [t for t in tx if t in m.columns])
    m = m.select(
        "datim_uid", F.col("partner_recode").alias("partner"), F.col("snu1").alias("snu"), "psnu",
        "sitename", "period", "date", "sex",
        age_band_50plus("ageasentered").alias("ageasentered"),
        F.regexp_replace("indicator", "_PLW", "").alias("indicator"),
        pop_type("otherdisaggregate").alias("pop_type"), F.lit(R.VL_SOURCE_PROGRAMME).alias("source"), "value")
    s = sup.filter(F.col("pop_type") != "KeyPop").select(
        "datim_uid", F.col("partner_pepfar_clinical").alias("partner"), "snu", "psnu", "sitename",
        "period", "sex", F.col("age").alias("ageasentered"),
        F.col("pop_subtype").alias("pop_type"), "source", "indicator", "value")
    fy, q = fiscal_period_columns(s, "period")
    s = s.withColumns({
        "date": period_date(fy, q),
        "indicator": recode("indicator", R.VL_INDICATOR_RECODE),
        "pop_type": F.coalesce(F.col("pop_type"), F.lit("Age/Sex")),
        "ageasentered": age_band_50plus(unknown_label("ageasentered", "Unknown Age",
                                                      all_to_null=True)),
        "sex": unknown_label("sex", "Unknown Sex"),
        "source": recode("source", R.VL_SOURCE_RECODE)}).filter(F.col("date") >= start_c)
    lo = F.add_months(start_c, -months_back)
    d = gather(disa.select("datim_uid", "partner", "snu", "psnu", "sitename",
                           F.col("period").alias("date"), F.col("age").alias("ageasentered"),
                           F.col("group").alias("pop_type"), "sex",
                           F.col("VL").alias("TX_PVLS_D"), F.col("VLS").alias("TX_PVLS")),
               ["datim_uid", "partner", "snu", "psnu", "sitename", "date", "ageasentered",
                "pop_type", "sex"], ["TX_PVLS_D", "TX_PVLS"])
    max_date = mer.agg(F.max("date")).scalar() if max_date is None else max_date
    d = d.filter((F.col("date") >= lo) & (F.col("date") <= max_date) & (F.col("value") > 0))
    d = d.withColumns({
        "source": F.lit(R.VL_SOURCE_LAB),
        "pop_type": F.when(F.col("pop_type") == "Age", F.lit("Age/Sex")).otherwise(F.col("pop_type")),
        "period": period_label(*fiscal_period_columns(d, "date", from_date=True))})
    d = d.withColumns({"ageasentered": null_for_pregnancy("ageasentered", "pop_type"),
                       "sex": null_for_pregnancy("sex", "pop_type")})
    d = d.join(sites.select("datim_uid").distinct(), "datim_uid", "left_semi")
    windows = trailing_cohort(d, date="date", anchors=anchors, months_back=months_back)
    combined = union_all([m, s, windows]).drop("partner", "snu", "psnu", "sitename")
    combined = enrich(combined, sites, "datim_uid")
    return enrich(combined, psnu_map.select("psnu", "psnuuid"), "psnu")


# ---------------------------------------------------------------------------
# Targets table (PSNU extract)
# ---------------------------------------------------------------------------


def targets_table(dg_psnu: DataFrame, dedup_map: DataFrame, *, long_rules=R.LONG_DERIVED) -> DataFrame:
    """Cumulative and target values per row, long-form derived indicators
    appended, restricted to indicators that have any target."""
    df = map_indicator(dg_psnu, dedup_map)
    df = df.withColumn("fy", F.col("fiscal_year").cast("int"))
    df = reshape_long(df.drop("fiscal_year"), fiscal_year="fy")
    df = df.filter(F.col("period_type").isin("cumulative", "targets")).withColumn(
        "indicator_temp", suffix_denominator("indicator", "numeratordenom"))
    df = derive_long(df, long_rules)
    wide = spread(df, "period_type", "value", ["cumulative", "targets"])
    drop = [c for c in ("numeratordenom", "hiv_treatment_status", "indicator") if c in wide.columns]
    wide = (wide.drop(*drop)
                .withColumnsRenamed({"fy": "fiscal_year", "trendscoarse": "agecoarse",
                                     "indicator_temp": "indicator"}))
    return keep_with_any(wide, "indicator", "targets")


# ---------------------------------------------------------------------------
# Histories of processed quarters and partner submissions
# ---------------------------------------------------------------------------


def refreshed_history(history: DataFrame, site_map: DataFrame, *,
                      attrs: Sequence[str] = ("snu", "psnu", "sitename"),
                      front: Sequence[str] = ("datim_uid", "period")) -> DataFrame:
    """C9 / C14 / C16 tail: replace stale site attributes with the site map's
    and put identifiers first."""
    out = refresh_attrs(history, site_map, "datim_uid", [a for a in attrs if a in site_map.columns]
                        + [c for c in site_map.columns if c not in ("datim_uid", *attrs)])
    lead = [c for c in front if c in out.columns]
    return out.select(*lead, *[c for c in out.columns if c not in lead])


def kp_quarter(submissions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """C14 head: sum the TX_ measures over all other columns, and the QA table
    of rows without a site uid."""
    summed = group_sum_rest(submissions, "TX_")
    uncoded = qa_missing_key(summed, "datim_uid").select(
        *[c for c in ("datim_uid", "snu", "psnu", "sitename") if c in summed.columns]).distinct()
    return summed, uncoded


def vl_quarter(submissions: DataFrame, site_map: DataFrame) -> tuple[DataFrame, DataFrame]:
    """C16 head: the quarter's rows, and the QA table of submitted sites that
    are not in the site map (anti-join)."""
    sites = submissions.select("datim_uid", "snu", "psnu", "sitename").distinct()
    return submissions, orphans(sites, site_map, "datim_uid")


def kp_report(submissions: DataFrame, table: str, site_map: DataFrame, *,
              columns: Sequence[str] = R.KP_COLUMNS,
              schema: T.StructType | str | None = None) -> tuple[DataFrame, DataFrame]:
    """C14: sum a quarter's submissions, put them into the history at ``table``
    in place of what it had for their periods, and return the whole history with
    the site map's attributes, and the QA table.  ``schema`` is the history's
    contract; without it the schemas of all its files are merged."""
    summed, uncoded = kp_quarter(submissions)
    history = refreshed_history(upsert_period(summed, table, schema=schema), site_map)
    return ordered(history, columns), uncoded


def vl_report(submissions: DataFrame, table: str, site_map: DataFrame, *,
              columns: Sequence[str] = R.VL_COLUMNS,
              schema: T.StructType | str | None = None) -> tuple[DataFrame, DataFrame]:
    """As :func:`kp_report`, for viral-load rows, which are not summed."""
    rows, orphan_sites = vl_quarter(submissions, site_map)
    history = refreshed_history(upsert_period(rows, table, schema=schema), site_map)
    return ordered(history, columns), orphan_sites


def score_history(history: DataFrame, sites: DataFrame, *,
                  columns: Sequence[str] = R.SCORE_HISTORY_COLUMNS) -> DataFrame:
    """The scores of all quarters with the site list's place names."""
    return ordered(refreshed_history(history, sites), columns)


# ---------------------------------------------------------------------------
# Running share, first version (from the site fact)
# ---------------------------------------------------------------------------

def running_share_v1(dg: DataFrame, dedup_map: DataFrame, partner_alt: DataFrame, *,
                     period: str, remove_sites: Sequence[str] = R.V1_REMOVED_SITES,
                     mech_overrides: Mapping[str, str] = R.V1_MECH_OVERRIDES,
                     indicators=R.V1_INDICATORS) -> DataFrame:
    """Running share of TX_CURR by site from the site fact, with the
    clinical site type; ``period`` is the extract's label (e.g. "FY22Q4")."""
    df = dg.filter(is_in("indicator", indicators) & not_in("orgunituid", remove_sites))
    df = map_indicator(df, dedup_map)
    df = reshape_long(df.withColumn("fiscal_year", F.col("fiscal_year").cast("int")))
    df = df.filter((F.col("period_type") == "results") & (F.col("period") == period)
                   & F.col("sitetype").isin("Facility", "Military"))
    df = df.withColumn("indicator", suffix_denominator("indicator", "numeratordenom"))
    mech = F.col("mech_name")
    for uid, m in mech_overrides.items():
        mech = F.when(F.col("orgunituid") == uid, F.lit(m)).otherwise(mech)
    df = df.withColumn("mech_name", mech)
    df = df.withColumn("site_type", F.when(is_in("mech_name", R.CLINICAL_PARTNERS_SITE_TYPE),
                                           F.lit("99-AJUDA"))
                       .when(F.col("mech_name") == "MISAU", F.lit("01-Sustainability"))
                       .otherwise(F.lit("non-clinical")))
    df = df.filter(F.col("site_type") != "non-clinical")
    measures = R.SHARE_MEASURES
    # other indicators of the extract take no part in the share
    wide = spread(df, "indicator", "value", measures, strict=False)
    wide = enrich(wide, partner_alt, "datim_uid", left_on="orgunituid")
    keys = ["orgunituid", "snu1", "psnu", "sitename", "site_type", "mech_name", "partner_alt"]
    g = group_sum(fill_zero(wide, measures), keys, measures).withColumnRenamed("orgunituid",
                                                                              "datim_uid")
    g = cumulative_share(g, "TX_CURR", ["datim_uid", "snu1", "psnu", "sitename", "site_type",
                                        "mech_name", "partner_alt"])
    return g.withColumn("PMTCT_HEI_POS_per",
                        F.coalesce(ratio("PMTCT_HEI_POS", "PMTCT_EID_D"), F.lit(0.0)))


# ---------------------------------------------------------------------------
# Site support list
# ---------------------------------------------------------------------------


def support_list(tx_curr_sites: DataFrame, other_partners: DataFrame,
                 case_finding: DataFrame) -> DataFrame:
    """Support classification of each site from two partner lists, with
    the rounded case-finding potential (half to even; non-numbers -> null)."""
    cf = case_finding.select(F.col("orgunituid").alias("datim_uid"),
                             F.bround(F.col("Case Finding Potential").try_cast("double"))
                              .alias("cfp"))
    out = enrich(enrich(tx_curr_sites, other_partners, "datim_uid"), cf, "datim_uid")
    out = out.withColumn("partner_code", support_class("partner_pepfar_clinical",
                                                       "partner_nonpepfar_sustain"))
    return relocate(out, cols(out, starts="partner"), after="sitename") \
        if "sitename" in out.columns else out


# ---------------------------------------------------------------------------
# MI extract
# ---------------------------------------------------------------------------


def mi_extract(mi: DataFrame, site_map: DataFrame, psnu_map: DataFrame, *,
               start: str = R.VL_PROGRAMME_START,
               drop: Sequence[str] = ("sisma_uid", "sisma_uid_datim_map", "site_nid", "numdenom",
                                      "program_ap3", "program_mi")) -> DataFrame:
    """MI series in long form since ``start``, enriched from the site and
    district maps."""
    ids = [c for c in mi.columns if not c.startswith("cv")]
    long = gather(mi, ids, [c for c in mi.columns if c.startswith("cv")])
    long = long.withColumn("period", F.to_date("period")).filter(
        F.col("period") >= F.to_date(F.lit(start)))
    long = long.drop(*[c for c in drop if c in long.columns]).withColumnRenamed("age", "ageasentered")
    long = long.withColumns({"source": F.lit(R.VL_SOURCE_MI), "sex": F.lit(None).cast("string")})
    extra = [c for c in ("datim_uid", "sisma_uid", "site_nid", "his_emr", "his_epts", "his_idart",
                         "his_disa") if c in site_map.columns]
    long = enrich(long, site_map.select(*extra), "datim_uid")
    return enrich(long, psnu_map.select("psnu", "psnuuid"), "psnu")


__all__ = ["results_rows", "results_wide", "results_volume", "results_measures", "results_with_sites",
           "union_extracts", "yearly_extracts", "attribute_partner", "results_long", "results_table",
           "tb_summary", "supply_triangulation", "waterfall", "site_scores", "running_share",
           "regional_rollup", "transfer_in", "vl_crosswalk", "targets_table",
           "refreshed_history", "waterfall_final", "kp_report", "vl_report", "score_history",
           "kp_quarter", "vl_quarter", "running_share_v1", "support_list",
           "mi_extract", "tpt_scores"]
