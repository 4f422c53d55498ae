"""Golden checks of the composite pipelines on the synthetic fixture."""

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from indicata.functions.columns import with_null_measures
from indicata.plans import reports as P
from indicata.plans import rules as R
from tests import fixtures as X


def _results(spark):
    dg = spark.createDataFrame(X.extract_rows(), X.EXTRACT)
    m = spark.createDataFrame(X.MAP_ROWS, "indicator string, standardizeddisaggregate string, "
                                          "indicator_new string")
    sites = spark.createDataFrame(X.SITE_ROWS, X.SITE_MAP)
    return P.results_table(dg, m, sites, X.NAMES)


def _sum(df, col, **eq):
    q = df
    for k, v in eq.items():
        q = q.filter(F.col(k) == v)
    return q.agg(F.sum(col)).first()[0]


def test_results_table_golden(spark):
    r = _results(spark).cache()
    # unmapped indicator dropped, excluded MISAU/FY2024 row removed
    assert "UNMAPPED" not in r.columns
    assert _sum(r, "TX_NEW") is None
    # bounds: TX_CURR results from 2023 Q4 (2023-09-20) to 2024 Q4 (2024-09-20)
    assert r.filter("period_type = 'results'").agg(F.min("date"), F.max("date")).first() == \
        (dt.date(2023, 9, 20), dt.date(2024, 9, 20))
    # partner attribution: clinical indicator at a site without partner -> MISAU
    assert _sum(r, "TX_CURR", datim_uid="s2", partner_recode="MISAU", period="2024 Q1") == 50.0
    # shifts: TX_CURR 2024 Q1 (100) appears as 3-month-prior in Q2 and 6-month-prior in Q3
    assert _sum(r, "TX_CURR_3MO_PRIOR", datim_uid="s1", period="2024 Q2") == 100.0
    assert _sum(r, "TX_CURR_6MO_PRIOR", datim_uid="s1", period="2024 Q3") == 100.0
    # 2024 Q4 + 3 months is 2025 Q1: beyond the max date, filtered out
    assert r.filter("period = '2025 Q1'").count() == 0
    # TB_PREV_D 2024 Q2 moved six months later -> 2023 Q4, inside the bounds
    assert _sum(r, "TB_PREV_D_6MO_AFTER", period="2023 Q4") == 7.0
    assert _sum(r, "TB_PREV_D_6MO_AFTER_New", period="2023 Q4") == 7.0
    # derived: recoded IIT label, patient loss excludes transfers, null label -> null
    assert _sum(r, "TX_ML_IIT") == 4.0 and _sum(r, "TX_CIRA") == 4.0
    assert _sum(r, "TX_PatientLoss") == 4.0
    # PMTCT_ART cohorts: latest window (date > max-12mo) labelled with the bounds
    latest = r.filter("period = '2024 Q4'")
    assert _sum(latest, "PMTCT_ART_12MO") == 3.0 + 4.0 + 5.0 + 6.0
    assert _sum(r, "PMTCT_ART_12MO", period="2024 Q3") == 2.0 + 3.0 + 4.0 + 5.0
    assert _sum(r, "PMTCT_ART_Already") == 2.0      # the 2023 Q3 row is before the bounds
    # cumulative rows kept with null period (the TX_CURR row and its two shifted
    # copies, whose fiscal year becomes null as in the reference); targets dropped
    cum = r.filter("period_type = 'cumulative'")
    assert cum.count() == 3 and cum.filter("period IS NULL AND fiscal_year IS NULL").count() == 2
    assert r.filter("period_type = 'targets'").count() == 0
    # site volume, enrichment and zero-filled flags
    vol = {x.datim_uid: x.site_volume for x in r.select("datim_uid", "site_volume").distinct().collect()}
    assert vol["s1"] == "Low"
    assert r.filter(F.col("his_epts").isNull()).count() == 0
    assert r.columns[:4] == ["datim_uid", "funding_agency", "mech_name", "partner_recode"]


def test_tb_triangulation_waterfall(spark):
    r = _results(spark)
    tri = P.supply_triangulation(r, r.agg(F.max("date")).scalar())
    assert {c for c in tri.columns} == {"period", "datim_uid", "snu1", "psnu", "sitename", "tx_curr"}
    assert tri.agg(F.sum("tx_curr")).first()[0] == 130.0
    wf = P.waterfall(r.withColumns({"TX_RTT": F.lit(None).cast("double"),
                                    "TX_NET_NEW": F.lit(None).cast("double")}))
    got = {(x.indicator, x.value) for x in wf.collect()}
    assert ("TX_ML_Interruption_u3", 4.0) in got and ("TX_ML_Interruption_Transfer_Out", 2.0) in got
    assert not any(i == "TX_ML" for i, _ in got)


def test_union_extracts_with_drift_and_corrections(spark):
    from pyspark.sql import types as T
    from indicata.operators.union import Contract
    from indicata.plans import rules as R
    canon = T.StructType([T.StructField(c, T.StringType()) for c in
                          ("orgunituid", "mech_name", "sitename", "snu1", "psnu", "psnuuid",
                           "modality")])
    y21 = spark.createDataFrame([("siMZUtd2cJW", "Ariel", "x", "s", "p", "u", "Index")],
                                "orgunituid string, mech_name string, sitename string, snu1 string, "
                                "psnu string, psnuuid string, modality string")
    y22 = spark.createDataFrame([("EslaBcDD5mZ", "Friends in Global Health", "y", "s", "q", "u")],
                                "orgunituid string, mech_name string, sitename string, snu1 string, "
                                "snu2 string, psnuuid string")
    out = P.union_extracts([(y21, Contract(canon)),
                            (y22, Contract(canon, rename={"snu2": "psnu"}))],
                           corrections=R.CORRECTIONS)
    got = sorted((r.orgunituid, r.mech_name, r.sitename, r.psnu, r.modality) for r in out.collect())
    assert got == [("oX9C1fOEzSk", "ARIEL", "Cadeia Central PS", "Matola", "Index Facility"),
                   ("wmXdfKNX0qT", "FGH", "Inhamizua CS", "q", None)]


def test_targets_table_keeps_indicators_with_targets(spark):
    from pyspark.sql import types as T
    schema = ("indicator string, standardizeddisaggregate string, numeratordenom string, "
              "statushiv string, statustb string, hiv_treatment_status string, "
              "otherdisaggregate string, trendscoarse string, fiscal_year int, "
              "cumulative double, targets double")
    dg = spark.createDataFrame([
        ("TB_STAT", "Age/Sex", "N", "Positive", None, None, "Newly Identified", "15+", 2024, 5.0, 8.0),
        ("TX_TB", "Age/Sex", "D", None, "Negative", "New", None, "15+", 2024, 3.0, None),
        ("HTS_TST", "Age/Sex", "N", None, None, None, None, "15+", 2024, 9.0, None)], schema)
    m = spark.createDataFrame([("TB_STAT", "Age/Sex", "TB_STAT"), ("TX_TB", "Age/Sex", "TX_TB"),
                               ("HTS_TST", "Age/Sex", "HTS_TST")],
                              "indicator string, standardizeddisaggregate string, indicator_new string")
    out = P.targets_table(dg, m)
    got = {(r.indicator, r.cumulative, r.targets) for r in out.collect()}
    # TB_STAT copies carry targets; TX_TB_D and HTS_TST have none and are dropped
    assert got == {("TB_STAT", 5.0, None), ("TB_STAT", None, 8.0), ("TB_STAT_POS", 5.0, None),
                   ("TB_STAT_POS", None, 8.0), ("TB_STAT_POS_NEW", 5.0, None),
                   ("TB_STAT_POS_NEW", None, 8.0)}
    assert "agecoarse" in out.columns and "fiscal_year" in out.columns
    assert {r.period for r in out.collect()} == {"FY24"}


def test_transfer_in_labels(spark):
    hist = spark.createDataFrame([
        ("u1", "S", "P", "n", "2024 Q1", "JHPIEGO-DoD", "Unknown", "05-09", 3.0, 1.0),
        ("u2", "S", "P", "n", "2024 Q1", "ECHO", "Female", "Unknown", None, 2.0),
        (None, "S", "P", "n", "2024 Q1", "FGH", "Male", "20-24", 1.0, 1.0)],
        "datim_uid string, snu string, psnu string, sitename string, period string, "
        "partner string, sex string, ageasentered string, TX_RTT double, TX_NEW double")
    out = P.transfer_in(hist, site_removal=["u9"])
    got = sorted((r.datim_uid, r.indicator, r.funding_agency, r.agecoarse, r.ageasentered, r.sex,
                  r.value) for r in out.collect())
    assert got == [("u1", "TX_NEW", "DOD", "<15", "05-09", "Unknown Sex", 1.0),
                   ("u1", "TX_RTT_SUP", "DOD", "<15", "05-09", "Unknown Sex", 3.0),
                   ("u2", "TX_NEW", "USAID", "Unknown Age", "Unknown Age", "Female", 2.0)]
    assert {"snu1", "partner_recode"} <= set(out.columns)


def test_vl_crosswalk_three_sources(spark):
    mer = spark.createDataFrame([
        ("s1", "ECHO", "A", "P1", "n1", "2023 Q1", dt.date(2022, 12, 20), "Female", "55-59",
         "Pregnant", 10.0, 8.0, None),
        ("s1", "MISAU", "A", "P1", "n1", "2023 Q1", dt.date(2022, 12, 20), "Male", "25-29",
         None, 1.0, 1.0, None),
        ("s1", "ECHO", "A", "P1", "n1", "2023 Q2", dt.date(2023, 3, 20), "Male", "25-29",
         None, None, None, 5.0)],
        "datim_uid string, partner_recode string, snu1 string, psnu string, sitename string, "
        "period string, date date, sex string, ageasentered string, otherdisaggregate string, "
        "TX_PVLS_D double, TX_PVLS double, TX_CURR_6MO_PRIOR double")
    sup = spark.createDataFrame([
        ("s1", "ECHO", "A", "P1", "n1", "2023 Q2", "Unknown", "All", None, "Clinical Module",
         "TX_PVLS_N", 4.0, "Age"),
        ("s1", "ECHO", "A", "P1", "n1", "2023 Q2", "F", "20-24", "PW", "Lab Module", "TX_PVLS_D",
         6.0, "KeyPop")],
        "datim_uid string, partner_pepfar_clinical string, snu string, psnu string, "
        "sitename string, period string, sex string, age string, pop_subtype string, "
        "source string, indicator string, value double, pop_type string")
    disa = spark.createDataFrame([
        ("s1", "X", "A", "P1", "n1", dt.date(2022, 2, 15), "25-29", "Age", "Male", 3.0, 2.0),
        ("s1", "X", "A", "P1", "n1", dt.date(2022, 1, 15), "25-29", "Age", "Male", 9.0, 9.0),
        ("s1", "X", "A", "P1", "n1", dt.date(2022, 11, 15), "", "PW", "Female", 1.0, 0.0),
        ("s9", "X", "A", "P1", "n1", dt.date(2022, 11, 15), "25-29", "Age", "Male", 7.0, 7.0)],
        "datim_uid string, partner string, snu string, psnu string, sitename string, period date, "
        "age string, group string, sex string, VL double, VLS double")
    sites = spark.createDataFrame([("s1", "ECHO", "A", "P1", "n1")],
                                  "datim_uid string, partner string, snu string, psnu string, "
                                  "sitename string")
    psnu = spark.createDataFrame([("P1", "pu1")], "psnu string, psnuuid string")
    out = P.vl_crosswalk(mer, sup, disa, sites, psnu, anchors=["2022-12-20", "2023-03-20"],
                         months_back=11, start="2022-12-20").cache()
    mer_rows = {(r.period, r.indicator, r.pop_type, r.ageasentered, r.value)
                for r in out.filter(F.col("source") == R.VL_SOURCE_PROGRAMME).collect()}
    assert mer_rows == {("2023 Q1", "TX_PVLS_D", "PW", "50+", 10.0),
                        ("2023 Q1", "TX_PVLS", "PW", "50+", 8.0),
                        ("2023 Q2", "TX_CURR_6MO_PRIOR", "Age/Sex", "25-29", 5.0)}
    sup_rows = {(r.source, r.indicator, r.ageasentered, r.sex, r.pop_type, r.date)
                for r in out.filter(~F.col("source").isin(R.VL_SOURCE_PROGRAMME, R.VL_SOURCE_LAB)).collect()}
    assert sup_rows == {("EPTS-Clinical", "TX_PVLS", None, "Unknown Sex", "Age/Sex",
                         dt.date(2023, 3, 20))}
    disa_rows = Counter((r.period, r.date, r.indicator, r.sex, r.value)
                        for r in out.filter(F.col("source") == R.VL_SOURCE_LAB).collect())
    # the February test is only in the first window (11 months back from 2022-12-20),
    # the November one in both, re-dated to each window's last period and date; the
    # January one is before the first window, zero values and unknown sites are dropped
    assert disa_rows == Counter([
        ("2023 Q1", dt.date(2022, 11, 15), "TX_PVLS_D", "Male", 3.0),
        ("2023 Q1", dt.date(2022, 11, 15), "TX_PVLS", "Male", 2.0),
        ("2023 Q1", dt.date(2022, 11, 15), "TX_PVLS_D", None, 1.0),
        ("2023 Q1", dt.date(2022, 11, 15), "TX_PVLS_D", None, 1.0)])
    assert set(out.select("psnuuid").distinct().toPandas()["psnuuid"]) == {"pu1"}


def test_kp_vl_quarters_and_history(spark):
    kp = spark.createDataFrame([("u1", "S", "P", "n", "2024 Q1", "MSM", 1.0, 2.0),
                                ("u1", "S", "P", "n", "2024 Q1", "MSM", 3.0, None),
                                (None, "S", "P", "x", "2024 Q1", "FSW", 1.0, 1.0)],
                               "datim_uid string, snu string, psnu string, sitename string, "
                               "period string, keypop string, TX_CURR double, tx_new double")
    summed, uncoded = P.kp_quarter(kp)
    assert sorted((r.datim_uid, r.TX_CURR, r.tx_new) for r in summed.collect()
                  if r.datim_uid) == [("u1", 4.0, 2.0)]
    assert [r.sitename for r in uncoded.collect()] == ["x"]
    site_map = spark.createDataFrame([("u1", "S2", "P2", "N2", "ECHO")],
                                     "datim_uid string, snu string, psnu string, sitename string, "
                                     "partner_pepfar_clinical string")
    hist = P.refreshed_history(summed, site_map)
    r = hist.filter("datim_uid = 'u1'").first()
    assert (r.snu, r.sitename, r.partner_pepfar_clinical) == ("S2", "N2", "ECHO")
    assert hist.columns[:2] == ["datim_uid", "period"]
    vl = spark.createDataFrame([("u1", "S", "P", "n", 1.0), ("u7", "S", "P", "m", 2.0)],
                               "datim_uid string, snu string, psnu string, sitename string, value double")
    _, orphan_sites = P.vl_quarter(vl, site_map)
    assert [r.datim_uid for r in orphan_sites.collect()] == ["u7"]


def test_running_share_v1_support_list_mi(spark):
    dg = spark.createDataFrame(X.extract_rows(), X.EXTRACT)
    m = spark.createDataFrame(X.MAP_ROWS, "indicator string, standardizeddisaggregate string, "
                                          "indicator_new string")
    alt = spark.createDataFrame([("s1", "GF")], "datim_uid string, partner_alt string")
    out = P.running_share_v1(dg, m, alt, period="FY24Q4")
    rows = [(r.datim_uid, r.TX_CURR, r.TX_CURR_cum, r.TX_CURR_cum_per, r.partner_alt)
            for r in out.orderBy(F.col("TX_CURR").desc()).collect()]
    assert rows == [("s1", 130.0, 130.0, 1.0, "GF")]
    sites = spark.createDataFrame([("s1", "n1", "ECHO"), ("s2", "n2", None), ("s3", "n3", None)],
                                  "datim_uid string, sitename string, partner_pepfar_clinical string")
    other = spark.createDataFrame([("s3", "GF")], "datim_uid string, partner_nonpepfar_sustain string")
    cf = spark.createDataFrame([("s1", "2.5"), ("s2", "n/a")],
                               "orgunituid string, `Case Finding Potential` string")
    sl = {r.datim_uid: (r.partner_code, r.cfp) for r in P.support_list(sites, other, cf).collect()}
    assert sl == {"s1": ("AJUDA", 2.0), "s2": ("No Support", None),
                  "s3": ("Other Donor Support", None)}
    mi = spark.createDataFrame([("s1", "2022-12-20", "P1", "15+", "x", 0.5, None),
                                ("s1", "2022-09-20", "P1", "15+", "x", 0.7, 0.1)],
                               "datim_uid string, period string, psnu string, age string, "
                               "numdenom string, cv_a double, cv_b double")
    smap = spark.createDataFrame([("s1", "SM1", 1.0)], "datim_uid string, sisma_uid string, his_epts double")
    pmap = spark.createDataFrame([("P1", "pu")], "psnu string, psnuuid string")
    got = P.mi_extract(mi, smap, pmap).collect()
    assert [(r.indicator, r.value, r.sisma_uid, r.psnuuid, r.source) for r in got] == \
        [("cv_a", 0.5, "SM1", "pu", "MI")]


def test_site_scores_with_tpt_and_wo_volume(spark):
    r = _results(spark)
    sites = spark.createDataFrame(X.SITE_ROWS, X.SITE_MAP).select("datim_uid",
                                                                 "partner_pepfar_clinical")
    tpt = spark.createDataFrame([("s1", 0.95), ("s2", None)], "orgunituid string, TPT_CUM_PER double")
    with pytest.raises(ValueError, match="absent"):
        P.site_scores(r.drop("TX_CURR"), sites, "2024 Q4")
    r = with_null_measures(r, R.SCORE_INDICATORS)
    out = P.site_scores(r, sites, "2024 Q4", partners=["ECHO", "MISAU"],
                        extra=P.tpt_scores(tpt)).collect()
    # s2 has no clinical partner (null != 'MISAU' is null): dropped like the R filter
    assert [x.datim_uid for x in out] == ["s3", "s1"]                 # ordered by score_clin
    s1 = [x for x in out if x.datim_uid == "s1"][0]
    assert s1.value_txcurr == 130.0 and s1.score_txcurr == 5          # < 700
    assert s1.score_tpt == 5                                          # > 0.9
    assert s1.value_txml is not None and s1.value_txml == 0.0         # no TX_ML in 2024 Q4
    # without-volume total sums the columns whose name contains a listed pattern
    assert s1.score_clin_wo_volume == s1.score_tpt + s1.score_txtb + s1.score_txml \
        + s1.score_vlc + s1.score_vlc_ped + s1.score_vls + s1.score_vls_ped + s1.score_vls_pw
    assert s1.score_clin == sum(v for k, v in s1.asDict().items()
                                if k.startswith("score_") and k not in ("score_clin",
                                                                        "score_clin_wo_volume"))
    s3 = [x for x in out if x.datim_uid == "s3"][0]
    assert s3.score_clin == 0 and s3.value_txcurr is None


def test_waterfall_final(spark):
    cascade = spark.createDataFrame([
        ("u1", "2024 Q1", "HHS/CDC", "FGH", "old", "old", "old", "Male", "20-24", "15+", "Died",
         "TX_NEW", 1.0),
        ("W04POMswKUF", "2024 Q1", "HHS/CDC", "FGH", "S", "P", "n", "Male", "20-24", "15+", None,
         "TX_NEW", 9.0),
        ("siMZUtd2cJW", "2024 Q1", "DOD", "JHPIEGO-DoD", "S", "P", "n", "Male", "20-24", "15+",
         None, "TX_RTT", 2.0),
        ("u1", "2024 Q1", "HHS/CDC", "FGH", "S", "P", "n", "Male", "20-24", "15+", None, "TX_RTT",
         None)],
        "datim_uid string, period string, funding_agency string, partner_recode string, "
        "snu1 string, psnu string, sitename string, sex string, ageasentered string, "
        "agecoarse string, otherdisaggregate string, indicator string, value double")
    hist = spark.createDataFrame([("u2", "S", "P", "n", "2024 Q1", "ECHO", "Female", "05-09", 4.0)],
                                 "datim_uid string, snu string, psnu string, sitename string, "
                                 "period string, partner string, sex string, ageasentered string, "
                                 "TX_RTT double")
    units = spark.createDataFrame([("u1", "A", "B", "C"), ("siMZUtd2cJW", "A", "B", "D")],
                                  "datim_uid string, snu1 string, psnu string, sitename string")
    sites = spark.createDataFrame(
        [("u1", "s1", 1, True, 2.0, 3.0, "y", 1.0, 1.0, None, 0.0)],
        "datim_uid string, sisma_uid string, site_nid int, grm_sernap boolean, latitude double, "
        "longitude double, program_x string, his_epts double, his_emr double, his_idart double, "
        "his_disa double")
    out = P.waterfall_final(cascade, P.transfer_in(hist), units, sites)
    assert out.columns == [
        "datim_uid", "sisma_uid", "site_nid", "period", "funding_agency", "partner_recode",
        "grm_sernap", "snu1", "psnu", "sitename", "latitude", "longitude", "program_x", "his_epts",
        "his_emr", "his_idart", "his_disa", "sex", "ageasentered", "agecoarse",
        "otherdisaggregate", "indicator", "value"]
    got = {(r.datim_uid, r.indicator): (r.snu1, r.sitename, r.sisma_uid, r.value)
           for r in out.collect()}
    assert got == {("u1", "TX_NEW"): ("A", "C", "s1", 1.0),
                   ("siMZUtd2cJW", "TX_RTT"): ("_Military Mozambique",) * 2 + (None, 2.0),
                   ("u2", "TX_RTT_SUP"): (None, None, None, 4.0)}
    with pytest.raises(Exception, match="his_disa"):
        P.waterfall_final(cascade, P.transfer_in(hist), units, sites.drop("his_disa"))


def test_submission_reports_replace_their_quarter(spark, tmp_path):
    site_map = spark.createDataFrame(
        [("u1", "s1", 1, "ECHO", "yes", "S2", "P2", "N2", 5.0, "x", 1.0, "no")],
        "datim_uid string, sisma_uid string, site_nid int, partner_pepfar_clinical string, "
        "grm_sernap string, snu string, psnu string, sitename string, latitude double, "
        "support_x string, his_epts double, security_insecure string")
    kp = "datim_uid string, snu string, psnu string, sitename string, period string, " \
         "pop_type string, keypop string, age string, TX_CURR double"
    one = spark.createDataFrame([("u1", "S", "P", "n", "2024 Q1", "KP", "MSM", "All", 1.0),
                                 ("u1", "S", "P", "n", "2024 Q2", "KP", "MSM", "All", 2.0)], kp)
    again = spark.createDataFrame([("u1", "S", "P", "n", "2024 Q2", "KP", "MSM", "All", 5.0),
                                   ("u1", "S", "P", "n", "2024 Q2", "KP", "MSM", "All", 2.0)], kp)
    table = str(tmp_path / "kp")
    P.kp_report(one, table, site_map)
    hist, uncoded = P.kp_report(again, table, site_map)
    assert sorted((r.period, r.sitename, r.TX_CURR) for r in hist.collect()) == [
        ("2024 Q1", "N2", 1.0), ("2024 Q2", "N2", 7.0)]
    assert hist.columns[:4] == ["datim_uid", "sisma_uid", "site_nid", "period"]
    assert hist.columns[-1] == "TX_CURR" and uncoded.count() == 0

    vl = spark.createDataFrame(
        [("u1", "S", "P", "n", "2024 Q1", "F", "All", "Age", None, None, "r", "src", "TX_PVLS", 3.0),
         ("u7", "S", "P", "m", "2024 Q1", "F", "All", "Age", None, None, "r", "src", "TX_PVLS", 4.0)],
        "datim_uid string, snu string, psnu string, sitename string, period string, sex string, "
        "age string, pop_type string, pop_subtype string, keypop string, motive string, "
        "source string, indicator string, value double")
    hist, orphan_sites = P.vl_report(vl, str(tmp_path / "vl"), site_map)
    assert hist.columns == ["datim_uid", "sisma_uid", "site_nid", "period",
                            "partner_pepfar_clinical", "grm_sernap", "snu", "psnu", "sitename",
                            "latitude", "support_x", "his_epts", "security_insecure", "sex", "age",
                            "pop_type", "pop_subtype", "keypop", "motive", "source", "indicator",
                            "value"]
    assert sorted((r.datim_uid, r.sitename, r.value) for r in hist.collect()) == [
        ("u1", "N2", 3.0), ("u7", None, 4.0)]
    assert [r.datim_uid for r in orphan_sites.collect()] == ["u7"]


def test_score_history_takes_the_sites_names(spark):
    hist = spark.createDataFrame([("u1", "2024 Q1", 3, 0.2, 7)],
                                 "datim_uid string, period string, score_a int, value_a double, "
                                 "score_clin int")
    sites = spark.createDataFrame([("u1", "S", "P", "N")],
                                  "datim_uid string, snu string, psnu string, sitename string")
    out = P.score_history(hist, sites)
    assert out.columns == ["snu", "psnu", "sitename", "datim_uid", "period", "score_a",
                           "score_clin"]
    assert tuple(out.first()) == ("S", "P", "N", "u1", "2024 Q1", 3, 7)


def test_yearly_layouts_choose_each_years_district_columns(spark):
    from pyspark.sql import types as T
    from indicata.plans import rules as R
    canon = T.StructType.fromDDL("orgunituid string, psnu string, psnuuid string, mech_name string")
    rows = [("a", "old", "o1", "s2", "s2u", "c22", "c22u", "Ariel", "x")]
    names = ["orgunituid", "psnu", "psnuuid", "snu2", "snu2uid", "cop22_psnu", "cop22_psnuuid",
             "mech_name", "country"]
    df = spark.createDataFrame(rows, names)
    out = {}
    for year in R.SITE_LAYOUTS:
        got = P.union_extracts(P.yearly_extracts({year: df}, R.SITE_LAYOUTS, canon))
        out[year] = tuple(got.first())
    assert out == {"2021": ("a", "old", "o1", "ARIEL"), "2022": ("a", "s2", "s2u", "ARIEL"),
                   "2023": ("a", "c22", "c22u", "ARIEL"), "2024_2025": ("a", "c22", "c22u", "ARIEL")}
    out = {}
    for year in R.PSNU_LAYOUTS:
        got = P.union_extracts(P.yearly_extracts({year: df}, R.PSNU_LAYOUTS, canon))
        out[year] = got.first()["psnu"]
    assert out == {"2022": "c22", "2023": "old", "2024_2025": "old"}


def test_yearly_extract_without_a_renamed_column_is_an_error(spark):
    from pyspark.sql import types as T
    from indicata.plans import rules as R
    df = spark.createDataFrame([("a", "p")], "orgunituid string, psnu string")
    with pytest.raises(ValueError, match="snu2"):
        P.yearly_extracts({"2022": df}, R.SITE_LAYOUTS, T.StructType([]))
    with pytest.raises(KeyError):
        P.yearly_extracts({"1999": df}, R.SITE_LAYOUTS, T.StructType([]))


def test_bundled_long_rules_all_run_in_a_query(spark):
    from indicata.plans.catalog import QUERIES
    found = {r.indicator for r in QUERIES["targets_bundled"](spark, "/root/testdata/sf0.001").collect()}
    assert {r["label"] for r in R.LONG_DERIVED} <= found


def test_every_derived_indicator_varies_in_the_results_table(spark):
    from indicata.plans import catalog_derived as D
    rows = D.q_results_derived(spark, "/root/testdata/sf0.001").collect()
    constant = [c for c in D.DERIVED_OUT if len({r[c] for r in rows if r[c] is not None}) < 2]
    assert len(D.DERIVED_OUT) == 36 and constant == []
