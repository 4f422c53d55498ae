"""Small synthetic inputs with the canonical schemas (FIXTURES.md §1)."""

from pyspark.sql import types as T

S, D, I = T.StringType(), T.DoubleType(), T.IntegerType()

EXTRACT = T.StructType([T.StructField(n, t) for n, t in [
    ("orgunituid", S), ("sitename", S), ("snu1", S), ("psnu", S), ("psnuuid", S),
    ("sitetype", S), ("funding_agency", S), ("mech_name", S), ("dreams", S),
    ("indicator", S), ("numeratordenom", S), ("standardizeddisaggregate", S),
    ("categoryoptioncomboname", S), ("otherdisaggregate", S), ("sex", S), ("ageasentered", S),
    ("trendscoarse", S), ("modality", S), ("statushiv", S), ("statustb", S), ("statuscx", S),
    ("hiv_treatment_status", S), ("fiscal_year", I),
    ("qtr1", D), ("qtr2", D), ("qtr3", D), ("qtr4", D), ("cumulative", D), ("targets", D)]])


def row(uid, mech, ind, nd, fy, q, *, dis="Age/Sex", other=None, sex="Female", age="25-29",
        coarse="15+", cum=None, tgt=None, sitetype="Facility"):
    vals = [None, None, None, None]
    for i, v in q.items():
        vals[i - 1] = v
    return (uid, f"site {uid}", "Maputo", "Matola", "P1", sitetype, "HHS/CDC", mech, None, ind, nd,
            dis, None, other, sex, age, coarse, None, None, None, None, None, fy,
            *vals, cum, tgt)


def extract_rows():
    return [
        # TX_CURR at two sites over FY2023-FY2024, clinical partner known for s1 only
        row("s1", "ECHO", "TX_CURR", "N", 2024, {1: 100.0, 2: 110.0, 3: 120.0, 4: 130.0}, cum=130.0,
            tgt=150.0),
        row("s1", "ECHO", "TX_CURR", "N", 2023, {4: 90.0}),
        row("s2", "MISAU", "TX_CURR", "N", 2024, {1: 50.0, 2: 60.0}),
        # TX_ML with an IIT label (recoded), a transfer out and a null label
        row("s1", "ECHO", "TX_ML", "N", 2024, {2: 4.0},
            other="No Contact Outcome - Interruption in Treatment <3 Months Treatment"),
        row("s1", "ECHO", "TX_ML", "N", 2024, {2: 2.0}, other="No Contact Outcome - Transferred Out"),
        row("s1", "ECHO", "TX_ML", "N", 2024, {3: 1.0}),
        # PMTCT_ART over six quarters for the 12-month cohorts
        row("s1", "ECHO", "PMTCT_ART", "N", 2023, {3: 1.0, 4: 2.0}, other="Life-long ART, Already"),
        row("s1", "ECHO", "PMTCT_ART", "N", 2024, {1: 3.0, 2: 4.0, 3: 5.0, 4: 6.0}),
        # TB_PREV (denominator) shifted six months later
        row("s1", "ECHO", "TB_PREV", "D", 2024, {2: 7.0}, other="Life-long ART, New"),
        # excluded by the data-quality rule: MISAU mechanism, FY2024, partner not MISAU
        row("s3", "MISAU", "TX_NEW", "N", 2024, {1: 9.0}),
        # unmapped indicator: dropped by the indicator map
        row("s1", "ECHO", "UNMAPPED", "N", 2024, {1: 1.0}),
    ]


MAP_ROWS = [("TX_CURR", "Age/Sex", "TX_CURR"), ("TX_ML", "Age/Sex", "TX_ML"),
            ("PMTCT_ART", "Age/Sex", "PMTCT_ART"), ("TB_PREV", "Age/Sex", "TB_PREV"),
            ("TX_NEW", "Age/Sex", "TX_NEW")]

SITE_MAP = T.StructType([T.StructField(n, t) for n, t in [
    ("datim_uid", S), ("latitude", D), ("longitude", D), ("partner_pepfar_clinical", S),
    ("grm_sernap", D), ("his_epts", D), ("program_ap3", D)]])
SITE_ROWS = [("s1", -25.9, 32.5, "ECHO", 1.0, None, 1.0), ("s2", -25.0, 32.0, None, None, 1.0, None),
             ("s3", -24.0, 33.0, "FGH", None, None, None)]

NAMES = ["TX_CURR", "TX_ML", "PMTCT_ART", "TB_PREV_D", "TX_NEW", "TX_CURR_3MO_PRIOR",
         "TX_ML_3MO_PRIOR", "TX_CURR_6MO_PRIOR", "TB_PREV_D_6MO_AFTER", "PMTCT_ART_12MO"]
