"""Bundled rule set: the literal business rules of the indicator reports.

Fixed values: every list, dictionary, band and anchor below must equal the
values the reports were defined with, so results match.  They are data,
passed to the generic operators; nothing here is executed.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Partner and indicator lists
# ---------------------------------------------------------------------------

# Indicators whose partner is the site's clinical partner (partner attribution).
CLINICAL_INDICATORS = [
    "TX_CURR", "TX_ML", "TX_NET_NEW", "TX_RTT", "TX_PVLS", "TX_NEW", "TX_TB",
    "TB_PREV", "TB_ART", "TB_STAT", "PMTCT_STAT", "PMTCT_STAT_POS", "PMTCT_ART",
    "PMTCT_EID", "PMTCT_HEI_POS",
]

# Site scoring: indicators kept in the long base, and the partners scored.
# "JHPEIGO" is spelled as in the original list (it matches no partner).
SCORE_INDICATORS = [
    "TX_CURR", "TX_CURR_6MO_PRIOR", "TX_ML", "TX_PVLS_PLW", "TX_PVLS_PLW_D",
    "TX_PVLS_D", "TX_PVLS", "TX_TB_D", "PMTCT_STAT_POS", "PMTCT_EID_D",
    "PMTCT_EID_MOD", "PMTCT_EID_Less_Equal_Two_Months", "PMTCT_HEI_POS",
]
SCORE_PARTNERS = ["ECHO", "EGPAF", "FGH", "ICAP", "CCS", "JHPEIGO", "ARIEL", "ITECH"]

# Site type (running share reports): clinical partners.
CLINICAL_PARTNERS_SITE_TYPE = ["JHPIEGO-DoD", "CCS", "ECHO", "FGH", "EGPAF", "ICAP", "ARIEL"]

# Support classification: clinical partners (MISAU included).
CLINICAL_PARTNERS_SUPPORT = ["ARIEL", "CCS", "ECHO", "EGPAF", "FGH", "ICAP", "ITECH",
                             "JHPIEGO-DoD", "MISAU"]

# Funding agency by partner; every other partner is HHS/CDC.
FUNDING_AGENCY = {"ECHO": "USAID", "JHPIEGO-DoD": "DOD"}
FUNDING_AGENCY_DEFAULT = "HHS/CDC"

# Age bands.
AGES_50_PLUS = ["50-54", "55-59", "60-64", "65+"]
AGES_UNDER_15 = ["<01", "01-04", "05-09", "10-14"]
WATERFALL_50_PLUS_PERIODS = ["2022 Q3", "2022 Q4", "2023 Q1"]
WATERFALL_START_DATE = "2022-06-20"
WATERFALL_EXCLUDED_AGES = ["<15", "15+"]

# ---------------------------------------------------------------------------
# Recode dictionaries
# ---------------------------------------------------------------------------

MECH_NAME_RECODE = {
    # clinical partners
    "Efficiencies for Clinical HIV Outcomes (ECHO)": "ECHO",
    "Friends in Global Health": "FGH",
    "Ariel": "ARIEL",
    "Clinical Services System Strenghening (CHASS)": "CHASS",
    "Ministry of Health Mozambique": "MISAU",
    # placeholders
    "[Placeholder - 160448 Mozambique HHS/CDC]": "ARIEL",
    "[Placeholder - 160450 Mozambique HHS/CDC]": "EGPAF",
    "[Placeholder - 160467 Mozambique USAID]": "ICRH-KP",
    "[Placeholder - 160472 Mozambique USAID]": "VMMC Local Activity",
    "[Placeholder - 160466 Mozambique USAID]": "OCSIDA",
    # prevention partners
    "Integrated HIV Prevention and Health Services for Key and Priority Populations (HIS-KP)": "Passos",
    "Key & Priority Populations (KPP) Local Activity in Mozambique/PASSOS+": "Passos",
    "Service Delivery and Support for Orphans and Vulnerable Children": "COVIDA",
    "Community Based HIV Services for the Southern Region": "Hlayissa",
    "Community HIV Activity in Zambezia": "Nweti",
    "OVC Response (Sofala)": "COMUSANAS",
    "OVC Response (Manica)": "ANDA",
    "Strengthen Family and Community Support to Orphan and Vunerable Children (FORCA Project)": "FORCA",
    "VMMC Services in Manica and Tete": "VMMC M/T",
    "Voluntary Medical Male Circumcision (VMMC) Local Activity in Mozambique": "VMMC M/T",
    "Voluntary Medical Male Circumcision (VMMC) Local Activity": "VMMC M/T",
    "Communication for Improved Health Outcomes (CIHO)": "CIHO",
    "Food and Nutrition Technical Assistance III (FANTA-III)": "FANTA-III",
    "Strengthening High Impact Interventions for an AIDS-Free Generation (AIDSFree) Project": "AIDSFree",
    "YouthPower Implementation -  Task Order 1": "YouthPower",
    "SCIP Zambezia": "SCIP",
    "HIV Community-Based Services (Nampula)": "HIV CBS (Nampula)",
    "Facilitating Impact that Lasts for Orphans and Vulnerable Children (FILOVC)": "FILOVC",
    # DoD partner
    "FADM HIV Treatment Scale-Up Program": "JHPIEGO-DoD",
    "FADM Prevention and Circumcision Program": "JHPIEGO-DoD",
    "JHPIEGO CORPORATION": "JHPIEGO-DoD",
    "FADM PCP": "JHPIEGO-DoD",
    # CDC partner
    "JHPIEGO Corporation": "JHPIEGO",
    "JHPIEGO HRH": "JHPIEGO",
    "Johns Hopkins": "JHPIEGO",
    # capacity building
    "Capacity Building for Sustainable HIV Services": "CBSHS",
    # state and peace corps
    "Integrating Early Child Development (ECD - GDA)": "ECD-GDA",
    "P/E Quick Impact Program": "P/E QIP",
    "United States Peace Corps/ Mozambique": "USPC",
    "Management and Operations": "USPC",
}

MODALITY_RECODE = {"Index": "Index Facility", "IndexMod": "Index Community"}

OTHERDISAGGREGATE_RECODE = {
    "No Contact Outcome - Interruption in Treatment <3 Months Treatment": "IIT 0-3m ART",
    "No Contact Outcome - Interruption in Treatment 3-5 Months Treatment": "IIT 3-5m ART",
    "No Contact Outcome - Interruption In Treatment 6+ Months Treatment": "IIT 6+m ART",
    "No Contact Outcome - Interruption in Treatment 3+ Months Treatment": "IIT 3+m ART",
    "No Contact Outcome - Transferred Out": "Transferred Out",
    "No Contact Outcome - Died": "Died",
    "No Contact Outcome - Refused Stopped Treatment": "Refused/Stopped ART",
}

# Viral-load source harmonisation.
VL_INDICATOR_RECODE = {"TX_PVLS_N": "TX_PVLS"}
VL_SOURCE_RECODE = {"Clinical Module": "EPTS-Clinical", "Lab Module": "EPTS-Lab"}
TRN_INDICATOR_RECODE = {"TX_RTT": "TX_RTT_SUP"}

# Sites left out of the transfer-in history, and the site that is shown by a fixed label.
SITE_REMOVAL = ["jKg6rpNATKH_ITECH", "W04POMswKUF"]
MILITARY_SITE = ("siMZUtd2cJW", "_Military Mozambique")

# Column order of the final tables; a star stands for any rest of a name.
WATERFALL_COLUMNS = ["datim_uid", "sisma_uid", "site_nid", "period", "funding_agency",
                     "partner_recode", "grm_sernap", "snu1", "psnu", "sitename", "*tude",
                     "program*", "his_epts", "his_emr", "his_idart", "his_disa", "sex", "age*",
                     "otherdisaggregate", "indicator", "value"]
KP_COLUMNS = ["datim_uid", "sisma_uid", "site_nid", "period", "partner_*", "grm_sernap", "snu",
              "psnu", "sitename", "*tude", "support*", "his*", "pop_type", "keypop", "age", "TX_*"]
VL_COLUMNS = ["datim_uid", "sisma_uid", "site_nid", "period", "partner_*", "grm_sernap", "snu",
              "psnu", "sitename", "*tude", "support*", "his*", "security_insecure", "sex", "age",
              "pop_type", "pop_subtype", "keypop", "motive", "source", "indicator", "value"]
SCORE_HISTORY_COLUMNS = ["snu", "psnu", "sitename", "datim_uid", "period", "score_*"]

# ---------------------------------------------------------------------------
# Ordered data corrections (uid, mechanism) -> new attributes.
# Each rule matches on the row as left by the previous rules; within a rule
# every assignment reads the row before the rule.
# ---------------------------------------------------------------------------

CORRECTIONS = [
    ({"orgunituid": "siMZUtd2cJW", "mech_name": "ARIEL"}, {"orgunituid": "oX9C1fOEzSk"}),
    ({"orgunituid": "oX9C1fOEzSk", "mech_name": "ARIEL"},
     {"sitename": "Cadeia Central PS", "snu1": "Maputo", "psnu": "Matola"}),
    ({"orgunituid": "siMZUtd2cJW", "mech_name": "ICAP"}, {"orgunituid": "oX9C1fOEzSk"}),
    ({"orgunituid": "oX9C1fOEzSk", "mech_name": "ICAP"},
     {"sitename": "Cadeia Central PS", "snu1": "Maputo", "psnu": "Matola"}),
    ({"orgunituid": "EjFYleP5G9K", "mech_name": "EGPAF"},
     {"psnu": "Chonguene", "sitename": "Chicavane CS", "orgunituid": "LqB6YZq9sG2"}),
    ({"orgunituid": "LqB6YZq9sG2", "mech_name": "MISAU"},
     {"psnu": "Mandlakaze", "psnuuid": "VjJPal9jqUi", "sitename": "Chizavane CS",
      "orgunituid": "EjFYleP5G9K"}),
    ({"orgunituid": "FWbL33AHdCC", "mech_name": "PSM"},
     {"sitename": "Mandlakazi HR", "orgunituid": "xlYle4v5GZ8"}),
    ({"orgunituid": "qM7gh9auEmt", "mech_name": "PSM"},
     {"sitename": "Massinga CS", "orgunituid": "wSW662GVwZP"}),
    ({"orgunituid": "W7CqwG3AuDh", "mech_name": "PSM"},
     {"sitename": "Chicuque HR", "orgunituid": "s28njgt1wYe"}),
    ({"orgunituid": "jKg6rpNATKH", "mech_name": "ITECH"}, {"orgunituid": "jKg6rpNATKH_ITECH"}),
    ({"orgunituid": "EslaBcDD5mZ"}, {"sitename": "Inhamizua CS", "orgunituid": "wmXdfKNX0qT"}),
]

# ---------------------------------------------------------------------------
# Data-quality exclusions (rows dropped when the rule is true;
# a null condition keeps the row).
# ---------------------------------------------------------------------------

EXCLUSIONS = [
    [[("mech_name", "==", "MISAU"), ("fy", "==", 2024),
      ("partner_recode", "not_in", ["MISAU", "Ministry of Health Mozambique"])]],
    [[("mech_name", "==", "MISAU"), ("fy", "==", 2024), ("quarter", "==", "Q2"),
      ("indicator", "in", CLINICAL_INDICATORS),
      ("orgunituid", "in", ["ub0cVLa8j1i", "jjWur7wj2v8"])]],
    [[("mech_name", "==", "MISAU"), ("fy", "==", 2024), ("quarter", "==", "Q2"),
      ("orgunituid", "in", ["WAVIEeXwnV6"])]],
]

# ---------------------------------------------------------------------------
# Cohort shifts (quarters, indicators, new labels).
# ---------------------------------------------------------------------------

COHORT_SHIFTS = [
    (1, {"TX_CURR": "TX_CURR_3MO_PRIOR", "TX_ML": "TX_ML_3MO_PRIOR"}),
    (2, {"PMTCT_EID_D": "PMTCT_EID_D_6MO_PRIOR", "TX_CURR": "TX_CURR_6MO_PRIOR",
         "TX_CURR_KP": "TX_CURR_KP_6MO_PRIOR"}),
    (-2, {"TB_PREV": "TB_PREV_6MO_AFTER", "TB_PREV_D": "TB_PREV_D_6MO_AFTER"}),
]

# 12-month PMTCT_ART cohorts: window k (0 = latest) covers
# [max - lo months, max - hi months]; the latest has no upper bound and a
# strict lower bound (date > max - 12 months).
PMTCT_ART_COHORT = {
    "indicator": "PMTCT_ART",
    "label": "PMTCT_ART_12MO",
    "windows": [(0, 12, None), (1, 14, 3), (2, 17, 6), (3, 20, 9), (4, 23, 12)],
}

# Trailing 12-month viral-load windows: anchor dates, months back (inclusive).
VL_ANCHORS = ["2022-12-20", "2023-03-20", "2023-06-20", "2023-09-20",
              "2023-12-20", "2024-03-20", "2024-06-20"]
VL_MONTHS_BACK = 11
VL_PROGRAMME_START = "2022-12-20"
# Source labels of the three viral-load series in the crosswalk.
VL_SOURCE_PROGRAMME = "MER"
VL_SOURCE_LAB = "DISA"
VL_SOURCE_MI = "MI"

# ---------------------------------------------------------------------------
# Site volume bands (TX_CURR at the latest period).
# ---------------------------------------------------------------------------

SITE_VOLUME_BANDS = [("Low", "<", 1000), ("Medium", "between", 1000, 5000), ("High", ">", 5000)]
SITE_VOLUME_DEFAULT = "Not Reported"

# ---------------------------------------------------------------------------
# Site score bands, in test order; unmatched -> 0.
# ---------------------------------------------------------------------------

BANDS_TXCURR = [(1, ">", 3500), (2, "between", 1500, 3499), (3, "between", 1000, 1490),
                (4, "between", 700, 999), (5, "<", 700)]
BANDS_TXCURR_PED = [(1, ">", 300), (2, "between", 150, 300), (3, "between", 80, 150),
                    (4, "between", 40, 80), (5, "<", 40)]
BANDS_VLC = [(1, "<", 0.5), (2, "between", 0.5, 0.6), (3, "between", 0.6, 0.75),
             (4, "between", 0.75, 0.9), (5, ">", 0.9)]
BANDS_VLS = [(1, "<", 0.7), (2, "between", 0.7, 0.8), (3, "between", 0.8, 0.9),
             (4, "between", 0.9, 0.95), (5, ">", 0.95)]
BANDS_PMTCT_POS = [(1, ">", 400), (2, "between", 200, 400), (3, "between", 120, 200),
                   (4, "between", 80, 120), (5, "<", 80)]
BANDS_HEI_POS = [(1, ">", 0.05), (2, "between", 0.04, 0.05), (3, "between", 0.03, 0.04),
                 (4, "between", 0.02, 0.03), (5, "<", 0.02)]
BANDS_EID_U2M = [(1, "<", 0.6), (2, "between", 0.6, 0.7), (3, "between", 0.7, 0.8),
                 (4, "between", 0.8, 0.9), (5, ">", 0.9)]
BANDS_TXTB = [(1, "<", 0.65), (2, "between", 0.65, 0.75), (3, "between", 0.75, 0.85),
              (4, "between", 0.85, 0.95), (5, ">", 0.95)]
BANDS_TXML = [(1, ">", 0.02), (2, "between", 0.015, 0.02), (3, "between", 0.01, 0.015),
              (4, "between", 0.005, 0.01), (5, "<", 0.005)]
BANDS_TPT = [(1, "<", 0.5), (2, "between", 0.5, 0.64), (3, "between", 0.64, 0.74),
             (4, "between", 0.74, 0.9), (5, ">", 0.9)]

# Score columns summed into score_clin_wo_volume: those whose name contains
# one of these strings (several match nothing, as in the original).
SCORE_WO_VOLUME_PATTERNS = ["score_tpt", "score_txtb", "score_txml", "score_vlc",
                            "score_vlc_u15", "score_vls", "score_vls_ped", "score_vls_pw",
                            "score_clin_eid_u2m", "score_clin_hei_pos"]

# Site score definitions, as data for operators.scoring.score_sites.
#   kind "sum":   value = sum of `num` rows
#   kind "ratio": value = ratio(num, den); fill0=True sums both sides with
#                 missing -> 0 (pivot then sum), fill0=False keeps a missing
#                 side null (sum then pivot); num_fill0 zero-fills the
#                 numerator only.
#   rows: "period" (scoring period), "window" (date in [max-9mo, max]),
#         "txtb" (max date, or max-3mo unless the period is Q2/Q4).
#   ped: restrict to agecoarse "<15".
SITE_SCORES = [
    {"name": "txcurr", "kind": "sum", "num": "TX_CURR", "rows": "period", "bands": BANDS_TXCURR},
    {"name": "txcurr_ped", "kind": "sum", "num": "TX_CURR", "rows": "period", "ped": True,
     "bands": BANDS_TXCURR_PED},
    {"name": "vlc", "kind": "ratio", "num": "TX_PVLS_D", "den": "TX_CURR_6MO_PRIOR",
     "rows": "period", "fill0": True, "bands": BANDS_VLC},
    {"name": "vlc_ped", "kind": "ratio", "num": "TX_PVLS_D", "den": "TX_CURR_6MO_PRIOR",
     "rows": "period", "ped": True, "fill0": True, "bands": BANDS_VLC},
    {"name": "vls", "kind": "ratio", "num": "TX_PVLS", "den": "TX_PVLS_D", "rows": "period",
     "fill0": True, "bands": BANDS_VLS},
    {"name": "vls_ped", "kind": "ratio", "num": "TX_PVLS", "den": "TX_PVLS_D", "rows": "period",
     "ped": True, "fill0": True, "bands": BANDS_VLS},
    {"name": "vls_pw", "kind": "ratio", "num": "TX_PVLS_PLW", "den": "TX_PVLS_PLW_D",
     "rows": "period", "fill0": True, "bands": BANDS_VLS},
    {"name": "pmtct_pos", "kind": "sum", "num": "PMTCT_STAT_POS", "rows": "window",
     "bands": BANDS_PMTCT_POS},
    {"name": "hei_pos", "kind": "ratio", "num": "PMTCT_HEI_POS", "den": "PMTCT_EID_MOD",
     "rows": "window", "fill0": False, "num_fill0": True, "bands": BANDS_HEI_POS},
    {"name": "eid_u2m", "kind": "ratio", "num": "PMTCT_EID_Less_Equal_Two_Months",
     "den": "PMTCT_EID_D", "rows": "window", "fill0": False, "bands": BANDS_EID_U2M},
    {"name": "txtb", "kind": "ratio", "num": "TX_TB_D", "den": "TX_CURR", "rows": "txtb",
     "fill0": True, "bands": BANDS_TXTB},
    {"name": "txml", "kind": "ratio", "num": "TX_ML", "den": "TX_CURR", "rows": "period",
     "fill0": True, "bands": BANDS_TXML},
]
SCORE_WINDOW_MONTHS = 9

# ---------------------------------------------------------------------------
# Derived indicators on the one-hot wide fact, applied in this
# order; each rule sees the columns as left by the rules before it.
#   {"out", "src", "when"}: src where the predicate holds, else null
#   {"out", "coalesce": [(column, sign), ...]}: first non-null signed term
#   {"out", "recode": dict, "col"}: dictionary recode of a label column
# ---------------------------------------------------------------------------

_IIT_ALL = ["IIT 0-3m ART", "IIT 3-5m ART", "IIT 6+m ART", "IIT 3+m ART"]
_IIT_3PLUS = ["IIT 3-5m ART", "IIT 6+m ART", "IIT 3+m ART"]
_ALREADY = ["IPT, Life-long ART, Already", "Life-long ART, Already"]
_NEW = ["IPT, Life-long ART, New", "Life-long ART, New"]
_POST_ANC = [[("fiscal_year", "<", 2024), ("modality", "==", "Post ANC1")],
             [("fiscal_year", ">", 2023),
              ("modality", "in", ["PMTCT Post ANC1 Breastfeeding", "PMTCT Post ANC1 Pregnant/L&D"])]]
_INDEX = ["Index Facility", "Index Community"]

DERIVED_INDICATORS = [
    {"out": "otherdisaggregate", "col": "otherdisaggregate", "recode": OTHERDISAGGREGATE_RECODE},
    {"out": "TX_MMD_D", "src": "TX_MMD", "when": None},
    {"out": "TX_MMD", "src": "TX_MMD", "when": [[("otherdisaggregate", "in", [
        "ARV Dispensing Quantity - 3 to 5 months", "ARV Dispensing Quantity - 6 or more months"])]]},
    {"out": "TX_CURR_FemaleAdult", "src": "TX_CURR",
     "when": [[("sex", "==", "Female"), ("agecoarse", "==", "15+")]]},
    {"out": "TX_ML_IIT", "src": "TX_ML", "when": [[("otherdisaggregate", "in", _IIT_ALL)]]},
    {"out": "TX_ML_IIT_3_Months_More", "src": "TX_ML",
     "when": [[("otherdisaggregate", "in", _IIT_3PLUS)]]},
    {"out": "TX_ML_IIT_3_Months_Less", "src": "TX_ML",
     "when": [[("otherdisaggregate", "==", "IIT 0-3m ART")]]},
    {"out": "TX_PatientLoss", "src": "TX_ML",
     "when": [[("otherdisaggregate", "!=", "Transferred Out")]]},
    {"out": "PMTCT_EID_MOD", "src": "PMTCT_EID",
     "when": [[("otherdisaggregate", "==", "EID First Test")], [("otherdisaggregate", "is_null")]]},
    {"out": "PMTCT_EID_MOD_2nd", "src": "PMTCT_EID",
     "when": [[("otherdisaggregate", "==", "EID Second Test or more")],
              [("otherdisaggregate", "is_null")]]},
    {"out": "PMTCT_EID_MOD_2_12MO", "src": "PMTCT_EID_MOD",
     "when": [[("ageasentered", "==", "02 - 12 Months")]]},
    {"out": "HTS_TST_PostANC", "src": "HTS_TST", "when": _POST_ANC},
    {"out": "HTS_TST_POS_PostANC", "src": "HTS_TST_POS", "when": _POST_ANC},
    {"out": "PMTCT_STAT_NEG", "src": "PMTCT_STAT", "when": [[("statushiv", "==", "Negative")]]},
    {"out": "PMTCT_ART_Already", "src": "PMTCT_ART",
     "when": [[("otherdisaggregate", "==", "Life-long ART, Already")]]},
    {"out": "HTS_TST_Female", "src": "HTS_TST", "when": [[("sex", "==", "Female")]]},
    {"out": "HTS_TST_Male", "src": "HTS_TST", "when": [[("sex", "==", "Male")]]},
    {"out": "HTS_TST_POS_Female", "src": "HTS_TST_POS", "when": [[("sex", "==", "Female")]]},
    {"out": "HTS_TST_POS_Male", "src": "HTS_TST_POS", "when": [[("sex", "==", "Male")]]},
    {"out": "HTS_TST_Index", "src": "HTS_TST", "when": [[("modality", "in", _INDEX)]]},
    {"out": "HTS_TST_POS_Index", "src": "HTS_TST_POS", "when": [[("modality", "in", _INDEX)]]},
    {"out": "OVC_SERV_Active", "src": "OVC_SERV", "when": [[("otherdisaggregate", "==", "Active")]]},
    {"out": "OVC_SERV_Graduated", "src": "OVC_SERV",
     "when": [[("otherdisaggregate", "==", "Graduated")]]},
    {"out": "TB_STAT_POS", "src": "TB_STAT", "when": [[("statushiv", "==", "Positive")]]},
    {"out": "TB_PREV_6MO_AFTER_Already", "src": "TB_PREV_6MO_AFTER",
     "when": [[("otherdisaggregate", "in", _ALREADY)]]},
    {"out": "TB_PREV_6MO_AFTER_New", "src": "TB_PREV_6MO_AFTER",
     "when": [[("otherdisaggregate", "in", _NEW)]]},
    {"out": "TB_PREV_D_6MO_AFTER_Already", "src": "TB_PREV_D_6MO_AFTER",
     "when": [[("otherdisaggregate", "in", _ALREADY)]]},
    {"out": "TB_PREV_D_6MO_AFTER_New", "src": "TB_PREV_D_6MO_AFTER",
     "when": [[("otherdisaggregate", "in", _NEW)]]},
    {"out": "TB_PREV_D_Already", "src": "TB_PREV_D", "when": [[("otherdisaggregate", "in", _ALREADY)]]},
    {"out": "TB_PREV_D_New", "src": "TB_PREV_D", "when": [[("otherdisaggregate", "in", _NEW)]]},
    {"out": "TX_TB_POS", "src": "TX_TB_D", "when": [[("statustb", "==", "Positive")]]},
    {"out": "TX_TB_NEG", "src": "TX_TB_D", "when": [[("statustb", "==", "Negative")]]},
    {"out": "TX_TB_NEG_Already", "src": "TX_TB_D",
     "when": [[("statustb", "==", "Negative"),
               ("otherdisaggregate", "==", "TB Screen - Negative, Life-long ART, Already")]]},
    {"out": "TX_TB_NEG_New", "src": "TX_TB_D",
     "when": [[("statustb", "==", "Negative"),
               ("otherdisaggregate", "==", "TB Screen - Negative, Life-long ART, New")]]},
    {"out": "TX_CIRA", "coalesce": [("TX_RTT", 1), ("TX_ML_IIT", 1)]},
    {"out": "TX_GainLoss_Unexpected", "coalesce": [("TX_NET_NEW", 1), ("TX_NEW", -1)]},
    {"out": "TX_CURR_Expected", "coalesce": [("TX_CURR", 1), ("TX_NET_NEW", -1), ("TX_NEW", 1)]},
]

# ---------------------------------------------------------------------------
# Long-form derived indicators on the PSNU targets table.
# A copy of each row matching `match_col == src` and the predicate is
# appended with indicator_temp relabelled src -> label (a row whose
# indicator_temp is not src keeps its label, as in the original).
# ---------------------------------------------------------------------------

LONG_DERIVED = [
    {"label": "TB_STAT_POS", "src": "TB_STAT", "match_col": "indicator",
     "when": [[("statushiv", "==", "Positive")]]},
    {"label": "TB_STAT_POS_NEW", "src": "TB_STAT", "match_col": "indicator",
     "when": [[("statushiv", "==", "Positive"), ("otherdisaggregate", "==", "Newly Identified")]]},
    {"label": "TB_STAT_POS_ALREADY", "src": "TB_STAT", "match_col": "indicator",
     "when": [[("statushiv", "==", "Positive"), ("otherdisaggregate", "==", "Known at Entry")]]},
    {"label": "TX_TB_D_POS", "src": "TX_TB_D", "match_col": "indicator_temp",
     "when": [[("statustb", "==", "Positive")]]},
    {"label": "TX_TB_D_POS_ALREADY", "src": "TX_TB_D", "match_col": "indicator_temp",
     "when": [[("statustb", "==", "Positive"), ("hiv_treatment_status", "==", "Already")]]},
    {"label": "TX_TB_D_POS_NEW", "src": "TX_TB_D", "match_col": "indicator_temp",
     "when": [[("statustb", "==", "Positive"), ("hiv_treatment_status", "==", "New")]]},
    {"label": "TX_TB_D_NEG", "src": "TX_TB_D", "match_col": "indicator_temp",
     "when": [[("statustb", "==", "Negative")]]},
    {"label": "TX_TB_D_NEG_ALREADY", "src": "TX_TB_D", "match_col": "indicator_temp",
     "when": [[("statustb", "==", "Negative"), ("hiv_treatment_status", "==", "Already")]]},
    {"label": "TX_TB_D_NEG_NEW", "src": "TX_TB_D", "match_col": "indicator_temp",
     "when": [[("statustb", "==", "Negative"), ("hiv_treatment_status", "==", "New")]]},
    {"label": "TB_PREV_NEW", "src": "TB_PREV", "match_col": "indicator_temp",
     "when": [[("hiv_treatment_status", "==", "New")]]},
    {"label": "TB_PREV_ALREADY", "src": "TB_PREV", "match_col": "indicator_temp",
     "when": [[("hiv_treatment_status", "==", "Already")]]},
    {"label": "TB_PREV_D_NEW", "src": "TB_PREV_D", "match_col": "indicator_temp",
     "when": [[("hiv_treatment_status", "==", "New")]]},
    {"label": "TB_PREV_D_ALREADY", "src": "TB_PREV_D", "match_col": "indicator_temp",
     "when": [[("hiv_treatment_status", "==", "Already")]]},
]

# Waterfall loss columns: TX_ML split by outcome label.
WATERFALL_LOSSES = [
    ("TX_ML_Died", "Died"),
    ("TX_ML_Interruption_u3", "IIT 0-3m ART"),
    ("TX_ML_Interruption_3_5", "IIT 3-5m ART"),
    ("TX_ML_Interruption_6o", "IIT 6+m ART"),
    ("TX_ML_Interruption_Transfer_Out", "Transferred Out"),
]

# ---------------------------------------------------------------------------
# Measures of the running share, and the indicators its first
# version reads from the site fact.
# ---------------------------------------------------------------------------

SHARE_MEASURES = ["HTS_TST_POS", "TX_CURR", "PMTCT_STAT", "PMTCT_STAT_POS", "PMTCT_HEI_POS",
                  "PMTCT_EID_D"]
V1_INDICATORS = ["HTS_TST_POS", "TX_CURR", "PMTCT_STAT", "PMTCT_STAT_POS", "PMTCT_HEI_POS",
                 "PMTCT_EID"]

# First version of the running share: sites left out as reporting duplicates, and
# sites counted for another mechanism.
V1_REMOVED_SITES = ["ChVIuS0HRZ8", "KzmQ90ne3V1", "ftbjGljVY2B"]
V1_MECH_OVERRIDES = {"FThJa71HEEs": "ICAP", "iJax0w1KHEN": "ICAP", "OgLIyzin181": "ICAP",
                     "FNUYBvpbWaA": "FGH", "EslaBcDD5mZ": "ECHO"}

# Second version: the ministry's sites under their graduated name.
V2_SITE_PARTNER_RECODE = {"MISAU": "MISAU Graduation"}

# ---------------------------------------------------------------------------
# Layouts of the yearly extracts, as columns left out and columns
# renamed.  Every other column is kept.
# ---------------------------------------------------------------------------

_SITE_DROP = ["country", "prime_partner_uei", "age_2018", "age_2019", "indicatortype", "source_name",
              "mech_code", "typemilitary", "prime_partner_name", "prime_partner_duns",
              "award_number", "community", "communityuid", "facilityuid", "operatingunituid",
              "facility", "operatingunit", "otherdisaggregate_sub", "approvallevel",
              "approvalleveldescription", "dataelementuid", "categoryoptioncombouid",
              "snuprioritization"]
_SITE_DROP_2022 = ["use_for_age", "target_age_2024", "target_modality_2024", "safe_for_net_new",
                   "safe_for_vlc"]
_SITE_2023 = {"drop": [*_SITE_DROP, "psnu", "psnuuid", "snu2", "snu2uid", "cop22_snuprioritization",
                       "local_prime_partner", *_SITE_DROP_2022],
              "rename": {"cop22_psnu": "psnu", "cop22_psnuuid": "psnuuid"}}
SITE_LAYOUTS = {
    "2021": {"drop": ["disaggregate", *_SITE_DROP], "rename": {}},
    "2022": {"drop": [*_SITE_DROP, "psnu", "psnuuid", "cop22_psnu", "cop22_psnuuid",
                      "cop22_snuprioritization", "is_indigenous_prime_partner", *_SITE_DROP_2022],
             "rename": {"snu2": "psnu", "snu2uid": "psnuuid"}},
    "2023": _SITE_2023,
    "2024_2025": _SITE_2023,
}

_PSNU_DROP = ["operatingunit", "operatingunituid", "country", "snuprioritization", "typemilitary",
              "prime_partner_name", "mech_code", "prime_partner_duns", "award_number",
              "indicatortype", "categoryoptioncomboname", "age_2018", "age_2019",
              "otherdisaggregate_sub", "source_name"]
_PSNU_2023 = {"drop": [*_PSNU_DROP, "cop22_psnu", "cop22_psnuuid"], "rename": {}}
PSNU_LAYOUTS = {
    "2022": {"drop": [*_PSNU_DROP, "psnu", "psnuuid"],
             "rename": {"cop22_psnu": "psnu", "cop22_psnuuid": "psnuuid"}},
    "2023": _PSNU_2023,
    "2024_2025": _PSNU_2023,
}
