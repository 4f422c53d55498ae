"""The stored results table after an update equals one built anew, and an update touches only
what its quarters reach."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from indicata.plans import results_store as S
from indicata.plans import rules as R

NAMES = ["TX_CURR", "TX_ML", "PMTCT_ART", "TB_PREV", "TX_CURR_3MO_PRIOR", "TX_ML_3MO_PRIOR",
         "TX_CURR_6MO_PRIOR", "TB_PREV_6MO_AFTER", "PMTCT_ART_12MO"]
DERIVED = [{"out": "TX_CURR_F", "src": "TX_CURR", "when": [[("sex", "==", "Female")]]}]
EXTRACT = ("orgunituid string, sitename string, snu1 string, psnu string, mech_name string, "
           "indicator string, numeratordenom string, standardizeddisaggregate string, "
           "otherdisaggregate string, sex string, ageasentered string, trendscoarse string, "
           "sitetype string, funding_agency string, fiscal_year int, qtr1 double, qtr2 double, "
           "qtr3 double, qtr4 double, cumulative double, targets double")


def extract(spark, change=None, years=range(2019, 2024)):
    rows = []
    for fy in years:
        for site in range(6):
            for n, ind in enumerate(("TX_CURR", "TX_ML", "PMTCT_ART", "TB_PREV")):
                v = [float((fy - 2000) * 10 + site * 7 + n + q) * (30 if ind == "TX_CURR" else 1)
                     for q in range(4)]
                if fy == 2023:
                    v[2] = v[3] = None                    # not reported yet
                if change:
                    v = [change(fy, q + 1, site, ind, x) for q, x in enumerate(v)]
                rows.append((f"u{site}", f"S{site}", "P", "D", "ECHO", ind, "N", "all", None,
                             "Female" if site % 2 else "Male", "25-29", "15+",
                             "Facility" if site < 5 else "Community", "USAID", fy, *v,
                             sum(x for x in v if x is not None), 5.0 * n))
    return spark.createDataFrame(rows, EXTRACT)


@pytest.fixture()
def put(spark):
    mapping = spark.createDataFrame(
        [(i, "all", i) for i in ("TX_CURR", "TX_ML", "PMTCT_ART", "TB_PREV")],
        "indicator string, standardizeddisaggregate string, indicator_new string")
    partner = spark.createDataFrame([(f"u{i}", "ECHO") for i in range(4)],
                                    "datim_uid string, partner_pepfar_clinical string")

    def run(store, rows, quarters=None):
        return S.update_results(store, rows, mapping, partner, NAMES, quarters=quarters,
                                derived=DERIVED)
    return run


def content(spark, store):
    sites = spark.createDataFrame([(f"u{i}", "ECHO", 1.0) for i in range(4)],
                                  "datim_uid string, partner_pepfar_clinical string, his_epts double")
    out = S.read_results(spark, store, sites)
    return sorted(map(repr, out.select(*sorted(out.columns)).collect()))


def files(store):
    out = {}
    for f in glob.glob(f"{store}/wide/*/*.parquet"):
        out.setdefault(os.path.basename(os.path.dirname(f))[5:], set()).add(
            (f, os.path.getmtime(f)))
    return out


def doubled(fy, q):
    return lambda y, k, site, ind, v: 2 * v if v is not None and (y, k) == (fy, q) else v


CHANGES = {
    "a quarter with other values": ([(2020, 2)], doubled(2020, 2)),
    "the latest quarter": ([(2023, 2)], doubled(2023, 2)),
    "a new latest quarter": ([(2023, 3)], lambda y, k, s, i, v:
                             50.0 * s + 900 if (y, k) == (2023, 3) else v),
    "a quarter withdrawn": ([(2021, 1)], lambda y, k, s, i, v: None if (y, k) == (2021, 1) else v),
    "the latest quarter withdrawn": ([(2023, 2)], lambda y, k, s, i, v:
                                     None if (y, k) == (2023, 2) else v),
    "the cohorts' indicator alone": ([(2022, 1)], lambda y, k, s, i, v:
                                     v + 1 if (y, k, i) == (2022, 1, "PMTCT_ART") else v),
}


@pytest.mark.parametrize("name", CHANGES)
def test_update_equals_a_full_build(spark, put, tmp_dir, name):
    quarters, change = CHANGES[name]
    store, anew = f"{tmp_dir}/store", f"{tmp_dir}/anew"
    put(store, extract(spark))
    before = files(store)
    years = {fy for fy, _ in quarters}
    state = put(store, extract(spark, change, years=sorted(years)), quarters)
    put(anew, extract(spark, change))
    assert content(spark, store) == content(spark, anew)
    assert S.read_state(spark, store)["max_date"] == S.read_state(spark, anew)["max_date"]
    after, rebuilt = files(store), set(state["rebuilt"])
    assert set(after) == set(files(anew))
    kept = [p for p in before if p not in rebuilt]
    assert kept and all(after[p] == before[p] for p in kept)
    if name == "a quarter with other values":
        # two quarters back and two on (D3), its year's cumulative rows, and no window
        assert rebuilt == {"2019Q4", "2020Q2", "2020Q3", "2020Q4", "FY2020"}


def test_update_twice_and_state(spark, put, tmp_dir):
    store = f"{tmp_dir}/store"
    put(store, extract(spark))
    for _ in range(2):
        put(store, extract(spark, doubled(2022, 3), years=[2022]), [(2022, 3)])
    anew = f"{tmp_dir}/anew"
    put(anew, extract(spark, doubled(2022, 3)))
    assert content(spark, store) == content(spark, anew)


def test_reports_prune_partitions_of_the_store(spark, put, tmp_dir):
    store = f"{tmp_dir}/store"
    put(store, extract(spark))
    wide = spark.read.parquet(f"{store}/wide").filter(F.col("part") == "2020Q2")
    assert len(wide.inputFiles()) < len(spark.read.parquet(f"{store}/wide").inputFiles()) \
        or "part" in wide._jdf.queryExecution().executedPlan().toString()
    assert {r.period for r in wide.select("period").distinct().collect()} == {"2020 Q2"}


def test_store_equals_results_table(spark, put, tmp_dir):
    from indicata.plans import reports as P
    store, rows = f"{tmp_dir}/store", extract(spark)
    put(store, rows)
    mapping = spark.createDataFrame(
        [(i, "all", i) for i in ("TX_CURR", "TX_ML", "PMTCT_ART", "TB_PREV")],
        "indicator string, standardizeddisaggregate string, indicator_new string")
    sites = spark.createDataFrame([(f"u{i}", "ECHO", 1.0) for i in range(4)],
                                  "datim_uid string, partner_pepfar_clinical string, his_epts double")
    want = P.results_table(rows, mapping, sites, NAMES, derived=DERIVED)
    got = S.read_results(spark, store, sites)
    assert got.columns == want.columns
    assert content(spark, store) == sorted(map(repr, want.select(*sorted(want.columns)).collect()))
    assert R.PMTCT_ART_COHORT["windows"]


def test_rows_are_stored_narrow_and_unsorted(spark, put, tmp_dir, monkeypatch):
    opened, write = [], S.write_stage
    monkeypatch.setattr(S, "write_stage", lambda df, path, **k: (
        opened.append((os.path.basename(path), k.get("open_files", 0))), write(df, path, **k)))
    store = f"{tmp_dir}/store"
    put(store, extract(spark, years=range(2021, 2023)))
    held = spark.read.parquet(f"{store}/wide").columns
    assert {"indicator_temp", "value"} <= set(held) and not {"TX_CURR", "TX_CURR_F"} & set(held)
    assert {n for n, files in opened if files} == {"long", "wide"}
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


def test_an_unlisted_indicator_fails_the_update(spark, put, tmp_dir, monkeypatch):
    monkeypatch.setitem(globals(), "NAMES", NAMES[1:])
    with pytest.raises(Exception, match="not a listed name"):
        put(f"{tmp_dir}/store", extract(spark, years=range(2022, 2023)))
