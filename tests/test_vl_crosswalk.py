"""The viral-load crosswalk at scale: what its steps write and how large their expressions grow."""

from datetime import date, datetime

from pyspark.sql import functions as F

from indicata.functions.periods import period_date, shifted
from indicata.plans import catalog_reports as C
from indicata.plans import proxy

DAYS = [datetime(1999, 5, 1), datetime(2000, 2, 1), datetime(2000, 8, 1), datetime(2001, 2, 1)]
ROWS = {
    "region": [(0, "AFRICA")],
    "nation": [(0, "KENYA", 0)],
    "supplier": [(1, "s1", 0, -5.0), (2, "s2", 0, 5.0)],
    "customer": [(1, "c1", 0, 0.0, "BUILDING")],
    "orders": [(1, 1, "O", 1.0, datetime(2000, 1, 1), "1-URGENT")],
    "lineitem": [(1, 1, site, n, 3.0 + n, 1.0, 0.0, 0.0, flag, "F", day)
                 for site in (1, 2) for flag in "RAN" for n, day in enumerate(DAYS)],
}


def _tables(spark, tmp_dir):
    for name, rows in ROWS.items():
        spark.createDataFrame(rows, proxy.TABLE_SCHEMAS[name]).write.parquet(f"{tmp_dir}/{name}.parquet")
    return tmp_dir


def test_supplemental_lines_before_the_start_are_left_out_by_day(spark, tmp_dir):
    sup, disa, _, _ = C._vl_inputs(spark, _tables(spark, tmp_dir))
    assert {r.period for r in sup.select("period").distinct().collect()} == {
        "2000 Q2", "2000 Q4", "2001 Q2"}
    assert disa.filter(F.col("period") < date(1999, 12, 20)).count() > 0  # its window begins earlier


def test_long_fact_keeps_a_row_s_quarters_side_by_side(spark, tmp_dir):
    sf_dir = _tables(spark, tmp_dir)
    store = C.results_store(spark, sf_dir)
    held = spark.read.parquet(f"{store}/long")
    # a label is written once for all quarters and shifted copies of the row
    assert {"qtr1", "qtr4", "cumulative", "targets"} <= set(held.columns)
    assert held.count() == 2 * 3 * 4  # sites, fiscal years, TX_CURR and TX_ML, TX_PVLS and PMTCT_ART
    wide = spark.read.parquet(f"{store}/wide")
    assert wide.count() > held.count()
    assert {"TX_CURR", "TX_CURR_3MO_PRIOR", "PMTCT_ART_12MO"} <= {
        r[0] for r in wide.select("indicator_temp").distinct().collect()}


def test_dates_and_shifts_repeat_their_arguments_little(spark):
    # a filter on the date is moved below sums and copies, with the expressions of its arguments in
    # their places; methods past 8000 bytes of code are not compiled by the JVM
    assert str(period_date("f_y", "q_n")).count("q_n") <= 2
    assert str(period_date("f_y", "q_n")).count("f_y") == 1
    rows = [(fy, q) for fy in (1999, 2000, None) for q in (0, 1, 2, 3, 4, 5, None)]
    df = spark.createDataFrame(rows, "fy int, q int")
    month = {1: 12, 2: 3, 3: 6, 4: 9}
    got = {(r.fy, r.q): r.d for r in df.select("fy", "q", period_date("fy", "q").alias("d")).collect()}
    assert got == {(fy, q): date(fy - (q == 1), month[q], 20) if fy and q in month else None
                   for fy, q in rows}
    for k in (-6, -1, 0, 2, 5):
        fy, q = shifted("fy", "q", F.lit(k))
        for r in df.select("fy", "q", fy.alias("a"), q.alias("b")).collect():
            at = None if r.fy is None or r.q is None else r.fy * 4 + r.q - 1 + k
            assert (r.a, r.b) == ((None, None) if at is None else (at // 4, at % 4 + 1))
