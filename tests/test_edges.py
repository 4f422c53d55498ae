"""Edge cases of the operators: options off the main path, empty and null inputs."""

from pyspark.sql import functions as F

from indicata.operators.cohorts import shift_period
from indicata.operators.derive import apply_corrections
from indicata.operators.joins import map_indicator
from indicata.operators.measures import cumulative_share
from indicata.operators.reshape import pivot_sum, reshape_long
from indicata.operators.select import exclude_where
from indicata.operators.union import union_all


def test_shift_without_original(spark):
    df = spark.createDataFrame([("TX_CURR", 2024, 2, 1.0), ("HTS", 2024, 2, 2.0)],
                               "indicator string, fy int, q int, v double")
    out = shift_period(df, [(1, {"TX_CURR": "TX_CURR_3MO_PRIOR"})], keep_original=False)
    assert [(r.indicator, r.fy, r.q) for r in out.collect()] == [("TX_CURR_3MO_PRIOR", 2024, 3)]


def test_reshape_long_keep_null(spark):
    df = spark.createDataFrame([("s", 2023, None, 1.0)],
                               "s string, fiscal_year int, qtr1 double, qtr2 double")
    assert reshape_long(df).count() == 1
    assert reshape_long(df, keep_null=True).count() == 2


def test_pivot_on_absent_name(spark):
    df = spark.createDataFrame([("a", "N", 1.0)], "s string, i string, v double")
    out = pivot_sum(df, ["s"], "i", "v", ["N", "D"], fill_zero=True).first()
    assert (out.N, out.D) == (1.0, 0.0)


def test_corrections_do_not_match_null(spark):
    df = spark.createDataFrame([("u1", None), ("u1", "ARIEL")], "orgunituid string, mech_name string")
    out = apply_corrections(df, [({"orgunituid": "u1", "mech_name": "ARIEL"}, {"orgunituid": "u2"})])
    assert sorted((r.orgunituid, r.mech_name or "") for r in out.collect()) == \
        [("u1", ""), ("u2", "ARIEL")]


def test_exclude_where_with_column(spark):
    df = spark.range(5).withColumn("x", F.when(F.col("id") == 2, None).otherwise(F.col("id")))
    assert sorted(r.id for r in exclude_where(df, F.col("x") > 2).collect()) == [0, 1, 2]


def test_cumulative_share_all_zero(spark):
    df = spark.createDataFrame([(1, 0.0), (2, 0.0)], "k long, v double")
    plain = {r.k: r.v_cum_per for r in cumulative_share(df, "v", ["k"]).collect()}
    assert plain == {1: None, 2: None}                     # 0/0 is NA in R
    filled = {r.k: r.v_cum_per for r in cumulative_share(
        df, "v", ["k"], zero_total_share=1.0).collect()}
    assert filled == {1: 1.0, 2: 1.0}                      # replace_na(., 1)


def test_map_indicator_on_single_shared_key(spark):
    fact = spark.createDataFrame([("A", 1.0), ("B", 2.0)], "indicator string, value double")
    m = spark.createDataFrame([("A", "A2"), ("A", "A3")], "indicator string, indicator_new string")
    got = sorted((r.indicator, r.value) for r in map_indicator(fact, m).collect())
    assert got == [("A2", 1.0), ("A3", 1.0)]


def test_union_all_fills_missing_columns(spark):
    a = spark.createDataFrame([(1, "x")], "id int, a string")
    b = spark.createDataFrame([(2, 3.0)], "id int, b double")
    out = union_all([a, b])
    assert set(out.columns) == {"id", "a", "b"} and out.count() == 2
