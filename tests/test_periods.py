"""Fiscal period arithmetic (D1-D3, R6) including property tests."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from indicata.functions.periods import (fiscal_quarter, fiscal_year, period_date, period_label,
                                        period_range, quarter_number, shifted, split_period,
                                        suffix_denominator)


def test_fiscal_period_and_dates(spark):
    rows = [(dt.date(2023, 10, 1),), (dt.date(2023, 12, 31),), (dt.date(2024, 1, 1),),
            (dt.date(2024, 6, 30),), (dt.date(2024, 9, 30),)]
    df = spark.createDataFrame(rows, "d date").select(
        fiscal_year("d").alias("fy"), fiscal_quarter("d").alias("q"))
    df = df.select("fy", "q", period_label("fy", "q").alias("p"), period_date("fy", "q").alias("r"))
    got = [(r.fy, r.q, r.p, r.r) for r in df.collect()]
    assert got == [(2024, 1, "2024 Q1", dt.date(2023, 12, 20)),
                   (2024, 1, "2024 Q1", dt.date(2023, 12, 20)),
                   (2024, 2, "2024 Q2", dt.date(2024, 3, 20)),
                   (2024, 3, "2024 Q3", dt.date(2024, 6, 20)),
                   (2024, 4, "2024 Q4", dt.date(2024, 9, 20))]


def test_null_quarter_gives_null_period_and_date(spark):
    df = spark.createDataFrame([(2024, None)], "fy int, q int")
    r = df.select(period_label("fy", "q").alias("p"), period_date("fy", "q").alias("d")).first()
    assert r.p is None and r.d is None


def test_quarter_number_forms(spark):
    df = spark.createDataFrame([("2024 Q4",), ("FY22Q1",), ("FY22",), (None,)], "p string")
    assert [r.q for r in df.select(quarter_number("p").alias("q")).collect()] == [4, 1, None, None]


@settings(max_examples=20, deadline=None)
@given(st.integers(1990, 2030), st.integers(1, 4), st.integers(-9, 9))
def test_shift_then_unshift_is_identity(spark, fy, q, k):
    df = spark.createDataFrame([(fy, q)], "fy int, q int")
    fy2, q2 = shifted(F.col("fy"), F.col("q"), F.lit(k))
    back = df.select(fy2.alias("fy"), q2.alias("q"))
    fy3, q3 = shifted(F.col("fy"), F.col("q"), F.lit(-k))
    r = back.select(fy3.alias("fy"), q3.alias("q")).first()
    assert (r.fy, r.q) == (fy, q)


def test_shift_matches_reference_tables(spark):
    # +1: Q4 -> Q1 of next year; +2: Q3 -> Q1 next; -2: Q1 -> Q3 previous
    df = spark.createDataFrame([(2024, 4, 1), (2024, 3, 2), (2024, 1, -2), (2024, 2, -2)],
                               "fy int, q int, k int")
    fy2, q2 = shifted(F.col("fy"), F.col("q"), F.col("k"))
    got = [(r.fy, r.q) for r in df.select(fy2.alias("fy"), q2.alias("q")).collect()]
    assert got == [(2025, 1), (2025, 1), (2023, 3), (2023, 4)]


def test_period_range_and_split(spark):
    assert period_range("2024 Q1") == ("2023-10-01", "2024-01-01")
    assert period_range("2024 Q4") == ("2024-07-01", "2024-10-01")
    df = split_period(spark.createDataFrame([("2024 Q4",)], "period string"))
    r = df.first()
    assert (r.period, r.fy, r.quarter) == ("2024 Q4", 2024, "Q4")


def test_suffix_denominator_null_safe(spark):
    df = spark.createDataFrame([("TX_PVLS", "D"), ("TX_PVLS", "N"), ("TX_CURR", None)],
                               "i string, nd string")
    got = [r.x for r in df.select(suffix_denominator("i", "nd").alias("x")).collect()]
    assert got == ["TX_PVLS_D", "TX_PVLS", "TX_CURR"]
