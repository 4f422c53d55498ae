"""Operators on hand-written rows: nulls, ties, fan-out, ordering, windows."""

import datetime as dt
import random

import pytest

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from indicata.operators.cohorts import (anchor_windows, label_windows, relative_windows,
                                        rolling_sum, shift_period, trailing_cohort)
from indicata.operators.derive import apply_corrections, derive_indicators, derive_long
from indicata.operators.joins import (duplicate_keys, keep_with_any, map_indicator, orphans,
                                      refresh_attrs, restrict_to)
from indicata.operators.measures import (cumulative_share, group_sum, group_sum_rest,
                                         period_bounds, share_of_total, sum_when)
from indicata.operators.reshape import gather, pivot_sum, reshape_long, spread
from indicata.operators.select import drop_all_zero, exclude_where, fill_zero
from indicata.operators.union import Contract, align, union_all
from indicata.plans import rules as R


def _key(t):
    return tuple((v is None, v if v is not None else 0) for v in t)


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=_key)


def test_exclude_where_keeps_null_condition(spark):
    df = spark.createDataFrame([("MISAU", 2024, "X"), ("MISAU", 2024, None), ("MISAU", 2024, "MISAU"),
                                ("ECHO", 2024, "X")], "mech string, fy int, partner string")
    out = exclude_where(df, [[("mech", "==", "MISAU"), ("fy", "==", 2024),
                              ("partner", "not_in", ["MISAU", "Ministry of Health Mozambique"])]])
    # not_in keeps the null partner in the condition -> that row is excluded too
    assert rows(out, "mech", "partner") == [("ECHO", "X"), ("MISAU", "MISAU")]
    out2 = exclude_where(df, [[("mech", "==", "MISAU"), ("partner", "==", "X")]])
    assert ("MISAU", None) in rows(out2, "mech", "partner")   # null condition keeps the row


def test_group_sum_of_nothing_is_zero(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("b", 2.0)], "k string, v double")
    assert rows(group_sum(df, ["k"], ["v"]), "k", "v") == [("a", 0.0), ("b", 2.0)]


def test_group_sum_rest_and_fill_zero(spark):
    df = spark.createDataFrame([("s", "p", 1.0, None), ("s", "p", 2.0, 3.0)],
                               "site string, period string, TX_A double, tx_b double")
    out = group_sum_rest(df, "TX_")
    assert rows(out, "site", "TX_A", "tx_b") == [("s", 3.0, 3.0)]
    assert fill_zero(df, ["tx_b"]).filter(F.col("tx_b").isNull()).count() == 0


def test_drop_all_zero(spark):
    df = spark.createDataFrame([("a", 0.0, 0.0), ("b", 0.0, 1.0), ("c", None, 0.0)],
                               "s string, x double, y double")
    assert [r.s for r in drop_all_zero(df, ["x", "y"], "s").orderBy("s").collect()] == ["b", "c"]


def test_drop_all_zero_removes_every_row_of_the_uid(spark):
    df = spark.createDataFrame([("u", "A", 0.0), ("u", "B", 5.0), ("w", "C", 1.0)],
                               "uid string, sitename string, x double")
    assert rows(drop_all_zero(df, ["x"], "uid"), "uid", "sitename") == [("w", "C")]


def test_spread_fails_on_an_unlisted_name(spark):
    df = spark.createDataFrame([(1, "TX_CURR", 1.0), (2, "TX_OTHER", 9.0), (3, None, 2.0)],
                               "id int, ind string, v double")
    with pytest.raises(Exception, match="TX_OTHER"):
        spread(df, "ind", "v", ["TX_CURR"]).collect()
    assert spread(df, "ind", "v", ["TX_CURR", "TX_OTHER"]).count() == 3
    assert spread(df, "ind", "v", ["TX_CURR"], strict=False).count() == 3


def test_gather_fails_on_an_absent_column(spark):
    df = spark.createDataFrame([(1, 2.0)], "id int, A double")
    with pytest.raises(ValueError, match="B"):
        gather(df, ["id"], ["A", "B"])


def test_group_sum_rest_takes_names_that_contain_the_part(spark):
    df = spark.createDataFrame([("s", 1.0, 2.0), ("s", 3.0, 4.0)],
                               "site string, TX_A double, old_tx_b double")
    assert rows(group_sum_rest(df, "TX_"), "site", "TX_A", "old_tx_b") == [("s", 4.0, 6.0)]


def test_pivot_sum_zero_fill_vs_null_side(spark):
    df = spark.createDataFrame([("a", "N", 1.0), ("a", "N", 2.0), ("b", "D", 4.0)],
                               "s string, i string, v double")
    z = pivot_sum(df, ["s"], "i", "v", ["N", "D"], fill_zero=True)
    n = pivot_sum(df, ["s"], "i", "v", ["N", "D"], fill_zero=False)
    assert rows(z, "s", "N", "D") == [("a", 3.0, 0.0), ("b", 0.0, 4.0)]
    assert rows(n, "s", "N", "D") == [("a", 3.0, None), ("b", None, 4.0)]


def test_spread_then_gather_round_trip(spark):
    data = [(i, random.choice(["A", "B", "C"]), float(i)) for i in range(50)]
    df = spark.createDataFrame(data, "id int, ind string, v double")
    wide = spread(df, "ind", "v", ["A", "B", "C"])
    assert wide.count() == 50 and set(wide.columns) == {"id", "A", "B", "C"}
    back = gather(wide, ["id"], ["A", "B", "C"], names_to="ind", values_to="v")
    assert rows(back, "id", "ind", "v") == sorted(data)


def test_reshape_long_periods_and_nulls(spark):
    df = spark.createDataFrame([("s", 2022, 1.0, None, 0.0, 4.0, 5.0, None)],
                               "s string, fiscal_year int, qtr1 double, qtr2 double, qtr3 double, "
                               "qtr4 double, cumulative double, targets double")
    got = rows(reshape_long(df), "period_type", "period", "value")
    assert got == [("cumulative", "FY22", 5.0), ("results", "FY22Q1", 1.0),
                   ("results", "FY22Q3", 0.0), ("results", "FY22Q4", 4.0)]


def test_map_indicator_null_safe_with_fanout(spark):
    fact = spark.createDataFrame([("TX_CURR", None, 1.0), ("TX_CURR", "Age", 2.0),
                                  ("HTS", "Age", 3.0), ("X", "Age", 4.0)],
                                 "indicator string, standardizeddisaggregate string, value double")
    m = spark.createDataFrame([("TX_CURR", None, "TX_CURR"), ("TX_CURR", "Age", "TX_CURR"),
                               ("TX_CURR", "Age", "TX_CURR_AGE"), ("HTS", "Age", None)],
                              "indicator string, standardizeddisaggregate string, indicator_new string")
    out = map_indicator(fact, m)
    assert rows(out, "indicator", "value") == [("TX_CURR", 1.0), ("TX_CURR", 2.0),
                                               ("TX_CURR_AGE", 2.0)]


def test_semi_anti_refresh_and_dup_keys(spark):
    fact = spark.createDataFrame([(1, "old", 1.0), (2, "old", 2.0), (3, "old", 3.0)],
                                 "uid int, psnu string, v double")
    master = spark.createDataFrame([(1, "p1"), (2, "p2")], "uid int, psnu string")
    assert rows(restrict_to(fact, master.select("uid"), "uid"), "uid") == [(1,), (2,)]
    assert rows(orphans(fact, master, "uid"), "uid") == [(3,)]
    ref = refresh_attrs(fact, master, "uid", ["psnu"], overrides={2: {"psnu": "_Military"}})
    assert rows(ref, "uid", "psnu") == [(1, "p1"), (2, "_Military"), (3, None)]
    assert duplicate_keys(master.union(master.limit(1)), ["uid"]).count() == 1


def test_keep_with_any(spark):
    df = spark.createDataFrame([("A", None), ("A", 1.0), ("B", None)], "i string, t double")
    assert rows(keep_with_any(df, "i", "t"), "i") == [("A",), ("A",)]


def test_corrections_are_order_dependent(spark):
    df = spark.createDataFrame([("EjFYleP5G9K", "EGPAF", "x"), ("LqB6YZq9sG2", "MISAU", "y"),
                                ("siMZUtd2cJW", "ARIEL", "z"), ("oX9C1fOEzSk", "ARIEL", "w")],
                               "orgunituid string, mech_name string, sitename string")
    df = df.withColumns({"snu1": F.lit(None).cast("string"), "psnu": F.lit(None).cast("string"),
                         "psnuuid": F.lit(None).cast("string")})
    out = apply_corrections(df, R.CORRECTIONS)
    got = rows(out, "mech_name", "orgunituid", "sitename", "psnu")
    assert ("EGPAF", "LqB6YZq9sG2", "Chicavane CS", "Chonguene") in got
    # the MISAU rule runs after the EGPAF one but only matches MISAU rows: the swap holds
    assert ("MISAU", "EjFYleP5G9K", "Chizavane CS", "Mandlakaze") in got
    # the ARIEL uid rewrite is seen by the next rule (attributes of the new uid)
    ariel = [g for g in got if g[0] == "ARIEL"]
    assert ariel == [("ARIEL", "oX9C1fOEzSk", "Cadeia Central PS", "Matola")] * 2


def test_derive_indicators_sequential_semantics(spark):
    schema = ("otherdisaggregate string, TX_MMD double, TX_ML double, TX_RTT double, "
              "TX_CURR double, TX_NET_NEW double, TX_NEW double, PMTCT_EID double, "
              "ageasentered string, sex string, agecoarse string")
    df = spark.createDataFrame([
        ("ARV Dispensing Quantity - 3 to 5 months", 5.0, None, None, None, None, None, None, None, None, None),
        ("ARV Dispensing Quantity - Less than 3 months", 7.0, None, None, None, None, None, None, None, None, None),
        ("No Contact Outcome - Interruption in Treatment <3 Months Treatment", None, 3.0, None, None, None, None, None, None, None, None),
        (None, None, None, None, None, None, 4.0, None, None, None, None),
        (None, None, None, None, None, None, None, 6.0, "02 - 12 Months", None, None),
    ], schema)
    out = derive_indicators(df, R.DERIVED_INDICATORS).collect()
    assert out[0].TX_MMD_D == 5.0 and out[0].TX_MMD == 5.0
    assert out[1].TX_MMD_D == 7.0 and out[1].TX_MMD is None       # copy taken before restriction
    assert out[2].otherdisaggregate == "IIT 0-3m ART"
    assert out[2].TX_ML_IIT == 3.0 and out[2].TX_CIRA == 3.0      # TX_CIRA sees TX_ML_IIT
    assert out[2].TX_ML_IIT_3_Months_Less == 3.0 and out[2].TX_PatientLoss == 3.0
    assert out[3].TX_GainLoss_Unexpected == -4.0 and out[3].TX_CURR_Expected == 4.0
    assert out[4].PMTCT_EID_MOD == 6.0 and out[4].PMTCT_EID_MOD_2_12MO == 6.0  # null label counts
    assert "HTS_TST_PostANC" in df.transform(lambda d: derive_indicators(d, R.DERIVED_INDICATORS)).columns


def test_derive_long_relabels_in_one_scan(spark):
    df = spark.createDataFrame([
        ("TB_STAT", "TB_STAT", "Positive", "Newly Identified", None, None, 1.0),
        ("TB_STAT", "TB_STAT_D", "Positive", None, None, None, 2.0),
        ("TX_TB", "TX_TB_D", None, None, "Negative", "New", 3.0)],
        "indicator string, indicator_temp string, statushiv string, otherdisaggregate string, "
        "statustb string, hiv_treatment_status string, value double")
    got = rows(derive_long(df, R.LONG_DERIVED), "indicator_temp", "value")
    assert got == sorted([("TB_STAT", 1.0), ("TB_STAT_POS", 1.0), ("TB_STAT_POS_NEW", 1.0),
                          ("TB_STAT_D", 2.0), ("TB_STAT_D", 2.0),  # appended under its old label
                          ("TX_TB_D", 3.0), ("TX_TB_D_NEG", 3.0), ("TX_TB_D_NEG_NEW", 3.0)])


def test_shift_period_adds_relabelled_copies(spark):
    df = spark.createDataFrame([("TX_CURR", 2024, 4, 1.0), ("TB_PREV", 2024, 1, 2.0),
                                ("TX_CURR", 2024, None, 3.0), ("HTS", 2024, 2, 4.0)],
                               "indicator string, fy int, q int, v double")
    got = rows(shift_period(df, R.COHORT_SHIFTS), "indicator", "fy", "q", "v")
    assert ("TX_CURR_3MO_PRIOR", 2025, 1, 1.0) in got
    assert ("TX_CURR_6MO_PRIOR", 2025, 2, 1.0) in got
    assert ("TB_PREV_6MO_AFTER", 2023, 3, 2.0) in got
    assert ("TX_CURR_3MO_PRIOR", None, None, 3.0) in got        # cumulative rows: null period
    assert len(got) == 4 + 2 + 1 + 2


def test_anchor_windows_edges_and_labels(spark):
    dates = [dt.date(2022, 1, 20), dt.date(2022, 1, 19), dt.date(2022, 12, 20), dt.date(2022, 12, 21)]
    df = spark.createDataFrame([(d, f"p{i}", 1.0) for i, d in enumerate(dates)],
                               "date date, period string, v double")
    w = anchor_windows(df, "date", ["2022-12-20"], 11)
    assert rows(w, "date") == [(dt.date(2022, 1, 20),), (dt.date(2022, 12, 20),)]
    out = trailing_cohort(df, date="date", anchors=["2022-12-20"], months_back=11,
                          label=("indicator", "X"))
    assert set(rows(out, "date", "period", "indicator")) == {(dt.date(2022, 12, 20), "p2", "X")}


def test_relative_windows_with_scalar_bound(spark):
    base = [dt.date(2024, 9, 20), dt.date(2024, 6, 20), dt.date(2024, 3, 20), dt.date(2023, 12, 20),
            dt.date(2023, 9, 20), dt.date(2023, 6, 20)]
    df = spark.createDataFrame([(d, f"{d}", 1.0) for d in base], "date date, period string, v double")
    mx = df.agg(F.max("date")).scalar()
    w = relative_windows(df, "date", mx, R.PMTCT_ART_COHORT["windows"], window_col="k")
    counts = dict((r.k, r["count"]) for r in w.groupBy("k").count().collect())
    assert (counts[0], counts[1], counts[2], counts[3]) == (4, 4, 4, 3)
    lab = label_windows(w, "k", fixed={0: (mx, F.lit("latest"))})
    assert {r.period for r in lab.filter("k = 0").collect()} == {"latest"}
    assert {r.date for r in lab.filter("k = 1").collect()} == {dt.date(2024, 6, 20)}


def test_rolling_sum_null_until_full(spark):
    df = spark.createDataFrame([("a", i, float(i)) for i in range(1, 6)] + [("a", 5, 1.0)],
                               "s string, t int, v double")
    got = rows(rolling_sum(df, ["s"], "t", "v", 4), "t", "v_roll4")
    assert got == [(1, None), (2, None), (3, None), (4, 10.0), (5, 15.0)]


def test_cumulative_share_two_phase_equals_window(spark):
    random.seed(7)
    data = [(i, float(random.choice([0, 1, 5, 5, 5, 9, 20]))) for i in range(3000)]
    df = spark.createDataFrame(data, "k long, v double")
    w = Window.orderBy(F.col("v").desc(), "k").rowsBetween(Window.unboundedPreceding, 0)
    a = df.withColumn("v_cum", F.sum("v").over(w)).withColumn(
        "v_cum_per", F.col("v_cum") / sum(v for _, v in data))
    b = cumulative_share(df, "v", ["k"], num_partitions=7)
    assert rows(a, "k", "v_cum", "v_cum_per") == rows(b, "k", "v_cum", "v_cum_per")
    assert max(r.v_cum_per for r in b.collect()) == 1.0


def test_share_and_sum_when(spark):
    df = spark.createDataFrame([("x", "A", 1.0), ("x", "B", 3.0), ("y", "A", 4.0)],
                               "g string, t string, v double")
    s = share_of_total(df, "v", "share")
    assert rows(s, "v", "share") == [(1.0, 0.125), (3.0, 0.375), (4.0, 0.5)]
    out = sum_when(df, ["g"], {"a": (F.col("t") == "A", "v"), "n": (F.col("t") == "B", 1.0)})
    assert rows(out, "g", "a", "n") == [("x", 1.0, 1.0), ("y", 4.0, 0.0)]


def test_period_bounds_scalars(spark):
    df = spark.createDataFrame([(dt.date(2024, 3, 20), "2024 Q2", "TX_CURR"),
                                (dt.date(2024, 9, 20), "2024 Q4", "HTS")],
                               "date date, period string, indicator string")
    b = period_bounds(df, where=F.col("indicator") == "TX_CURR")
    r = df.select(b["max_date"].alias("m"), b["max_period"].alias("p")).first()
    assert r.m == dt.date(2024, 3, 20) and r.p == "2024 Q2"


def test_align_and_union_with_drift(spark):
    canon = T.StructType([T.StructField("uid", T.StringType()), T.StructField("psnu", T.StringType()),
                          T.StructField("fy", T.IntegerType())])
    a = spark.createDataFrame([("u1", "P", "2021", "x")], "uid string, snu2 string, fy string, junk string")
    b = spark.createDataFrame([("u2", 2023)], "uid string, fy int")
    a2 = align(a, Contract(canon, drop=["junk"], rename={"snu2": "psnu"}))
    out = union_all([a2, b], schema=canon)
    assert out.schema == canon
    assert rows(out, "uid", "psnu", "fy") == [("u1", "P", 2021), ("u2", None, 2023)]


def test_property_window_copies_equal_rolling_sum(spark):
    """Summing the copies of a 4-quarter trailing window equals the rolling
    4-row sum wherever all four quarters are present (SURVEY §5)."""
    from hypothesis import given, settings
    from hypothesis import strategies as st

    quarters = [dt.date(2022, 12, 20), dt.date(2023, 3, 20), dt.date(2023, 6, 20),
                dt.date(2023, 9, 20), dt.date(2023, 12, 20), dt.date(2024, 3, 20),
                dt.date(2024, 6, 20)]

    @settings(max_examples=8, deadline=None)
    @given(st.lists(st.integers(0, 50), min_size=len(quarters), max_size=len(quarters)))
    def check(values):
        rows = [("s", d, float(v)) for d, v in zip(quarters, values)]
        df = spark.createDataFrame(rows, "site string, date date, v double")
        anchors = [d.isoformat() for d in quarters]
        win = anchor_windows(df, "date", anchors, 9).groupBy("anchor").agg(
            F.sum("v").alias("w"), F.count(F.lit(1)).alias("n"))
        roll = rolling_sum(df, ["site"], "date", "v", 4)
        got = {r.anchor: r.w for r in win.filter("n = 4").collect()}
        want = {r.date: r.v_roll4 for r in roll.filter(F.col("v_roll4").isNotNull()).collect()}
        assert got == want and len(got) == len(quarters) - 3

    check()


def test_compiled_corrections_equal_rules_in_turn(spark):
    """Random rules over two matched columns, one of them reassigned on the way."""
    import random

    from indicata.operators.derive import apply_corrections, compile_corrections
    rng = random.Random(5)
    values = {"uid": ["a", "b", "c", None, "zz"], "mech": ["m", "n", None, "other"]}
    for _ in range(6):
        rules = [({c: rng.choice(values[c][:3 if c == "uid" else 2])
                   for c in rng.sample(["uid", "mech"], rng.randint(1, 2))},
                  {c: rng.choice([*filter(None, values.get(c, ["x", "y"])), None])
                   for c in rng.sample(["uid", "mech", "place"], rng.randint(1, 2))})
                 for _ in range(5)]
        rows = [(u, m, "p") for u in values["uid"] for m in values["mech"]]
        want = []
        for row in rows:
            now = dict(zip(("uid", "mech", "place"), row))
            for match, sets in rules:
                if all(v is not None and now[c] == v for c, v in match.items()):
                    now |= sets
            want.append(tuple(now.values()))
        got = apply_corrections(spark.createDataFrame(rows, "uid string, mech string, place string"),
                                rules)
        assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))
    # the plan has one join, however many rules
    sizes = []
    for n in (1, 40):
        rules = [({"uid": f"u{i}"}, {"place": f"p{i}"}) for i in range(n)]
        df = apply_corrections(spark.range(3).selectExpr("cast(id as string) uid", "'x' place"), rules)
        sizes.append(df._jdf.queryExecution().analyzed().toString().count("CASE WHEN"))
        assert len(compile_corrections(rules)[2]) == n
    assert sizes[0] == sizes[1]


def test_cumulative_share_shuffles_its_rows_once(spark):
    from indicata.operators.measures import cumulative_share
    df = spark.range(500).selectExpr("id", "cast(id % 7 as double) as v")
    out = cumulative_share(df, "v", ["id"], num_partitions=8)
    plan = out._jdf.queryExecution().executedPlan()
    text = plan.toString()
    assert "Window" in text and "Bucketed: true" in text
    rows = text.split("BroadcastExchange")[0]          # the rows' side; the other has one per range
    assert "Exchange hashpartitioning" not in rows and "Exchange rangepartitioning" not in rows
    got = sorted((r["v_cum"], r["v"], r["id"]) for r in out.collect())
    want, total = [], 0.0
    for i, v in sorted(((i, i % 7) for i in range(500)), key=lambda x: (-x[1], x[0])):
        total += v
        want.append((total, float(v), i))
    assert got == sorted(want)


def test_map_indicator_does_not_shuffle_the_fact_by_the_maps_keys(spark):
    from indicata.operators.joins import map_indicator
    fact = spark.createDataFrame([("a", "x", 1.0), ("b", None, 2.0)], "indicator string, d string, v double")
    m = spark.createDataFrame([("a", "x", "n"), ("b", None, "k")], "indicator string, d string, indicator_new string")
    out = map_indicator(fact, m)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    assert sorted(r.indicator for r in out.collect()) == ["k", "n"]
