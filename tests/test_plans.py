"""Physical-plan checks: the properties the scale design relies on."""

import os
import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from indicata.operators.cohorts import anchor_windows, shift_period
from indicata.operators.measures import group_sum
from indicata.operators.reshape import spread
from indicata.plans import rules as R

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_group_sum_combines_map_side(spark):
    df = spark.range(10000).select((F.col("id") % 3).alias("k"), F.col("id").cast("double").alias("v"))
    p = plan(group_sum(df, ["k"], ["v"]))
    assert "partial_sum" in p and p.count("Exchange hashpartitioning") == 1


def test_spread_is_narrow(spark):
    df = spark.range(100).select(F.when(F.col("id") % 2 == 0, "A").otherwise("B").alias("i"),
                                 F.col("id").cast("double").alias("v"))
    assert "Exchange" not in plan(spread(df, "i", "v", ["A", "B"]))


def test_shift_and_windows_are_single_scan_generates(spark):
    df = spark.range(100).select(F.lit("TX_CURR").alias("indicator"), F.lit(2024).alias("fy"),
                                 (F.col("id") % 4 + 1).cast("int").alias("q"),
                                 F.current_date().alias("date"))
    p1 = plan(shift_period(df, R.COHORT_SHIFTS))
    p2 = plan(anchor_windows(df, "date", R.VL_ANCHORS, R.VL_MONTHS_BACK))
    for p in (p1, p2):
        assert "Generate" in p and "Union" not in p and "Exchange" not in p
        assert "NestedLoopJoin" not in p and "Cartesian" not in p


def test_cumulative_share_range_partitions_balance_under_skew(spark):
    from indicata.operators.measures import cumulative_share
    random.seed(3)
    # a third of the rows share one value: the tie key splits them across partitions
    rows = [(i, 7.0 if i % 3 == 0 else float(random.randint(0, 1000))) for i in range(6000)]
    df = spark.createDataFrame(rows, "k long, v double")
    out = cumulative_share(df, "v", ["k"], num_partitions=6)
    sizes = [r["count"] for r in out.withColumn("p", F.spark_partition_id())
             .groupBy("p").count().collect()]
    assert max(sizes) < 2 * (6000 / 6)


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_period_filter_reaches_the_scan(spark):
    p = plan(E.queries()["coverage_score"](spark, SF))
    assert "GreaterThanOrEqual(l_shipdate" in p and "LessThan(l_shipdate" in p


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_no_python_udf_and_no_cartesian_in_any_query(spark):
    from indicata.plans import catalog
    for name, fn in sorted(catalog.QUERIES.items()):
        p = plan(fn(spark, SF))
        for node in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "CartesianProduct",
                     "BroadcastNestedLoopJoin", "ShuffledHashJoin"):
            assert node not in p, (name, node)


def test_hot_site_key_join_is_split_by_aqe(spark):
    from indicata.operators.joins import enrich
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.enabled": "true",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        # a third of the fact rows belong to site 0
        fact = spark.range(30000).select(
            F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 500).alias("site"),
            F.col("id").cast("double").alias("v"))
        dim = spark.range(500).select(F.col("id").alias("site"), F.lit("x").alias("name"))
        out = enrich(fact, dim, "site")
        qe = out._jdf.queryExecution()
        qe.toRdd().count()                       # run this plan: AQE finalises it
        assert "skew=true" in qe.executedPlan().toString()
        assert out.count() == 30000
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
