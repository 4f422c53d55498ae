"""Viral-load and key-population submissions at scale: what the plans of their steps read and shuffle."""

import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from indicata.operators.union import Contract
from indicata.plans import catalog_reports as C
from indicata.plans import proxy
from indicata.sources.files import read_folder, read_tsv

NO_BROADCAST = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
ROWS = {
    "region": [(0, "AFRICA")],
    "nation": [(0, "KENYA", 0)],
    "supplier": [(1, "s1", 0, -5.0), (2, "s2", 0, 5.0)],
    "customer": [(1, "c1", 0, 0.0, "BUILDING")],
    "orders": [(1, 1, "O", 1.0, datetime(2000, 1, 1), "1-URGENT"),
               (2, 1, "O", 1.0, datetime(2000, 1, 1), "4-NOT SPECIFIED")],
    # two lines with a site uid, two whose order has none; the last two in the quarter handed in twice
    "lineitem": [(1, 1, 1, 1, 3.0, 1.0, 0.0, 0.0, "R", "F", datetime(2000, 2, 1)),
                 (2, 1, 1, 2, 4.0, 1.0, 0.0, 0.0, "R", "F", datetime(2000, 2, 1)),
                 (1, 1, 2, 3, 5.0, 1.0, 0.0, 0.0, "R", "F", datetime(2000, 8, 1)),
                 (2, 1, 2, 4, 6.0, 1.0, 0.0, 0.0, "R", "F", datetime(2000, 8, 1))],
}


@pytest.fixture()
def tables(spark, tmp_dir):
    for name, rows in ROWS.items():
        spark.createDataFrame(rows, proxy.TABLE_SCHEMAS[name]).write.parquet(f"{tmp_dir}/{name}.parquet")
    return tmp_dir


@pytest.fixture()
def large_sites(spark):
    """No table is small enough for a broadcast that is not asked for."""
    for key in NO_BROADCAST:
        spark.conf.set(key, "-1")
    yield
    for key in NO_BROADCAST:
        spark.conf.unset(key)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_history_takes_a_small_site_map_unshuffled(spark, tables):
    out = C.q_vl_submissions(spark, tables)
    plan = _plan(out)
    assert plan.count("Join [") == 1 and "BroadcastHashJoin [datim_uid" in plan
    got = {(r.snu, r.period, r.security_insecure): (r.n, r.v) for r in out.collect()}
    assert got == {("AFRICA", "2000 Q2", True): (1, 3.0), (None, "2000 Q2", None): (1, 4.0),
                   ("AFRICA", "2000 Q4", False): (1, 5.0), (None, "2000 Q4", None): (1, 6.0)}


@pytest.mark.parametrize("query", [C.q_vl_submissions, C.q_kp_submissions])
def test_history_meets_a_large_site_map_in_one_plain_join(spark, tables, large_sites, query):
    out = query(spark, tables)
    plan = _plan(out)
    # AQE deals out the rows without a uid only where both sides of the join are plain shuffles
    assert plan.count("Join [") == 1 and "SortMergeJoin [datim_uid" in plan
    assert sum(r.n for r in out.collect()) == 4


def test_lines_meet_suppliers_before_the_geography(spark, tables):
    fact = proxy.fact(spark, tables)
    joins = re.findall(r"(\w+Join) \[(\w+)#", _plan(fact))
    assert ("BroadcastHashJoin", "l_suppkey") in joins and ("SortMergeJoin", "l_suppkey") not in joins
    assert sorted((r.site_uid, r.sitename, r.psnu, r.snu1, r.value) for r in fact.collect()) == [
        (1, "s1", "KENYA", "AFRICA", 3.0), (1, "s1", "KENYA", "AFRICA", 4.0),
        (2, "s2", "KENYA", "AFRICA", 5.0), (2, "s2", "KENYA", "AFRICA", 6.0)]


def test_a_quarter_of_a_folder_is_filtered_in_parsing(spark, tmp_dir):
    with open(f"{tmp_dir}/a.csv", "w") as f:
        f.write('uid\tperiod\tv\nu1\t2000 Q4\t1\n""\t2000 Q4\t" "\nNA\t2000 Q3\t2\n\t""\t""\n'
                ' u2 \t "2000 Q4" \t"NA"\nu3\t2000 Q4\n')
    schema = T.StructType.fromDDL("uid string, period string, v string")
    sub = read_folder(spark, f"{tmp_dir}/*.csv", Contract(schema))
    quarter = sub.filter(F.col("period") == "2000 Q4")
    assert "EqualTo(period,2000 Q4)" in quarter._jdf.queryExecution().toString()
    key = lambda r: tuple(x or "" for x in r)
    assert sorted((tuple(r) for r in quarter.collect()), key=key) == [
        (None, "2000 Q4", " "), ("u1", "2000 Q4", "1"), ("u2", "2000 Q4", None), ("u3", "2000 Q4", None)]
    assert sorted((tuple(r) for r in sub.filter(F.col("uid").isNull()).collect()), key=key) == [
        (None, None, None), (None, "2000 Q3", "2"), (None, "2000 Q4", " ")]
    # with another null value an empty field, in quotes or not, is null as well
    plain = read_tsv(spark, f"{tmp_dir}/a.csv", schema, null_value="-")
    assert plain.filter("uid = '' or period = '' or v = ''").count() == 0
    assert plain.filter("uid = 'NA'").count() == 1
