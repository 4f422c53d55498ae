"""Sources and sinks: null policy, header-order union, idempotent history."""

import glob
import os

import pytest

from pyspark.sql import functions as F
from pyspark.sql import types as T

from indicata.operators.union import Contract
from indicata.sources.files import (export_period, read_folder, read_stage, read_tsv,
                                    upsert_period, write_stage, write_tsv)

SCHEMA = T.StructType([T.StructField("uid", T.StringType()), T.StructField("period", T.StringType()),
                       T.StructField("TX_CURR", T.DoubleType())])


def _write(path, text):
    with open(path, "w") as fh:
        fh.write(text)


def test_read_tsv_na_empty_and_trim(spark, tmp_dir):
    p = os.path.join(tmp_dir, "a.txt")
    _write(p, "uid\tperiod\tTX_CURR\n u1 \t2024 Q1\t5\nNA\t\tNA\nu3\t2024 Q2\tabc\n")
    rows = read_tsv(spark, p, SCHEMA).collect()
    assert (rows[0].uid, rows[0].period, rows[0].TX_CURR) == ("u1", "2024 Q1", 5.0)
    assert rows[1].uid is None and rows[1].period is None and rows[1].TX_CURR is None
    assert rows[2].TX_CURR is None            # unparsable number -> null, not a failed job


def test_write_tsv_null_policy(spark, tmp_dir):
    df = spark.createDataFrame([("u1", None, 1.0)], SCHEMA)
    for na, expect in (("NA", "u1\tNA\t1.0"), ("", "u1\t\t1.0")):
        out = os.path.join(tmp_dir, f"out_{na or 'empty'}")
        write_tsv(df.coalesce(1), out, na=na)
        part = [p for p in glob.glob(out + "/part-*") if p.endswith(".csv")][0]
        lines = open(part).read().splitlines()
        assert lines[0] == "uid\tperiod\tTX_CURR" and lines[1] == expect


def test_read_folder_aligns_by_name(spark, tmp_dir):
    d = os.path.join(tmp_dir, "subs")
    os.makedirs(d)
    _write(os.path.join(d, "p1.txt"), "uid\tperiod\tTX_CURR\nu1\t2024 Q1\t1\n")
    _write(os.path.join(d, "p2.txt"), "TX_CURR\tuid\tperiod\n2\tu2\t2024 Q1\n")
    _write(os.path.join(d, "p3.txt"), "period\tuid\n2024 Q2\tu3\n")
    out = read_folder(spark, d + "/*.txt", Contract(SCHEMA))
    got = sorted((r.uid, r.period, r.TX_CURR) for r in out.collect())
    assert got == [("u1", "2024 Q1", 1.0), ("u2", "2024 Q1", 2.0), ("u3", "2024 Q2", None)]


def test_upsert_period_replaces_only_that_period(spark, tmp_dir):
    table = os.path.join(tmp_dir, "hist")
    q1 = spark.createDataFrame([("u1", "2024 Q1", 1.0), ("u2", "2024 Q1", 2.0)], SCHEMA)
    q2 = spark.createDataFrame([("u1", "2024 Q2", 3.0)], SCHEMA)
    upsert_period(q1, table)
    upsert_period(q2, table)
    again = spark.createDataFrame([("u9", "2024 Q2", 9.0)], SCHEMA)
    hist = upsert_period(again, table)
    got = sorted((r.uid, r.period, r.TX_CURR) for r in hist.collect())
    assert got == [("u1", "2024 Q1", 1.0), ("u2", "2024 Q1", 2.0), ("u9", "2024 Q2", 9.0)]
    upsert_period(again, table)                # re-running a quarter is idempotent
    assert read_stage(spark, table).count() == 3


def test_stage_partition_pruning(spark, tmp_dir):
    path = os.path.join(tmp_dir, "stage")
    df = spark.range(100).select(F.col("id"), (F.col("id") % 4 + 2021).cast("int").alias("fy"))
    write_stage(df, path)
    q = read_stage(spark, path).filter(F.col("fy") == 2022)
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(fy" in plan and q.count() == 25


def test_export_period_folders(spark, tmp_dir):
    df = spark.createDataFrame([("u1", "2024 Q1", 1.0), ("u1", "2024 Q2", 2.0)], SCHEMA)
    out = os.path.join(tmp_dir, "export")
    export_period(df, out)
    names = sorted(os.path.basename(p) for p in glob.glob(out + "/period=*"))
    assert names == ["period=2024 Q1", "period=2024 Q2"]


def test_read_csv_and_source_tagging(spark, tmp_dir):
    from indicata.sources.files import read_csv, with_source_file
    p = os.path.join(tmp_dir, "sites.csv")
    _write(p, "datim_uid,snu,psnu,sitename\nu1,S,P,n1\nu2,S,P,\n")
    df = with_source_file(read_csv(spark, p, "datim_uid string, snu string, psnu string, "
                                               "sitename string"))
    rows = sorted((r.datim_uid, r.sitename) for r in df.collect())
    assert rows == [("u1", "n1"), ("u2", None)]
    assert all(r.source_file.endswith("sites.csv") for r in df.collect())


def test_file_headers_one_job(spark, tmp_dir):
    from indicata.sources.files import file_headers
    d = os.path.join(tmp_dir, "h")
    os.makedirs(d)
    for i in range(5):
        _write(os.path.join(d, f"f{i}.txt"), f"c{i}\tx\n" + "1\t2\n" * 50)
    got = {os.path.basename(k): v for k, v in file_headers(spark, d + "/*.txt").items()}
    assert got == {f"f{i}.txt": f"c{i}\tx" for i in range(5)}


def test_export_period_parquet(spark, tmp_dir):
    df = spark.createDataFrame([("u1", "2024 Q1", 1.0), ("u2", "2024 Q2", 2.0)], SCHEMA)
    out = os.path.join(tmp_dir, "export_pq")
    export_period(df, out, fmt="parquet")
    back = read_stage(spark, out).filter(F.col("period") == "2024 Q2")
    assert [(r.uid, r.TX_CURR) for r in back.collect()] == [("u2", 2.0)]


def test_history_keeps_columns_that_a_later_quarter_adds(spark, tmp_dir):
    table = os.path.join(tmp_dir, "drift")
    q1 = spark.createDataFrame([("u1", "2024 Q1", 1.0)], "uid string, period string, TX_A double")
    q2 = spark.createDataFrame([("u2", "2024 Q2", 2.0, 7.0)],
                               "uid string, period string, TX_A double, TX_B double")
    upsert_period(q1, table)
    got = sorted((r.uid, r.TX_A, r.TX_B) for r in upsert_period(q2, table).collect())
    assert got == [("u1", 1.0, None), ("u2", 2.0, 7.0)]
    contract = "uid string, TX_A double, TX_B double, period string"
    assert sorted((r.uid, r.TX_B) for r in upsert_period(q2, table, schema=contract).collect()) \
        == [("u1", None), ("u2", 7.0)]
    with pytest.raises(ValueError, match="TX_C"):
        upsert_period(q2.withColumn("TX_C", F.lit(1.0)), table, schema=contract)


def test_read_tsv_quotes_and_backslashes(spark, tmp_dir):
    p = os.path.join(tmp_dir, "quotes.txt")
    _write(p, 'uid\tperiod\tTX_CURR\n1\t"C:\\"\t5\n2\t"say ""hi"""\t6\n')
    got = [(r.uid, r.period, r.TX_CURR) for r in read_tsv(spark, p, SCHEMA).collect()]
    assert got == [("1", "C:\\", 5.0), ("2", 'say "hi"', 6.0)]


def test_bad_rows_lists_lines_that_do_not_fit(spark, tmp_dir):
    from indicata.sources.files import bad_rows
    p = os.path.join(tmp_dir, "bad.txt")
    _write(p, "uid\tperiod\tTX_CURR\nu1\t2024 Q1\t5\nu2\t2024 Q1\tabc\nu3\t2024 Q1\n")
    assert sorted(r.line.split("\t")[0] for r in bad_rows(spark, p, SCHEMA).collect()) == ["u2", "u3"]


def test_headers_read_no_more_than_a_line(spark, tmp_dir):
    from indicata.sources.files import file_headers
    from indicata.sources.headers import CHUNK, header_rows, list_files
    for i in range(70):                                   # more than one bundle
        with open(os.path.join(tmp_dir, f"part {i}.txt"), "w") as f:
            f.write(f"uid\tc{i}\r\n" + "x\t1\n" * (400_000 if i == 0 else 2))
    with open(os.path.join(tmp_dir, "long.txt"), "w") as f:
        f.write("h" * 3 * CHUNK)
    open(os.path.join(tmp_dir, "_hidden.txt"), "w").close()
    paths = list_files(spark, tmp_dir + "/*.txt")
    rows = header_rows(spark, paths).collect()
    assert len(rows) == 71 and max(r.read for r in rows) == 3 * CHUNK
    assert sum(r.read for r in rows) < 71 * CHUNK + 3 * CHUNK
    got = {os.path.basename(k): v for k, v in file_headers(spark, tmp_dir + "/*.txt").items()}
    assert got["part 5.txt"] == "uid\tc5" and got["long.txt"] == "h" * 3 * CHUNK


def test_refresh_history_rewrites_changed_periods_only(spark, tmp_dir):
    import glob

    from indicata.sources.files import refresh_history, write_stage
    table = os.path.join(tmp_dir, "hist")
    rows = [("a", "old", 1.0, "2024 Q1"), ("b", "B", 2.0, "2024 Q1"), ("b", "B", 3.0, "2024 Q2"),
            ("c", "C", 4.0, "2024 Q3"), (None, None, 5.0, "2024 Q2"), ("d", None, 6.0, "2024 Q4")]
    write_stage(spark.createDataFrame(rows, "uid string, name string, v double, period string"),
                table, partition_by=("period",))
    old = spark.createDataFrame([("a", "old"), ("b", "B"), ("c", "C")], "uid string, name string")
    new = spark.createDataFrame([("a", "new"), ("b", "B"), ("d", "D")], "uid string, name string")
    before = {f: os.path.getmtime(f) for f in glob.glob(table + "/*/*.parquet")}
    assert refresh_history(spark, table, old, new, "uid", ["name"]) == ["2024 Q1", "2024 Q3",
                                                                       "2024 Q4"]
    got = sorted(map(repr, map(tuple, spark.read.parquet(table).select("uid", "name", "v").collect())))
    assert got == sorted(map(repr, [("a", "new", 1.0), ("b", "B", 2.0), ("b", "B", 3.0),
                                    ("c", None, 4.0), (None, None, 5.0), ("d", "D", 6.0)]))
    after = {f: os.path.getmtime(f) for f in glob.glob(table + "/*/*.parquet")}
    assert {f for f in before if "Q2" in f} == {f for f in after if "Q2" in f}
    assert all(after[f] == before[f] for f in before if "Q2" in f)
    assert refresh_history(spark, table, new, new, "uid", ["name"]) == []
