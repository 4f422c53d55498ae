"""Streaming ingestion of a submission folder into the period history."""

import os

from pyspark.sql import types as T

from indicata.operators.union import Contract
from indicata.streaming.submissions import ingest_submissions, read_history, read_manifest

FILE = T.StructType([T.StructField("uid", T.StringType()), T.StructField("period", T.StringType()),
                     T.StructField("TX_CURR", T.StringType())])
CANON = T.StructType([T.StructField("uid", T.StringType()), T.StructField("period", T.StringType()),
                      T.StructField("TX_CURR", T.DoubleType())])


def _write(path, text):
    with open(path, "w") as fh:
        fh.write(text)


def test_incremental_ingest_is_exactly_once(spark, tmp_dir):
    src, hist, ckpt = (os.path.join(tmp_dir, n) for n in ("in", "hist", "ckpt"))
    os.makedirs(src)
    _write(os.path.join(src, "a.txt"), "uid\tperiod\tTX_CURR\nu1\t2024 Q1\t1\nu2\t2024 Q1\tNA\n")
    _write(os.path.join(src, "b.txt"), "uid\tperiod\tTX_CURR\nu3\t2024 Q2\t3\n")
    ingest_submissions(spark, src, FILE, Contract(CANON), hist, ckpt).awaitTermination()
    assert read_history(spark, hist).count() == 3
    # a second partner file for an already loaded quarter is added, not overwritten
    _write(os.path.join(src, "c.txt"), "uid\tperiod\tTX_CURR\nu4\t2024 Q1\t4\n")
    ingest_submissions(spark, src, FILE, Contract(CANON), hist, ckpt).awaitTermination()
    ingest_submissions(spark, src, FILE, Contract(CANON), hist, ckpt).awaitTermination()
    h = read_history(spark, hist)
    got = sorted((r.uid, r.period, r.TX_CURR) for r in h.collect())
    assert got == [("u1", "2024 Q1", 1.0), ("u2", "2024 Q1", None), ("u3", "2024 Q2", 3.0),
                   ("u4", "2024 Q1", 4.0)]
    assert h.schema["TX_CURR"].dataType == T.DoubleType()


def test_a_corrected_file_replaces_its_submission(spark, tmp_dir):
    """By name in another folder: corrected, repeated unchanged, and left alone."""
    src, hist, ckpt = (os.path.join(tmp_dir, n) for n in ("in", "hist", "ckpt"))
    head = "uid\tperiod\tTX_CURR\n"

    def put(version, name, text, at):
        os.makedirs(os.path.join(src, version), exist_ok=True)
        path = os.path.join(src, version, name)
        _write(path, head + text)
        os.utime(path, (at, at))

    def ingest():
        ingest_submissions(spark, src, FILE, Contract(CANON), hist, ckpt).awaitTermination()

    def rows():
        got = read_history(spark, hist, Contract(CANON))
        assert got.columns[-1] == "period"
        return sorted((r.uid, r.period, r.TX_CURR) for r in got.collect())

    put("v1", "a.txt", "u1\t2024 Q1\t1\nu2\t2024 Q2\t2\n", 1000)
    put("v1", "b.txt", "u3\t2024 Q1\t3\n", 1000)
    ingest()
    put("v2", "a.txt", "u1\t2024 Q1\t10\nu9\t2024 Q1\t9\n", 2000)      # one quarter corrected
    put("v2", "b.txt", "u3\t2024 Q1\t3\n", 2000)                          # the same once more
    ingest()
    want = [("u1", "2024 Q1", 10.0), ("u2", "2024 Q2", 2.0), ("u3", "2024 Q1", 3.0),
            ("u9", "2024 Q1", 9.0)]
    assert rows() == want
    put("late", "a.txt", "u1\t2024 Q1\t7\n", 500)                         # an older file found late
    ingest()
    ingest()
    assert rows() == want
    assert read_history(spark, hist, versions=True).count() == 7
    versions = read_manifest(spark, hist)
    assert versions.count() == 6 and versions.filter("newest").count() == 3


def test_submissions_named_by_columns(spark, tmp_dir):
    src, hist, ckpt = (os.path.join(tmp_dir, n) for n in ("in", "hist", "ckpt"))
    os.makedirs(src)
    head = "uid\tperiod\tTX_CURR\n"
    for n, (uid, v) in enumerate([("u1", 1), ("NA", 2), ("u1", 5), ("NA", 6)]):
        path = os.path.join(src, f"f{n}.txt")
        _write(path, head + f"{uid}\tNA\t{v}\n")
        os.utime(path, (1000 + n, 1000 + n))
    ingest_submissions(spark, src, FILE, Contract(CANON), hist, ckpt,
                       submission=["uid"]).awaitTermination()
    got = sorted(((r.uid, r.period, r.TX_CURR) for r in read_history(spark, hist).collect()), key=repr)
    assert got == [("u1", None, 5.0), (None, None, 6.0)] or got == [(None, None, 6.0), ("u1", None, 5.0)]


def test_a_file_of_several_submissions(spark, tmp_dir):
    """One of them is corrected by a later file; the others of its file stay."""
    src, hist, ckpt = (os.path.join(tmp_dir, n) for n in ("in", "hist", "ckpt"))
    os.makedirs(src)
    head = "uid\tperiod\tTX_CURR\n"
    for n, text in enumerate(("u1\t2024 Q1\t1\nu2\t2024 Q1\t2\n", "u1\t2024 Q1\t9\n")):
        path = os.path.join(src, f"f{n}.txt")
        _write(path, head + text)
        os.utime(path, (1000 + n, 1000 + n))
        ingest_submissions(spark, src, FILE, Contract(CANON), hist, ckpt,
                           submission=["uid"]).awaitTermination()
    got = sorted((r.uid, r.TX_CURR) for r in read_history(spark, hist, Contract(CANON)).collect())
    assert got == [("u1", 9.0), ("u2", 2.0)]


def test_a_partners_periods_are_spread_over_tasks(spark, tmp_dir, monkeypatch):
    import pytest

    from indicata.plans import catalog_files as CF
    rows = spark.createDataFrame([("MSM", f"20{y} Q1") for y in range(10, 30)],
                                 "keypop string, period string")
    seen = []

    def record(df, path, **_):
        seen.append(df._jdf.queryExecution().analyzed().toString())
        raise StopIteration

    monkeypatch.setattr(CF.C, "_kp_rows", lambda *_: rows)
    monkeypatch.setattr(CF, "write_tsv", record)
    with pytest.raises(StopIteration):
        CF.q_kp_versions(spark, tmp_dir)
    assert "RepartitionByExpression [keypop" in seen[0] and "period" in seen[0].splitlines()[0]
