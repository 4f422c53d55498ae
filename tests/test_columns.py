"""Schema helpers: selection, relocation, schema difference."""

from indicata.functions.columns import cols, lower_names, relocate, schema_diff
from indicata.sources.files import load_dim


def test_cols_selectors(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0, "x", 3)],
                               "datim_uid string, TX_CURR double, tx_ml double, his_epts string, n int")
    assert cols(df, starts="tx_") == ["TX_CURR", "tx_ml"]          # case-insensitive
    assert cols(df, ends="_uid") == ["datim_uid"]
    assert cols(df, contains=["CURR", "eps"]) == ["TX_CURR"]
    assert cols(df, numeric=True) == ["TX_CURR", "tx_ml", "n"]
    assert cols(df, span=("TX_CURR", "his_epts")) == ["TX_CURR", "tx_ml", "his_epts"]
    assert cols(df, numeric=True, exclude=["n"]) == ["TX_CURR", "tx_ml"]


def test_relocate_and_lower(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "a int, b int, c int, d int")
    assert relocate(df, ["d"], after="a").columns == ["a", "d", "b", "c"]
    assert relocate(df, ["a"], before="d").columns == ["b", "c", "a", "d"]
    assert relocate(df, ["a", "b"]).columns == ["c", "d", "a", "b"]
    assert lower_names(spark.createDataFrame([(1,)], "TX_CURR int")).columns == ["tx_curr"]


def test_schema_diff(spark):
    a = spark.createDataFrame([(1, "x", 2.0)], "uid int, psnu string, v double")
    b = spark.createDataFrame([(1,)], "uid int")
    assert [(r.column, r.type) for r in schema_diff(spark, a, b).collect()] == \
        [("psnu", "string"), ("v", "double")]


def test_load_dim_subset(spark, tmp_dir):
    path = tmp_dir + "/dim"
    spark.createDataFrame([("u", "S", 1.0)], "datim_uid string, snu string, lat double") \
        .write.parquet(path)
    assert load_dim(spark, path, ["datim_uid", "snu"]).columns == ["datim_uid", "snu"]
