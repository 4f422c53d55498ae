"""Domain recodes and label bands (D10, D13-D17, D11 year-dependent rule)."""

from pyspark.sql import functions as F

from indicata.functions.domain import (age_band_50plus, age_coarse, funding_agency, pop_type,
                                       site_type, support_class, unknown_label)
from indicata.operators.derive import derive_indicators
from indicata.operators.scoring import site_volume
from indicata.plans import rules as R


def _col(df, expr):
    return [r.x for r in df.select(expr.alias("x")).collect()]


def test_site_volume_label_edges(spark):
    df = spark.createDataFrame([("a", 999.0), ("b", 1000.0), ("c", 5000.0), ("d", 5001.0),
                                ("e", None)], "s string, v double")
    got = {r.s: r.site_volume for r in site_volume(df, site="s", value="v",
                                                   bands=R.SITE_VOLUME_BANDS,
                                                   default=R.SITE_VOLUME_DEFAULT).collect()}
    # a site with no TX_CURR sums to 0 and is "Low" ("Not Reported" is unreachable)
    assert got == {"a": "Low", "b": "Medium", "c": "Medium", "d": "High", "e": "Low"}


def test_age_bands(spark):
    df = spark.createDataFrame([("55-59", "2022 Q3"), ("55-59", "2024 Q1"), ("10-14", "2022 Q3"),
                                ("Unknown", "2022 Q3"), (None, "2022 Q3")],
                               "age string, period string")
    assert _col(df, age_band_50plus("age")) == ["50+", "50+", "10-14", "Unknown", None]
    assert _col(df, age_band_50plus("age", period="period",
                                    only_periods=R.WATERFALL_50_PLUS_PERIODS)) == \
        ["50+", "55-59", "10-14", "Unknown", None]
    assert _col(df, age_coarse("age")) == ["15+", "15+", "<15", "Unknown Age", "15+"]
    assert _col(df, unknown_label("age", "Unknown Age")) == \
        ["55-59", "55-59", "10-14", "Unknown Age", None]


def test_pop_type_order_and_agency(spark):
    df = spark.createDataFrame([("Pregnant, Breastfeeding",), ("Pregnant",), ("Age/Sex",), (None,)],
                               "d string")
    assert _col(df, pop_type("d")) == ["LW", "PW", "Age/Sex", "Age/Sex"]
    p = spark.createDataFrame([("ECHO",), ("JHPIEGO-DoD",), ("FGH",), (None,)], "p string")
    assert _col(p, funding_agency("p")) == ["USAID", "DOD", "HHS/CDC", "HHS/CDC"]


def test_site_type_variants_and_support_class(spark):
    p = spark.createDataFrame([("ECHO",), ("MISAU",), ("Passos",), (None,)], "p string")
    assert _col(p, site_type("p")) == ["99-AJUDA", "01-Sustainability", "non-clinical",
                                       "non-clinical"]
    assert _col(p, site_type("p", variant=2)) == ["99-AJUDA", "01-Sustainability",
                                                  "01-Sustainability", "01-Sustainability"]
    s = spark.createDataFrame([(None, None), (None, "GF"), ("ICAP", None), ("ICAP", "GF"),
                               ("MISAU", None), ("Other", None)], "a string, b string")
    assert _col(s, support_class("a", "b")) == ["No Support", "Other Donor Support", "AJUDA",
                                                "AJUDA", "AJUDA", None]


def test_post_anc_rule_depends_on_fiscal_year(spark):
    df = spark.createDataFrame([(2023, "Post ANC1", 1.0), (2024, "Post ANC1", 2.0),
                                (2024, "PMTCT Post ANC1 Breastfeeding", 3.0),
                                (2023, "PMTCT Post ANC1 Pregnant/L&D", 4.0)],
                               "fiscal_year int, modality string, HTS_TST double")
    out = derive_indicators(df, R.DERIVED_INDICATORS)
    assert [r.HTS_TST_PostANC for r in out.orderBy("HTS_TST").collect()] == [1.0, None, 3.0, None]
    assert out.filter(F.col("HTS_TST_POS_PostANC").isNotNull()).count() == 0
