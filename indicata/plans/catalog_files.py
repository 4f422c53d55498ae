"""Queries over files that are written and read back: versioned submissions (S7, C14), the
bundled long-form rules through the targets report (C7, D12), and the CSV source, dimension
load, schema difference, lower-case names and period-named output (S2, S6, P6, F11, S8)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from indicata.functions.columns import lower_names, schema_diff
from indicata.operators.union import Contract
from indicata.plans import catalog_reports as C
from indicata.plans import proxy
from indicata.plans import reports as P
from indicata.plans import rules as R
from indicata.plans.registry import (ORACLE, ORACLE_CTE, QUERIES, _sql_in, _sql_predicate,
                                     _sql_value, label_pool, register)
from indicata.session import scratch_path
from indicata.sources.files import (export_period, load_dim, read_csv, read_tsv, refresh_history,
                                    write_stage, write_tsv)
from indicata.streaming.submissions import ingest_submissions, read_history

# ---------------------------------------------------------------------------
# A corrected and a repeated submission
# ---------------------------------------------------------------------------

CORRECTED, REPEATED = "FSW", "TG"
CORRECTED_PERIODS = ["2000 Q3", "2000 Q4"]


def q_kp_versions(spark, sf_dir):
    """Submissions streamed into the history; then one partner hands two quarters in again with
    doubled counts, and another the same file once more."""
    folder, table, ckpt = (scratch_path(spark, f"kp-{n}") for n in ("files", "versions", "stream"))
    contract = Contract(T.StructType.fromDDL(C.KP_SUBMISSION))
    lines = T.StructType([T.StructField(f.name, T.StringType()) for f in contract.schema.fields])

    def hand_in(rows, version):
        # a partner's period is in one file: versions are told apart per period
        write_tsv(rows.repartition("keypop", "period"), f"{folder}/{version}")
        ingest_submissions(spark, folder, lines, contract, table, ckpt, pattern="*.csv",
                           submission=["keypop"]).awaitTermination()

    rows = C._kp_rows(spark, sf_dir)
    hand_in(rows, "v1")
    fixed = rows.filter((F.col("keypop") == CORRECTED) & F.col("period").isin(CORRECTED_PERIODS)) \
        .withColumn("TX_CURR", 2 * F.col("TX_CURR"))
    hand_in(fixed.unionByName(rows.filter(F.col("keypop") == REPEATED)), "v2")
    summed, _uncoded = P.kp_quarter(read_history(spark, table, contract))
    site_map = proxy.sites(spark, sf_dir).select(
        F.col("site_uid").cast("string").alias("datim_uid"), F.col("snu1").alias("snu"),
        "psnu", "sitename")
    return P.refreshed_history(summed, site_map).groupBy("snu", "period", "keypop").agg(
        F.count(F.lit(1)).alias("n"), F.sum("TX_CURR").alias("TX_CURR"),
        F.sum("TX_PVLS").alias("TX_PVLS"))


def _versions_sql() -> str:
    sql, was = C._kp_sql(), "CASE WHEN indicator = 'TX_CURR' THEN value END AS TX_CURR"
    assert sql.count(was) == 1
    mech = next(k for k, v in C.KEYPOP.items() if v == CORRECTED)
    twice = (f"CASE WHEN mech_name = '{mech}' AND period IN ({_sql_in(CORRECTED_PERIODS)}) "
             "THEN 2 ELSE 1 END")
    return sql.replace(was, f"CASE WHEN indicator = 'TX_CURR' THEN value * {twice} END AS TX_CURR")


QUERIES["kp_versions"] = q_kp_versions
ORACLE["kp_versions"] = ORACLE_CTE + _versions_sql()


# ---------------------------------------------------------------------------
# The 13 bundled long-form rules through the targets report
# ---------------------------------------------------------------------------

_WHEN = [r["when"] for r in R.LONG_DERIVED]
# Values by site and year; lengths without a common factor, so that all combinations meet.
DEALT = {"indicator": (["TB_STAT", "TX_TB", "TB_PREV", "TX_CURR"], 1, 1)} | {
    c: ((2 * label_pool(_WHEN, c))[:n], 1, k) for c, n, k in (
        ("statushiv", 3, 0), ("statustb", 5, 2), ("otherdisaggregate", 7, 0),
        ("hiv_treatment_status", 7, 3))}


def _dealt_sql(column: str, brackets: tuple[str, str], pick: str) -> str:
    values, a, b = DEALT[column]
    items = ", ".join(map(_sql_value, values))
    at = f"CAST((CAST(orgunituid AS INT) * {a} + fiscal_year * {b}) % {len(values)} AS INT) + 1"
    return pick.format(f"{brackets[0]}{items}{brackets[1]}", at)


def q_targets_rules(spark, sf_dir):
    e = proxy.canonical_extract(spark, sf_dir)
    e = e.withColumns({c: F.expr(_dealt_sql(c, ("array(", ")"), "element_at({}, {})"))
                       for c in DEALT})
    names, whole = DEALT["indicator"][0], [*proxy.PROXY_OTHERDISAGG, None]
    same = spark.createDataFrame([(i, d, i) for i in names for d in whole],
                                 "indicator string, standardizeddisaggregate string, "
                                 "indicator_new string")
    return P.targets_table(e, same).groupBy("indicator", "fiscal_year", "period").agg(
        F.count(F.lit(1)).alias("n"), F.sum("cumulative").alias("cumulative"),
        F.sum("targets").alias("targets"))


def _targets_sql() -> str:
    dealt = ", ".join(f"{_dealt_sql(c, ('[', ']'), '({})[{}]')} AS {c}" for c in DEALT)
    copies = ["SELECT indicator_temp AS ind, fiscal_year, period_type, value FROM t3"] + [
        f"SELECT CASE WHEN indicator_temp = '{r['src']}' THEN '{r['label']}' ELSE indicator_temp END, "
        f"fiscal_year, period_type, value FROM t3 WHERE {r['match_col']} = '{r['src']}' "
        f"AND ({_sql_predicate(r['when'])})" for r in R.LONG_DERIVED]
    rest = "statushiv, statustb, otherdisaggregate, hiv_treatment_status"
    return f"""
, t1 AS (SELECT {dealt}, numeratordenom, fiscal_year, cumulative, targets FROM ext3),
t2 AS (SELECT indicator, {rest}, numeratordenom, fiscal_year, 'cumulative' AS period_type,
              cumulative AS value FROM t1
       UNION ALL SELECT indicator, {rest}, numeratordenom, fiscal_year, 'targets', targets FROM t1),
t3 AS (SELECT *, indicator || CASE WHEN numeratordenom = 'D' THEN '_D' ELSE '' END AS indicator_temp
       FROM t2 WHERE value IS NOT NULL),
t4 AS ({" UNION ALL ".join(copies)}),
t5 AS (SELECT ind AS indicator, fiscal_year,
              CASE WHEN period_type = 'cumulative' THEN value END AS cumulative,
              CASE WHEN period_type = 'targets' THEN value END AS targets FROM t4)
SELECT indicator, fiscal_year, 'FY' || lpad(CAST(fiscal_year % 100 AS VARCHAR), 2, '0') AS period,
       count(*) AS n, sum(cumulative) AS cumulative, sum(targets) AS targets
FROM t5 WHERE indicator IN (SELECT indicator FROM t5 WHERE targets IS NOT NULL)
GROUP BY indicator, fiscal_year
"""


QUERIES["targets_rules"] = q_targets_rules
ORACLE["targets_rules"] = ORACLE_CTE + C.RESULTS_CHAIN + _targets_sql()


# ---------------------------------------------------------------------------
# CSV source, dimension, schema difference, period-named output
# ---------------------------------------------------------------------------

SITE_CSV = "SITE_UID bigint, SITENAME string, PSNU string, SNU1 string, ACCTBAL double"
EXPORTED = ["2000 Q3", "2000 Q4"]


@register("file_sources", f"""
, sums AS (SELECT period, site_uid, sum(value) AS v FROM dated GROUP BY period, site_uid)
SELECT 'site' AS part, snu1 AS key, count(*) AS n,
       CAST(sum(CAST(round(acctbal * 100) AS BIGINT)) AS DOUBLE) AS v FROM site_dim GROUP BY snu1
UNION ALL SELECT 'dimension', psnu, count(*), CAST(sum(site_uid) AS DOUBLE) FROM site_dim GROUP BY psnu
UNION ALL SELECT 'schema', key, 1, 0 FROM (VALUES ('acctbal double'), ('psnu string')) t(key)
UNION ALL SELECT 'period', period, count(*), sum(v) FROM sums
WHERE period IN ({_sql_in(EXPORTED)}) GROUP BY period
""")
def file_sources(spark, sf_dir):
    """A site list written and read as CSV, a dimension of two of its columns, the columns that the
    dimension lacks, and two quarters read back from a period-named output."""
    listed, exported = scratch_path(spark, "site-list"), scratch_path(spark, "periods")
    sites = proxy.sites(spark, sf_dir)
    write_tsv(sites.select("site_uid", "sitename", "psnu", "snu1", "acctbal")
              .toDF(*[f.split()[0] for f in SITE_CSV.split(", ")]), listed, sep=",")
    read = lower_names(read_csv(spark, listed, SITE_CSV))
    dim = load_dim(spark, listed, ["SITE_UID", "SITENAME", "PSNU"], fmt="csv",
                   schema=T.StructType.fromDDL(SITE_CSV))
    kept = lower_names(dim.drop("PSNU")).withColumn("snu1", F.lit("x"))
    sums = proxy.fact(spark, sf_dir).groupBy("period", "site_uid").agg(F.sum("value").alias("v"))
    export_period(sums, exported)
    parts = [
        read.groupBy(F.col("snu1").alias("key")).agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.round(F.col("acctbal") * 100).cast("long")).cast("double").alias("v"))
        .withColumn("part", F.lit("site")),
        dim.groupBy(F.col("PSNU").alias("key")).agg(
            F.count(F.lit(1)).alias("n"), F.sum("SITE_UID").cast("double").alias("v"))
        .withColumn("part", F.lit("dimension")),
        schema_diff(spark, read, kept).select(
            F.concat_ws(" ", "column", "type").alias("key"), F.lit(1).cast("long").alias("n"),
            F.lit(0.0).alias("v"), F.lit("schema").alias("part")),
        *[read_tsv(spark, f"{exported}/period={p}", "site_uid bigint, v double").agg(
            F.count(F.lit(1)).alias("n"), F.sum("v").alias("v"))
          .withColumns({"key": F.lit(p), "part": F.lit("period")}) for p in EXPORTED]]
    out = parts[0].select("part", "key", "n", "v")
    for rows in parts[1:]:
        out = out.unionByName(rows.select("part", "key", "n", "v"))
    return out


# ---------------------------------------------------------------------------
# A stored history brought to the next master list
# ---------------------------------------------------------------------------


@register("history_refreshed", """
, h AS (SELECT period, site_uid, sum(value) AS v FROM dated GROUP BY period, site_uid)
SELECT h.period, CASE WHEN s.site_uid % 7 = 3 THEN 'Renamed' WHEN s.site_uid % 7 <> 5 THEN s.psnu END
         AS psnu, count(*) AS n, sum(h.v) AS v
FROM h JOIN site_dim s ON h.site_uid = s.site_uid GROUP BY 1, 2
""")
def history_refreshed(spark, sf_dir):
    """Sites renamed, and sites that left the list, in a stored history."""
    table = scratch_path(spark, "refreshed")
    old = proxy.sites(spark, sf_dir).select("site_uid", "psnu")
    new = old.filter("site_uid % 7 <> 5").withColumn(
        "psnu", F.when(F.col("site_uid") % 7 == 3, F.lit("Renamed")).otherwise(F.col("psnu")))
    rows = proxy.fact(spark, sf_dir).groupBy("period", "site_uid", "psnu").agg(
        F.sum("value").alias("v"))
    write_stage(rows, table, partition_by=("period",))
    refresh_history(spark, table, old, new, "site_uid", ["psnu"])
    return spark.read.schema("site_uid bigint, psnu string, v double, period string") \
        .parquet(table).groupBy("period", "psnu").agg(F.count(F.lit(1)).alias("n"),
                                                      F.sum("v").alias("v"))
