"""The indicator fact derived from the TPC-H-style test tables.

Analogues: supplier = site, nation = district (psnu), region = province
(snu1), customer market segment = mechanism, line return flag = indicator,
line status = numerator/denominator, order priority = disaggregate (with
nulls), ship date = reporting quarter, quantity = value.

Join plan (chosen for scale, see README):
  * nation and region have a fixed size (25 / 5 rows): broadcast.
  * orders x customer is joined first (orders is ~1/4 of lineitem), so the
    lineitem side is shuffled once on the order key; that join is a hinted
    sort-merge join (never a broadcast: both sides grow with the data).
  * supplier and customer grow with the data: no broadcast hint; Spark
    broadcasts them only when the table's files or, with AQE, the side
    measured at run time are below ``spark.sql.autoBroadcastJoinThreshold``
    (``spark.sql.adaptive.autoBroadcastJoinThreshold``).
  * a period restriction becomes a plain ship-date range on the lineitem
    scan (``PushedFilters``), so only matching row groups are read.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indicata.functions.expressions import case_match
from indicata.functions.periods import period_range, with_fiscal_period
from indicata.session import path_state, scratch_path

# Proxy mapping of the test tables onto indicator fields (fixture contract).
PROXY_INDICATOR = [(["R"], "TX_CURR"), (["A"], "TX_PVLS_D")]
PROXY_INDICATOR_DEFAULT = "TX_PVLS"
PROXY_NULL_PRIORITY = "4-NOT SPECIFIED"
INDICATORS = ["TX_CURR", "TX_PVLS_D", "TX_PVLS"]

# Proxy clinical partner of a site, from its province (one province maps to
# no partner, one to the ministry), and partner of a mechanism.
PROXY_SITE_PARTNER = {"AFRICA": "ECHO", "AMERICA": "FGH", "ASIA": "MISAU", "EUROPE": "ICAP"}
PROXY_MECH_PARTNER = {"AUTOMOBILE": "ECHO", "BUILDING": "FGH", "FURNITURE": "MISAU",
                      "HOUSEHOLD": "EGPAF", "MACHINERY": "Passos"}


# Declared schemas of the test tables: reading with a schema skips the
# footer-inference job Spark otherwise runs for every Parquet read.
TABLE_SCHEMAS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Site dimension: supplier with its district and province names."""
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey",
                                                "s_acctbal")
    return (_with_geo(spark, sf_dir, s)
             .select(F.col("s_suppkey").alias("site_uid"), F.col("s_name").alias("sitename"),
                     F.col("n_name").alias("psnu"), F.col("r_name").alias("snu1"),
                     F.col("s_acctbal").alias("acctbal")))


def _with_geo(spark: SparkSession, sf_dir: str, df: DataFrame) -> DataFrame:
    """Rows of suppliers (or of lines with their supplier) joined to district and province."""
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    geo = F.broadcast(n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey))
    return df.join(geo, F.col("s_nationkey") == geo.n_nationkey)


def site_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of the site dimension (for semi-joins after aggregating lines)."""
    return sites(spark, sf_dir).select("site_uid")


def fact(spark: SparkSession, sf_dir: str, *, periods: Sequence[str] | None = None,
         ship_from: str | None = None, ship_to: str | None = None, order_join: str = "merge",
         with_sites: bool = True) -> DataFrame:
    """Long indicator fact with fiscal fields (fy, q, period, date).

    ``periods`` / ``ship_from`` / ``ship_to`` (exclusive) restrict the lineitem scan by ship date; the
    derived ``period`` filter is then redundant but kept exact.

    ``order_join`` is the strategy of the lineitem x orders join.  Both sides
    grow with the data, so it is a shuffled join on the order key at every
    scale: left to itself, AQE broadcasts whichever side is just under the
    threshold (at small scale the *lineitem* side, built on the driver).
    ``merge`` (the default) spills, so it holds at any size; with
    ``shuffle_hash`` the table built from orders must fit a task's memory.

    ``with_sites=False`` leaves out the site join (``site_uid`` is the
    line's supplier key, site attributes absent): callers that aggregate
    by site first then join the aggregate to :func:`sites` (same rows for
    any per-site aggregate, far less data through the join).
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus", "l_shipdate", "l_quantity")
    ts = F.col("l_shipdate")
    if periods:
        cond = None
        for p in periods:
            lo, hi = period_range(p)
            c = (ts >= F.lit(lo).cast("timestamp_ntz")) & (ts < F.lit(hi).cast("timestamp_ntz"))
            cond = c if cond is None else cond | c
        li = li.filter(cond)
    if ship_from:
        li = li.filter(ts >= F.lit(ship_from).cast("timestamp_ntz"))
    if ship_to:
        li = li.filter(ts < F.lit(ship_to).cast("timestamp_ntz"))
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    oc = o.join(c, o.o_custkey == c.c_custkey).select("o_orderkey", "o_orderpriority",
                                                      "c_mktsegment")
    joined = li.join(oc.hint(order_join), li.l_orderkey == oc.o_orderkey)
    if with_sites:
        # lines meet the bare supplier table, whose size its files tell, before the fixed geography:
        # joined to that first, it would be measured only after a shuffle, with its names spelled out
        s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
        joined = _with_geo(spark, sf_dir, joined.join(s, F.col("l_suppkey") == F.col("s_suppkey")))
        site_cols = [F.col("s_suppkey").alias("site_uid"), F.col("s_name").alias("sitename"),
                     F.col("n_name").alias("psnu"), F.col("r_name").alias("snu1")]
    else:
        site_cols = [F.col("l_suppkey").alias("site_uid")]
    out = joined.select(
        *site_cols,
        F.col("c_mktsegment").alias("mech_name"),
        case_match("l_returnflag", PROXY_INDICATOR, PROXY_INDICATOR_DEFAULT).alias("indicator"),
        F.when(F.col("l_linestatus") == "O", F.lit("D")).otherwise(F.lit("N"))
         .alias("numeratordenom"),
        F.nullif(F.col("o_orderpriority"), F.lit(PROXY_NULL_PRIORITY))
         .alias("standardizeddisaggregate"),
        F.to_date("l_shipdate").alias("ship_date"),
        F.col("l_quantity").alias("value"),
        F.col("l_orderkey").alias("order_key"),
        F.col("l_partkey").alias("part_key"))
    out = with_fiscal_period(out, "ship_date")
    if periods:
        out = out.filter(F.col("period").isin(list(periods)))
    return out


# The same fact in DuckDB SQL: the oracle side of every proxy query.
ORACLE_CTE = """
WITH fact AS (
  SELECT s.s_suppkey AS site_uid, s.s_name AS sitename, n.n_name AS psnu, r.r_name AS snu1,
         c.c_mktsegment AS mech_name,
         CASE l.l_returnflag WHEN 'R' THEN 'TX_CURR' WHEN 'A' THEN 'TX_PVLS_D' ELSE 'TX_PVLS' END
           AS indicator,
         CASE l.l_linestatus WHEN 'O' THEN 'D' ELSE 'N' END AS numeratordenom,
         nullif(o.o_orderpriority, '4-NOT SPECIFIED') AS standardizeddisaggregate,
         CAST(l.l_shipdate AS DATE) AS ship_date,
         CAST(year(CAST(l.l_shipdate AS DATE) + INTERVAL 3 MONTH) AS INT) AS fy,
         CAST(quarter(CAST(l.l_shipdate AS DATE) + INTERVAL 3 MONTH) AS INT) AS q,
         l.l_quantity AS value,
         l.l_orderkey AS order_key,
         l.l_partkey AS part_key
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey),
dated AS (
  SELECT *, concat(CAST(fy AS VARCHAR), ' Q', CAST(q AS VARCHAR)) AS period,
         make_date(CASE WHEN q = 1 THEN fy - 1 ELSE fy END,
                   CASE q WHEN 1 THEN 12 WHEN 2 THEN 3 WHEN 3 THEN 6 ELSE 9 END, 20) AS date
  FROM fact),
site_dim AS (
  SELECT s.s_suppkey AS site_uid, s.s_name AS sitename, n.n_name AS psnu, r.r_name AS snu1,
         s.s_acctbal AS acctbal
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey)
"""


# ---------------------------------------------------------------------------
# Canonical wide-by-quarter extract derived from the proxy fact (input of the
# results-table pipeline), with the attributes the rules read.
# ---------------------------------------------------------------------------

PROXY_OTHERDISAGG = {
    "1-URGENT": "No Contact Outcome - Interruption in Treatment <3 Months Treatment",
    "2-HIGH": "No Contact Outcome - Transferred Out",
    "3-MEDIUM": "ARV Dispensing Quantity - 3 to 5 months",
    "5-LOW": "Life-long ART, Already",
}
PROXY_AGE = {"AUTOMOBILE": "25-29", "BUILDING": "10-14", "FURNITURE": "50-54",
             "HOUSEHOLD": "02 - 12 Months", "MACHINERY": "65+"}
PROXY_DEDUP = ([("TX_CURR", d, "TX_CURR") for d in ("1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW", None)]
               + [("TX_CURR", "1-URGENT", "TX_ML")]
               + [("TX_PVLS", d, "TX_PVLS") for d in ("1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW", None)]
               + [("TX_PVLS_D", d, "PMTCT_ART") for d in ("1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW")])
PROXY_NAMES = ["TX_CURR", "TX_CURR_D", "TX_ML", "TX_ML_D", "TX_PVLS", "TX_PVLS_D", "PMTCT_ART",
               "PMTCT_ART_D", "TX_CURR_3MO_PRIOR", "TX_ML_3MO_PRIOR", "TX_CURR_6MO_PRIOR",
               "PMTCT_ART_12MO"]


# Tables written once per session and set of input files, by session, folder and name.
_STAGED: dict[tuple, str] = {}
FACT_TABLES = ("lineitem", "orders", "customer", "supplier", "nation", "region")


def staged(spark: SparkSession, sf_dir: str, name: str, build: Callable[[str], None]) -> str:
    """Folder of a table that later queries of the session read, as later reports read the stored
    results table; ``build`` writes it.  Changed input files give a new one."""
    seen = tuple(path_state(spark, f"{sf_dir.rstrip('/')}/{t}.parquet") for t in FACT_TABLES)
    key = (spark.sparkContext.applicationId, sf_dir, name, seen)
    if key not in _STAGED:
        path = scratch_path(spark, name)
        build(path)
        _STAGED[key] = path
    return _STAGED[key]


def daily_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact's sums per site key, mechanism, indicator, disaggregate and day: the finest grain of
    the extract and of the supplemental and laboratory series, joined and summed once."""
    keys = ["site_uid", "mech_name", "indicator", "numeratordenom", "standardizeddisaggregate",
            "ship_date"]

    def build(path: str) -> None:
        (fact(spark, sf_dir, with_sites=False).groupBy(*keys).agg(F.sum("value").alias("value"))
         .write.parquet(path))

    days = spark.read.parquet(staged(spark, sf_dir, "daily", build))
    return with_fiscal_period(days, "ship_date")


def canonical_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per site x mechanism x indicator x disaggregate x fiscal year,
    measures in qtr1..qtr4 / cumulative / targets (partial aggregation)."""
    from indicata.functions.domain import age_coarse, funding_agency
    from indicata.functions.expressions import lookup, recode
    # aggregate first (map-side partial sums), then attach site attributes
    # to the aggregate: the site join sees one row per group, not per line
    f = daily_lines(spark, sf_dir)
    q, v = F.col("q"), F.col("value")
    g = f.groupBy("site_uid", "mech_name", "indicator", "numeratordenom",
                  "standardizeddisaggregate", F.col("fy").alias("fiscal_year")).agg(
        *[F.sum(F.when(q == i, v)).alias(f"qtr{i}") for i in range(1, 5)],
        F.sum(v).alias("cumulative"),
        F.sum(F.when(F.col("numeratordenom") == "D", v)).alias("targets"))
    # by the uid as later site joins have it, so that they find the rows in place
    uid = F.col("site_uid").cast("string").alias("orgunituid")
    attrs = sites(spark, sf_dir)
    g = g.select(uid, *[c for c in g.columns if c != "site_uid"]).join(
        attrs.select(uid, *[c for c in attrs.columns if c not in ("site_uid", "acctbal")]),
        "orgunituid")
    g = g.select(*[c for c in g.columns if c != "orgunituid"], "orgunituid")
    g = g.withColumns({
        "otherdisaggregate": lookup("standardizeddisaggregate", PROXY_OTHERDISAGG),
        "sex": F.when(F.col("numeratordenom") == "D", F.lit("Female")).otherwise(F.lit("Male")),
        "ageasentered": lookup("mech_name", PROXY_AGE),
        "funding_agency": funding_agency(recode("mech_name", PROXY_MECH_PARTNER)),
        "sitetype": F.when(F.col("snu1") == "MIDDLE EAST", F.lit("Community"))
                     .otherwise(F.lit("Facility"))})
    return g.withColumn("trendscoarse", age_coarse("ageasentered"))


def site_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Site dimension in canonical form: uid, partner, coordinates, flags."""
    from indicata.functions.expressions import lookup
    s = sites(spark, sf_dir)
    return s.select(F.col("site_uid").cast("string").alias("datim_uid"),
                    lookup("snu1", PROXY_SITE_PARTNER).alias("partner_pepfar_clinical"),
                    F.col("acctbal").alias("latitude"),
                    F.when(F.col("acctbal") > 5000, F.lit(1.0)).alias("his_epts"))
