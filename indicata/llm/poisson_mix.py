"""Operator 6, mixing sources to target weights by Poisson replication.

DataFrame functions only.  Each source gets a mean repetition rate, each
document a uniform number from a hash of seed and id, and the number of its
copies is the inverse of the Poisson distribution at that number.  Copies are
exploded and dealt out by a hash of seed, id, copy and row, which is a global
shuffle in one exchange.  A source's distribution is a table up to a rate of
MAX_TABLE; above it each document walks from the lower tail to its number, in
steps that are few beside its copies.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indicata.llm.common import id_text, new_columns, stage

COLUMNS = ["rate", "copies", "copy_no", "shuffle_key"]
#: A rates table of at most so many sources is broadcast; beyond it the join shuffles.
BROADCAST_SOURCES = 10_000
#: Greatest rate with a table, whose size follows the rate.
MAX_TABLE = 1000.0


def rates(docs: DataFrame, source_col: str = "source", text_col: str = "text",
          weights: Mapping[str, float] | None = None, temperature: float = 0.7,
          scale: float = 1.0) -> DataFrame:
    """One row per source: mass, weight, rate and the distribution of its copies.

    ``mass`` is UTF-8 bytes plus one per document.  Target weights are those
    given (sources not named get 0), or mass to the power ``temperature``.  The
    expected mass of the result is ``scale`` times that of the input.  ``cdf``
    holds the distribution up to a tail below double precision, and is null
    above MAX_TABLE.
    """
    mass = (docs.groupBy(F.col(source_col).alias("source"))
            .agg(F.sum(F.coalesce(F.octet_length(text_col), F.lit(0)) + F.lit(1))
                 .cast("long").alias("mass")))
    if weights is None:
        mass = mass.withColumn("weight", F.pow(F.col("mass").cast("double"), F.lit(temperature)))
    else:
        given = docs.sparkSession.createDataFrame(
            [(k, float(v)) for k, v in weights.items()], "source string, weight double")
        mass = (mass.join(given, mass["source"].eqNullSafe(given["source"]), "left")
                .select(mass["source"], "mass",
                        F.coalesce("weight", F.lit(0.0)).alias("weight")))
    mass = stage(mass, "mass")
    all_mass, all_weight = mass.agg(F.sum("mass"), F.sum("weight")).first()  # one row
    rate = (F.lit(float(scale)) * F.lit(all_mass) * F.col("weight") / F.lit(all_weight)
            / F.col("mass")) if all_weight else F.lit(0.0)
    out = mass.withColumn("rate", rate.cast("double"))
    top = F.ceil(F.least("rate", F.lit(MAX_TABLE)) + 10 * F.sqrt("rate") + 30).cast("int")
    step = F.struct(F.lit(0.0).alias("logp"), F.array().cast("array<double>").alias("cdf"))
    grown = F.aggregate(
        F.sequence(F.lit(0), top), step,
        lambda a, k: F.struct(
            F.when(k == 0, -F.col("rate")).otherwise(a["logp"] + F.log(F.col("rate") / k))
            .alias("logp"),
            F.concat(a["cdf"], F.array(F.coalesce(F.try_element_at(a["cdf"], F.lit(-1)), F.lit(0.0))
                                       + F.exp(F.when(k == 0, -F.col("rate"))
                                               .otherwise(a["logp"] + F.log(F.col("rate") / k)))))
            .alias("cdf")))["cdf"]
    return out.withColumn("cdf", F.when(F.col("rate") > MAX_TABLE, F.lit(None))
                          .when(F.col("rate") > 0, grown).otherwise(F.array(F.lit(1.0))))


def walked(rate: Column, u: Column) -> Column:
    """The inverse of the Poisson distribution at ``u``, for a rate above MAX_TABLE.

    The walk starts 12 standard deviations below the mean, where Stirling's
    series gives the probability to double precision.
    """
    first = F.floor(rate - 12 * F.sqrt(rate)).cast("long")
    k = first.cast("double")
    log_factorial = (k * F.log(k) - k + 0.5 * F.log(2 * math.pi * k)
                     + 1 / (12 * k) - 1 / (360 * k * k * k))
    logp = k * F.log(rate) - rate - log_factorial
    state = F.struct(logp.alias("logp"), F.exp(logp).alias("sum"), F.lit(0).cast("long").alias("n"))
    steps = F.sequence(first + 1, F.ceil(rate + 12 * F.sqrt(rate)).cast("long"))

    def step(a: Column, i: Column) -> Column:
        here = a["logp"] + F.log(rate / i)
        return F.struct(here.alias("logp"), (a["sum"] + F.exp(here)).alias("sum"),
                        (a["n"] + (a["sum"] <= u).cast("long")).alias("n"))

    return first + F.aggregate(steps, state, step)["n"]


def uniform(id_col: str, seed: int):
    """52 bits of md5(seed:id) as a double in [0, 1)."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), id_text(F.col(id_col))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / float(1 << 52)


def poisson_mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source",
                text_col: str = "text", weights: Mapping[str, float] | None = None,
                temperature: float = 0.7, scale: float = 1.0, seed: int = 17) -> DataFrame:
    """The rows of ``docs``, each as often as drawn, in a global random order.

    New columns: rate, copies, copy_no (from 1), shuffle_key.  A null source is
    a source of its own, a null id draws as the empty text, rows with one id
    draw one count, a source of weight 0 leaves.  Input columns with the new
    names are replaced.  An empty table gives an empty result.
    """
    known = stage(rates(docs, source_col, text_col, weights, temperature, scale), "rates")
    known = known.select(F.col("source").alias("__source"), F.col("rate").alias("__rate"), "cdf")
    small = known.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES
    rows = docs.select(*new_columns(docs, [c for c in COLUMNS
                                           if c not in (id_col, source_col, text_col)]),
                       uniform(id_col, seed).alias("__u"))
    rows = rows.join(F.broadcast(known) if small else known,
                     F.col(source_col).eqNullSafe(F.col("__source")))
    drawn = rows.withColumn(
        "copies", F.when(F.col("cdf").isNull(), walked(F.col("__rate"), F.col("__u")).cast("int"))
        .otherwise(F.size(F.filter("cdf", lambda c: c <= F.col("__u")))))
    drawn = drawn.filter("copies > 0").withColumn("rate", F.col("__rate")) \
        .drop("cdf", "__source", "__u", "__rate")
    copies = drawn.withColumn("copy_no", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    key = F.md5(F.concat(F.lit(f"{seed}:"), id_text(F.col(id_col)), F.lit(":"),
                         F.col("copy_no").cast("string")))
    # the row's number keeps copies of rows that share an id, or have none, apart
    copies = copies.withColumns({"shuffle_key": key, "__row": F.monotonically_increasing_id()})
    return (copies.repartition(F.xxhash64("shuffle_key", "__row")).drop("__row")
            .sortWithinPartitions("shuffle_key"))
