"""A corpus pipeline of five stages, each calling one operator of ``indicata.llm``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's docs.  All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indicata.llm import byte_cnn, drr_packing, exact_index, poisson_mix, simhash_bktree
from indicata.llm.common import stage, table

#: A document goes when its language is unknown or less likely than this.
MIN_LANGUAGE_SCORE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose language the network names."""
    found = byte_cnn.language_id(docs)
    kept = found.filter((F.col("lang_pred") != byte_cnn.UNKNOWN)
                        & (F.col("score") >= MIN_LANGUAGE_SCORE))
    return kept.select(*docs.columns)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of equal texts, also where rows repeat an id or have none."""
    kept = exact_index.exact_dedup(docs).filter("kept")
    return kept.dropDuplicates(["text_sha256"]).select(*docs.columns)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the least id of each group of near copies.

    Rows are told apart by id and text, which differ after ``exact_dedup``: a
    repeated id or rows without one do not keep a second row of a group.  A null
    id stays where its group has no other.
    """
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"),
                   F.sha2(F.coalesce(F.col("text"), F.lit("")), 256).alias("digest"))
    groups = simhash_bktree.near_groups(docs.select(row.alias("row"), "text"), id_col="row",
                                        shingle=3, radius=2)
    first = groups.select("component.*").distinct()
    keyed = docs.select("*", row.alias("__row"))
    return keyed.join(first, F.col("__row.id").eqNullSafe(first["id"])
                      & (F.col("__row.digest") == first["digest"]), "left_semi").drop("__row")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replicate documents to the sources' target weights, in a global random order."""
    return poisson_mix.poisson_mix(docs).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack the mixed documents into sequences of 4096 tokens."""
    return drr_packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2,
                            length=4096)


STAGES = [("language_id", language_id), ("exact_dedup", exact_dedup),
          ("simhash_near_dedup", simhash_near_dedup), ("mix_sources", mix_sources),
          ("pack", pack)]

#: Training, fingerprints and tokenizers have no SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
