"""Operator 7, quality rules: a bitmask ledger.

DataFrame functions only.  Every rule is evaluated once per document; the
ledger keeps the measurements and one bit per failed rule, and is written once.
A policy is a versioned set of bits, applied to the stored ledger without a
second look at the texts, and ablations are bitwise aggregations over it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indicata.llm.common import new_columns, stage

WS = r"[\x20\x09-\x0D]+"
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]

#: Name and condition of failure, in the order of the bits.
RULES: list[tuple[str, str]] = [
    ("few_words", "n_words < 50"),
    ("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    ("symbols", "100 * n_symbols > 50 * n_words"),
    ("duplicate_lines", "n_lines >= 10 AND 100 * n_dup_lines > 50 * n_lines"),
    ("short_words", "word_chars < 2 * n_words"),
    ("long_words", "word_chars > 30 * n_words"),
]
BIT = {name: 1 << i for i, (name, _) in enumerate(RULES)}

#: Versioned policies: a document stays when it fails none of their rules.
POLICIES: dict[str, int] = {
    "base": BIT["few_words"] | BIT["repeated_windows"],
    "v1": BIT["few_words"] | BIT["repeated_windows"] | BIT["symbols"] | BIT["duplicate_lines"],
    "v2": (1 << len(RULES)) - 1,
}


def _bind(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once: higher-order functions evaluate what
    their lambda names again for every element, except its own variables."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _repeated_starts(words: Column) -> Column:
    """Sorted starts of the 3-word windows found twice or more in ``words``.

    Windows are compared by a 64-bit hash within one document.
    """
    windows = F.transform(
        F.sequence(F.lit(0), F.size(words) - 3),
        lambda i: F.struct(F.xxhash64(words[i], words[i + 1], words[i + 2]).alias("h"),
                           i.alias("i")))

    def twins(s: Column) -> Column:
        n = F.size(s)
        return F.filter(s, lambda x, k: (
            F.coalesce(F.get(s, k - 1)["h"] == x["h"], F.lit(False))
            | ((k + 1 < n) & F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False)))))

    found = _bind(F.sort_array(windows), twins)
    return F.when(F.size(words) >= 3, F.sort_array(F.transform(found, lambda x: x["i"]))) \
        .otherwise(F.array().cast("array<int>"))


def _covered(starts: Column) -> Column:
    """Words in the union of the 3-word windows at these sorted starts."""
    return F.aggregate(
        starts, F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("end")),
        lambda a, s: F.struct((a["n"] + s + 3 - F.greatest(a["end"], s)).cast("long").alias("n"),
                              (s + 3).alias("end")),
        lambda a: a["n"])


def ledger(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Every row of ``docs`` with the measurements and ``fail_bits``.

    A null text counts as empty: no words, no lines.  Input columns with the
    names of the new ones are replaced.
    """
    new = [*MEASURES, "fail_bits"]
    text = F.coalesce(F.col(text_col), F.lit(""))
    body = F.btrim(text, F.lit(" \t\n\x0b\x0c\r"))
    words = F.when(body == "", F.array().cast("array<string>")).otherwise(F.split(body, WS))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    rows = docs.select(
        *new_columns(docs, [c for c in new if c != text_col]),
        words.alias("__words"), lines.alias("__lines"),
        (F.octet_length(text) - F.octet_length(F.regexp_replace(text, r"[#*$%&|<>]+", "")))
        .cast("long").alias("n_symbols"))
    rows = rows.withColumns({
        "n_words": F.size("__words").cast("long"),
        "word_chars": F.char_length(F.array_join("__words", "")).cast("long"),
        "n_lines": F.size("__lines").cast("long"),
        "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
        "n_repeat_words": _bind(F.col("__words"), lambda w: _covered(_repeated_starts(w))),
    }).drop("__words", "__lines")
    bits = F.lit(0).cast("long")
    for name, failed in RULES:
        bits = bits.bitwiseOR(F.when(F.expr(failed), F.lit(BIT[name])).otherwise(F.lit(0))
                              .cast("long"))
    return rows.withColumn("fail_bits", bits)


def stored(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The ledger of every row without its text, written once and read again."""
    led = ledger(docs.select(id_col, text_col), text_col)
    return stage(led.select(id_col, *MEASURES, "fail_bits"), "ledger")


def apply_policy(led: DataFrame, policy: str | int, out: str = "kept") -> DataFrame:
    """The ledger with the verdict of a policy (a name of POLICIES or a mask)."""
    mask = POLICIES[policy] if isinstance(policy, str) else policy
    return led.withColumn(out, F.col("fail_bits").bitwiseAND(F.lit(mask).cast("long")) == 0)


def ablation(led: DataFrame, policy: str | int) -> DataFrame:
    """For each rule of a policy: failures, failures of this rule alone, and documents
    kept without the rule.

    One aggregation by failure bits (at most two to the number of rules rows),
    then bitwise operations on those rows.
    """
    mask = POLICIES[policy] if isinstance(policy, str) else policy
    seen = (led.groupBy(F.col("fail_bits").bitwiseAND(F.lit(mask).cast("long")).alias("bits"))
            .agg(F.count(F.lit(1)).alias("n")))
    rules = [F.struct(F.lit(name).alias("rule"), F.lit(BIT[name]).cast("long").alias("bit"))
             for name, _ in RULES if BIT[name] & mask]
    each = seen.select("bits", "n", F.explode(F.array(*rules)).alias("r"))
    fails = F.col("bits").bitwiseAND(F.col("r.bit")) != 0
    alone = F.col("bits") == F.col("r.bit")
    return (each.groupBy("r.rule")
            .agg(F.sum(F.when(fails, F.col("n")).otherwise(0)).alias("failed"),
                 F.sum(F.when(alone, F.col("n")).otherwise(0)).alias("failed_alone"),
                 F.sum(F.when(alone | (F.col("bits") == 0), F.col("n")).otherwise(0))
                 .alias("kept_without")))
