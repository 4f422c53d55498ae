"""Registered queries of the numbered operators, each over its whole table, and their SQL."""

from __future__ import annotations

from itertools import permutations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indicata.llm import (byte_cnn, drr_packing, exact_index, filter_diagram, merkle_windows,
                          pairwise_quality, pii_bootstrap, poisson_mix, rp_forest, rule_ledger,
                          simhash_bktree, substring_rk, token_cache)
from indicata.llm.common import stage_path, table

_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extendible-hash exact dedup of ``documents``."""
    found = exact_index.exact_dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", F.col("group_size").cast("long"), "kept",
                        "text_sha256")


OP5_SQL = f"""
WITH n AS (SELECT doc_id, translate(coalesce(text, ''), '{_UP}', '{_LOW}') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id IS NOT DISTINCT FROM g.keep_id AS kept,
       sha256(n.t) AS text_sha256
FROM n JOIN g ON n.t = g.t
"""


def op6_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Poisson replication of ``documents`` to tempered source weights."""
    mixed = poisson_mix.poisson_mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "source", F.round("rate", 6).alias("rate"),
                        F.col("copies").cast("long").alias("copies"),
                        F.col("copy_no").cast("long").alias("copy_no"), "shuffle_key")


OP6_SQL = """
WITH RECURSIVE mass AS (
  SELECT source, sum(coalesce(strlen(text), 0) + 1)::BIGINT AS mass FROM documents GROUP BY source),
rate AS (
  SELECT source, (sum(mass) OVER ())::DOUBLE * pow(mass::DOUBLE, 0.7)
         / sum(pow(mass::DOUBLE, 0.7)) OVER () / mass AS rate FROM mass),
cdf AS (
  SELECT source, rate, 0 AS k, -rate AS logp, exp(-rate) AS c FROM rate
  UNION ALL
  SELECT source, rate, k + 1, logp + ln(rate / (k + 1)), c + exp(logp + ln(rate / (k + 1)))
  FROM cdf WHERE k < ceil(rate + 10 * sqrt(rate) + 30)),
tables AS (SELECT source, any_value(rate) AS rate, list(c ORDER BY k) AS cs
           FROM cdf GROUP BY source),
u AS (
  SELECT doc_id, source,
         ('0x' || substr(md5('17:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::UBIGINT
           / 4503599627370496.0::DOUBLE AS u
  FROM documents),
drawn AS (
  SELECT u.doc_id, u.source, t.rate, len(list_filter(t.cs, lambda x: x <= u.u))::BIGINT AS copies
  FROM u JOIN tables t ON u.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, source, round(rate, 6) AS rate, copies, copy_no,
       md5('17:' || coalesce(doc_id::VARCHAR, '') || ':' || copy_no::VARCHAR) AS shuffle_key
FROM drawn, unnest(range(1, copies + 1)) AS c(copy_no)
"""


def op7_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule ledger of ``documents`` and the verdict of policy v2."""
    led = rule_ledger.stored(table(spark, sf_dir, "documents"))
    led = rule_ledger.apply_policy(led, "base", "base_ok")
    led = rule_ledger.apply_policy(led, "v2", "kept")
    return led.select("doc_id", *rule_ledger.MEASURES[:5],
                      (~F.col("base_ok")).alias("base_failed"), "kept", "fail_bits")


OP7_SQL = """
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT r, doc_id, text,
         list_filter(regexp_split_to_array(text, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws,
         list_filter(string_split(text, chr(10)),
                     lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls
  FROM d),
starts AS (
  SELECT r, i, ws[i] || chr(10) || ws[i + 1] || chr(10) || ws[i + 2] AS g
  FROM w, unnest(range(1, len(ws) - 1)) AS x(i)),
twins AS (SELECT r, i FROM starts
          QUALIFY count(*) OVER (PARTITION BY r, g) >= 2),
covered AS (SELECT r, count(DISTINCT i + k) AS n FROM twins, (VALUES (0), (1), (2)) AS o(k)
            GROUP BY r),
m AS (
  SELECT doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
         (strlen(text) - strlen(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
         coalesce(c.n, 0)::BIGINT AS n_repeat_words, len(ls)::BIGINT AS n_lines
  FROM w LEFT JOIN covered c USING (r)),
f AS (
  SELECT *, n_words < 50 AS b0, 100 * n_repeat_words > 50 * n_words AS b1,
         100 * n_symbols > 50 * n_words AS b2,
         n_lines >= 10 AND 100 * n_dup_lines > 50 * n_lines AS b3,
         word_chars < 2 * n_words AS b4, word_chars > 30 * n_words AS b5
  FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       b0 OR b1 AS base_failed, NOT (b0 OR b1 OR b2 OR b3 OR b4 OR b5) AS kept,
       (b0::BIGINT + 2 * b1::BIGINT + 4 * b2::BIGINT + 8 * b3::BIGINT + 16 * b4::BIGINT
        + 32 * b5::BIGINT)::BIGINT AS fail_bits
FROM f
"""


def op7_rule_ablation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each rule of policy v2 does in ``documents``, from the stored ledger."""
    return rule_ledger.ablation(rule_ledger.stored(table(spark, sf_dir, "documents")), "v2")


OP7_ABLATION_SQL = f"""
WITH ledger AS ({OP7_SQL}),
rules(rule, bit) AS (VALUES {", ".join(f"('{r}', {b})" for r, b in rule_ledger.BIT.items())})
SELECT rule, count(*) FILTER (WHERE fail_bits & bit <> 0) AS failed,
       count(*) FILTER (WHERE fail_bits = bit) AS failed_alone,
       count(*) FILTER (WHERE fail_bits IN (0, bit)) AS kept_without
FROM ledger, rules GROUP BY rule
"""


def op1_token_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of ``documents``, through a cache that starts empty."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    found = token_cache.count_tokens(table(spark, sf_dir, "documents"), path,
                                     stage_path(spark, "token-cache"))
    return found.select("doc_id", "n_bytes", "n_tokens",
                        (F.col("n_tokens") > 1024).alias("over_limit"))


def op2_simhash_bktree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash groups of ``documents``."""
    found = simhash_bktree.near_groups(table(spark, sf_dir, "documents"), shingle=3, radius=2)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                        F.col("component").alias("component_id"))


def op3_pairwise_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bradley-Terry quality score of ``documents``."""
    docs = table(spark, sf_dir, "documents")
    model = pairwise_quality.learn(docs, table(spark, sf_dir, "labels"))
    return pairwise_quality.rank(docs, model).select(
        "doc_id", pairwise_quality.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op4_pii_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of ``documents``; the counts and the digest are of the base spans."""
    found = pii_bootstrap.find(table(spark, sf_dir, "documents"))
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}")
              for k in pii_bootstrap.KINDS]
    return found.select(
        "doc_id", *counts,
        F.sha2(pii_bootstrap.spans_text(F.col("base")), 256).alias("base_sha256"),
        pii_bootstrap.spans_text(F.col("spans")).alias("spans"))


def op8_drr_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` packed into sequences of 4096 tokens, each source by its share."""
    return drr_packing.pack(table(spark, sf_dir, "documents"),
                            public_tokenizers.path("word_bpe_49k.json"), end_id=2, length=4096)


def op9_substring_rk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated 35-word windows of ``documents`` removed."""
    found = substring_rk.repeated_spans(table(spark, sf_dir, "documents"), window=35)
    return found.select("doc_id", "n_words", "n_removed",
                        F.sha2("kept_text", 256).alias("kept_sha256"))


def op10_byte_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of ``documents``."""
    found = byte_cnn.language_id(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op11_filter_diagram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Interaction of five filters over ``documents``, by source, in all orders."""
    masks = filter_diagram.failure_masks(table(spark, sf_dir, "documents"),
                                         table(spark, sf_dir, "labels"))
    return filter_diagram.audit(masks)


_ORDERS = ", ".join(f"('{''.join(o)}')" for o in permutations(filter_diagram.FILTERS))
OP11_SQL = f"""
WITH firsts AS (SELECT coalesce(text, '') AS t, min(doc_id) AS least FROM documents GROUP BY 1),
l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic
      FROM labels GROUP BY doc_id),
d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'),
                     lambda x: x <> '') AS ws
  FROM documents),
m AS (
  SELECT d.part, (len(ws) < 200)::INT + 2 * (100 * len(list_distinct(ws)) < 50 * len(ws))::INT
         + 4 * (100 * (strlen(t) - strlen(regexp_replace(t, '[A-Z]', '', 'g')))
                > 2 * length(t))::INT
         + 8 * regexp_matches(t, '[#$%&*|]')::INT
         + 16 * coalesce(d.doc_id > f.least, false)::INT AS mask,
         coalesce(l.good, 0) AS good, coalesce(l.toxic, 0) AS toxic
  FROM d JOIN firsts f USING (t) LEFT JOIN l ON l.doc_id = d.doc_id),
c AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic
      FROM m GROUP BY part, mask),
orders(filter_order) AS (VALUES {_ORDERS}),
steps AS (
  SELECT filter_order, step, filter_order[step] AS f,
         (1 << (instr('ABCDE', filter_order[step]) - 1)) AS bit,
         list_sum([1 << (instr('ABCDE', filter_order[j]) - 1) for j in range(1, step)]) AS before
  FROM orders, range(1, 6) AS s(step)),
r AS (
  SELECT part, filter_order, step, f,
         sum(n) FILTER (mask & (coalesce(before, 0)::INT | bit) = 0) AS kept,
         sum(n) FILTER (mask & bit <> 0 AND mask & coalesce(before, 0)::INT = 0) AS removed,
         sum(n) FILTER (mask & bit <> 0 AND mask & coalesce(before, 0)::INT <> 0) AS redundant,
         sum(n) FILTER (mask = bit) AS unique_fails,
         sum(good) FILTER (mask & bit <> 0 AND mask & coalesce(before, 0)::INT = 0) AS good_lost,
         sum(toxic) FILTER (mask & bit <> 0 AND mask & coalesce(before, 0)::INT = 0) AS toxic_lost
  FROM c, steps GROUP BY part, filter_order, step, f)
SELECT part, filter_order, step::INT AS step, coalesce(kept, 0)::BIGINT AS kept,
       coalesce(removed, 0)::BIGINT AS removed, coalesce(redundant, 0)::BIGINT AS redundant,
       coalesce(unique_fails, 0)::BIGINT AS unique_fails,
       coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
       (sum(coalesce(removed, 0)) OVER (PARTITION BY part, f))::BIGINT AS shapley
FROM r
"""


def op12_merkle_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle manifest of ``documents`` by source, and a check of tampered texts against it."""
    return merkle_windows.manifest(table(spark, sf_dir, "documents")).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def _crc_sql(text: str) -> str:
    """crc32 of an ASCII text in SQL, four bits at a time."""
    steps = []
    for c in range(16):
        for _ in range(4):
            c = c >> 1 ^ (0xEDB88320 if c & 1 else 0)
        steps.append(c)
    halves = (f"flatten([[ascii(ch) & 15, ascii(ch) >> 4] for ch in string_split({text}, '')])")
    return (f"xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, {halves}), "
            f"lambda c, x: xor(c >> 4, (CAST({steps} AS BIGINT[]))[(xor(c, x) & 15) + 1])))")


def _merkle_sql(depth: int = 6) -> str:
    """The manifest with ``depth`` levels in either tree, written out (16**6 rows a source)."""
    def h(cols):
        return "sha256(" + " || ".join(
            f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')"
            for c in cols) + ")"

    def tree(name, key, start):
        """Levels, then per first node (key, i) the left and right siblings of every level."""
        parts = [f"{name}0 AS ({start})"]
        for k in range(depth):
            parts.append(
                f"{name}r{k} AS (SELECT {key}, i // 16 AS run, list(d ORDER BY i) AS ds, "
                f"any_value(n) AS n FROM {name}{k} GROUP BY ALL)")
            parts.append(
                f"{name}{k + 1} AS (SELECT {key}, run AS i, CASE WHEN n = 1 THEN ds[1] ELSE "
                f"sha256(array_to_string(ds, '')) END AS d, (n + 15) // 16 AS n FROM {name}r{k})")
        cols = ", ".join(
            f"CASE WHEN r{k}.n > 1 THEN [array_to_string(r{k}.ds[1:(z.i // {16 ** k}) % 16], ''), "
            f"array_to_string(r{k}.ds[(z.i // {16 ** k}) % 16 + 2:], '')] END AS s{k}"
            for k in range(depth))
        joins = " ".join(
            f"JOIN {name}r{k} r{k} ON r{k}.{key} = z.{key} AND r{k}.run = z.i // {16 ** (k + 1)}"
            for k in range(depth))
        parts.append(f"{name}s AS (SELECT z.*, {cols} FROM {name}0 z {joins})")
        return ", ".join(parts)

    def folded(value, rows):
        out = value
        for row in rows:
            out = f"(CASE WHEN {row} IS NULL THEN {out} ELSE sha256({row}[1] || {out} || {row}[2]) END)"
        return out

    lower = f"translate(text, '{_UP}', '{_LOW}')"
    changed = h(["doc_id", "source", "lang", "n_chars", "other"])
    steps = [f"l.s{k}" for k in range(depth)] + [f"t.s{k}" for k in range(depth)]
    proof = " || ".join(f"coalesce({s}[1] || {s}[2], '')" for s in steps)
    # nested folds are written level by level, as an expression would double at each
    fold, last = [], "start"
    for k, s in enumerate(steps):
        col = f"w{k}"
        fold.append(f"f{k} AS (SELECT *, CASE WHEN p{k} IS NULL THEN {last} ELSE "
                    f"sha256(p{k}[1] || {last} || p{k}[2]) END AS {col} "
                    f"FROM {'base' if k == 0 else f'f{k - 1}'})")
        last = col
    named = ", ".join(f"{s} AS p{k}" for k, s in enumerate(steps))
    return f"""
WITH docs AS (
  SELECT *, coalesce('s' || source, 'n') AS g,
         CASE WHEN doc_id IS NOT NULL AND text IS NOT NULL AND {_crc_sql("doc_id::VARCHAR")} % 5 = 0
              THEN {lower} ELSE text END AS other
  FROM documents),
hashed AS (
  SELECT doc_id, g, {h(["doc_id", "source", "lang", "n_chars", "text"])} AS d, {changed} AS other
  FROM docs),
{tree("l", "g", "SELECT doc_id, other, g, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, d) - 1 AS i, d, count(*) OVER (PARTITION BY g) AS n FROM hashed")},
tops AS (SELECT g AS name, d FROM l{depth}),
{tree("t", "one", "SELECT 1 AS one, name, row_number() OVER (ORDER BY name) - 1 AS i, d, count(*) OVER () AS n FROM tops")},
base AS (
  SELECT l.doc_id, l.d AS leaf, t.d AS subroot, (SELECT d FROM t{depth}) AS root, l.other AS start,
         sha256({proof}) AS proof_sha256, {named}
  FROM ls l JOIN ts t ON t.name = l.g),
{", ".join(fold)}
SELECT doc_id, leaf, subroot, root, proof_sha256, {last} AS folded_root, {last} = root AS verified
FROM f{len(steps) - 1}
"""


def op13_rp_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every 20th vector of ``embeddings`` by inner product."""
    vectors = table(spark, sf_dir, "embeddings")
    return rp_forest.search(vectors, F.col("vec_id") % 20 == 0, k=20)


QUERIES = {f.__name__: f for f in (
    op1_token_cache, op2_simhash_bktree, op3_pairwise_quality, op4_pii_bootstrap, op5_exact_dedup,
    op6_poisson_mix, op7_rule_ledger, op7_rule_ablation, op8_drr_packing, op9_substring_rk,
    op10_byte_cnn, op11_filter_diagram, op12_merkle_windows, op13_rp_forest)}
ORACLE = {"op5_exact_dedup": OP5_SQL, "op6_poisson_mix": OP6_SQL, "op7_rule_ledger": OP7_SQL,
          "op7_rule_ablation": OP7_ABLATION_SQL, "op11_filter_diagram": OP11_SQL,
          "op12_merkle_windows": _merkle_sql()}
