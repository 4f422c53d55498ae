"""Exact dedup, mixing, rule ledger and the pipeline against plain Python."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from indicata.llm import byte_cnn as C
from indicata.llm import exact_index as X
from indicata.llm import poisson_mix as M
from indicata.llm import queries as Q
from indicata.llm import rule_ledger as L
from indicata.llm.common import table
from tests.llm.test_simhash_substring import brute_fp, brute_groups

SF = "/root/testdata/sf0.001"


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def plain_copies(rows, seed=17, temperature=0.7):
    """Copies by id of (id, source, text) rows."""
    mass = Counter()
    for _, s, t in rows:
        mass[s] += len((t or "").encode()) + 1
    total, weight = sum(mass.values()), {s: m ** temperature for s, m in mass.items()}
    out = {}
    for i, s, _ in rows:
        rate = total * weight[s] / sum(weight.values()) / mass[s]
        text = f"{seed}:{'' if i is None else i}"
        u = int(hashlib.md5(text.encode()).hexdigest()[:13], 16) / 2 ** 52
        k, p = 0, math.exp(-rate)
        c = p
        while c <= u:
            k += 1
            p *= rate / k
            c += p
        out[i] = k
    return out


def test_exact_dedup_edges_collisions_and_splits(edge_docs, no_docs):
    rows = edge_docs.select("doc_id", "text").collect()
    want = defaultdict(list)
    for r in rows:
        want[low(r.text)].append(r.doc_id)
    weak = lambda c: F.char_length(c) % 3  # noqa: E731 - many texts share a key
    for got in (X.exact_dedup(edge_docs.withColumn("kept", F.lit("clash"))),
                X.exact_dedup(edge_docs, bucket_capacity=2, key=weak)):
        got = got.collect()
        assert len(got) == len(rows)
        for r in got:
            ids = want[low(r.text)]
            top = max((i for i in ids if i is not None), default=None)
            assert (r.keep_id, r.group_size, r.kept) == (top, len(ids), r.doc_id == top)
            assert r.text_sha256 == hashlib.sha256(low(r.text).encode()).hexdigest()
    assert X.exact_dedup(no_docs).count() == 0
    index = X.build_index(edge_docs, bucket_capacity=2, key=weak)[1]
    assert index.agg(F.max("chain")).first()[0] > 1


def test_directory_buckets_fit(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"))
    slots, index = X.build_index(docs, bucket_capacity=100)
    assert slots.agg(F.max("global_depth")).first()[0] >= 5
    assert index.groupBy("bucket").count().agg(F.max("count")).first()[0] <= 100
    assert index.count() == 3000


def test_rows_are_found_through_the_directory(spark, monkeypatch):
    """Without half of its slots, the rows of those slots are in no bucket and in no result."""
    docs = spark.range(2000).select(F.col("id").alias("doc_id"),
                                    (F.col("id") % 1500).cast("string").alias("text"))
    whole = X.directory
    monkeypatch.setattr(X, "directory", lambda keys, capacity: whole(keys, capacity)
                        .filter("slot % 2 = 0"))
    assert 0 < X.exact_dedup(docs, bucket_capacity=100).count() < 1500


def test_large_directory_is_joined_by_a_shuffle(edge_docs, monkeypatch):
    monkeypatch.setattr(X, "BROADCAST_SLOTS", 0)
    got = X.exact_dedup(edge_docs)
    assert got.count() == edge_docs.count()
    assert "ResolvedHint (strategy=broadcast)" not in got._jdf.queryExecution().analyzed().toString()


def test_mixing_edges(edge_docs, no_docs):
    rows = [tuple(r) for r in edge_docs.select("doc_id", "source", "text").collect()]
    want, seen = plain_copies(rows), Counter(i for i, _, _ in rows)
    got = Counter(r.doc_id for r in M.poisson_mix(edge_docs.withColumn("rate", F.lit("x"))).collect())
    assert got == Counter({i: n * seen[i] for i, n in want.items() if n})
    assert M.poisson_mix(no_docs).count() == 0
    only = M.poisson_mix(edge_docs, weights={"a": 1.0}, scale=40.0).select("source").distinct()
    assert [r.source for r in only.collect()] == ["a"]


def test_ledger_edges_policies_and_ablation(edge_docs, no_docs):
    led = L.ledger(edge_docs.withColumn("fail_bits", F.lit("x"))).cache()
    got = {r.doc_id: r for r in led.collect()}
    assert led.count() == 17 and L.ledger(no_docs).count() == 0
    for i in (3, 4, 5):
        assert [got[i][c] for c in L.MEASURES] == [0] * 6
    assert got[14].n_repeat_words == 400 and got[14].fail_bits & L.BIT["repeated_windows"]
    assert got[13].fail_bits & L.BIT["long_words"] and got[12].n_symbols == 4
    fails = {r.rule: r for r in L.ablation(led, "v2").collect()}
    for name, bit in L.BIT.items():
        bits = [r.fail_bits for r in led.collect()]
        if name in fails:
            assert fails[name].failed == sum(b & bit != 0 for b in bits)
            assert fails[name].failed_alone == sum(b == bit for b in bits)
            assert fails[name].kept_without == sum(b in (0, bit) for b in bits)
    led.unpersist()


def test_policies_and_ablation_read_the_stored_ledger(spark):
    led = L.stored(table(spark, SF, "documents"))
    assert led.columns == ["doc_id", *L.MEASURES, "fail_bits"]
    found = Q.op7_rule_ledger(spark, SF)
    assert found.inputFiles() and all("/ledger-" in f for f in found.inputFiles())
    bits = [r.fail_bits for r in found.collect()]
    got = {r.rule: (r.failed, r.failed_alone, r.kept_without)
           for r in Q.op7_rule_ablation(spark, SF).collect()}
    assert len(bits) == table(spark, SF, "documents").count()
    assert got == {name: (sum(b & bit != 0 for b in bits), sum(b == bit for b in bits),
                          sum(b in (0, bit) for b in bits)) for name, bit in L.BIT.items()}


def test_dedup_stages_keep_one_row_of_a_group(spark):
    base = " ".join(f"word{i}" for i in range(300))
    rows = [(1, "same ROW"), (1, "same row"), (1, "same row"), (None, "no id here"), (None, "no id here"),
            (None, base), (7, base + " tail"), (7, base + " tall"), (7, "another text altogether of id seven"),
            (None, "a lone text without any id at all"), (7, "same row")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    exact = corpus_pipeline.exact_dedup(spark, docs, SF)
    assert exact.columns == ["doc_id", "text"]
    groups = {t for _, t in rows} - {"same ROW"}
    left = [tuple(r) for r in exact.collect()]
    assert sorted(t for _, t in left) == sorted(groups) and (7, "same row") in left
    prints = {t: brute_fp(t) for t in groups}
    of = {i: c for i, _, c in brute_groups(list(zip(range(len(left)), [prints[t] for _, t in left])))}
    near = [tuple(r) for r in corpus_pipeline.simhash_near_dedup(spark, exact, SF).collect()]
    assert len(near) == len(set(of.values())) < len(left)
    assert {of[left.index(r)] for r in near} == set(of.values())
    for r in near:
        ids = [left[k][0] for k in of if of[k] == of[left.index(r)] and left[k][0] is not None]
        assert r[0] == min(ids, default=None)


def test_pipeline_equals_plain_python(spark):
    docs = table(spark, SF, "documents")
    rows = docs.collect()
    model = C.train(*C.sample(docs, "doc_id", "text", "lang"))
    langs, scores = C.classify(model, [r.text for r in rows])
    rows = [r for r, g, s in zip(rows, langs, scores) if g != "und" and s >= 0.5]
    keep = {}
    for r in rows:
        keep[low(r.text)] = max(r.doc_id, keep.get(low(r.text), r.doc_id))
    rows = [r for r in rows if keep[low(r.text)] == r.doc_id]
    first = {i for i, _, c in brute_groups([(r.doc_id, brute_fp(r.text)) for r in rows]) if i == c}
    rows = [r for r in rows if r.doc_id in first]
    copies = plain_copies([(r.doc_id, r.source, r.text) for r in rows])
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {r.doc_id: copies[r.doc_id] * (1 + len(tok.encode(r.text, add_special_tokens=False).ids))
            for r in rows if copies[r.doc_id]}
    got, filled = Counter(), Counter()
    for p in corpus_pipeline.run(spark, SF).collect():
        got[p.doc_id] += p.length
        filled[p.sequence_id] += p.length
    assert got == Counter(want)
    assert all(n == 4096 or n & (n - 1) == 0 for n in filled.values())


def test_copies_of_high_rates_follow_the_inversion(spark):
    """Above MAX_TABLE the walk from the lower tail equals the sum of the probabilities."""
    cases = [(r, u / 97) for r in (1001.0, 5000.5, 250_000.0) for u in range(1, 97, 8)]
    rows = spark.createDataFrame(cases, "rate double, u double")
    got = rows.select("rate", "u", M.walked(F.col("rate"), F.col("u")).alias("n")).collect()
    for rate, u, n in got:
        k = max(0, math.floor(rate - 12 * math.sqrt(rate)))
        p = math.exp(k * math.log(rate) - rate - math.lgamma(k + 1))
        total, near = p, []
        while total <= u + 1e-9:
            if total > u - 1e-9:
                near.append(k)
            k += 1
            p *= rate / k
            total += p
        assert n == k or n in near or n - 1 in near, (rate, u, n, k)


def test_mix_repeats_a_small_source_to_a_large_weight(spark):
    rows = [(i, "big", "x" * 1000) for i in range(300)] + [(1000, "small", "y" * 9)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    got = M.poisson_mix(docs, weights={"big": 0.5, "small": 0.5}).groupBy("source") \
        .agg(F.count("*").alias("n"), F.max("copy_no").alias("top"), F.max("rate")).collect()
    small = next(r for r in got if r["source"] == "small")
    assert small[3] > M.MAX_TABLE and small["n"] == small["top"]
    assert abs(small["n"] - small[3]) < 5 * math.sqrt(small[3])


def test_copies_of_one_id_are_dealt_to_many_tasks(spark):
    docs = spark.createDataFrame([(None, "s", "t")] * 4000,
                                 "doc_id bigint, source string, text string").repartition(4)
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # no small partitions joined
    try:
        sizes = [r["count"] for r in M.poisson_mix(docs, scale=2.0, seed=2)
                 .groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) > 1 and max(sizes) < 0.6 * sum(sizes)
