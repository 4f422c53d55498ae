"""Language ID and quality: held-out accuracy on the given tables, and edges."""

import zlib

import numpy as np
from pyspark.sql import functions as F

from indicata.llm import byte_cnn as C
from indicata.llm import pairwise_quality as P
from indicata.llm import queries as Q
from indicata.llm.common import table

SF = "/root/testdata/sf0.01"


def test_language_held_out_accuracy(spark):
    found = Q.op10_byte_cnn(spark, SF).join(table(spark, SF, "documents").select("doc_id", "lang"),
                                            "doc_id").toPandas()
    assert (found.held_out == [zlib.crc32(str(i).encode()) % 3 == 1 for i in found.doc_id]).all()
    held = found[found.held_out]
    assert (held.lang == held.lang_pred).mean() > 0.97
    assert found.score.between(0, 1).all()


def test_language_edges(spark, edge_docs, no_docs):
    got = {r.doc_id: r for r in C.language_id(edge_docs.drop("lang").withColumn(
        "lang", F.lit("en")).withColumn("score", F.lit("clash"))).collect()}
    for i in (3, 4, 5):
        assert (got[i].lang_pred, got[i].score) == ("und", 0.0)
    assert got[6].lang_pred == "en" and got[13].lang_pred == "en"
    assert C.language_id(no_docs).count() == 0
    assert {r.lang_pred for r in C.language_id(edge_docs.withColumn(
        "lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_only_unicode_letters_make_a_language(spark):
    docs = spark.createDataFrame([(i, "plain words of a text", "en") for i in range(20)],
                                 "doc_id bigint, text string, lang string")
    model = C.train(*C.sample(docs, "doc_id", "text", "lang"))
    none = ["\u00bd", "\u00b2 \u00b3", "\u2460\u2461", "\u2167", "\u0301", "1_2", "\u0661", "\U0001f600", "_"]
    some = ["\u00aa", "\u02b0", "\u00df", "\u0436", "\u05d0", "\u4e2d", "\u01c5", "1 x"]
    langs, scores = C.classify(model, none + some)
    assert langs == ["und"] * len(none) + ["en"] * len(some)
    assert scores[:len(none)] == [0.0] * len(none) and min(scores[len(none):]) > 0


def test_language_query_equals_plain_network(spark):
    """Each document's windows, one by one, through a plain convolution of the same model."""
    docs = table(spark, SF, "documents").select("doc_id", "text", "lang")
    model = C.train(*C.sample(docs, "doc_id", "text", "lang"))
    want = {}
    for r in docs.collect():
        if not any(c.isalpha() for c in r.text or ""):
            want[r.doc_id] = ("und", 0.0)
            continue
        x = C.windows(r.text.encode())
        pooled = np.concatenate([
            sum(k[j][x[:, j:C.WINDOW - w + 1 + j]] for j in range(w)).max(axis=1)
            for w, k in model.filters.items()], axis=1)
        logit = np.maximum(pooled + model.bias, 0) @ model.dense + model.offset
        logp = logit - np.log(np.exp(logit).sum(axis=1, keepdims=True))
        weight = np.full(len(x), C.STRIDE, float)
        weight[-1] = max(1, len(r.text.encode()) - C.STRIDE * (len(x) - 1))
        mean = (logp * (weight / weight.sum())[:, None]).sum(axis=0)
        prob = np.exp(mean - mean.max())
        want[r.doc_id] = (model.langs[int(mean.argmax())], float(prob.max() / prob.sum()))
    got = {r.doc_id: (r.lang_pred, r.score) for r in Q.op10_byte_cnn(spark, SF).collect()}
    assert set(got) == set(want)
    assert all(got[i][0] == want[i][0] and abs(got[i][1] - want[i][1]) < 1e-3 for i in want)


def test_training_sample_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(C, "MAX_LANGS", 3)
    monkeypatch.setattr(C, "MAX_DOCS", 10)
    rows = [(7, "one text again and again", "l0")] * 200 \
        + [(i, f"text {i}", f"l{i % 9}") for i in range(300)]
    x, langs = C.sample(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"),
                        "doc_id", "text", "lang")
    assert len(x) <= 40 and len(set(langs)) <= 3


def test_windows_hold_every_run_of_bytes():
    for n in (0, 1, 3, 255, 256, 257, 509, 512, 5000):
        data = np.random.default_rng(n).integers(1, 255, n).astype(np.uint8).tobytes()
        seen = {w[i:i + 4].tobytes() for w in C.windows(data) for i in range(C.WINDOW - 3)}
        assert all(data[i:i + 4] in seen for i in range(n - 3))


def test_pair_tables_equal_plain_convolution():
    x = np.random.default_rng(0).integers(0, 256, (130, C.WINDOW)).astype(np.uint8)
    model = C.train(x, ["a" if r[0] < 128 else "b" for r in x], epochs=1)
    pooled = []
    for w, k in model.filters.items():
        out = sum(k[j][x[:, j:C.WINDOW - w + 1 + j]] for j in range(w))
        pooled.append(out.max(axis=1))
    logit = np.maximum(np.concatenate(pooled, axis=1) + model.bias, 0) @ model.dense + model.offset
    want = logit - np.log(np.exp(logit).sum(axis=1, keepdims=True))
    assert np.allclose(C.log_probabilities(model, x), want, atol=1e-4)


def test_quality_held_out_accuracy(spark):
    labels = table(spark, SF, "labels")
    found = Q.op3_pairwise_quality(spark, SF).join(labels, "doc_id").toPandas()
    assert (found.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in found.doc_id]).all()
    held = found[found.held_out]
    assert (held.quality == held.predicted).mean() > 0.95
    good, bad = held.score[held.quality == 1], held.score[held.quality == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.98


def test_quality_edges(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(i, int(i < 12), 0) for i in (1, 2, 4, 6, 7, 9, 12, 13, 14)],
                                   "doc_id bigint, quality int, toxic int")
    model = P.learn(edge_docs, labels)
    rows = P.rank(edge_docs, model).collect()
    assert len(rows) == 17 and all(0 <= r.score <= 1 for r in rows)
    assert P.rank(no_docs, model).count() == 0
    assert P.learn(edge_docs, labels.filter("quality = 1")) is None
    assert {r.score for r in P.rank(edge_docs, None).collect()} == {0.5}
    assert P.learn(no_docs, labels) is None


def test_quality_threshold_covers_all_labelled_rows(spark, monkeypatch):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    labels = labels.filter("doc_id IS NOT NULL")
    monkeypatch.setattr(P, "SAMPLE_ROWS", labels.count() // 4)
    model = P.learn(docs, labels)
    rows = docs.join(labels.filter(~P.held_out(F.col("doc_id"))), "doc_id").toPandas()
    s = np.sort(model.raw(np.array([P.features(t) for t in rows.text])))
    k = int((rows.quality == 0).sum())
    assert 0 < k < len(s) and np.isclose(model.threshold, (s[k - 1] + s[k]) / 2, atol=1e-9)


def test_quantile_search_is_exact(spark, monkeypatch):
    monkeypatch.setattr(P, "INTERVALS", 3)
    rng = np.random.default_rng(5)
    values = [*rng.normal(size=200), *[0.25] * 50, 1e9, -1e9, 5e-324, 0.0]
    scores = spark.createDataFrame([(float(v),) for v in values], "s double").repartition(3).cache()
    for k in (1, 2, 100, 140, 200, 253, 254):
        assert P.smallest(scores, k) == sorted(values)[k - 1]
    scores.unpersist()


def test_bradley_terry_orders_and_cuts_at_the_quantile():
    rng = np.random.default_rng(3)
    y = (rng.random(2000) < 0.8).astype(int)
    x = np.c_[rng.normal(3 * y, 1), rng.normal(size=2000)]
    model = P.fit(x, y, pairs=5000)
    assert abs(model.weights[0]) > 5 * abs(model.weights[1])
    assert abs((model.score(x) < P.CUT).mean() - (y == 0).mean()) < 0.01
