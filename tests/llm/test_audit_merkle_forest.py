"""Operators 11 to 13 against plain Python, with the edges they state."""

import hashlib
import zlib
from itertools import permutations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from indicata.llm import filter_diagram, merkle_windows, rp_forest


# --- 11 ---------------------------------------------------------------------------------------

def plain_audit(rows, filters):
    """(order, step) -> counts, by applying the filters of each order one after another."""
    out, removed_by = {}, dict.fromkeys(filters, 0)
    for order in permutations(filters):
        left = rows
        for step, f in enumerate(order, 1):
            bit = 1 << filters.index(f)
            gone = [r for r in left if r[0] & bit]
            early = sum(1 for r in rows if r[0] & bit) - len(gone)
            left = [r for r in left if not r[0] & bit]
            out["".join(order), step] = [len(left), len(gone), early,
                                         sum(1 for r in rows if r[0] == bit),
                                         sum(r[1] for r in gone), sum(r[2] for r in gone)]
            removed_by[f] += len(gone)
    return {k: tuple(v + [removed_by[k[0][k[1] - 1]]]) for k, v in out.items()}


def totals(rows):
    found = {}
    for mask, good, toxic in rows:
        n, g, t = found.get(mask, (0, 0, 0))
        found[mask] = (n + 1, g + good, t + toxic)
    return found


@settings(deadline=None, max_examples=40)
@given(st.integers(1, 5).flatmap(lambda n: st.tuples(
    st.just("ABCDE"[:n]),
    st.lists(st.tuples(st.integers(0, 2 ** n - 1), st.integers(0, 1), st.integers(0, 1)),
             min_size=1, max_size=40))))
def test_diagram_steps_equal_filters_in_turn(case):
    filters, rows = case
    got = filter_diagram.audit_part(filters, totals(rows))
    assert {(r[0], r[1]): tuple(r[2:]) for r in got} == plain_audit(rows, filters)
    assert len(got) == len({(r[0], r[1]) for r in got})


def test_swap_keeps_other_levels_and_shares_equal_nodes():
    rows = [(m, 0, 0) for m in range(32)] * 2 + [(3, 1, 0)]
    d = filter_diagram.Diagram("ABCDE", totals(rows))
    before = [dict(level) for level in d.level]
    nodes = sum(map(len, before))
    assert nodes < 31  # a full tree
    d.swap(1)
    assert [d.level[v] for v in (0, 3, 4)] == [before[v] for v in (0, 3, 4)]
    assert d.order == [0, 2, 1, 3, 4]
    d.swap(1)
    assert sum(map(len, d.level)) == nodes


def test_plain_changes_visit_every_order():
    for n in range(1, 6):
        order, seen = list(range(n)), set()
        seen.add(tuple(order))
        for at in filter_diagram.plain_changes(n):
            order[at:at + 2] = order[at + 1], order[at]
            seen.add(tuple(order))
        assert seen == set(permutations(range(n)))


def plain_masks(rows, labels):
    out = []
    for doc, text, _, source, *_ in rows:
        t = text or ""
        words = t.encode().split()
        twins = [r[0] for r in rows if (r[1] or "") == t and r[0] is not None]
        mask = ((len(words) < 200) + 2 * (100 * len(set(words)) < 50 * len(words))
                + 4 * (100 * sum("A" <= c <= "Z" for c in t) > 2 * len(t))
                + 8 * any(c in "#$%&*|" for c in t)
                + 16 * (doc is not None and any(x < doc for x in twins)))
        said = [x for x in labels if x[0] == doc and doc is not None]
        out.append((source or "", mask, int(any(x[1] == 1 for x in said)),
                    int(any(x[2] == 1 for x in said))))
    return out


def test_audit_edges(spark, edge_docs, edge_rows, no_docs):
    labels = [(1, 1, 0), (1, 0, 1), (2, None, 1), (4, 1, None), (None, 1, 1), (6, 1, 0),
              (99, 1, 1), (11, 1, 1)]
    labelled = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    clash = edge_docs.withColumns({c: F.lit("x") for c in ("part", "mask", "bits", "digest", "id",
                                                           "good", "n", "least")})
    masks = filter_diagram.failure_masks(clash, labelled)
    want = plain_masks(edge_rows, labels)
    assert sorted(map(tuple, masks.collect())) == sorted(want)
    got = filter_diagram.audit(masks).collect()
    parts = {w[0] for w in want}
    assert len(got) == 600 * len(parts)
    for part in parts:
        rows = [w[1:] for w in want if w[0] == part]
        mine = {(r["filter_order"], r["step"]): tuple(r)[3:] for r in got if r["part"] == part}
        assert mine == plain_audit(rows, "ABCDE")
    empty = filter_diagram.audit(filter_diagram.failure_masks(no_docs))
    assert empty.collect() == [] and empty.columns[0] == "part"
    with pytest.raises(ValueError):
        filter_diagram.audit(masks, "ABCDEFGH")


# --- 12 ---------------------------------------------------------------------------------------

def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def enc(*values):
    return "".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values)


def plain_tree(leaves):
    """Root, and per leaf the (left, right) siblings of every level."""
    steps, at, nodes = [[] for _ in leaves], list(range(len(leaves))), leaves
    while len(nodes) > 1:
        runs = [nodes[i:i + 16] for i in range(0, len(nodes), 16)]
        for k, i in enumerate(at):
            run = runs[i // 16]
            steps[k].append(("".join(run[:i % 16]), "".join(run[i % 16 + 1:])))
        at, nodes = [i // 16 for i in at], [sha(*run) for run in runs]
    return nodes[0], steps


def plain_manifest(rows):
    """rows: doc_id, source, lang, n_chars, text."""
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append((r, sha(enc(*r))))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
        trees[g] = plain_tree([x[1] for x in groups[g]])
    root, over = plain_tree([trees[g][0] for g in names])
    out = []
    for g, top in zip(names, over):
        for (r, leaf), steps in zip(groups[g], trees[g][1]):
            path = steps + top
            text = r[4]
            if text is not None and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            node = sha(enc(*r[:4], text))
            for left, right in path:
                node = sha(left, node, right)
            out.append((r[0], leaf, trees[g][0], root, sha(*[a + b for a, b in path]), node,
                        node == root))
    return out


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def same(got, want):
    key = repr
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_manifest_edges(spark, edge_docs, edge_rows, no_docs):
    clash = edge_docs.withColumns({c: F.lit("x") for c in ("g", "i", "n", "digest", "leaf", "top",
                                                           "root", "run", "block", "id")})
    want = plain_manifest([(r[0], r[3], r[2], r[4], r[1]) for r in edge_rows])
    same(merkle_windows.manifest(clash).select(*COLUMNS).collect(), want)
    assert merkle_windows.manifest(no_docs).collect() == []


@pytest.mark.parametrize("sizes", [(1,), (16,), (17, 1), (257, 1, 16, 300), (4200,)])
def test_manifest_equals_plain_trees(spark, sizes):
    rows = [(1000 * k + i, f"s{k}" if k else None, "en", i, f"Text {i} OF {k}")
            for k, n in enumerate(sizes) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, lang string, "
                                       "n_chars bigint, text string").repartition(5)
    got = merkle_windows.manifest(docs).select(*COLUMNS).collect()
    same(got, plain_manifest(rows))
    tampered = [r for r in got if not r["verified"]]
    assert tampered and len(tampered) < len(got) or len(rows) < 17


def test_manifest_of_many_sources(spark):
    rows = [(i, f"h{i % 700}", None, 1, "a") for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, lang string, "
                                       "n_chars bigint, text string")
    same(merkle_windows.manifest(docs).select(*COLUMNS).collect(), plain_manifest(rows))


def test_window_partitions_are_bounded(spark):
    nodes = spark.range(2000).select(F.lit("sx").alias("g"), F.col("id").alias("i"),
                                     F.lit(2000).cast("long").alias("n"),
                                     F.sha2(F.col("id").cast("string"), 256).alias("digest"))
    most = merkle_windows.with_siblings(nodes).groupBy("g", "block").count() \
        .agg(F.max("count")).first()[0]
    assert most == 256


# --- 13 ---------------------------------------------------------------------------------------

def brute(rows, k):
    """query row -> [(score, id, row)] of the valid rows."""
    ok = [(i, vid, np.asarray(v, float)) for i, (vid, v) in enumerate(rows)
          if v and None not in v and np.isfinite(v).all() and np.any(v)]
    dim = max({len(v) for *_, v in ok},
              key=lambda n: (sum(len(v) == n for *_, v in ok), n), default=0)
    ok = [x for x in ok if len(x[2]) == dim]
    out = []
    for i, vid, q in ok:
        if vid is not None and vid % 20 == 0:
            near = sorted((-float((q * v).sum()), o is None, o or 0, j)
                          for j, o, v in ok if j != i)[:k]
            out.append((vid, [(-s, None if no else o) for s, no, o, _ in near]))
    return out


def searched(spark, rows, k, kind="float"):
    frame = spark.createDataFrame(rows, f"vec_id bigint, embedding array<{kind}>").repartition(4)
    frame = frame.withColumns({c: F.lit(1) for c in ("row", "id", "vec", "query", "bucket")})
    found = {}
    for r in rp_forest.search(frame, F.col("vec_id") % 20 == 0, k).collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["score"], r["vec_id"]))
    return {q: [(s, v) for _, s, v in sorted(x)] for q, x in found.items()}


def test_search_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.0]), (2, [0.5, 0.0]), (3, [-1.0, 2.0]), (4, None),
            (5, [0.0, 0.0]), (6, [1.0, None]), (7, [nan, 1.0]), (8, [inf, 1.0]), (9, []),
            (10, [1.0, 2.0, 3.0]), (20, [3.0, -4.0]), (40, [0.0, 0.0]), (None, [0.5, 0.0]),
            (60, [1e-30, 1e-30]), (80, None)]
    got = searched(spark, rows, 4, "double")
    want = dict(brute(rows, 4))
    assert {q: [v for _, v in x] for q, x in got.items()} \
        == {q: [v for _, v in x] for q, x in want.items()}
    for q, x in got.items():
        assert np.allclose([s for s, _ in x], [s for s, _ in want[q]], rtol=1e-14)
    assert searched(spark, [(0, [1.0])], 3) == {}
    assert searched(spark, [], 3) == {}
    assert searched(spark, [(0, None), (20, [0.0])], 3) == {}


def test_search_repeated_rows(spark):
    rows = [(0, [1.0, 1.0])] * 3 + [(1, [2.0, 2.0])]
    got = searched(spark, rows, 2)
    assert got[0] == [(2.0, 0), (2.0, 0), (2.0, 0), (4.0, 1), (4.0, 1), (4.0, 1)] \
        or sorted(got[0]) == [(2.0, 0)] * 3 + [(4.0, 1)] * 3


@pytest.mark.parametrize("shape", ["random", "clusters", "lengths", "copies"])
def test_search_recall(spark, monkeypatch, shape):
    monkeypatch.setattr(rp_forest, "LEAF_ROWS", 50)
    monkeypatch.setattr(rp_forest, "BUCKET_ROWS", 120)
    rng = np.random.default_rng(3)
    n, d, k = 1600, 12, 10
    x = rng.normal(size=(n, d))
    if shape == "clusters":
        x = rng.normal(size=(40, d))[rng.integers(0, 40, n)] + 0.1 * x
    if shape != "lengths":
        x /= np.linalg.norm(x, axis=1, keepdims=True)
    if shape == "copies":  # a third of all rows is one vector
        x[::3] = x[0]
    rows = [(int(i), v.astype(np.float32).astype(float).tolist()) for i, v in enumerate(x)]
    got, want = searched(spark, rows, k), dict(brute(rows, k))
    assert set(got) == set(want)
    hits = sum(len({v for _, v in got[q]} & {v for _, v in want[q]}) for q in want)
    assert hits >= 0.9 * k * len(want)
    for q, near in got.items():
        assert len(near) == k and near == sorted(near, key=lambda e: (-e[0], e[1]))
        vectors = dict(rows)
        assert np.allclose([s for s, _ in near],
                           [np.dot(vectors[q], vectors[v]) for _, v in near], atol=1e-12)


def test_budget_follows_the_data(spark, monkeypatch):
    """Where neighbours lie together, the queue reaches them after a small share of the rows."""
    monkeypatch.setattr(rp_forest, "LEAF_ROWS", 50)
    rng = np.random.default_rng(4)
    share = {}
    for shape in ("random", "clusters"):
        x = rng.normal(size=(2000, 16))
        if shape == "clusters":
            x = 3 * rng.normal(size=(50, 16))[rng.integers(0, 50, 2000)] + 0.05 * x
        rows = [(int(i), v.tolist()) for i, v in enumerate(x / np.linalg.norm(x, axis=1)[:, None])]
        frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
        valid = rp_forest.valid_vectors(frame, F.col("vec_id") % 20 == 0, "vec_id", "embedding")
        forest = rp_forest.build(valid, 10)
        assert forest.sizes.sum() == 2000 * rp_forest.TREES
        share[shape] = forest.budget / 2000
    assert share["clusters"] < 0.5 * share["random"]


def test_hot_leaf_is_split(monkeypatch):
    monkeypatch.setattr(rp_forest, "BUCKET_ROWS", 100)
    sizes = np.array([10, 1000, 20, 0, 60, 30, 5, 5])  # 4 trees of 2 leaves
    first, many = rp_forest._buckets(sizes)
    assert many.tolist() == [1, 10, 1, 1, 1, 1, 1, 1]
    spans = [set(range(f, f + m)) for f, m in zip(first, many)]
    assert not spans[0] & spans[1] and not spans[1] & spans[2] and not spans[3] & spans[4]
