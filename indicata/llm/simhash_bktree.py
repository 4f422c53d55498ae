"""Operator 2, SimHash near-dedup with BK-trees.

1. *Fingerprints*, 64 bits by majority over the hashes of word shingles.  Equal
   fingerprints form a class; classes, not rows, go on.
2. *Shards.*  With four bands of 16 bits, two fingerprints at most 2 bits apart
   agree on two bands at least.  Each class goes to the shards of its six pairs
   of bands.  A shard with more than ``tree_size`` classes is dealt anew by six
   pairs of the other 32 bits; 16 bits are then free, so no tree ever has more
   than 65,536 nodes.
3. *Trees.*  A task builds the BK-tree of each of its shards (children keyed by
   integer Hamming distance to the parent) and follows only the edges within
   the radius.  The trees together grow with the corpus, so they meet their
   queries by a shuffle on the shard, where a broadcast would have no bound.
   Each shard returns a spanning forest of its links, not every pair.
4. *Groups* by alternating large and small stars.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indicata.llm.common import stage

SEED = 42
PAIRS = list(combinations(range(4), 2))
ROWS = 1 << 14


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """SimHash of a text: A-Z lower-cased, words between ASCII white space."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    n = max(1, len(words) - shingle + 1)
    h = np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(SEED)), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for i in range(0, n, ROWS):
        part = h[i:i + ROWS].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > n).view(np.int64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = 3) -> DataFrame:
    """The id and the fingerprint (as a signed long, ``fp``) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t.as_py(), shingle) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.int64())],
                                             [id_col, "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, fp bigint")


def build_trees(tree: np.ndarray, fp: np.ndarray):
    """A BK-tree for every run of equal ``tree``; nodes are positions in ``fp``.

    Returns each node's root, and the edges sorted by 65 * parent + distance,
    with their children.  The rows of all trees go down one level at a time.
    """
    first = np.flatnonzero(np.diff(tree, prepend=tree[:1] - 1))
    root = first[np.cumsum(np.isin(np.arange(len(tree)), first)) - 1]
    rows = np.setdiff1d(np.arange(len(tree)), first, assume_unique=True)
    at, edges, children = root[rows], [], []
    while len(rows):
        edge = at * 65 + np.bitwise_count(fp[rows] ^ fp[at])
        order = np.argsort(edge, kind="stable")
        rows, edge = rows[order], edge[order]
        new = np.diff(edge, prepend=-1) != 0
        edges.append(edge[new])
        children.append(rows[new])
        at = rows[new][np.cumsum(new) - 1][~new]
        rows = rows[~new]
    edges = np.concatenate(edges) if edges else np.empty(0, np.int64)
    children = np.concatenate(children) if children else np.empty(0, np.int64)
    order = np.argsort(edges)
    return root, edges[order], children[order]


def search_trees(fp: np.ndarray, root: np.ndarray, edges: np.ndarray, children: np.ndarray,
                 rows: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row, node) of ``rows`` and the nodes of their trees within ``radius`` bits."""
    query, node, out = rows, root[rows], []
    while len(query):
        d = np.bitwise_count(fp[query] ^ fp[node]).astype(np.int64)
        near = d <= radius
        out.append((query[near], node[near]))
        low = np.searchsorted(edges, node * 65 + np.maximum(d - radius, 0))
        high = np.searchsorted(edges, node * 65 + np.minimum(d + radius, 64), side="right")
        n = high - low
        query = np.repeat(query, n)
        node = children[np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())]
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (rows[:0], rows[:0])


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least member of each of ``n`` rows' group under the links a-b."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _links(tree: np.ndarray, fp: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links inside each tree, as pairs of fingerprints."""
    size = np.diff(np.append(np.flatnonzero(np.diff(tree, prepend=tree[:1] - 1)), len(tree)))
    many = np.repeat(size > 1, size)
    tree, fp, widest = tree[many], fp[many], int(size.max())
    root, edges, children = build_trees(tree, fp)
    a, b, step = [], [], max(1, (1 << 21) // max(1, widest))
    for i in range(0, len(fp), step):
        rows = np.arange(i, min(i + step, len(fp)))
        q, v = search_trees(fp, root, edges, children, rows, radius)
        a.append(q[q > v])
        b.append(v[q > v])
    if not a:
        return fp[:0], fp[:0]
    label = _roots(len(fp), np.concatenate(a), np.concatenate(b))
    own = np.flatnonzero(label != np.arange(len(fp)))
    return fp[own], fp[label[own]]


def _bits(c: Column, shift: int, width: int) -> Column:
    return F.shiftrightunsigned(c, shift).bitwiseAND(F.lit((1 << width) - 1).cast("long"))


def shards(classes: DataFrame, tree_size: int) -> DataFrame:
    """Each fingerprint with its shards: table (number of the pair of bands) and key."""
    fp = F.col("fp")
    band = [_bits(fp, 16 * i, 16) for i in range(4)]
    coarse = F.array(*[
        F.struct(F.lit(t).alias("t"),
                 F.shiftleft(band[i], 16).bitwiseOR(band[j]).alias("k"))
        for t, (i, j) in enumerate(PAIRS)])
    rows = classes.select("fp", F.explode(coarse).alias("s")).select("fp", "s.t", "s.k")
    full = stage(rows.groupBy("t", "k").agg(F.count(F.lit(1)).alias("n"))
                 .filter(F.col("n") > tree_size).select("t", "k"), "full")
    fine = []
    for t, pair in enumerate(PAIRS):
        rest = [16 * i + 8 * h for i in range(4) if i not in pair for h in (0, 1)]
        for s, (i, j) in enumerate(PAIRS):
            key = F.shiftleft(F.col("k"), 16).bitwiseOR(
                F.shiftleft(_bits(fp, rest[i], 8), 8).bitwiseOR(_bits(fp, rest[j], 8)))
            fine.append(F.struct(F.lit(len(PAIRS) * (t + 1) + s).alias("t"), key.alias("k")))
    picked = F.slice(F.array(*fine), F.col("t") * len(PAIRS) + 1, len(PAIRS))
    deep = rows.join(full, ["t", "k"], "left_semi").select("fp", F.explode(picked).alias("s"))
    return (rows.join(full, ["t", "k"], "left_anti").select("fp", "t", "k")
            .unionByName(deep.select("fp", "s.t", "s.k")))


def links(classes: DataFrame, radius: int = 2, tree_size: int = 4096) -> DataFrame:
    """Links a-b between distinct fingerprints that join the same groups as all links do."""
    if radius > 2:
        raise ValueError("four bands find fingerprints at most 2 bits apart")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = None

        def found(t, k, fp):
            tree = np.cumsum((np.diff(t, prepend=-1) != 0) | (np.diff(k, prepend=-1) != 0))
            a, b = _links(tree, fp, radius)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)),
                                               pa.array(b.view(np.int64))], ["a", "b"])

        for batch in batches:
            t, k, fp = (batch.column(c).to_numpy() for c in ("t", "k", "fp"))
            fp = fp.view(np.uint64)
            if left is not None:
                t, k, fp = (np.concatenate(x) for x in zip(left, (t, k, fp)))
            if not len(t):
                continue
            last = np.flatnonzero((t != t[-1]) | (k != k[-1]))
            cut = last[-1] + 1 if len(last) else 0  # the last shard may go on in the next batch
            if cut:
                yield found(t[:cut], k[:cut], fp[:cut])
            left = (t[cut:], k[cut:], fp[cut:])
        if left is not None:
            yield found(*left)

    rows = shards(classes, tree_size).repartition("t", "k").sortWithinPartitions("t", "k", "fp")
    return rows.mapInArrow(run, "a bigint, b bigint").distinct()


def stars(edges: DataFrame) -> DataFrame:
    """Each linked node (a) and the least node of its component (b).

    Alternating large and small stars; every round is written, so a lost
    executor costs one round at most.  A hot centre's rows meet one row of the
    minima in a join that Spark can split.
    """
    def order(e: DataFrame) -> DataFrame:
        return (e.filter("a != b").select(F.greatest("a", "b").alias("a"),
                                          F.least("a", "b").alias("b")).distinct())

    def state(e: DataFrame):
        return e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()

    edges = stage(order(edges), "links")
    before = state(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        least = least.select("a", F.least("a", "m").alias("m"))
        large = order(both.join(least, "a").filter("b > a").select(F.col("b").alias("a"),
                                                                   F.col("m").alias("b")))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = order(small.select(F.col("b").alias("a"), F.col("m").alias("b"))
                      .unionByName(least.select("a", F.col("m").alias("b"))))
        edges = stage(small, "links")
        after = state(edges)
        if after == before:
            break
        before = after
    return edges


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                shingle: int = 3, radius: int = 2, tree_size: int = 4096) -> DataFrame:
    """The id, fp and component (least id of the group) of every row.

    Texts without a word have fingerprint zero and link like any other; null
    texts count as empty.  A null id never names a group that has another id.
    Repeated rows share a fingerprint.  An empty table gives an empty result.
    """
    rows = stage(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    classes = stage(rows.groupBy("fp").agg(F.min(id_col).alias("low")), "classes")
    joined = stars(links(classes, radius, tree_size)) \
        .select(F.col("a").alias("fp"), F.col("b").alias("top"))
    member = classes.join(joined, "fp", "left").withColumn("top", F.coalesce("top", "fp"))
    lowest = member.groupBy("top").agg(F.min("low").alias("component"))
    of = member.select("fp", "top").join(lowest, "top").select("fp", "component")
    return rows.join(of, "fp").select(id_col, "fp", "component")
