"""Operator 13, approximate nearest neighbours: a forest of random-projection trees.

1. Valid vectors are written once with a row number.  Directions are random,
   thresholds are medians of a bounded sample; every row is then dealt to one
   leaf of each tree.
2. A query pops the trees' nodes from one priority queue, by the sum of squared
   margins on the way, until the leaves it has reached hold ``budget`` rows.
3. The budget is measured: for a bounded sample of queries the true neighbours
   are found by brute force, and with them the share of rows at which the
   queue reaches ``RECALL`` of them.
4. Leaves are packed into buckets of bounded size (a leaf with more rows, as of
   many copies, takes several).  A bucket's members come first, its queries
   stream past them: leaf candidates are reranked by the inner product in
   double precision and each query keeps its best of the bucket.

Largest inner product is nearest neighbour after adding a component that gives
all vectors one length, so vectors need not be of unit length.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from indicata.llm.common import stage

TREES, LEAF_ROWS, MAX_DEPTH = 4, 1024, 10
#: Bounds of the sample for thresholds, the sample of queries, the bytes of all directions.
SAMPLE_ROWS, SAMPLE_QUERIES, MODEL_BYTES = 8192, 128, 16 << 20
#: Share of the sampled queries' neighbours that the budget must reach.
RECALL = 0.95
#: Rows of a bucket, queries scored at a time, pairs reranked at a time.
BUCKET_ROWS, QUERY_BLOCK, PAIR_BLOCK = 4096, 256, 1 << 16


@dataclass
class Forest:
    depth: int
    directions: np.ndarray      # (trees * inner nodes, dimension + 1)
    thresholds: np.ndarray      # (trees * inner nodes,)
    scale: float                # the greatest length of a vector
    sizes: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))  # rows by cell
    budget: int = 0

    @property
    def trees(self) -> int:
        return TREES

    @property
    def inner(self) -> int:
        return (1 << self.depth) - 1

    def margins(self, points: np.ndarray) -> np.ndarray:
        return points @ self.directions.T - self.thresholds

    def cells(self, points: np.ndarray) -> np.ndarray:
        """The leaf of each point in each tree; leaves of all trees are numbered through."""
        side = self.margins(points) > 0
        out, rows = np.zeros((len(points), TREES), np.int64), np.arange(len(points))
        for t in range(TREES):
            for _ in range(self.depth):
                out[:, t] = 2 * out[:, t] + 1 + side[rows, t * self.inner + out[:, t]]
            out[:, t] += -self.inner + (t << self.depth)
        return out

    def visits(self, margins: np.ndarray) -> Iterator[int]:
        """Cells in the order of the queue that all trees share."""
        queue = [(0.0, t, 0) for t in range(TREES)]
        while queue:
            far, t, node = heapq.heappop(queue)
            if node >= self.inner:
                yield node - self.inner + (t << self.depth)
                continue
            m = float(margins[t * self.inner + node])
            near = 2 * node + 1 + (m > 0)
            heapq.heappush(queue, (far, t, near))
            heapq.heappush(queue, (far + m * m, t, 4 * node + 3 - near))

    def reached(self, margins: np.ndarray) -> list[int]:
        """The first cells of the queue that together hold ``budget`` rows."""
        out, rows = [], 0
        for cell in self.visits(margins):
            if rows >= self.budget:
                break
            if self.sizes[cell]:
                out.append(cell)
                rows += int(self.sizes[cell])
        return out


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64) \
        .reshape(len(column), -1)


def raised(vectors: np.ndarray, scale: float) -> np.ndarray:
    """Vectors over ``scale``, with a component that makes their length 1."""
    x = (vectors / scale).astype(np.float32)
    rest = np.sqrt(np.maximum(0, 1 - (x * x).sum(axis=1, dtype=np.float64)))
    return np.hstack([x, rest[:, None].astype(np.float32)])


def pointed(vectors: np.ndarray) -> np.ndarray:
    """Queries by their direction alone, without the added component."""
    big = np.abs(vectors).max(axis=1, keepdims=True)
    x = vectors / big
    x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
    return np.hstack([x, np.zeros((len(x), 1))]).astype(np.float32)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows in double precision, each summed in the same order."""
    with np.errstate(over="ignore", invalid="ignore"):
        return np.nan_to_num((a * b).sum(axis=1), nan=-np.inf, posinf=np.inf, neginf=-np.inf)


def valid_vectors(vectors: DataFrame, is_query: Column, id_col: str, vec_col: str) -> DataFrame:
    """Rows that take part, with a row number: row, id, vec, query."""
    v = F.col("vec")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec"),
                          F.coalesce(is_query, F.lit(False)).alias("query"))
    finite = F.forall(v, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    rows = rows.filter(v.isNotNull() & finite & F.exists(v, lambda x: x != 0))
    lengths = rows.groupBy(F.size(v).alias("n")).count().orderBy(F.desc("count"), F.desc("n"))
    most = lengths.limit(1).collect()
    rows = rows.filter(F.size(v) == (most[0]["n"] if most else 0))
    return stage(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")


def fit(rows: DataFrame) -> Forest | None:
    """Random directions and the thresholds that halve the sample at every node."""
    big = F.aggregate("vec", F.lit(0.0), lambda a, x: F.greatest(a, F.abs(x).cast("double")))
    norm = big * F.sqrt(F.aggregate("vec", F.lit(0.0),
                                    lambda a, x: a + (x / F.col("big")) * (x / F.col("big"))))
    n, scale = rows.withColumn("big", big).agg(
        F.count(F.lit(1)), F.least(F.max(norm.cast("double")), F.lit(1e300))).first()
    if not n:
        return None
    picked = rows.orderBy(F.xxhash64("row"), "row").limit(SAMPLE_ROWS).select("vec").toArrow()
    points = raised(_matrix(picked.column(0).combine_chunks()), scale)
    depth = min(MAX_DEPTH, max(0, int(np.ceil(np.log2(n / LEAF_ROWS)))))
    while depth and TREES * (1 << depth) * points.shape[1] * 4 > MODEL_BYTES:
        depth -= 1
    rng = np.random.default_rng(13)
    inner = (1 << depth) - 1
    directions = rng.normal(size=(TREES * inner, points.shape[1]))
    directions /= np.sqrt((directions ** 2).sum(axis=1, keepdims=True))
    directions = directions.astype(np.float32)
    thresholds = np.zeros(TREES * inner, np.float32)
    for t in range(TREES):
        at = np.zeros(len(points), np.int64)
        for node in range(inner):
            here = np.flatnonzero(at == node)
            side = points[here] @ directions[t * inner + node]
            cut = np.float32(np.median(side)) if len(here) else np.float32(0)
            thresholds[t * inner + node] = cut
            at[here] = 2 * node + 1 + (side > cut)
    return Forest(depth, directions, thresholds, float(scale))


def _sizes(rows: DataFrame, forest: Forest) -> np.ndarray:
    total = TREES << forest.depth

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(total, np.int64)
        for batch in batches:
            if batch.num_rows:
                points = raised(_matrix(batch.column(0)), forest.scale)
                found += np.bincount(forest.cells(points).ravel(), minlength=total)
        here = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(here, pa.int64()), pa.array(found[here])],
                                         ["cell", "n"])

    out = np.zeros(total, np.int64)
    for cell, n in (rows.select("vec").mapInArrow(count, "cell bigint, n bigint")
                    .groupBy("cell").agg(F.sum("n")).collect()):  # one row a cell of the forest
        out[cell] = n
    return out


#: Entries order by it: nearest first, then the smaller id, null ids last.
ENTRY = "struct<far:double,no_id:boolean,id:bigint,row:bigint,cells:array<int>>"


def _best(query: np.ndarray, vectors: np.ndarray, score: np.ndarray, rows: np.ndarray,
          ids: list, own: np.ndarray, k: int, slack: np.ndarray, cells=None) -> list[list[dict]]:
    """Each query's k best of the members: those near its k-th best ``score`` (float32, with an
    error below ``slack``) are compared in double precision."""
    score = np.where(rows[None, :] == own[:, None], -np.inf, score)
    if score.shape[1] > k:
        kth = -np.partition(-score, k - 1, axis=1)[:, k - 1]
        keep = (score >= (kth - 2 * slack)[:, None]) & (score > -np.inf)
    else:
        keep = score > -np.inf
    q, m = np.nonzero(keep)
    exact = np.concatenate([products(query[q[i:i + PAIR_BLOCK]], vectors[m[i:i + PAIR_BLOCK]])
                            for i in range(0, len(q), PAIR_BLOCK)] or [np.empty(0)])
    key = np.array([np.iinfo(np.int64).max if i is None else i for i in ids], np.int64)
    order = np.lexsort((rows[m], key[m], -exact, q))
    first = np.searchsorted(q[order], np.arange(len(query)))
    out = []
    for i, a in enumerate(first):
        b = min(a + k, first[i + 1] if i + 1 < len(first) else len(order))
        out.append([{"far": -float(exact[j]), "no_id": ids[m[j]] is None, "id": ids[m[j]],
                     "row": int(rows[m[j]]), "cells": None if cells is None else cells[m[j]].tolist()}
                    for j in order[a:b]])
    return out


def _merged(tops: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The k best of all lists of a query; a row found in several trees counts once."""
    best = F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("top")))), 1, k)
    return tops.groupBy(*keys).agg(best.alias("top"))


def _budget(rows: DataFrame, forest: Forest, k: int) -> int:
    """Rows to reach for RECALL of the neighbours of a sample of queries."""
    picked = (rows.filter("query").orderBy(F.xxhash64("row", F.lit(1)), "row")
              .limit(SAMPLE_QUERIES).select("row", "vec").toArrow())
    least = TREES * (k + 1)  # a row counts once a tree, so k others are among them
    if not picked.num_rows or not forest.depth:
        return max(least, int(forest.sizes.sum()))
    own = picked.column(0).to_numpy()
    query = _matrix(picked.column(1).combine_chunks())
    aimed = pointed(query)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = _matrix(batch.column(2))
            points = raised(vectors, forest.scale)
            top = _best(query, vectors, aimed @ points.T, batch.column(0).to_numpy(),
                        batch.column(1).to_pylist(), own, k, _slack(aimed), forest.cells(points))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(query))), pa.array(top, _arrow_entries())], ["q", "top"])

    tops = rows.select("row", "id", "vec").mapInArrow(scan, f"q bigint, top array<{ENTRY}>")
    true = {r["q"]: r["top"] for r in _merged(tops, ["q"], k).collect()}  # SAMPLE_QUERIES rows
    margins, need = forest.margins(aimed), []
    for q, top in true.items():
        at, rows_before = {}, 0
        for cell in forest.visits(margins[q]):
            at[cell] = rows_before
            rows_before += int(forest.sizes[cell])
        need += [min(at[c] for c in e["cells"]) + 1 for e in top]
    need.sort()
    return max(least, need[min(len(need) - 1, int(np.ceil(RECALL * len(need))) - 1)] if need else 0)


def _slack(aimed: np.ndarray) -> np.ndarray:
    return np.full(len(aimed), aimed.shape[1] * 2.0 ** -22)


def _arrow_entries() -> pa.DataType:
    return pa.list_(pa.struct([("far", pa.float64()), ("no_id", pa.bool_()), ("id", pa.int64()),
                               ("row", pa.int64()), ("cells", pa.list_(pa.int32()))]))


def build(rows: DataFrame, k: int) -> Forest | None:
    forest = fit(rows)
    if forest is not None:
        forest.sizes = _sizes(rows, forest)
        forest.budget = _budget(rows, forest, k)
    return forest


def _buckets(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First bucket and number of buckets of every cell; small neighbours of a tree share one."""
    first, many = np.zeros(len(sizes), np.int64), np.ones(len(sizes), np.int64)
    at, held = 0, 0
    for cell, n in enumerate(sizes.tolist()):
        if held and (held + n > BUCKET_ROWS or cell % (len(sizes) // TREES) == 0):
            at, held = at + 1, 0
        first[cell], many[cell] = at, max(1, -(-n // BUCKET_ROWS))
        held += n
        if many[cell] > 1:
            at, held = at + int(many[cell]), 0
    return first, many


def search(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id",
           vec_col: str = "embedding", forest: Forest | None = None) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): the k nearest found of every query, nearest first.

    Candidates of a query are all rows but its own.  The score is the inner
    product of the original vectors in double precision; ties go to the smaller
    id, null ids last.  Vectors that are null, empty, zero, hold a null or
    non-finite component, or are not of the table's most frequent length (the
    longer of two) take no part.  Rows that repeat an id are rows of their own;
    a query that repeats one gets its own k rows.  Fewer candidates than k are
    all returned; an empty table gives an empty result.
    """
    rows = valid_vectors(vectors, is_query, id_col, vec_col)
    forest = forest or build(rows, k)
    empty = "query_id bigint, rank int, vec_id bigint, score double"
    if forest is None:
        return vectors.sparkSession.createDataFrame([], empty)
    first, many = _buckets(forest.sizes)
    kind = rows.schema["vec"].dataType
    schema = T.StructType([
        T.StructField("bucket", T.LongType()), T.StructField("asks", T.BooleanType()),
        T.StructField("row", T.LongType()), T.StructField("id", T.LongType()),
        T.StructField("vec", kind), T.StructField("cells", T.ArrayType(T.IntegerType()))])

    def sent(batch: pa.RecordBatch, which, bucket, asks: bool, cells) -> pa.RecordBatch:
        own = batch.take(pa.array(which, pa.int64()))
        return pa.RecordBatch.from_arrays(
            [pa.array(bucket, pa.int64()), pa.array([asks] * len(which)), *own.columns,
             pa.array(cells, pa.list_(pa.int32()))], schema.names)

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            cells = forest.cells(raised(_matrix(batch.column(2)), forest.scale)).ravel()
            row = np.repeat(batch.column(0).to_numpy(), TREES)
            chunk = (row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
            bucket = first[cells] + (chunk % many[cells].astype(np.uint64)).astype(np.int64)
            yield sent(batch, np.repeat(np.arange(batch.num_rows), TREES), bucket, False,
                       cells[:, None].tolist())

    def queries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, QUERY_BLOCK):
                batch = whole.slice(i, QUERY_BLOCK)
                margins = forest.margins(pointed(_matrix(batch.column(2))))
                which, buckets, lists = [], [], []
                for q, m in enumerate(margins):
                    met: dict[int, list[int]] = {}
                    for cell in forest.reached(m):
                        for b in range(first[cell], first[cell] + many[cell]):
                            met.setdefault(b, []).append(cell)
                    which += [q] * len(met)
                    buckets += met.keys()
                    lists += met.values()
                yield sent(batch, which, buckets, True, lists)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, held, done = None, [], True
        vectors = points = rows_ = ids = cells = None
        for batch in batches:
            edges = np.column_stack([batch.column(0).to_numpy(),
                                     batch.column(1).to_numpy(zero_copy_only=False)])
            cuts = [0, *(np.flatnonzero((edges[1:] != edges[:-1]).any(axis=1)) + 1).tolist(),
                    len(edges)]
            for a, b in zip(cuts, cuts[1:]):
                part = batch.slice(a, b - a)
                if not len(edges):
                    continue
                if edges[a, 0] != bucket:
                    bucket, held, done = edges[a, 0], [], False
                if not edges[a, 1]:
                    held.append(part)
                    continue
                if not held:
                    continue
                if not done:
                    vectors = np.concatenate([_matrix(p.column(4)) for p in held])
                    points = raised(vectors, forest.scale)
                    rows_ = np.concatenate([p.column(2).to_numpy() for p in held])
                    ids = [x for p in held for x in p.column(3).to_pylist()]
                    cells = np.concatenate([p.column(5).flatten().to_numpy() for p in held])
                    done = True
                for i in range(0, part.num_rows, QUERY_BLOCK):
                    asked = part.slice(i, QUERY_BLOCK)
                    query = _matrix(asked.column(4))
                    aimed = pointed(query)
                    found = aimed @ points.T
                    for q, own in enumerate(asked.column(5).to_pylist()):
                        found[q, ~np.isin(cells, own)] = -np.inf
                    top = _best(query, vectors, found, rows_, ids, asked.column(2).to_numpy(), k,
                                _slack(aimed))
                    yield pa.RecordBatch.from_arrays(
                        [asked.column(0), asked.column(2), asked.column(3),
                         pa.array(top, _arrow_entries())], ["bucket", "qrow", "query_id", "top"])

    base = rows.select("row", "id", "vec")
    both = base.mapInArrow(members, schema).unionByName(
        rows.filter("query").select("row", "id", "vec").mapInArrow(queries, schema))
    tops = (both.repartition("bucket").sortWithinPartitions("bucket", "asks")
            .mapInArrow(score, f"bucket bigint, qrow bigint, query_id bigint, top array<{ENTRY}>"))
    salts = max(1, int(np.sqrt(first[-1] + many[-1])))
    tops = _merged(tops.withColumn("salt", F.pmod("bucket", F.lit(salts))),
                   ["qrow", "query_id", "salt"], k)
    best = _merged(tops, ["qrow", "query_id"], k)
    return best.select("query_id", F.posexplode("top").alias("at", "e")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("e.id").alias("vec_id"),
        (F.lit(0.0) - F.col("e.far")).alias("score"))
