"""Operator 11, filter interaction audit: count-weighted decision diagrams.

1. One pass over the texts gives each document's failures of the filters that
   look at the text alone, and a digest of the text.  Only these, the id and
   the part go on.
2. Rows of equal digests and the labels are met by shuffles on light rows;
   copies are counted by digest before, so only texts that occur twice are met.
3. Documents are counted by part and failure mask: at most ``2**filters`` rows
   a part, whatever its size.
4. Each part's counts become a decision diagram, one level a filter.  All
   orders of the filters follow from one diagram by swaps of adjacent levels;
   an order's all-pass path has what each step keeps and removes.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indicata.llm.common import stage

#: The filters of ``failure_masks``, in the order of their bits.
FILTERS = "ABCDE"
#: All orders are listed, so their number bounds that of the filters.
MAX_FILTERS = 7
UPPER = bytes(range(ord("A"), ord("Z") + 1))
SYMBOL = re.compile(rb"[#$%&*|]").search


def text_failures(text: str) -> int:
    """Bits of the filters A to D for one text; words are split at ASCII white space."""
    data = text.encode()
    words = data.split()
    upper = len(data) - len(data.translate(None, UPPER))
    return ((len(words) < 200) | (100 * len(set(words)) < 50 * len(words)) << 1
            | (100 * upper > 2 * len(text)) << 2 | (SYMBOL(data) is not None) << 3)


def failure_masks(docs: DataFrame, labels: DataFrame | None = None, id_col: str = "doc_id",
                  text_col: str = "text", part_col: str = "source") -> DataFrame:
    """One row per document: part, mask (a bit a filter of FILTERS), good and toxic (0 or 1).

    A null text is empty, a null part the empty string.  Filter E fails for an
    id above the least one of its text, so rows that repeat the least id pass,
    and a null id passes and is no text's least one.  Of repeated labels of an
    id, one that says good (toxic) is enough; a document without a label, or
    without an id, is neither.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            masks, digests = [], []
            for value in batch.column(2):
                text = value.as_py() or ""
                masks.append(text_failures(text))
                digests.append(hashlib.sha256(text.encode()).digest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(masks, pa.int32()),
                 pa.array(digests, pa.binary())], ["id", "part", "bits", "digest"])

    rows = docs.select(F.col(id_col), F.coalesce(F.col(part_col).cast("string"), F.lit("")),
                       F.col(text_col))
    seen = stage(rows.mapInArrow(scan, f"id {kind}, part string, bits int, digest binary"),
                 "masks")
    least = (seen.groupBy("digest").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n"))
             .filter("n > 1").select("digest", "least"))
    found = seen.join(least, "digest", "left")
    late = F.coalesce(F.col("id") > F.col("least"), F.lit(False)).cast("int")
    found = found.select("id", "part", (F.col("bits") + 16 * late).alias("mask"))
    if labels is None:
        return found.select("part", "mask", F.lit(0).alias("good"), F.lit(0).alias("toxic"))
    said = (labels.groupBy(F.col(id_col).alias("id"))
            .agg(*[F.max(F.coalesce((F.col(c) == 1).cast("int"), F.lit(0))).alias(n)
                   for c, n in (("quality", "good"), ("toxic", "toxic"))]))
    return (found.join(said, "id", "left")
            .select("part", "mask", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("good", "toxic")]))


def plain_changes(n: int) -> Iterator[int]:
    """Places of the swaps (with the next level) that lead through all orders of n levels."""
    if n < 2:
        return
    inner = plain_changes(n - 1)
    while True:
        yield from range(n - 2, -1, -1)
        if (at := next(inner, None)) is None:
            return
        yield at + 1
        yield from range(n - 1)
        if (at := next(inner, None)) is None:
            return
        yield at


class Diagram:
    """Decision diagram of failure masks; a node's total is that of the documents below it.

    Nodes of one level that have the same two branches (pass, fail) are one
    node; the last level's branches are totals of single masks.
    """

    def __init__(self, filters: Sequence[str], totals: Mapping[int, tuple[int, ...]]):
        self.order = list(range(len(filters)))
        self.total: list[tuple[int, ...]] = []
        self.branches: list[tuple[int, int] | None] = []
        self.level: list[dict[tuple[int, int], int]] = [{} for _ in filters]
        width = len(next(iter(totals.values())))
        ends: dict[tuple[int, ...], int] = {}
        row = []
        for path in range(1 << len(filters)):
            mask = sum(1 << v for v in self.order if path >> (len(filters) - 1 - v) & 1)
            weight = tuple(totals.get(mask, (0,) * width))
            if weight not in ends:
                ends[weight] = self._new(weight, None)
            row.append(ends[weight])
        for v in reversed(self.order):
            row = [self._node(v, a, b) for a, b in zip(row[::2], row[1::2])]
        self.root = row[0]

    def _new(self, total: tuple[int, ...], branches: tuple[int, int] | None) -> int:
        self.total.append(total)
        self.branches.append(branches)
        return len(self.total) - 1

    def _node(self, v: int, passed: int, failed: int) -> int:
        known = self.level[v]
        if (passed, failed) not in known:
            total = tuple(map(sum, zip(self.total[passed], self.total[failed])))
            known[passed, failed] = self._new(total, (passed, failed))
        return known[passed, failed]

    def swap(self, at: int) -> None:
        """Exchange the levels ``at`` and ``at + 1``; nodes of other levels stay as they are."""
        x, y = self.order[at:at + 2]
        upper, self.level[x], self.level[y] = self.level[x], {}, {}
        for (passed, failed), node in upper.items():
            (pp, pf), (fp, ff) = self.branches[passed], self.branches[failed]
            self.branches[node] = (self._node(x, pp, fp), self._node(x, pf, ff))
            self.level[y][self.branches[node]] = node
        self.order[at:at + 2] = y, x

    def steps(self) -> Iterator[tuple[int, tuple[int, ...], tuple[int, ...]]]:
        """Along the all-pass path: filter, totals kept and totals removed."""
        node = self.root
        for v in self.order:
            node, failed = self.branches[node]
            yield v, self.total[node], self.total[failed]


def audit_part(filters: str, totals: Mapping[int, tuple[int, int, int]]) -> list[tuple]:
    """All orders' steps of one part: order, step, kept, removed, redundant, unique fails, good
    lost, toxic lost, Shapley sum."""
    diagram = Diagram(filters, totals)
    n = len(filters)
    fails, alone, summed, rows = [0] * n, [0] * n, [0] * n, []
    changes = plain_changes(n)
    while True:
        order = "".join(filters[v] for v in diagram.order)
        for step, (v, kept, removed) in enumerate(diagram.steps(), 1):
            rows.append((order, step, v, kept[0], *removed))
            summed[v] += removed[0]
            if step == 1:
                fails[v] = removed[0]
            if step == n:
                alone[v] = removed[0]
        if (at := next(changes, None)) is None:
            break
        diagram.swap(at)
    return [(order, step, kept, gone, fails[v] - gone, alone[v], good, toxic, summed[v])
            for order, step, v, kept, gone, good, toxic in rows]


NAMES = ("filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost",
         "toxic_lost", "shapley")


def audit(masks: DataFrame, filters: str = FILTERS) -> DataFrame:
    """Rows (part, filter_order, step, and the counts of NAMES) for every part and order.

    ``masks`` has part, mask, good and toxic, one row per document.  An empty
    table has no part and gives an empty result.
    """
    if not 0 < len(filters) <= MAX_FILTERS:
        raise ValueError(f"1 to {MAX_FILTERS} filters, as all orders are listed")
    counts = (masks.groupBy("part", "mask")
              .agg(F.count(F.lit(1)).alias("n"), F.sum("good").alias("good"),
                   F.sum("toxic").alias("toxic"))
              .groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic"))
                                   .alias("counts")))
    kinds = [pa.string(), pa.int32(), *[pa.int64()] * 7]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                found = audit_part(filters, {c["mask"]: (c["n"], c["good"], c["toxic"])
                                             for c in row["counts"]})
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["part"]] * len(found), pa.string()),
                     *[pa.array(c, k) for c, k in zip(zip(*found), kinds)]], ["part", *NAMES])

    return counts.mapInArrow(run, "part string, filter_order string, step int, "
                             + ", ".join(f"{c} bigint" for c in NAMES[2:]))
