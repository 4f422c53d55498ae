"""Operator 4, personal data: bootstrapped contextual extraction.

1. *Seeds.*  Fixed patterns with checks find e-mail addresses, IP addresses,
   card and phone numbers.  A first pass marks the words around them in two
   bitmaps of fixed size.
2. *Candidates.*  A second pass notes the seeds and two sorts of candidates,
   which have a digit or an @ and touch no base span: chains of tokens without
   words, of any length and wherever they are, and short runs with words among
   them, in slots whose words the bitmaps know.  A join with the seeds'
   patterns then drops the runs that the bitmaps let through by chance.
3. *Graph.*  A lexical pattern is the words around a token and its class (with
   an @, else with a digit); an edge joins a pattern to each instance it was
   seen with, of whatever shape.
4. *Rounds.*  A pattern's confidence in a kind is the weight of that kind's
   instances among all its instances; an instance's score is one less the
   product of one less the confidences of its trusted patterns.  Instances
   with a high score count as seeds in the next round.  What was trusted or
   accepted stays so, and the rounds end when none is added.
5. Mentions of accepted instances in trusted patterns become spans of their
   kind.  They never touch a base span, and base spans stay.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from indicata.llm.common import stage

KINDS = ["email", "ip", "card", "phone"]
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
MARK = re.compile(r"[0-9@]")
DIGIT_OR_AT = re.compile(r"[\d@]")
TOKEN = re.compile(r"\S+")
EDGE = " .,;:!?()[]{}<>\"'=|*#$%&\t\n\r\x0b\x0c"
#: Tokens of a candidate that has words among them; a chain has any number.
RUN = 5
#: Bits of each bitmap of seed contexts.
BITS = 1 << 23


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of the address pattern, found from each @: linear in the text."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
            end = m.end()
        else:
            end = max(end, at + 1)
        at = text.find("@", max(at + 1, end))
    return out


def base_spans(text: str | None) -> list[tuple[int, int, int]]:
    """Kind (place in KINDS), start and end in code points, by kind and start."""
    if not text or not MARK.search(text):
        return []
    out = [(0, a, b) for a, b in emails(text)]
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255
               for p in m[0].split(".")):
            out.append((1, *m.span()))
    for kind, pattern, low, high in ((2, CARD, 16, 19), (3, PHONE, 8, 15)):
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m[0])
            if low <= len(digits) <= high and (kind == 3 or luhn(digits)):
                out.append((kind, *m.span()))
    return out


def _bare(word: str) -> str:
    return word.strip(EDGE).lower()


def _bit(text: str) -> int:
    return zlib.crc32(text.encode()) & (BITS - 1)


def _key(text: str) -> bytes:
    """What stands for a pattern or a surface, however long, in the graph."""
    return blake2b(text.encode(), digest_size=16).digest()


class Gate:
    """Bitmaps of the seeds' patterns and of the words before them: 1 MB each, for any corpus.

    They know every seed context, and others by chance.
    """

    def __init__(self, patterns: bytes, lefts: bytes):
        self.patterns, self.lefts = patterns, lefts

    def left(self, word: str) -> bool:
        n = _bit(word)
        return bool(self.lefts[n >> 3] >> (n & 7) & 1)

    def pattern(self, pattern: str) -> bool:
        n = _bit(pattern)
        return bool(self.patterns[n >> 3] >> (n & 7) & 1)


def mentions(text: str | None, spans: list[tuple[int, int, int]]):
    """Base spans and candidates: start, end, kind or None, surface, and the lexical patterns."""
    return [m[:5] for m in _mentions(text, spans, None)]


def _mentions(text: str | None, spans: list[tuple[int, int, int]], gate: Gate | None,
              seeds_only: bool = False):
    """As ``mentions``, and whether the candidate is a short run that needs a seed's pattern.

    A candidate is a run of tokens with a digit or an @ that touches no base
    span.  A chain is the longest run of tokens that have a digit or an @, or
    else no letter, from the first to the last of the former; it is a candidate
    between two words and after two words, however long, and so is the
    longest run without tokens of the latter sort.  Any other run of RUN tokens
    at most is one between two words that ``gate`` knows (without a gate: any
    two).  The text's ends count as words.
    """
    if not text or not DIGIT_OR_AT.search(text) or seeds_only and not spans:
        return []
    tokens = [m.span() for m in TOKEN.finditer(text)]
    starts = [a for a, _ in tokens]
    taken: list[list[int]] = []                 # base spans, overlapping ones joined
    for a, b in sorted((a, b) for _, a, b in spans):
        if taken and a < taken[-1][1]:
            taken[-1][1] = max(taken[-1][1], b)
        else:
            taken.append([a, b])

    words = {}

    def word(i: int) -> str:
        if i not in words:
            raw = text[slice(*tokens[i])] if 0 <= i < len(tokens) else "^" if i < 0 else "$"
            words[i] = _bare(raw) or raw
        return words[i]

    def noted(a, b, kind, left, right, after, short=False):
        surface = text[a:b]
        sort = "@" if "@" in surface else "0"
        patterns = [f"{left[-1]} _ {right} {sort}"] if right is not None else []
        if after:
            patterns.append(f"{left[0]} {left[1]} {sort} _")
        return a, b, kind, surface, patterns, short

    out = []
    for kind, a, b in spans:
        i = bisect_right(starts, a) - 1
        j = bisect_left(starts, b) - 1
        glued = _bare(text[starts[i]:a])
        left = [word(i - 1), glued] if glued else [word(i - 2), word(i - 1)]
        right = _bare(text[b:max(b, tokens[j][1])]) or word(j + 1)
        out.append(noted(a, b, KINDS[kind], left, right, True))
    if seeds_only:
        return out

    ends = [b for _, b in taken]

    def free(i: int) -> bool:
        k = bisect_right(ends, starts[i])
        return k == len(ends) or taken[k][0] >= tokens[i][1]

    def edges(i: int, j: int) -> tuple[int, int]:
        a, b = starts[i], tokens[j][1]
        while a < b and text[a] in EDGE:
            a += 1
        while b > a and text[b - 1] in EDGE:
            b -= 1
        return a, b

    marked, at = [], 0                          # free tokens with a digit or an @
    while m := DIGIT_OR_AT.search(text, at):
        i = bisect_right(starts, m.start()) - 1
        at = tokens[i][1]
        if free(i):
            marked.append(i)
    chains, runs = [], []                       # first and last token
    for i in marked:
        if runs and runs[-1][1] == i - 1:
            runs[-1][1] = i
        else:
            runs.append([i, i])
    for i, j in runs:
        if chains and all(free(k) and not any(map(str.isalpha, text[slice(*tokens[k])]))
                          for k in range(chains[-1][1] + 1, i)):
            chains[-1][1] = j
        else:
            chains.append([i, j])
    for i, j in sorted({*map(tuple, chains), *map(tuple, runs)}):
        out.append(noted(*edges(i, j), None, (word(i - 2), word(i - 1)),
                         word(j + 1) if j - i >= RUN else None, True))
    whole = dict(chains)
    seen = -1                                   # starts up to this one have had their runs
    for i in marked:
        for first in range(max(seen + 1, i - RUN + 1, 0), i + 1):
            left, chain = word(first - 1), whole.get(first, -1)
            known = gate is None or gate.left(left)
            if not known and not first <= chain < first + RUN:
                continue
            if not all(map(free, range(first, i))):
                continue
            inside = set(map(word, range(first, i)))
            for j in range(i, min(first + RUN, len(tokens)) if known else chain + 1):
                if not free(j):
                    break
                inside.add(word(j))
                if left in inside:
                    break
                right, short = word(j + 1), j != chain
                # A run whose end is punctuation only is the run without that end.
                if (short and not known or right in inside
                        or any(edges(k, k)[0] == tokens[k][1] for k in (first, j))):
                    continue
                m = noted(*edges(first, j), None, (None, left), right, False, short)
                if not short or gate is None or gate.pattern(m[4][0]):
                    out.append(m)
        seen = i
    return out


def _gate(docs: DataFrame, text_col: str) -> Gate:
    """The bitmaps of all base spans' contexts; the driver gets their words, 2 MB at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = set()
            for text in batch.column(0):
                text = text.as_py()
                for m in _mentions(text, base_spans(text), None, seeds_only=True):
                    for p in m[4]:
                        if not p.endswith(" _"):
                            got |= {(0, _bit(p)), (1, _bit(p[:p.rindex(" _ ")]))}
            which, bit = zip(*got) if got else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(which, pa.int32()),
                                              pa.array(bit, pa.int32())], ["which", "bit"])

    bits = docs.select(text_col).mapInArrow(run, "which int, bit int")
    words = (bits.groupBy("which", F.expr("bit div 64").alias("at"))
             .agg(F.expr("bit_or(shiftleft(1L, bit % 64))").alias("word")).collect())
    maps = np.zeros((2, BITS // 64), "<i8")
    for r in words:
        maps[r["which"], r["at"]] = r["word"]
    return Gate(maps[0].tobytes(), maps[1].tobytes())


def _scan(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    kind = docs.schema[id_col].dataType.simpleString()
    span = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64())]))
    found = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string()),
                                ("surface", pa.binary()), ("patterns", pa.list_(pa.binary())),
                                ("short", pa.bool_())]))
    shared = docs.sparkSession.sparkContext.broadcast(_gate(docs, text_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uid, gate = TaskContext.get().partitionId() << 33, shared.value
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                some = batch.slice(i, 256)
                spans, noted = [], []
                for text in some.column(1):
                    text = text.as_py()
                    own = base_spans(text)
                    spans.append([{"kind": k, "start": a, "end": b} for k, a, b in own])
                    noted.append([
                        {"start": a, "end": b, "kind": kind, "surface": _key(surface),
                         "patterns": list(map(_key, patterns)), "short": short}
                        for a, b, kind, surface, patterns, short in _mentions(text, own, gate)])
                n = some.num_rows
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(uid, uid + n), pa.int64()), some.column(0),
                     pa.array(spans, span), pa.array(noted, found)],
                    ["uid", "id", "spans", "noted"])
                uid += n

    return docs.select(id_col, text_col).mapInArrow(
        run, f"uid bigint, id {kind}, spans array<struct<kind:int,start:bigint,end:bigint>>, "
             "noted array<struct<start:bigint,end:bigint,kind:string,surface:binary,"
             "patterns:array<binary>,short:boolean>>")


def bootstrap(edges: DataFrame, min_confidence: float, min_support: int,
              min_score: float) -> tuple[DataFrame, DataFrame]:
    """Trusted patterns (pattern, kind, confidence) and accepted instances (surface, kind, score).

    ``edges``: pattern, surface, kind (null unless a base span).  Every round
    but the last accepts an instance at least, so the rounds end.
    """
    links = stage(edges.groupBy("pattern", "surface").agg(F.max("kind").alias("seed")), "edges")
    best = F.max_by(F.struct("kind", "w", "n"), F.struct("w", "kind"))
    top = F.max_by(F.struct("kind", "score"), F.struct("score", "kind"))
    trusted = accepted = None
    while True:
        if accepted is None:
            rows = links.select("pattern", "surface", F.col("seed").alias("kind"),
                                F.when(F.col("seed").isNotNull(), 1.0).otherwise(0.0).alias("w"))
        else:
            got = accepted.select("surface", F.col("kind").alias("new"), "score")
            rows = links.join(got, "surface", "left").select(
                "pattern", "surface", F.coalesce("seed", "new").alias("kind"),
                F.when(F.col("seed").isNotNull(), 1.0)
                .otherwise(F.coalesce("score", F.lit(0.0))).alias("w"))
        sums = rows.groupBy("pattern", "kind").agg(
            F.sum("w").alias("w"), F.count(F.lit(1)).alias("n"))
        more = (sums.groupBy("pattern")
                .agg(F.sum("n").alias("all"), best.alias("top"))
                .select("pattern", F.col("top.kind").alias("kind"),
                        F.round(F.col("top.w") / F.col("all"), 9).alias("confidence"),
                        F.col("top.n").alias("support"))
                .filter(F.col("kind").isNotNull() & (F.col("support") >= min_support)
                        & (F.col("confidence") >= min_confidence)).drop("support"))
        if trusted is not None:
            more = trusted.union(more.join(trusted.select("pattern"), "pattern", "left_anti"))
        trusted = stage(more, "patterns")
        votes = links.filter("seed IS NULL").select("pattern", "surface").join(trusted, "pattern")
        if accepted is not None:
            votes = votes.join(accepted.select("surface"), "surface", "left_anti")
        votes = votes.groupBy("surface", "kind").agg(F.round(
            1 - F.exp(F.sum(F.log(1 - F.least("confidence", F.lit(0.999))))), 9).alias("score"))
        new = stage(votes.groupBy("surface").agg(top.alias("t"))
                    .select("surface", "t.kind", "t.score")
                    .filter(F.col("score") >= min_score), "accepted")
        if new.isEmpty():
            return trusted, new if accepted is None else accepted
        accepted = new if accepted is None else stage(accepted.union(new), "accepted")


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         min_confidence: float = 0.8, min_support: int = 3, min_score: float = 0.8) -> DataFrame:
    """The id of every row, ``base`` and ``spans``: arrays of kind, start and end.

    ``spans`` has the base spans and those that the method adds, by kind as in
    KINDS, then start; of added spans of a kind inside one another the widest
    is kept.  A null text counts as empty and has none.  Repeated
    rows have their spans each; an empty table gives an empty result.
    """
    rows = stage(_scan(docs, id_col, text_col), "scan")
    noted = rows.select("uid", F.explode("noted").alias("m")) \
        .select("uid", "m.*").withColumn("pattern", F.explode("patterns")).drop("patterns")
    known = noted.filter("kind IS NOT NULL").select("pattern").distinct()
    noted = stage(noted.filter("NOT short").union(
        noted.filter("short").join(known, "pattern", "left_semi").select(noted.columns)), "noted")
    trusted, accepted = bootstrap(noted.select("pattern", "surface", "kind"),
                                  min_confidence, min_support, min_score)
    new = (noted.filter("kind IS NULL").select("uid", "start", "end", "pattern", "surface")
           .join(trusted.select("pattern", "kind"), "pattern")
           .join(accepted.select("surface", "kind"), ["surface", "kind"]))
    place = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int") - 1
    new = new.select("uid", "start", "end", "kind").distinct()
    before = Window.partitionBy("uid", "kind").orderBy("start", F.desc("end")) \
        .rowsBetween(Window.unboundedPreceding, -1)
    new = new.withColumn("reach", F.max("end").over(before)) \
        .filter(F.col("reach").isNull() | (F.col("end") > F.col("reach")))
    new = new.select("uid", F.struct(place.alias("kind"), "start", "end").alias("s")) \
        .groupBy("uid").agg(F.collect_set("s").alias("more"))
    named = lambda c: F.transform(
        F.array_sort(c), lambda s: F.struct(F.get(F.array(*map(F.lit, KINDS)), s["kind"])
                                            .alias("kind"), s["start"], s["end"]))
    none = F.array().cast("array<struct<kind:int,start:bigint,end:bigint>>")
    return (rows.select("uid", "id", "spans").join(new, "uid", "left")
            .select(F.col("id").alias(id_col), named(F.col("spans")).alias("base"),
                    named(F.concat("spans", F.coalesce("more", none))).alias("spans")))


def spans_text(c: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    return F.array_join(F.transform(c, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
