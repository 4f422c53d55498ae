"""Operator 9, substring dedup: Rabin-Karp hashes of every window of words.

1. Documents are gathered into blocks of a few MB, written once as a table
   bucketed by block, so later joins on the block move no text.
2. Every block hashes each of its windows twice.  One hash is the window's key,
   the other deals it to a range, so two windows meet only if both agree.  A
   block sends one sorted array of distinct keys per range: a passage in every
   document is one entry per block.
3. Each range counts its keys over the blocks and returns, block by block, one
   bit per key.  A range has a bounded number of keys, as their number follows
   the size of the input; rows are sent for ranges with keys only.
4. Rolling hashes can agree by chance or by design of a text, so what they find
   is a screen.  The windows that pass it are counted once more, by a 128-bit
   BLAKE2 digest of their words, and only those count as repeated.
5. Every block merges its repeated windows into maximal intervals of words and
   removes those.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indicata.llm.common import bucketed, stage

BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
MIX = np.uint64(0xD6E8FEB86659FD93)
BYTE_KEYS = np.random.default_rng(20).integers(1, 2**63, 256, dtype=np.uint64)
SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True
BYTE_KEYS[SPACE] = 0
#: Bytes of text in a block and in a range.
BLOCK_BYTES, RANGE_BYTES = 4 << 20, 8 << 20
PIECE = 1 << 20


def _piece_words(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and 64-bit hashes of the words of ``data``."""
    b = np.frombuffer(data, np.uint8)
    space = SPACE[b]
    before = np.empty_like(space)
    before[0] = True
    before[1:] = space[:-1]
    starts = np.flatnonzero(~space & before)
    if not len(starts):
        return starts, np.empty(0, np.uint64)
    spans = np.diff(np.append(starts, len(b)))
    offset = np.arange(starts[0], len(b)) - np.repeat(starts, spans)
    longest = int(offset[~space[starts[0]:]].max()) + 1
    powers = np.full(longest, BASES[0], np.uint64)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    terms = BYTE_KEYS[b[starts[0]:]] * powers[np.minimum(offset, longest - 1)]
    h = np.add.reduceat(terms, starts - starts[0])
    h = (h ^ (h >> np.uint64(32))) * MIX
    return starts, h ^ (h >> np.uint64(29))


def _words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Words per text, and the hashes of all words in order; about a MB at a time."""
    counts, hashes, i = np.zeros(len(texts), np.int64), [], 0
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and (j == i or size + len(texts[j]) < PIECE):
            size += len(texts[j]) + 1
            j += 1
        starts, h = _piece_words(b"\n".join(texts[i:j]) + b"\n")
        ends = np.cumsum([len(t) + 1 for t in texts[i:j]])
        at = np.searchsorted(starts, ends)
        counts[i:j] = np.diff(np.append(0, at))
        hashes.append(h)
        i = j
    return counts, np.concatenate(hashes) if hashes else np.empty(0, np.uint64)


def _window_hashes(w: np.ndarray, length: int, base: int) -> np.ndarray:
    """Polynomial hash of every ``length`` words, modulo 2**64, by doubling."""
    m = len(w) - length + 1
    if m <= 0:
        return np.empty(0, np.uint64)
    out, done, span, size, rest = np.zeros(m, np.uint64), 0, w, 1, length
    while rest:
        step = np.uint64(pow(base, size, 1 << 64))
        if rest & 1:
            out = out * step + span[done:done + m]
            done += size
        rest >>= 1
        if rest:
            span = span[:-size] * step + span[size:]
            size *= 2
    return out


class Keys(NamedTuple):
    """A block's windows by their keys, in order of range."""

    starts: np.ndarray   # first words of the windows
    place: np.ndarray    # each window's place among the distinct keys
    times: np.ndarray    # how often a key occurs here
    part: np.ndarray     # the keys' ranges
    keys: np.ndarray     # the distinct keys, rows of 64-bit numbers

    def again(self, hits: list[dict] | None) -> np.ndarray:
        """First words of the windows whose key occurs twice, here or with another block."""
        twice = self.times > 1
        for x in hits or []:
            a, b = np.searchsorted(self.part, [x["part"], x["part"] + 1])
            twice[a:b] |= np.unpackbits(np.frombuffer(x["hits"], np.uint8),
                                        count=b - a).astype(bool)
        return self.starts[twice[self.place]]


def _order(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of rows of keys, and which of them, in that order, differ from the one before."""
    order = np.lexsort(keys.T[::-1])
    new = np.ones(len(keys), bool)
    new[1:] = (keys[order[1:]] != keys[order[:-1]]).any(axis=1)
    return order, new


def _by_range(starts: np.ndarray, keys: np.ndarray, ranges: int, part_of) -> Keys:
    """``part_of(first)`` deals the keys at these places in ``keys`` to ranges."""
    order, new = _order(keys)
    place = np.empty(len(keys), np.int64)
    place[order] = np.cumsum(new) - 1
    first = order[new]
    times = np.diff(np.append(np.flatnonzero(new), len(keys)))
    part = (part_of(first) >> np.uint64(20)) % np.uint64(ranges)
    by_range = np.argsort(part, kind="stable")
    back = np.empty(len(by_range), np.int64)
    back[by_range] = np.arange(len(by_range))
    return Keys(starts, back[place], times[by_range], part[by_range].astype(np.int64),
                keys[first][by_range])


def _rolling(texts: list[bytes], length: int, ranges: int) -> tuple[np.ndarray, Keys]:
    """Words per text, and the windows by their rolling hashes."""
    counts, w = _words(texts)
    doc = np.repeat(np.arange(len(texts), dtype=np.int32), counts)
    starts = np.flatnonzero(doc[:len(w) - length + 1] == doc[length - 1:]) \
        if len(w) >= length else np.empty(0, np.int64)
    keys = _window_hashes(w, length, BASES[0])[starts]
    return counts, _by_range(starts, keys[:, None], ranges,
                             lambda first: _window_hashes(w, length, BASES[1])[starts[first]])


def _exact(texts: list[bytes], counts: np.ndarray, starts: np.ndarray, length: int,
           ranges: int) -> Keys:
    """The windows at ``starts`` by digests of their words."""
    digests, first = [], np.append(0, np.cumsum(counts))
    cuts = np.searchsorted(starts, first)
    for i in np.flatnonzero(np.diff(cuts)).tolist():
        words = texts[i].split()
        digests += [hashlib.blake2b(b" ".join(words[k:k + length]), digest_size=16).digest()
                    for k in (starts[cuts[i]:cuts[i + 1]] - first[i]).tolist()]
    keys = np.frombuffer(b"".join(digests), np.uint64).reshape(-1, 2)
    return _by_range(starts, keys, ranges, lambda first: keys[first, 0])


def _pack(keys: np.ndarray) -> bytes:
    """Sorted keys with their bytes in planes, the first of which compress well."""
    return np.ascontiguousarray(keys).view(np.uint8).T.tobytes()


def _unpack(data: bytes, width: int) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8 * width, -1).T) \
        .view(np.uint64)


def _blocks(docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"block bigint, ids array<{kind}>, texts array<string>"

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        texts: list = []
        size, made = 0, 0
        first = TaskContext.get().partitionId() << 32

        def block(id_type):
            return pa.RecordBatch.from_arrays(
                [pa.array([first + made], pa.int64()), pa.array([ids], pa.list_(id_type)),
                 pa.array([texts], pa.list_(pa.string()))], ["block", "ids", "texts"])

        id_type = None
        for batch in batches:
            id_type = batch.schema.field(0).type
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids.append(i)
                texts.append(t or "")
                size += len(texts[-1])
                if size >= BLOCK_BYTES:
                    yield block(id_type)
                    ids, texts, size, made = [], [], 0, made + 1
        if ids:
            yield block(id_type)

    rows = docs.select(F.col(id_col), F.col(text_col)).mapInArrow(gather, schema)
    return bucketed(rows, "blocks", "block", size)


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   window: int = 35) -> DataFrame:
    """Each document's words, the intervals of words to remove, and the text that is left.

    Columns: the id, n_words, n_removed, removed (array of start and end in
    words, end exclusive), kept_text (words joined by one space).  A word goes
    when a window of ``window`` words over it starts anywhere else as well, in
    the same document or another.  Repeated rows are documents of their own, so
    they remove each other.  A null text has no words; shorter texts than a
    window stay; an empty table gives an empty result.
    """
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    ranges = max(1, -(-size // RANGE_BYTES))
    blocks = _blocks(docs, id_col, text_col, size)
    kind = docs.schema[id_col].dataType.simpleString()

    def sent(block: int, found: Keys) -> pa.RecordBatch:
        cuts = np.append(np.flatnonzero(np.diff(found.part, prepend=-1)), len(found.part))
        return pa.RecordBatch.from_arrays(
            [pa.array(found.part[cuts[:-1]], pa.int64()),
             pa.array([block] * (len(cuts) - 1), pa.int64()),
             pa.array([_pack(found.keys[a:b]) for a, b in zip(cuts, cuts[1:])], pa.binary())],
            ["part", "block", "keys"])

    def screen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, texts in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = [t.encode() for t in texts.as_py()]
                yield sent(block, _rolling(data, window, ranges)[1])

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, texts, found in zip(*(batch.column(c) for c in ("block", "texts", "hits"))):
                data = [t.encode() for t in texts.as_py()]
                counts, own = _rolling(data, window, ranges)
                yield sent(block.as_py(),
                           _exact(data, counts, own.again(found.as_py()), window, ranges))

    def counted(sent: DataFrame, width: int) -> DataFrame:
        """Per block the ranges and bits of the keys that another block has sent as well."""

        def count(group: pd.DataFrame) -> pd.DataFrame:
            sets = [_unpack(k, width) for k in group["keys"]]
            ends = np.cumsum([len(s) for s in sets])
            order, new = _order(np.concatenate(sets))
            same = ~new[1:]
            hit = np.zeros(len(order), bool)
            hit[order[1:][same]] = True
            hit[order[:-1][same]] = True
            bits = np.split(hit, ends[:-1])
            some = [b.any() for b in bits]
            return pd.DataFrame({"part": group["part"][some], "block": group["block"][some],
                                 "hits": [np.packbits(b).tobytes() for b in bits if b.any()]})

        hits = sent.groupBy("part").applyInPandas(count, "part bigint, block bigint, hits binary")
        return hits.groupBy("block").agg(F.collect_list(F.struct("part", "hits")).alias("hits"))

    keys = "part bigint, block bigint, keys binary"
    rolling = stage(counted(blocks.select("block", "texts").mapInArrow(screen, keys), 1), "screen")
    passed = blocks.join(rolling.hint("shuffle_hash"), "block", "left")
    exact = counted(passed.select("block", "texts", "hits").mapInArrow(confirm, keys), 2)

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, texts, found, sure in zip(*(batch.column(c)
                                                 for c in ("ids", "texts", "hits", "sure"))):
                data = [t.encode() for t in texts.as_py()]
                counts, own = _rolling(data, window, ranges)
                own = _exact(data, counts, own.again(found.as_py()), window, ranges)
                at = own.again(sure.as_py())
                change = np.zeros(int(counts.sum()) + 1, np.int32)
                np.add.at(change, at, 1)
                np.add.at(change, at + window, -1)
                gone = np.cumsum(change[:-1]) > 0
                out: dict[str, list] = {"n_words": [], "n_removed": [], "removed": [], "kept": []}
                end = 0
                for text, n in zip(data, counts.tolist()):
                    mine = gone[end:end + n]
                    end += n
                    words = text.split()
                    edges = np.flatnonzero(np.diff(mine.astype(np.int8), prepend=0, append=0))
                    spans = [{"start": int(a), "end": int(b)}
                             for a, b in zip(edges[::2], edges[1::2])]
                    if spans:
                        words = [w for w, g in zip(words, mine.tolist()) if not g]
                    out["n_words"].append(n)
                    out["n_removed"].append(n - len(words))
                    out["removed"].append(spans)
                    out["kept"].append(b" ".join(words).decode())
                span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
                yield pa.RecordBatch.from_arrays(
                    [ids.values, pa.array(out["n_words"], pa.int64()),
                     pa.array(out["n_removed"], pa.int64()), pa.array(out["removed"], span),
                     pa.array(out["kept"], pa.string())],
                    [id_col, "n_words", "n_removed", "removed", "kept_text"])

    sure = exact.withColumnRenamed("hits", "sure").hint("shuffle_hash")
    return (passed.join(sure, "block", "left").select("ids", "texts", "hits", "sure")
            .mapInArrow(remove, f"`{id_col}` {kind}, n_words bigint, n_removed bigint, "
                                "removed array<struct<start:int,end:int>>, kept_text string"))
