"""Operator 8, packing: deficit round-robin over source queues.

1. Documents are dealt out by a hash, so every partition holds every source,
   then tokenized into blocks, written once as a table bucketed by block.
2. A block's first position and what each source has got before it are prefix
   sums over small tables of counts.  From these its deficits follow: target
   share times position, less what was served.  So all blocks are filled at the
   same time, as if one after another.
3. In every window, each source's deficit grows by its share of the room; the
   sources with tokens left are served up to their deficits, and what room is
   left goes to them by share.  Deficits pass from window to window and, by the
   sums of step 2, from block to block and partition to partition.

The blocks follow one another without a gap, so only the last tokens can need
padding; they are cut into sequences whose lengths are powers of two.
"""

from __future__ import annotations

import json
import re
import string
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from indicata.llm.common import bucketed, stage, worker_slot

#: Tokens of a block.
BLOCK_TOKENS = 1 << 21
#: Partitions in one group of the prefix sums.
GROUP = 1024
#: Entries of a worker's memos of words and of their parts; bytes or characters of a kept one.
MEMO_ENTRIES, PART_ENTRIES, MEMO_CHARS = 450_000, 250_000, 64
#: Fixed value: the pattern by which this kind of tokenizer splits words.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
MARKS = frozenset(string.punctuation)
#: Characters with one code point in lower case and no other composed form.
PLAIN = re.compile(r"[!-~\xa1-\u012f\u0131-\u024f]+")


class Words(dict):
    """Ids of words as bytes; a word that is not there is encoded, and kept while there is room."""

    def __init__(self, encode, entries: int):
        super().__init__()
        self.encode = encode
        self.entries = entries

    def __missing__(self, word: bytes) -> bytes:
        ids = self.encode(word)
        if len(self) < self.entries and len(word) <= MEMO_CHARS:
            self[word] = ids
        return ids


class Encoder:
    """Token ids of whole texts as bytes of ``dtype``.

    Where the tokenizer drops white space and splits words by SPLIT, a text's
    ids are those of its words one after another, and a word's ids those that
    the library's model gives its parts.
    """

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.dtype = np.dtype("<u2" if self.tok.get_vocab_size() <= 1 << 16 else "<u4")
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        norm = [n["type"] for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        added = spec.get("added_tokens", [])
        self.special = [t["content"].encode() for t in added]
        self.by_word = (norm == ["NFC", "Replace", "Lowercase"] and len(steps) == 2
                        and steps[0].get("pattern") == {"Regex": SPLIT} and steps[0]["invert"]
                        and steps[1]["type"] == "ByteLevel" and not steps[1]["use_regex"]
                        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added)
                        and not any(len(s.split()) != 1 for s in self.special))
        #: Whether no special string lies in a word of letters and one mark at its end.
        self.simple = all(len(s) > 1 and not s.decode()[0].isalpha() for s in self.special)
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        self.split = regex.compile(SPLIT).findall
        self.to_bytes = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.words = Words(self._word, MEMO_ENTRIES)
        self.parts = Words(self._part, PART_ENTRIES)

    def _whole(self, text: str) -> bytes:
        ids = self.tok.encode_batch_fast([text], add_special_tokens=False)[0].ids
        return np.array(ids, self.dtype).tobytes()

    def _part(self, part: str) -> bytes:
        if not part.isascii():
            part = self.to_bytes(part)[0][0]
        return array(self.code, [t.id for t in self.tok.model.tokenize(part)]).tobytes()

    def _word(self, word: bytes) -> bytes:
        text = word.decode()
        if self.simple and (text.isascii() or PLAIN.fullmatch(text)):
            if text.isalpha():
                return self.parts[text.lower()]
            if text[-1] in MARKS and text[:-1].isalpha():
                return self.parts[text[:-1].lower()] + self.parts[text[-1]]
        if not PLAIN.fullmatch(text) or any(s in word for s in self.special):
            return self._whole(text)
        return b"".join(map(self.parts.__getitem__, self.split(text.lower())))

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.by_word:
            return list(map(self._whole, texts))
        return [b"".join(map(self.words.__getitem__, t.encode().split())) for t in texts]


def _encoder(path: str) -> Encoder:
    return worker_slot(("encoder", path), lambda: Encoder(path))


def _blocks(docs: DataFrame, tokenizer: str, end_id: int, id_col: str, source_col: str,
            text_col: str) -> DataFrame:
    kind = docs.schema[id_col].dataType.simpleString()
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(tokenizer)
        end = np.array([end_id], enc.dtype).tobytes()
        part, made = TaskContext.get().partitionId(), 0
        ids, sources, lengths, tokens, held = [], [], [], [], 0

        def block(id_type):
            return pa.RecordBatch.from_arrays(
                [pa.array([part << 32 | made], pa.int64()), pa.array([ids], pa.list_(id_type)),
                 pa.array([sources], pa.list_(pa.string())),
                 pa.array([lengths], pa.list_(pa.int64())),
                 pa.array([b"".join(tokens)], pa.binary())],
                ["block", "ids", "sources", "lengths", "tokens"])

        id_type = None
        for batch in batches:
            id_type = batch.schema.field(0).type
            for i in range(0, batch.num_rows, 64):
                some = batch.slice(i, 64)
                texts = [t or "" for t in some.column(2).to_pylist()]
                for doc, source, data in zip(some.column(0).to_pylist(),
                                             some.column(1).to_pylist(), enc.encode(texts)):
                    data += end
                    ids.append(doc)
                    sources.append(source)
                    lengths.append(len(data) // enc.dtype.itemsize)
                    tokens.append(data)
                    held += lengths[-1]
                    if held >= BLOCK_TOKENS:
                        yield block(id_type)
                        ids, sources, lengths, tokens, held = [], [], [], [], 0
                        made += 1
        if ids:
            yield block(id_type)

    # where copies of a row make a partition too large, Spark splits it at run time
    dealt = docs.select(id_col, F.col(source_col).cast("string"), text_col,
                        F.xxhash64(id_col, text_col).alias("__deal")) \
        .hint("rebalance", "__deal").drop("__deal")
    rows = dealt.mapInArrow(run, f"block bigint, ids array<{kind}>, sources array<string>, "
                                 "lengths array<bigint>, tokens binary")
    return bucketed(rows, "tokens", "block", size)


def _before(rows: DataFrame, key: list[str], value: str, out: str) -> DataFrame:
    """``rows`` with the sum of ``value`` over earlier blocks of the same ``key``.

    Sums go by block in a partition, partition in a group, and group, so no
    task sees more than the partitions of one group or one row per group.
    """
    part = F.shiftright("block", 32)
    rows = rows.withColumns({"__p": part, "__g": F.floor(part / GROUP)})
    up = rows.groupBy(*key, "__g", "__p").agg(F.sum(value).alias("__v"))
    top = up.groupBy(*key, "__g").agg(F.sum("__v").alias("__v"))

    def running(df: DataFrame, by: list[str], order: str, v: str, name: str) -> DataFrame:
        w = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
        return df.withColumn(name, F.coalesce(F.sum(v).over(
            w.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))

    def same(a: DataFrame, b: DataFrame, cols: list[str]) -> DataFrame:
        on = [a[c].eqNullSafe(b[c]) for c in cols]
        return a.join(b, on).select(a["*"], *[b[c] for c in b.columns if c not in cols])

    rows = running(rows, [*key, "__g", "__p"], "block", value, "__a")
    up = running(up, [*key, "__g"], "__p", "__v", "__b").drop("__v")
    top = running(top, key, "__g", "__v", "__c").drop("__v")
    rows = same(same(rows, up, [*key, "__g", "__p"]), top, [*key, "__g"])
    return rows.withColumn(out, F.expr("__a + __b + __c")).drop("__a", "__b", "__c", "__p", "__g")


def _tail(total: int, length: int) -> list[int]:
    """Ends of the last sequences: powers of two that make up what fills no window."""
    at, rest, ends = total // length * length, total % length, []
    while rest:
        size = 1 << (rest.bit_length() - 1)
        at, rest = at + size, rest - size
        ends.append(at)
    return ends


def serve(lengths: list[int], sources: list, start: int, total: int, length: int,
          share: Mapping, before: Mapping) -> Iterator[tuple[int, int, int, int, int]]:
    """Pieces of one block: document (its place), its first token, tokens, sequence, offset."""
    queues = defaultdict(list)
    for i, s in enumerate(sources):
        queues[s].append(i)
    left = {s: sum(lengths[i] for i in q) for s, q in queues.items()}
    place = dict.fromkeys(queues, 0)            # which document of the queue is next
    used = [0] * len(lengths)
    deficit = {s: share[s] * start - before[s] for s in queues}
    ends, at, rest = _tail(total, length), start, sum(lengths)
    full = total // length * length

    while rest:
        if at < full:
            sequence, first = at // length, at // length * length
            end = first + length
        else:
            k = next(i for i, e in enumerate(ends) if e > at)
            sequence, end = full // length + k, ends[k]
            first = ends[k - 1] if k else full
        room = min(end - at, rest)
        for s in queues:
            deficit[s] += share[s] * room
        grant = {s: min(max(0, int(deficit[s])), left[s]) for s in queues}
        over = sum(grant.values()) - room
        for s in sorted(grant, key=lambda s: deficit[s]) if over > 0 else ():
            cut = min(over, grant[s])
            grant[s] -= cut
            over -= cut
        spare = room - sum(grant.values())
        while spare:
            open_ = [s for s in queues if left[s] > grant[s]]
            weight = sum(share[s] for s in open_)
            given = 0
            for s in sorted(open_, key=lambda s: grant[s] - deficit[s]):
                part = spare * share[s] / weight if weight else spare / len(open_)
                part = min(max(1, int(part)), left[s] - grant[s], spare - given)
                grant[s] += part
                given += part
            spare -= given
        for s, n in grant.items():
            deficit[s] -= n
            left[s] -= n
            rest -= n
            while n:
                i = queues[s][place[s]]
                size = min(n, lengths[i] - used[i])
                if size:
                    yield i, used[i], size, sequence, at - first
                    used[i] += size
                    at += size
                    n -= size
                if used[i] == lengths[i]:
                    place[s] += 1


def pack(docs: DataFrame, tokenizer: str, end_id: int, length: int = 4096,
         weights: Mapping[str | None, float] | None = None, id_col: str = "doc_id",
         source_col: str = "source", text_col: str = "text",
         with_tokens: bool = False) -> DataFrame:
    """Every document's tokens, closed by ``end_id``, cut into pieces of sequences.

    Columns: the id, start, length, ids_crc32 (of little-endian unsigned 32-bit
    ids), doc_tokens, sequence_id, offset, and ``tokens`` (those ids) if asked
    for.  Target shares are ``weights``, or each source's share of all tokens;
    a source without a weight is served where the others leave room.  A null
    text is empty and keeps its end token, a null source is a source of its
    own, repeated rows are packed each.  An empty table gives an empty result.
    """
    blocks = _blocks(docs, tokenizer, end_id, id_col, source_col, text_col)
    each = F.explode(F.arrays_zip("sources", "lengths")).alias("d")
    counts = stage(blocks.select("block", each)
                   .groupBy("block", F.col("d.sources").alias("source"))
                   .agg(F.sum("d.lengths").alias("n")), "counts")
    total = counts.agg(F.sum("n")).first()[0] or 0
    if weights is None:
        share = counts.groupBy("source").agg((F.sum("n") / F.lit(float(max(1, total))))
                                             .alias("share"))
    else:
        whole = float(sum(weights.values())) or 1.0
        share = docs.sparkSession.createDataFrame(
            [(k, v / whole) for k, v in weights.items()], "source string, share double")
    got = _before(counts, ["source"], "n", "before")
    got = got.join(share, got["source"].eqNullSafe(share["source"]), "left").select(
        "block", got["source"], "before", F.coalesce("share", F.lit(0.0)).alias("share"))
    first = _before(counts.groupBy("block").agg(F.sum("n").alias("n")), [], "n", "first")
    state = (got.groupBy("block").agg(F.collect_list(F.struct("source", "before", "share"))
                                      .alias("state"))
             .join(first.select("block", "first"), "block"))
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.select(["sources", "lengths", "state", "first"]).to_pylist()
            for at, row in enumerate(rows):
                lengths = row["lengths"]
                pieces = list(serve(
                    lengths, row["sources"], row["first"], total, length,
                    {s["source"]: s["share"] for s in row["state"]},
                    {s["source"]: s["before"] for s in row["state"]}))
                data = batch.column("tokens")[at].as_py()
                dtype = f"<u{len(data) // sum(lengths)}"
                data = memoryview(np.frombuffer(data, dtype).astype("<u4").tobytes())
                begin = [0, *np.cumsum(lengths).tolist()]
                cut = [data[4 * (begin[i] + a):4 * (begin[i] + a + n)] for i, a, n, _, _ in pieces]
                doc, start, size, sequence, offset = (np.array(c, np.int64) for c in zip(*pieces))
                columns = {id_col: batch.column("ids")[at].values.take(pa.array(doc)),
                           "start": start, "length": size,
                           "ids_crc32": np.array([zlib.crc32(c) for c in cut], np.int64),
                           "doc_tokens": np.array(lengths, np.int64)[doc],
                           "sequence_id": sequence, "offset": offset}
                if with_tokens:
                    columns["tokens"] = pa.array(
                        [np.frombuffer(c, "<u4").astype(np.int32) for c in cut],
                        pa.list_(pa.int32()))
                yield pa.RecordBatch.from_pydict(columns)

    schema = (f"`{id_col}` {kind}, start bigint, length bigint, ids_crc32 bigint, "
              "doc_tokens bigint, sequence_id bigint, offset bigint"
              + (", tokens array<int>" if with_tokens else ""))
    return blocks.join(state.hint("shuffle_hash"), "block").mapInArrow(run, schema)
