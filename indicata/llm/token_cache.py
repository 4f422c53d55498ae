"""Operator 1, token counts: a digest cache.

The cache is a Parquet table of (tokenizer version, content digest, count) on
shared storage.  Distinct digests, without texts, drop out where the cache has
their count.  Only texts of the others are read again, reduced to one of each
digest before the shuffle, encoded and appended, and every document takes its
count from the cache.  An append is one atomic
Spark job; a digest appended twice by two runs counts once.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indicata.llm.common import new_columns, stage, worker_slot

SCHEMA = "version string, digest binary, n_tokens bigint"
COLUMNS = ["n_bytes", "n_tokens"]
#: Entries of a worker's memo of pieces; characters of a piece that is kept there.
MEMO_ENTRIES, MEMO_CHARS = 500_000, 64
#: A piece is white space and what follows it; see ``cuts_at_space``.
PIECE = re.compile(r"[ \t\n\x0b\x0c\r]*[^ \t\n\x0b\x0c\r]+|[ \t\n\x0b\x0c\r]+")
OTHER_SPACE = re.compile(r"[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
DOCS_AT_ONCE = 64
#: So many digests without a stored count (32 bytes each) are broadcast to find their texts.
BROADCAST_MISSES = 500_000


def cuts_at_space(spec: dict) -> bool:
    """Whether a text's tokens are those of its pieces, one after another.

    So it is for a byte-level tokenizer with the usual pattern and no
    normalizer: a token starts before white space that follows another
    character, never across it.
    """
    pre = spec.get("pre_tokenizer") or {}
    return (pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
            and not pre.get("add_prefix_space") and not spec.get("normalizer")
            and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or " " in t["content"]
                        for t in spec.get("added_tokens", [])))


class Counter(dict):
    """Counts of tokens by the library of the file's kind, without added special tokens.

    As a dict it is a bounded memo of pieces, which encodes a piece that it lacks.
    """

    def __init__(self, path: str):
        super().__init__()
        self.pieces = False
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.encode = lambda texts: list(map(len, model.encode(texts, num_threads=1)))
            return
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(path)
        tok.no_truncation()
        tok.no_padding()
        self.encode = lambda texts: [
            len(e) for e in tok.encode_batch_fast(texts, add_special_tokens=False)]
        with open(path, encoding="utf-8") as f:
            self.pieces = cuts_at_space(json.load(f))

    def __missing__(self, piece: str) -> int:
        n = self.encode([piece])[0]
        if len(self) < MEMO_ENTRIES and len(piece) <= MEMO_CHARS:
            self[piece] = n
        return n

    def count(self, texts: list[str]) -> list[int]:
        if not self.pieces:
            return self.encode(texts)
        return [sum(map(self.__getitem__, PIECE.findall(t)))
                if t.isascii() or not OTHER_SPACE.search(t) else self.encode([t])[0]
                for t in texts]


def tokenizer_version(path: str) -> str:
    """Digest of the tokenizer's file and of how it is applied."""
    with open(path, "rb") as f:
        return hashlib.sha256(f.read() + b"|no special tokens added").hexdigest()


def count_tokens(docs: DataFrame, tokenizer: str, cache: str, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Every row of ``docs`` with n_bytes (UTF-8) and n_tokens.

    ``tokenizer`` is the path of a .json or .model file on every machine,
    ``cache`` a folder on shared storage, made where it is missing.  A null
    text counts as empty.  Input columns with the new names are replaced.  An
    empty table gives an empty result.
    """
    spark = docs.sparkSession
    version = tokenizer_version(tokenizer)
    text = F.coalesce(F.col(text_col), F.lit(""))
    spark.createDataFrame([], SCHEMA).write.mode("append").parquet(cache)  # now it exists

    def stored() -> DataFrame:
        rows = spark.read.schema(SCHEMA).parquet(cache).filter(F.col("version") == version)
        return rows.groupBy(F.col("digest").alias("__digest")).agg(F.max("n_tokens").alias("__n"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = worker_slot(("counter", version), lambda: Counter(tokenizer))
        for batch in batches:
            for i in range(0, batch.num_rows, DOCS_AT_ONCE):
                part = batch.slice(i, DOCS_AT_ONCE)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([version] * part.num_rows, pa.string()), part.column(0),
                     pa.array(counter.count(part.column(1).to_pylist()), pa.int64())],
                    ["version", "digest", "n_tokens"])

    texts = docs.select(F.unhex(F.sha2(text, 256)).alias("__digest"), text.alias("__text"))
    known = stored()
    if not known.isEmpty():
        misses = stage(texts.select("__digest").distinct().join(known, "__digest", "left_anti"),
                       "misses")
        few = misses.limit(BROADCAST_MISSES + 1).count() <= BROADCAST_MISSES
        texts = texts.join(F.broadcast(misses) if few else misses, "__digest", "left_semi")
    (texts.dropDuplicates(["__digest"]).select("__digest", "__text").mapInArrow(encode, SCHEMA)
     .write.mode("append").parquet(cache))
    rows = docs.select(*new_columns(docs, [c for c in COLUMNS if c not in (id_col, text_col)]),
                       F.unhex(F.sha2(text, 256)).alias("__digest"),
                       F.octet_length(text).cast("long").alias("n_bytes"))
    counts = stage(stored(), "counts")  # a table, so that Spark can split a hot digest's rows
    return rows.join(counts, "__digest").withColumn("n_tokens", F.col("__n")) \
        .drop("__digest", "__n")
