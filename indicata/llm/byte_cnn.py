"""Operator 10, language ID: a byte convolutional network in numpy.

Filters of several widths slide over windows of 256 bytes; the greatest
response of each filter goes to a softmax layer.  Training sees a bounded,
stratified sample of labelled windows; scoring covers every byte of every text
in batches of windows, whose log-probabilities are averaged by bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indicata.llm.common import id_text, worker_slot

WIDTHS, FILTERS, WINDOW = (2, 3, 4), 16, 256
STRIDE = WINDOW - max(WIDTHS) + 1  # every run of bytes that a filter sees lies in one window
#: Bounds of the training sample: documents per language (in expectation), windows per document,
#: languages (the most frequent ones) and documents in total.
DOCS_PER_LANG, WINDOWS_PER_DOC, MAX_LANGS, MAX_DOCS = 300, 4, 200, 30_000
BATCH = 64
UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")


@dataclass
class Model:
    langs: list[str]
    filters: dict[int, np.ndarray]  # width: (width, 256, FILTERS)
    bias: np.ndarray
    dense: np.ndarray
    offset: np.ndarray


def windows(text: bytes) -> np.ndarray:
    """All windows of a text, the last one filled up with zero bytes."""
    n = max(1, -(-(len(text) - (WINDOW - STRIDE)) // STRIDE))
    whole = np.zeros(n * STRIDE + WINDOW - STRIDE, np.uint8)
    whole[:len(text)] = np.frombuffer(text, np.uint8)
    return np.lib.stride_tricks.as_strided(whole, (n, WINDOW), (STRIDE, 1))


def held_out(id_col: Column) -> Column:
    return F.pmod(F.crc32(id_text(id_col)), F.lit(3)) == 1


def sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str):
    """Windows (n, 256) and languages of a bounded sample.

    It has about DOCS_PER_LANG documents of each language, fewer where there
    are many languages; of more than MAX_LANGS the most frequent are learned.
    """
    rows = docs.filter(~held_out(F.col(id_col)) & F.col(lang_col).isNotNull()
                       & F.col(text_col).isNotNull())
    counts = rows.groupBy(lang_col).agg(F.count(F.lit(1)).alias("n"))
    sizes = dict(counts.orderBy(F.desc("n"), lang_col).limit(MAX_LANGS).collect())
    if not sizes:
        return np.empty((0, WINDOW), np.uint8), []
    each = min(DOCS_PER_LANG, MAX_DOCS / 2 / len(sizes))
    share = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, each / n)])
    draw = F.pmod(F.xxhash64(id_text(F.col(id_col)), F.lit("sample")), F.lit(1 << 30)) / (1 << 30)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, parts = [], []
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = windows(text.as_py().encode())
                for i in np.unique(np.linspace(0, len(own) - 1, WINDOWS_PER_DOC).astype(int)):
                    langs.append(lang)
                    parts.append(own[i].tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()), pa.array(parts, pa.binary())], ["lang", "part"])

    # the limit is met only where many rows repeat one id
    picked = rows.filter(draw < F.try_element_at(share, F.col(lang_col))) \
        .select(lang_col, text_col).mapInArrow(cut, "lang string, part binary") \
        .limit(MAX_DOCS * WINDOWS_PER_DOC)
    got = sorted(picked.toPandas().itertuples(index=False))
    x = np.frombuffer(b"".join(r.part for r in got), np.uint8).reshape(-1, WINDOW)
    return x, [r.lang for r in got]


def train(x: np.ndarray, labels: list[str], epochs: int = 8, seed: int = 5) -> Model | None:
    """Adam on the cross-entropy; half the windows are cut short at random, as short texts are."""
    if not labels:
        return None
    rng = np.random.default_rng(seed)
    langs = sorted(set(labels))
    y = np.searchsorted(langs, labels)
    n_out = FILTERS * len(WIDTHS)
    p = {w: rng.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS}
    p |= {"bias": np.zeros(n_out, np.float32), "offset": np.zeros(len(langs), np.float32),
          "dense": rng.normal(0, 0.2, (n_out, len(langs))).astype(np.float32)}
    m = {k: np.zeros_like(v) for k, v in p.items()}
    s = {k: np.zeros_like(v) for k, v in p.items()}
    step = 0
    for _ in range(epochs):
        for rows in np.array_split(rng.permutation(len(y)), max(1, len(y) // BATCH)):
            b = x[rows].copy()
            short = rng.random(len(rows)) < 0.5
            b[(np.arange(WINDOW) >= rng.integers(12, WINDOW, len(rows))[:, None])
              & short[:, None]] = 0
            pooled, at = [], {}
            for w in WIDTHS:
                out = sum(p[w][j][b[:, j:WINDOW - w + 1 + j]] for j in range(w))
                at[w] = out.argmax(axis=1)
                pooled.append(np.take_along_axis(out, at[w][:, None], 1)[:, 0])
            z = np.concatenate(pooled, axis=1) + p["bias"]
            a = np.maximum(z, 0)
            logit = a @ p["dense"] + p["offset"]
            prob = np.exp(logit - logit.max(axis=1, keepdims=True))
            prob /= prob.sum(axis=1, keepdims=True)
            prob[np.arange(len(rows)), y[rows]] -= 1
            prob /= len(rows)
            back = (prob @ p["dense"].T) * (z > 0)
            grad = {"dense": a.T @ prob, "offset": prob.sum(axis=0), "bias": back.sum(axis=0)}
            for i, w in enumerate(WIDTHS):
                g, own = np.zeros_like(p[w]), back[:, i * FILTERS:(i + 1) * FILTERS]
                for j in range(w):
                    hit = np.take_along_axis(b, at[w] + j, 1)
                    np.add.at(g[j], (hit, np.arange(FILTERS)[None, :]), own)
                g[:, 0] = 0  # the filling byte stays neutral
                grad[w] = g
            step += 1
            for k, g in grad.items():
                m[k] += 0.1 * (g - m[k])
                s[k] += 0.001 * (g * g - s[k])
                p[k] -= (0.01 * (m[k] / (1 - 0.9 ** step))
                         / (np.sqrt(s[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    for w in WIDTHS:
        p[w][:, 0] = 0
    return Model(langs, {w: p[w] for w in WIDTHS}, p["bias"], p["dense"], p["offset"])


def _tables(model: Model) -> list[tuple[int, list[tuple[int, bool, np.ndarray]]]]:
    """Responses to pairs of bytes (and single ones) by width: offset, is a pair, table."""
    out = []
    for w, k in model.filters.items():
        parts = [(j, True, (k[j][:, None] + k[j + 1][None]).reshape(-1, FILTERS))
                 for j in range(0, w - 1, 2)]
        out.append((w, parts + ([(w - 1, False, k[w - 1])] if w % 2 else [])))
    return out


def log_probabilities(model: Model, b: np.ndarray, tables=None) -> np.ndarray:
    """Log-softmax of each window."""
    tables = tables or _tables(model)
    out = np.empty((len(b), len(model.langs)), np.float32)
    for i in range(0, len(b), BATCH):
        one = b[i:i + BATCH]
        two = one[:, :-1].astype(np.int32) * 256 + one[:, 1:]
        pooled = []
        for w, parts in tables:
            last = WINDOW - w + 1
            total = None
            for j, pair, t in parts:
                r = t.take((two if pair else one)[:, j:j + last], axis=0)
                total = r if total is None else np.add(total, r, out=total)
            pooled.append(total.max(axis=1))
        logit = np.maximum(np.concatenate(pooled, axis=1) + model.bias, 0) @ model.dense \
            + model.offset
        logit -= logit.max(axis=1, keepdims=True)
        out[i:i + BATCH] = logit - np.log(np.exp(logit).sum(axis=1, keepdims=True))
    return out


def classify(model: Model, texts: list[str | None]) -> tuple[list[str], list[float]]:
    """Language and probability of each text; ``und`` and 0 where no letter is."""
    tables = worker_slot(("byte_cnn", model.dense.tobytes()), lambda: _tables(model))
    langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
    queue: list[tuple[int, np.ndarray, np.ndarray]] = []
    held = 0

    def flush():
        if not queue:
            return
        logp = log_probabilities(model, np.concatenate([q[1] for q in queue]), tables)
        logp = logp * np.concatenate([q[2] for q in queue])[:, None]
        mean = np.add.reduceat(logp, np.cumsum([0] + [len(q[1]) for q in queue[:-1]]), axis=0)
        for (i, _, _), row in zip(queue, mean):
            prob = np.exp(row - row.max())
            langs[i] = model.langs[int(row.argmax())]
            scores[i] = float(prob.max() / prob.sum())
        queue.clear()

    for i, text in enumerate(texts):
        if text and LETTER.search(text):
            data = text.encode()
            own = windows(data)
            size = np.full(len(own), STRIDE, np.float32)
            size[-1] = max(1, len(data) - STRIDE * (len(own) - 1))
            queue.append((i, own, size / size.sum()))
            held += len(own)
            if held >= 4096:
                flush()
                held = 0
    flush()
    return langs, scores


def detect(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score; input columns with these names are replaced.

    A null text, an empty one and one without a letter give ``und`` and 0, and
    so does every text where there was nothing to learn from.
    """
    from pyspark.sql import types as T

    keep = [f for f in docs.schema.fields if f.name not in ("lang_pred", "score")
            or f.name == text_col]
    rows = docs.select(*[F.col(f"`{f.name}`") for f in keep])
    if model is None:
        return rows.withColumns({"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0)})
    at = [f.name for f in keep].index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                some = batch.slice(i, 512)
                langs, scores = classify(model, some.column(at).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*some.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                    [*batch.schema.names, "lang_pred", "score"])

    schema = T.StructType([*keep, T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(run, schema)


def language_id(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                lang_col: str = "lang") -> DataFrame:
    """``docs`` with held_out, lang_pred and score.

    The network learns from rows whose crc32 of the id modulo 3 is not 1 and
    whose language and text are not null; a null id hashes as the empty text.
    """
    model = train(*sample(docs, id_col, text_col, lang_col))
    return detect(docs, model, text_col).withColumn("held_out", held_out(F.col(id_col)))
