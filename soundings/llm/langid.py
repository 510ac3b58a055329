"""Language identification: averaged hashed subword embeddings and a linear softmax, trained in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructType

from .sampling import per_class
from .words import BLANK, LOWER, slices

UNDETERMINED = "und"
BUCKET_BITS = 15


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1 + column.offset)[column.offset :]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
    return LOWER[data], offsets - offsets[0]


def subwords(data: np.ndarray, offsets: np.ndarray, sizes: tuple[int, ...] = (2, 3, 4)) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each n-gram size: the row and the bucket of every byte n-gram that lies in one word, its borders counted as bytes."""
    blank = BLANK[data]
    plain = np.where(blank, np.uint8(0x20), data).astype(np.uint32)
    row = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets))
    for n in sizes:
        m = len(plain) - n + 1
        if m <= 0:
            continue
        key = np.zeros(m, np.uint32)
        for k in range(n):
            key |= plain[k : k + m] << np.uint32(8 * k)
        good = row[:m] == row[n - 1 :]
        for k in range(1, n - 1):
            good &= ~blank[k : k + m]
        if n == 2:
            good &= ~(blank[:m] & blank[1:])
        at = np.flatnonzero(good)
        h = (key[at] * np.uint32(2654435761) + np.uint32(n * 40503)) * np.uint32(2246822519)
        yield row[at], (h >> np.uint32(32 - BUCKET_BITS)).astype(np.int32)


@dataclass
class LanguageModel:
    languages: list[str]
    table: np.ndarray  # buckets x languages: embeddings times output weights
    bias: np.ndarray
    temperature: float
    threshold: float

    def scores(self, column: pa.Array) -> np.ndarray:
        """Calibrated probabilities of every whole text."""
        data, offsets = _bytes(column)
        total, count = np.zeros((len(column), len(self.languages))), np.zeros(len(column))
        for row, bucket in subwords(data, offsets):
            if len(row):
                first = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
                total[row[first]] += np.add.reduceat(self.table[bucket], first, axis=0)
                count[row[first]] += np.diff(np.append(first, len(row)))
        return _softmax((total / np.maximum(count, 1)[:, None] + self.bias) / self.temperature)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _features(items: list[str], most: int = 1 << 20) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets and counts of all items end to end, and where each begins; made in runs of about ``most`` bytes to keep scratch small."""
    buckets, counts, sizes, at = [], [], [], 0
    while at < len(items):
        end, total = at, 0
        while end < len(items) and (not total or total + len(items[end]) <= most):
            total += len(items[end])
            end += 1
        data, offsets = _bytes(pa.array(items[at:end], pa.large_string()))
        codes = [r.astype(np.int64) << BUCKET_BITS | b for r, b in subwords(data, offsets)]
        code, n = np.unique(np.concatenate(codes or [np.zeros(0, np.int64)]), return_counts=True)
        buckets.append((code & ((1 << BUCKET_BITS) - 1)).astype(np.int32))
        counts.append(n.astype(np.int32))
        sizes.append(np.bincount(code >> BUCKET_BITS, minlength=end - at))
        at = end
    begin = np.concatenate(([0], np.cumsum(np.concatenate(sizes or [np.zeros(0, np.int64)])))).astype(np.int64)
    return np.concatenate(buckets or [np.zeros(0, np.int32)]), np.concatenate(counts or [np.zeros(0, np.int32)]), begin


def train(texts: list[str], labels: list[str], dim: int = 16, epochs: int = 4, rate: float = 0.5, reject: float = 0.002, seed: int = 7) -> LanguageModel:
    """Stochastic gradient descent over whole texts and their lines; a fifth of the texts calibrates.

    Temperature: the one of least log loss on lines held back. Threshold: the ``reject`` quantile of
    the winning probability there, at most one half, so that text of a learned language passes."""
    rng = np.random.default_rng(seed)
    names = sorted(set(labels))
    items, gold, held = [], [], []
    for t, y in zip(texts, labels, strict=True):
        back = rng.random() < 0.2
        lines = [x for x in t.split("\n") if len(x) > 8]
        picked = [lines[i] for i in rng.permutation(len(lines))[:4]]
        for x in [t, *picked]:
            items.append(x)
            gold.append(names.index(y))
            held.append(back)
    bucket, n, begin = _features(items)
    emb = rng.normal(0, 0.1, (1 << BUCKET_BITS, dim))
    out, bias = rng.normal(0, 0.1, (dim, len(names))), np.zeros(len(names))
    gold, held = np.array(gold), np.array(held)
    own = np.flatnonzero(~held & (np.diff(begin) > 0))
    steps, done = epochs * len(own), 0
    for _ in range(epochs):
        for i in rng.permutation(own):
            lr = rate * (1 - done / steps)
            done += 1
            b, w = bucket[begin[i] : begin[i + 1]], n[begin[i] : begin[i + 1]]
            w = w / w.sum()
            h = w @ emb[b]
            p = _softmax((h @ out + bias)[None])[0]
            p[gold[i]] -= 1
            emb[b] -= lr * len(b) ** 0.5 * np.outer(w, out @ p)
            out -= lr * np.outer(h, p)
            bias -= 0.1 * lr * p
    model = LanguageModel(names, (emb @ out).astype(np.float32), bias, 1.0, 0.0)
    back = np.flatnonzero(held)
    if len(back):
        parts = [model.scores(pa.array([items[i] for i in back[k : k + 50]], pa.large_string())) for k in range(0, len(back), 50)]
        logits = np.log(np.maximum(np.concatenate(parts), 1e-30))
        losses = {t: -np.mean(np.log(np.maximum(_softmax(logits / t)[np.arange(len(back)), gold[back]], 1e-30))) for t in (0.1, 0.2, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0, 3.0)}
        model.temperature = min(losses, key=losses.get)
        best = _softmax(logits / model.temperature).max(axis=1)
        model.threshold = float(min(0.5, np.quantile(best, reject)))
    return model


def fit(rows: DataFrame, text: str = "text", lang: str = "lang", per_language: int = 400, keys: tuple[str, ...] = ("doc_id",)) -> LanguageModel | None:
    """Fit on about ``per_language`` (400) labelled rows of each language (a documented bound; whole texts). None without rows."""
    own = rows.where(F.col(text).rlike(r"\p{L}"))
    got = per_class(own, lang, per_language, keys).select(text, lang).collect()
    got.sort(key=lambda r: (r[1], r[0]))
    return train([r[0] for r in got], [r[1] for r in got]) if got else None


def predict(docs: DataFrame, model: LanguageModel | None, text: str = "text") -> DataFrame:
    """``row`` (the input's columns), ``lang_pred``, ``score`` and ``rejected`` for every row. One map, no shuffle.

    Null texts and texts without a letter are ``und`` with score 0, and rejected; so is everything without a
    model. Other texts get the likeliest learned language, the first by name of equally likely ones; ``rejected`` when its calibrated probability is under
    the model's threshold. Very long texts are read whole. Repeated rows each get their own result."""
    spark = docs.sparkSession
    own = docs.select(F.struct("*").alias("row"))
    own = own.select("row", F.coalesce(F.col(f"row.`{text}`").rlike(r"\p{L}"), F.lit(False)).alias("letters"))
    if model is None:
        return own.select("row", F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("rejected"))
    shared = spark.sparkContext.broadcast(model)  # a fixed number of buckets

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        names = np.array([*m.languages, UNDETERMINED], object)
        for whole in batches:
            for batch in slices(whole, text, 1 << 18, inside="row"):
                p = m.scores(batch.column("row").field(text))
                letters = np.asarray(batch.column("letters").to_numpy(zero_copy_only=False), bool)
                best = np.where(letters, p.argmax(axis=1), len(m.languages))
                top = np.where(letters, p.max(axis=1), 0.0)
                yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(names[best].tolist(), pa.string()), pa.array(top), pa.array(~letters | (top < m.threshold))], names=["row", "lang_pred", "score", "rejected"])

    schema = StructType().add("row", own.schema["row"].dataType).add("lang_pred", StringType()).add("score", DoubleType()).add("rejected", BooleanType())
    return own.mapInArrow(score, schema)
