"""Importance resampling towards a target distribution: hashed runs of words, log-ratio gains, and a draw by perturbed weights.

A 256-byte table lowers A-Z and blanks separators in UTF-8, so ``bytes.translate`` and ``bytes.split`` yield the words of a text; a run of
words is hashed by continuing the CRC-32 of the run one word shorter, and counters add up buckets in each task before anything is shuffled.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator
from hashlib import sha256
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import staged
from .words import slices

#: Distinct features that a task's counter and a task's table of known words hold before they are emptied; nothing is lost by that.
HELD = 400_000


def _folding() -> bytes:
    """Bytes of words stand for themselves, A-Z for a-z, all others for a blank."""
    inside = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
    return bytes(b + 32 if 0x41 <= b <= 0x5A else b if b in inside else 0x20 for b in range(256))


FOLDING = _folding()


def words_of(text: bytes) -> list[bytes]:
    return text.translate(FOLDING).split()


def longer_runs(words: list[bytes], longest: int) -> Iterator[list[int]]:
    """CRC-32 of all runs of two words (joined by one space), of three, up to ``longest``: each continues the one a word shorter."""
    runs = [crc32(w) for w in words] if longest > 1 else []
    for k in range(1, longest):
        runs = [crc32(b" " + w, seed) for seed, w in zip(runs, words[k:], strict=False)]
        yield runs


class _Known(dict):
    """Values of words by their CRC-32, worked out once for each word while there is room."""

    def __init__(self, of: Callable[[int], int]) -> None:
        super().__init__()
        self.of = of

    def __missing__(self, word: bytes) -> int:
        if len(self) >= HELD:
            self.clear()
        found = self[word] = self.of(crc32(word))
        return found


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    for whole in batches:
        for batch in slices(whole, "text"):
            yield batch, [x or b"" for x in batch.column("text").cast(pa.large_binary()).to_pylist()]


def bucket_counts(docs: DataFrame, text: str = "text", longest: int = 1, buckets: int = 10_000) -> np.ndarray:
    """How often each bucket occurs in all whole texts (null: empty). A task gives a row for each bucket at most, the driver gets ``buckets`` sums."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros(buckets, np.int64), Counter()

        def empty() -> None:
            for x, n in seen.items():  # words by their bytes, longer runs by their CRC
                total[(x if isinstance(x, int) else crc32(x)) % buckets] += n
            seen.clear()

        for _, texts in _texts(batches):
            for t in texts:
                words = words_of(t)
                seen.update(words)
                for runs in longer_runs(words, longest):
                    seen.update(runs)
                if len(seen) >= HELD:
                    empty()
        empty()
        own = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(total[own])], names=["bucket", "n"])

    found = docs.select(F.col(text).alias("text")).mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(buckets, np.int64)
    out[found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    return out


def gains_of(source: np.ndarray, target: np.ndarray) -> list[int]:
    """Thousandths of the log of how much likelier each bucket is in the target, both counts with one added, rounded down."""
    s_all, t_all, size = int(source.sum()), int(target.sum()), len(source)
    return [math.floor(1000 * math.log((float(t + 1) * float(s_all + size)) / (float(s + 1) * float(t_all + size)))) for s, t in zip(source.tolist(), target.tolist(), strict=True)]


def noise(seed: int, doc_id: object) -> int:
    """Thousandths of a Gumbel variate fixed by the seed and the id (null: empty text)."""
    h = int(sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weigh(docs: DataFrame, gains: list[int], text: str = "text", doc_id: str = "doc_id", longest: int = 1, seed: int = 2024) -> DataFrame:
    """``doc_id``, ``tie`` (a hash of the text), ``n_words``, ``n_features``, ``weight`` and ``score`` of every whole text; one map, no shuffle."""
    own = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("tie"), F.col(text).alias("text"))
    buckets, shared = len(gains), docs.sparkSession.sparkContext.broadcast(gains)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        known = _Known(lambda c: gain[c % buckets])
        for batch, texts in _texts(batches):
            ids = batch.column("doc_id")
            n_words, n_features, weights, scores = [], [], [], []
            for t, i in zip(texts, ids.to_pylist(), strict=True):
                words = words_of(t)
                n, total = len(words), sum(map(known.__getitem__, words))
                for runs in longer_runs(words, longest):
                    n += len(runs)
                    total += sum(gain[c % buckets] for c in runs)
                weight = total // n if n else 0
                n_words.append(len(words))
                n_features.append(n)
                weights.append(weight)
                scores.append(weight + noise(seed, i))
            yield pa.RecordBatch.from_arrays([ids, batch.column("tie"), *(pa.array(x, pa.int64()) for x in (n_words, n_features, weights, scores))], names=["doc_id", "tie", "n_words", "n_features", "weight", "score"])

    kind = own.schema["doc_id"].dataType.simpleString()
    return own.mapInArrow(measure, f"doc_id {kind}, tie long, n_words long, n_features long, weight long, score long")


def highest(rows: DataFrame, of: int) -> DataFrame:
    """Rows with ``rank`` (1, 2, 3, ...) for the ``of`` highest scores, ties to the smaller ``doc_id`` (null last), then to the smaller ``tie``; null for the rest.

    Scores are whole numbers of a bounded range (some 200,000 values), so a count of each says where the draw ends; only rows from
    there on are sorted, by ranges, and each range starts where the ones before it end."""
    counts = rows.groupBy("score").count().toArrow()
    score, n = counts.column("score").to_numpy(), counts.column("count").to_numpy()
    by = np.argsort(-score)
    reached = np.flatnonzero(np.cumsum(n[by]) >= of)
    if not of or not len(reached):
        return rows.withColumn("rank", F.lit(None).cast("long"))
    last = int(score[by[reached[0]]])
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("tie").asc()]
    drawn = rows.where(F.col("score") >= last).repartitionByRange(*order).sortWithinPartitions(*order)
    drawn = staged(drawn.withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}), "drawn")
    base, total = [], 0
    for part, n in sorted(drawn.groupBy("_part").count().collect()):  # a row for each range
        base.append((part, total))
        total += n
    bases = F.broadcast(drawn.sparkSession.createDataFrame(base, "_part int, _base long"))
    place = F.col("_base") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1  # the low bits count a range's rows
    ranked = drawn.join(bases, "_part").withColumn("rank", F.when(place <= of, place)).drop("_part", "_at", "_base")
    return ranked.unionByName(rows.where(F.col("score") < last).withColumn("rank", F.lit(None).cast("long")))


def resample(docs: DataFrame, target: DataFrame, percent: int = 10, least_words: int = 20, longest: int = 1, buckets: int = 10_000, seed: int = 2024, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Weigh every document by how much likelier its words (runs of up to ``longest``) are in the texts of ``target``, and draw ``percent`` of those with ``least_words``.

    Returns a row for every document: ``doc_id``, ``n_features``, ``weight``, ``score`` and ``rank`` (null if not drawn). Counts cover all rows of both
    tables. Null and empty texts have no features, weight 0 and are not drawn. Null ids count as empty text in the seed and come last in ties;
    repeated rows are each counted, weighed and drawn; very long texts are read whole, a run of their own each. An empty target
    leaves weights to the source alone; an empty table of documents gives an empty result. Extra columns are not read."""
    gains = gains_of(bucket_counts(docs, text, longest, buckets), bucket_counts(target, text, longest, buckets))
    rows = staged(weigh(docs, gains, text, doc_id, longest, seed), "weighed")
    enough = F.col("n_words") >= least_words
    out = highest(rows.where(enough), percent * rows.where(enough).count() // 100).unionByName(rows.where(~enough).withColumn("rank", F.lit(None).cast("long")))
    return out.select("doc_id", "n_features", "weight", "score", "rank")
