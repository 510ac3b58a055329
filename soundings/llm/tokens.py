"""Token ids of documents in ORC: run-length encoded integers, row indexes and Bloom filters on document ids."""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .words import slices, split_chunks, spread

#: Entries of the cache that a worker keeps between batches and tasks; frequent chunks come first, so they are the ones kept.
CACHE_SIZE = 800_000


class ChunkEncoder:
    """Ids of whole texts from the library's ids of their distinct chunks."""

    _own: dict[str, ChunkEncoder] = {}

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.cache: dict[bytes, bytes] = {}

    @classmethod
    def of(cls, path: str) -> ChunkEncoder:
        if path not in cls._own:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            cls._own[path] = cls(path)
        return cls._own[path]

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and how many each text has."""
        chunks = split_chunks(texts)
        _, keys, place = chunks.distinct()
        found = [self.cache.get(k) for k in keys]
        new = [i for i, x in enumerate(found) if x is None]
        if new:
            for i, e in zip(new, self.library.encode_batch_fast([keys[i].decode() for i in new], add_special_tokens=False), strict=True):
                found[i] = np.array(e.ids, np.uint32).tobytes()
                if len(self.cache) < CACHE_SIZE:
                    self.cache[keys[i]] = found[i]
        lengths = np.fromiter(map(len, found), np.int64, len(found)) // 4
        flat = np.frombuffer(b"".join(found), np.uint32)
        n = lengths[place] if len(place) else np.zeros(0, np.int64)
        ids = flat[spread(n, (np.cumsum(lengths) - lengths)[place])] if len(n) else np.zeros(0, np.uint32)
        total = np.concatenate(([0], np.cumsum(n)))
        return ids, np.diff(total[chunks.bounds])


def write_token_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int, text: str = "text", doc_id: str = "doc_id", stripe_mb: int = 64, index_stride: int = 1000) -> None:
    """Encode every whole text, append ``end_id``, and write ORC in ascending ``doc_id`` order.

    Files hold ``part`` (their place in the order), ``doc_id``, ``start_in_part`` and ``ids``. The integer columns are
    run-length encoded; every stripe carries row indexes and a Bloom filter on ``doc_id``, so a reader skips
    stripes by metadata and reads the rest in parallel. Texts are what is shuffled: they are a third the size of ids.
    Null and empty texts are documents of one id, ``end_id``. Null ids come first; rows with equal ids are
    ordered by a hash of their text, and repeated rows are each written. A very long text is encoded whole. Ids keep their type."""
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("tie"))
    own = own.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part, at = ChunkEncoder.of(tokenizer), TaskContext.get().partitionId(), 0
        for whole in batches:
            for batch in slices(whole, "text", 4 << 20):
                ids, n = coder.ids(batch.column("text"))
                ends = np.cumsum(n)
                ids = np.insert(ids, ends, end_id)
                offsets = np.concatenate(([0], ends + np.arange(1, len(n) + 1)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(n), part, np.int32)), batch.column("doc_id"), pa.array(at + offsets[:-1]), pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids.astype(np.int32)))],
                    names=["part", "doc_id", "start_in_part", "ids"],
                )
                at += int(offsets[-1])

    kind = own.schema["doc_id"].dataType.simpleString()
    rows = own.mapInArrow(encode, f"part int, doc_id {kind}, start_in_part long, ids array<int>")
    writer = rows.write.option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", "0.01")
    writer.option("orc.stripe.size", stripe_mb << 20).option("orc.row.index.stride", index_stride).option("orc.compress", "ZSTD").orc(path)


def read_token_ids(spark: SparkSession, path: str, kind: str = "long") -> DataFrame:
    """Rows of the files with ``start``, the number of ids in all documents before. ``kind``: the type of ``doc_id``; a filter on it prunes stripes."""
    rows = spark.read.schema(f"part int, doc_id {kind}, start_in_part long, ids array<int>").orc(path)
    ends = rows.groupBy("part").agg(F.max(F.col("start_in_part") + F.size("ids")).alias("n")).collect()  # a row for each file
    base, total = {}, 0
    for part, n in sorted(ends):
        base[part] = total
        total += n
    parts = spark.createDataFrame(sorted(base.items()) or [(0, 0)], "part int, base long")
    return rows.join(F.broadcast(parts), "part").select("doc_id", (F.col("base") + F.col("start_in_part")).alias("start"), "ids")


def id_digests(rows: DataFrame) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens`` and the CRC-32 of the ids as little-endian 32-bit integers."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            flat = np.asarray(ids.values).astype("<u4", copy=False)
            at = np.asarray(ids.offsets)
            data = memoryview(np.ascontiguousarray(flat)).cast("B")
            crc = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("start"), pa.array(np.diff(at).astype(np.int64)), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(digest, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long")
