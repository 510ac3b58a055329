"""Packing by powers of two: documents are cut into pieces of binary lengths, and pieces of equal length share a bucket.

A piece is a whole sequence, so no sequence crosses documents and none is padded. Buckets are folders of one table: a reader of sequences
of one length opens only theirs.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import TextEncoder
from .words import slices, spread

#: Entries of the table that a worker keeps between batches and tasks.
PIECES_KNOWN = 600_000


def binary_pieces(n: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Lengths of the pieces of documents of ``n`` tokens, end to end, and how many each has: pieces of ``most`` first, then the binary digits of the rest, high ones first."""
    if most < 1 or most & (most - 1):
        raise ValueError("sequences need a power of two as their greatest length")
    whole, rest = n // most, n % most
    powers = np.array([1 << k for k in reversed(range(most.bit_length() - 1))], np.int64)
    digit = (rest[:, None] & powers[None, :]) > 0
    many = np.concatenate((whole[:, None], digit), axis=1)
    lengths = np.repeat(np.tile(np.concatenate(([most], powers)), len(n)), many.ravel())
    return lengths, many.sum(axis=1)


class PieceCoder:
    """Ids of distinct pieces of texts by the library: pieces not known yet are encoded together, and the ids' offsets tell them apart."""

    _own: dict[str, PieceCoder] = {}

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.known: dict[bytes, bytes] = {}

    @classmethod
    def of(cls, path: str) -> PieceCoder:
        if path not in cls._own:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            cls._own[path] = cls(path)
        return cls._own[path]

    def encode(self, pieces: list[bytes]) -> Iterator[bytes]:
        """Ids as 32-bit integers. White space ends a word of this tokenizer and has no id of its own, so pieces with a blank between them don't touch."""
        texts = [p.decode() for p in pieces]
        for at in range(0, len(texts), 4096):
            part = texts[at : at + 4096]
            found = self.library.encode(" ".join(part), add_special_tokens=False)
            n = np.fromiter(map(len, part), np.int64, len(part)) + 1
            begin = np.fromiter((a for a, _ in found.offsets), np.int64, len(found.offsets))
            cut = [*np.searchsorted(begin, np.cumsum(n) - n).tolist(), len(begin)]
            data = np.array(found.ids, np.int32).tobytes()
            yield from [data[4 * a : 4 * b] for a, b in zip(cut[:-1], cut[1:], strict=True)]

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and how many stand before each text and after the last."""
        chunks = TextEncoder._split(texts)
        _, keys, place = chunks.distinct()
        found = [self.known.get(k) for k in keys]
        new = [i for i, x in enumerate(found) if x is None]
        for i, ids in zip(new, self.encode([keys[i] for i in new]), strict=True):
            found[i] = ids
            if len(self.known) < PIECES_KNOWN:
                self.known[keys[i]] = ids
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        each = size[place] if len(place) else np.zeros(0, np.int64)
        flat = np.frombuffer(b"".join(found), np.int32)
        ids = flat[spread(each, (np.cumsum(size) - size)[place])] if len(each) else flat
        return ids, np.concatenate(([0], np.cumsum(each)))[chunks.bounds]


def write_packed(docs: DataFrame, path: str, tokenizer: str, end_id: int, most: int = 2048, text: str = "text", doc_id: str = "doc_id") -> None:
    """Encode every whole text, append ``end_id``, cut at binary lengths, and write Parquet with a folder ``length=...`` for each bucket.

    Rows are sequences: ``sequence_id`` (a number of its own for each: the task's above 2^36, the place in it below), ``doc_id``, ``start`` (the document's
    ids before it), ``doc_tokens`` (the document's ids with the end) and ``ids``. One map over rows, no shuffle, and nothing passes the driver.
    Null and empty texts are documents of one id, ``end_id``; repeated rows and null ids are each packed; a very long text is encoded
    whole, a run of its own. An empty table writes no sequence. Extra columns are not read."""
    binary_pieces(np.zeros(0, np.int64), most)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, given = PieceCoder.of(tokenizer), TaskContext.get().partitionId() << 36
        for whole in batches:
            for batch in slices(whole, "text", 4 << 20):
                ids, ends = coder.ids(batch.column("text"))
                ids = np.insert(ids, ends[1:], end_id).astype(np.int32)
                n = np.diff(ends) + 1
                lengths, many = binary_pieces(n, most)
                doc = np.repeat(np.arange(len(n)), many)
                offsets = np.concatenate(([0], np.cumsum(lengths)))
                start = offsets[:-1] - (np.cumsum(n) - n)[doc]
                for at in range(0, len(lengths), 1 << 14):
                    cut = slice(at, at + (1 << 14))
                    bounds = offsets[at : at + len(lengths[cut]) + 1]
                    lists = pa.ListArray.from_arrays(pa.array((bounds - bounds[0]).astype(np.int32)), pa.array(ids[bounds[0] : bounds[-1]]))
                    columns = [pa.array(lengths[cut].astype(np.int32)), pa.array(given + at + np.arange(len(bounds) - 1)), batch.column("doc_id").take(pa.array(doc[cut])), pa.array(start[cut]), pa.array(n[doc[cut]]), lists]
                    yield pa.RecordBatch.from_arrays(columns, names=["length", "sequence_id", "doc_id", "start", "doc_tokens", "ids"])
                given += len(lengths)

    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = own.schema["doc_id"].dataType.simpleString()
    rows = own.mapInArrow(pack, f"length int, sequence_id long, doc_id {kind}, start long, doc_tokens long, ids array<int>")
    rows.write.partitionBy("length").option("compression", "zstd").parquet(path)


def read_packed(spark: SparkSession, path: str, length: int | None = None, kind: str = "long") -> DataFrame:
    """Sequences of the table, or of one bucket (``length``), whose folder alone is read. ``offset`` is the piece's place in its sequence, which it fills. ``kind``: the type of ``doc_id``."""
    rows = spark.read.schema(f"sequence_id long, doc_id {kind}, start long, doc_tokens long, ids array<int>, length int").parquet(path)
    rows = rows if length is None else rows.where(F.col("length") == length)
    return rows.select("doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", F.lit(0).cast("long").alias("offset"))


def sequence_digests(rows: DataFrame) -> DataFrame:
    """The columns of ``read_packed`` with ``ids_crc32``, the CRC-32 of the ids as little-endian 32-bit integers, in place of the ids."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            data = memoryview(np.ascontiguousarray(np.asarray(ids.values).astype("<u4", copy=False))).cast("B")
            at = np.asarray(ids.offsets).tolist()
            crc = pa.array([zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(at[:-1], at[1:], strict=True)], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("start"), batch.column("length").cast(pa.int64()), crc, *(batch.column(c) for c in ("doc_tokens", "sequence_id", "offset"))], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(digest, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
