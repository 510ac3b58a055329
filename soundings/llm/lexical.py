"""Ranked lexical search over bit-sliced Bloom signatures.

Each document has a Bloom signature of its terms, and of its terms that occur at least twice, four times and so on. Signatures of
documents of like size stand side by side in a block: a slice is the bitmap of one signature bit over the block's documents. A
term is possibly present where all its slices have a bit, so sums of term weights over slices, times what a term can be worth in each
document, bound its score from above. The exact scores of the ten best by bound give each item a floor; every document whose bound
reaches it is scored exactly from its text. All others are provably outside the first ten.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import staged
from .words import ALNUM, Words, mix, slices, split_words, spread

#: Frequencies from which a term has a further entry in a signature.
STEPS = (1, 2, 4, 8, 16, 32)
#: Slices of an entry, and bits of a signature for each entry at least.
PROBES, BITS_EACH = 4, 8
#: Signatures are not wider; those of longer documents fill up and exclude less, nothing else.
MOST_WIDTH = 1 << 20
#: Bits of a block, and documents in it at most.
BLOCK_BITS, BLOCK_DOCS = 1 << 22, 8192
#: Text of items that are searched together, in bytes: what tasks hold of them.
ITEMS_HELD = 4 << 20
#: Items whose bounds a task works out together.
ITEMS_EACH = 256
_ODD = 0x9E3779B97F4A7C15


@dataclass
class Asked:
    """Items and their distinct terms: hashes in order, with the length and first bytes of each. A pair is a term in an item, ``times`` over, of ``weight`` for all of them."""

    ids: list
    hashes: np.ndarray
    sizes: np.ndarray
    heads: np.ndarray
    item: np.ndarray
    term: np.ndarray
    times: np.ndarray
    weight: np.ndarray
    docs: int = 0
    terms: int = 0

    @staticmethod
    def of(items: pa.Table) -> Asked:
        words = split_words(items.column("text").combine_chunks(), ALNUM)
        hashes, first, place = np.unique(words.hashes(), return_index=True, return_inverse=True)
        code, times = np.unique(words.doc * max(len(hashes), 1) + place, return_counts=True)
        heads, _, begin = words._blocks(first) if len(first) else (np.zeros(0, np.uint64),) * 3
        return Asked(items.column("item_id").to_pylist(), hashes, (words.end - words.start)[first], heads[begin], code // max(len(hashes), 1), code % max(len(hashes), 1), times, times * 0)

    def hits(self, words: Words, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which words (``h``: their hashes) are asked-for terms, and which terms they are: equal in hash, length and first eight bytes."""
        if not len(self.hashes) or not len(words.start):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        own = np.flatnonzero((self.hashes[at] == h) & (self.sizes[at] == words.end - words.start))
        if not len(own):
            return own, own
        heads, _, begin = words._blocks(own)
        own = own[heads[begin] == self.heads[at[own]]]
        return own, at[own]

    def weighed(self, df: np.ndarray, docs: int, terms: int) -> Asked:
        """With weights by the documents that hold each term; terms that weigh nothing are left out."""
        w = np.array([math.floor(1000 * math.log((2 * docs + 2) / (2 * n + 1))) for n in df.tolist()], np.int64)
        weight = self.times * w[self.term] if len(w) else self.times
        own = weight > 0
        return replace(self, item=self.item[own], term=self.term[own], times=self.times[own], weight=weight[own], docs=docs, terms=terms)

    def parts(self) -> Iterator[tuple[int, Asked]]:
        """Runs of items with the terms of their own, and the first item of each."""
        for a in range(0, len(self.ids), ITEMS_EACH):
            own = slice(*np.searchsorted(self.item, [a, a + ITEMS_EACH]))
            terms, term = np.unique(self.term[own], return_inverse=True)
            yield a, replace(self, ids=self.ids[a : a + ITEMS_EACH], hashes=self.hashes[terms], sizes=self.sizes[terms], heads=self.heads[terms], item=self.item[own] - a, term=term, times=self.times[own], weight=self.weight[own])


def worth(tf: np.ndarray, n: np.ndarray, asked: Asked) -> np.ndarray:
    """What a term's weight is multiplied with: it grows with its frequency ``tf`` and falls with the document's length ``n``."""
    m = 25 + 75 * n * asked.docs // max(asked.terms, 1)
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


def _entry(keys: np.ndarray, step: int) -> np.ndarray:
    """The entry of a term (by 48 bits of its hash) at one step of its frequency."""
    return mix(keys + np.uint64((step + 1) * _ODD % (1 << 64)))


def _slices_of(entries: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """The slices of each entry, one probe after the other."""
    a, b = entries & np.uint64(0xFFFFFFFF), (entries >> np.uint64(32)) | np.uint64(1)
    for k in range(PROBES):
        yield ((a + np.uint64(k) * b) & np.uint64(width - 1)).astype(np.int64)


class _Block:
    """Documents of one width whose signatures are not written yet."""

    def __init__(self, width: int) -> None:
        self.width, self.most = width, max(8, min(BLOCK_DOCS, BLOCK_BITS // width))
        self.ids, self.n, self.top, self.entries, self.doc = [], [], [], [], []

    def row(self, kind: pa.DataType) -> pa.RecordBatch:
        docs = -(-len(self.ids) // 8) * 8
        entries, doc = np.concatenate(self.entries), np.concatenate(self.doc)
        flags = np.zeros(self.width * docs, bool)
        for at in _slices_of(entries, self.width):
            flags[at * docs + doc] = True
        bits = np.packbits(flags.reshape(self.width, docs), axis=1)
        return _row(width=pa.array([self.width], pa.int32()), doc_id=pa.array([self.ids], pa.list_(kind)), n=pa.array([self.n], pa.list_(pa.int64())), top=pa.array([self.top], pa.list_(pa.int64())), bits=pa.array([bits.tobytes()], pa.binary()))


def _row(kind: pa.DataType | None = None, **given: pa.Array) -> pa.RecordBatch:
    kinds = {"width": pa.int32(), "doc_id": pa.list_(kind or pa.int64()), "n": pa.list_(pa.int64()), "top": pa.list_(pa.int64()), "bits": pa.binary(), "df": pa.list_(pa.int64())}
    return pa.RecordBatch.from_arrays([given.get(k, pa.nulls(1, t)) for k, t in kinds.items()], names=list(kinds))


def read_texts(docs: DataFrame, shared: Broadcast, signed: bool = True, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One pass over all whole texts: blocks of signatures (``width``, ``doc_id``, ``n`` terms, ``top``: the highest frequency there can be, ``bits``: slice after slice), if ``signed``,
    and a row for each task with ``df``, the documents that hold each term of ``shared`` (an ``Asked``). Documents without terms have no signature."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, open_blocks = shared.value, {}
        df, kind = np.zeros(len(asked.hashes), np.int64), None

        def add(words: Words, h: np.ndarray, ids: list) -> Iterator[pa.RecordBatch]:
            keys = np.sort((words.doc.astype(np.uint64) << np.uint64(48)) | (h >> np.uint64(16)))
            first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
            tf, keys = np.diff(np.append(first, len(keys))), keys[first]
            owner, keys = (keys >> np.uint64(48)).astype(np.int64), keys & np.uint64((1 << 48) - 1)
            top = words.counts - np.bincount(owner, minlength=len(ids)) + 1
            reached = [np.flatnonzero(tf >= step) for step in STEPS]
            entries = np.concatenate([_entry(keys[own], k) for k, own in enumerate(reached)])
            doc = np.concatenate([owner[own] for own in reached])
            by = np.argsort(doc, kind="stable")
            entries, many = entries[by], np.bincount(doc, minlength=len(ids))
            begin = np.cumsum(many) - many
            width = np.minimum(64 << np.ceil(np.log2(np.maximum(many * BITS_EACH / 64, 1))).astype(np.int64), MOST_WIDTH)
            for w in np.unique(width[many > 0]).tolist():
                left = np.flatnonzero((width == w) & (many > 0))
                while len(left):
                    block = open_blocks.setdefault(w, _Block(w))
                    now, left = np.split(left, [block.most - len(block.ids)])
                    block.entries.append(entries[spread(many[now], begin[now])])
                    block.doc.append(np.repeat(len(block.ids) + np.arange(len(now)), many[now]))
                    block.n += words.counts[now].tolist()
                    block.top += top[now].tolist()
                    block.ids += [ids[i] for i in now.tolist()]
                    if len(block.ids) == block.most:
                        yield open_blocks.pop(w).row(kind)

        for whole in batches:
            kind = whole.column("doc_id").type
            for part in slices(whole, "text"):
                for at in range(0, part.num_rows, 1 << 15):
                    batch = part.slice(at, 1 << 15)
                    words = split_words(batch.column("text"), ALNUM)
                    if len(words.start):
                        h = words.hashes()
                        own, term = asked.hits(words, h)
                        code = np.unique(words.doc[own] * max(len(df), 1) + term)
                        df += np.bincount(code % max(len(df), 1), minlength=len(df))
                        if signed:
                            yield from add(words, h, batch.column("doc_id").to_pylist())
        for block in open_blocks.values():
            yield block.row(kind)
        if kind is not None:
            yield _row(kind, df=pa.array([df.tolist()], pa.list_(pa.int64())))

    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = own.schema["doc_id"].dataType.simpleString()
    return own.mapInArrow(read, f"width int, doc_id array<{kind}>, n array<long>, top array<long>, bits binary, df array<long>")


def upper_bounds(bits: bytes, width: int, n: np.ndarray, top: np.ndarray, asked: Asked) -> np.ndarray:
    """A bound of the score of each document of a block (columns) for each item (rows)."""
    docs = -(-len(n) // 8)
    table = np.frombuffer(bits, np.uint8).reshape(width, docs)
    out = np.zeros((len(asked.ids), len(n)), np.int64)
    live = np.arange(len(asked.hashes))
    keys, before, below = asked.hashes >> np.uint64(16), np.zeros(len(n), np.int64), None
    for k, step in enumerate(STEPS):
        last = 2 * step - 1 if k + 1 < len(STEPS) else 1 << 40
        reach = worth(np.minimum(np.maximum(top, 1), last), n, asked)
        present = np.full((len(live), docs), 255, np.uint8) if below is None else below
        for at in _slices_of(_entry(keys[live], k), width):
            present &= table[at]
        some = present.any(axis=1)
        live, below = live[some], present[some]
        if not len(live):
            break
        at = np.minimum(np.searchsorted(live, asked.term), len(live) - 1)
        pairs = np.flatnonzero(live[at] == asked.term)
        if len(pairs):
            row, item, weight = at[pairs], asked.item[pairs], asked.weight[pairs]
            first = np.flatnonzero(np.concatenate(([True], item[1:] != item[:-1])))
            wide = max(1, (1 << 21) // (8 * len(pairs)))
            for a in range(0, docs, wide):
                shown = np.unpackbits(below[:, a : a + wide], axis=1)[row, : len(n) - 8 * a]
                cols = slice(8 * a, 8 * a + shown.shape[1])
                out[item[first], cols] += np.add.reduceat(shown * weight[:, None], first, axis=0) * (reach - before)[cols]
        before = reach
    return out


def _last(doc_id: object) -> tuple:
    """Order of ids: null last."""
    return (1, 0) if doc_id is None else (0, doc_id)


def _bounds_of(batch: pa.RecordBatch, parts: list[tuple[int, Asked]]) -> Iterator[tuple[list, int, np.ndarray]]:
    """For each block of documents and each run of items: the ids, the first item and the bounds."""
    for r in range(batch.num_rows):
        n, top = (np.asarray(batch.column(c)[r].values, np.int64) for c in ("n", "top"))
        ids, bits, width = (batch.column(c)[r].as_py() for c in ("doc_id", "bits", "width"))
        for a, asked in parts:
            yield ids, a, upper_bounds(bits, width, n, top, asked)


def _first(rows: DataFrame, depth: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= depth)


def _pairs(found: dict[int, list], kind: pa.DataType) -> pa.RecordBatch:
    flat = [(i, d, s) for i, own in found.items() for s, d in own]
    return pa.RecordBatch.from_arrays([pa.array([x[0] for x in flat], pa.int32()), pa.array([x[1] for x in flat], kind), pa.array([x[2] for x in flat], pa.int64())], names=["item", "doc_id", "score"])


def best_by_bound(index: DataFrame, shared: Broadcast, depth: int) -> DataFrame:
    """``item``, ``doc_id`` and ``score`` (the bound) of the ``depth`` documents of highest bound; each task gives its own ``depth`` at most."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, found, kind = list(shared.value.parts()), {}, pa.int64()
        least = np.ones(len(shared.value.ids), np.int64)  # the bound of each item's last so far
        for batch in batches:
            kind = batch.column("doc_id").type.value_type
            for ids, a, bound in _bounds_of(batch, parts):
                few = min(depth, bound.shape[1])
                better = np.flatnonzero(bound.max(axis=1) >= least[a : a + len(bound)])
                for i, own in zip(better.tolist(), np.argpartition(-bound[better], few - 1, axis=1)[:, :few], strict=True):
                    new = [(s, ids[d]) for s, d in zip(bound[i, own].tolist(), own.tolist(), strict=True) if s > 0]
                    found[a + i] = sorted(found.get(a + i, []) + new, key=lambda x: (-x[0], _last(x[1])))[:depth]
                    if len(found[a + i]) == depth:
                        least[a + i] = found[a + i][-1][0]
        yield _pairs(found, kind)

    kind = index.schema["doc_id"].dataType.elementType.simpleString()
    return _first(index.mapInArrow(search, f"item int, doc_id {kind}, score long"), depth)


def not_excluded(index: DataFrame, shared: Broadcast) -> DataFrame:
    """``item`` and ``doc_id`` of all documents whose bound reaches the item's floor (a score and, for an equal bound, the greatest id). ``shared``: items and floors."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, score, greatest = shared.value
        parts = list(asked.parts())
        for batch in batches:
            kind = batch.column("doc_id").type.value_type
            for ids, a, bound in _bounds_of(batch, parts):
                floor = score[a : a + len(bound)]
                item, doc = np.nonzero(bound >= floor[:, None])
                tie = bound[item, doc] == floor[item]
                out = [(a + i, ids[d]) for i, d, t in zip(item.tolist(), doc.tolist(), tie.tolist(), strict=True) if not t or greatest[a + i] is None or _last(ids[d]) <= greatest[a + i]]
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int32()), pa.array([x[1] for x in out], kind)], names=["item", "doc_id"])

    kind = index.schema["doc_id"].dataType.elementType.simpleString()
    return index.mapInArrow(search, f"item int, doc_id {kind}")


def exact_scores(docs: DataFrame, pairs: DataFrame, shared: Broadcast, depth: int) -> DataFrame:
    """The ``depth`` best of each item by exact scores above 0, among the documents in ``pairs`` (``item``, ``doc_id``): their whole texts are read, each once for all its items.

    Rows that share an id are all scored. Each task gives its own ``depth`` of each item at most."""
    wanted = pairs.select("item", "doc_id").distinct().groupBy("doc_id").agg(F.collect_list("item").alias("items"))  # as many as there are items at most
    own = docs.join(wanted.withColumnRenamed("doc_id", "wanted"), F.col("doc_id").eqNullSafe(F.col("wanted"))).select("doc_id", "text", "items")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, found, kind = shared.value, {}, pa.int64()
        begin = np.searchsorted(asked.item, np.arange(len(asked.ids) + 1))
        size = len(asked.hashes)
        single = np.zeros(size, np.int64)  # weight of one occurrence in an item
        single[asked.term] = asked.weight // asked.times
        worths = np.zeros(size, np.int64)
        for whole in batches:
            kind = whole.column("doc_id").type
            for batch in slices(whole, "text"):
                words = split_words(batch.column("text"), ALNUM)
                at, term = asked.hits(words, words.hashes())
                code, tf = np.unique(words.doc[at] * max(size, 1) + term, return_counts=True)
                doc, term = code // max(size, 1), code % max(size, 1)
                value = single[term] * worth(tf, words.counts[doc], asked)
                bounds = np.searchsorted(doc, np.arange(batch.num_rows + 1))
                for d, (name, items) in enumerate(zip(batch.column("doc_id").to_pylist(), batch.column("items").to_pylist(), strict=True)):
                    mine = slice(bounds[d], bounds[d + 1])
                    worths[term[mine]] = value[mine]
                    for i in items:
                        these = slice(begin[i], begin[i + 1])
                        s = int((asked.times[these] * worths[asked.term[these]]).sum())
                        if s > 0:
                            own = found.setdefault(i, [])
                            own.append((s, name))
                            if len(own) > 64 * depth:
                                own[:] = sorted(own, key=lambda x: (-x[0], _last(x[1])))[:depth]
                    worths[term[mine]] = 0
        yield _pairs({i: sorted(own, key=lambda x: (-x[0], _last(x[1])))[:depth] for i, own in found.items()}, kind)

    kind = own.schema["doc_id"].dataType.simpleString()
    return _first(own.mapInArrow(score, f"item int, doc_id {kind}, score long"), depth)


def _searched(docs: DataFrame, index: DataFrame | None, items: DataFrame, depth: int) -> tuple[DataFrame, DataFrame]:
    """Ranks for one block of items, and the index (made in the same pass over the texts that counts terms, if there is none yet)."""
    spark = docs.sparkSession
    asked = Asked.of(items.toArrow())
    read = staged(read_texts(docs, spark.sparkContext.broadcast(asked), signed=index is None), "texts")
    if index is None:
        index = read.where("bits is not null")
    n = F.aggregate("n", F.lit(0).cast("long"), lambda a, x: a + x)
    docs_held, terms_held = index.agg(F.coalesce(F.sum(F.size("n")), F.lit(0)), F.coalesce(F.sum(n), F.lit(0))).first()
    df = np.zeros(len(asked.hashes), np.int64)
    for at, count in read.where("df is not null").select(F.posexplode("df")).where("col > 0").groupBy("pos").agg(F.sum("col")).collect():  # a row for each term of the block
        df[at] = count
    asked = asked.weighed(df, docs_held, terms_held)
    shared = spark.sparkContext.broadcast(asked)
    pilot = staged(best_by_bound(index, shared, depth), "pilot")  # ``depth`` rows for each item of the block at most
    floor, greatest = np.ones(len(asked.ids), np.int64), [None] * len(asked.ids)
    for r in exact_scores(docs, pilot, shared, depth).where(F.col("rank") == depth).collect():
        floor[r.item], greatest[r.item] = r.score, _last(r.doc_id)
    left = staged(not_excluded(index, spark.sparkContext.broadcast((asked, floor, greatest))), "left")
    names = spark.createDataFrame(list(enumerate(asked.ids)) or [(0, None)], f"item int, item_id {items.schema['item_id'].dataType.simpleString()}")
    return exact_scores(docs, left, shared, depth).join(F.broadcast(names), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"), index


def ranked_search(docs: DataFrame, items: DataFrame, depth: int = 10, text: str = "text", doc_id: str = "doc_id", item_id: str = "item_id", item_text: str = "text", items_held: int = ITEMS_HELD) -> DataFrame:
    """Rank all documents for each row of ``items``: ``item_id``, ``rank`` (from 1), ``doc_id`` and ``score`` of the ``depth`` highest scores above 0, equal ones by ``doc_id`` (null last).

    Null and empty texts have no terms and are not found; items without terms find nothing. Repeated rows of documents are each ranked
    and repeated items each answered; very long texts are read whole. An empty table of either kind gives an empty result; extra columns are not read.
    Items are searched in blocks of about ``items_held`` bytes of text, chosen by a hash; signatures are made once and serve all blocks."""
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    asked = items.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("text"))
    size = asked.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, math.ceil(1.2 * size / items_held)) if size > items_held else 1
    place: Column = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    index, out = None, None
    for k in range(blocks):
        found, index = _searched(own, index, asked.where(place == k) if blocks > 1 else asked, depth)
        out = found if out is None else out.unionByName(found)
    return out
