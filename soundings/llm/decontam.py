"""Benchmark decontamination by a positional inverted index: offset-adjusted lists of the rarest terms are intersected.

The index holds the places of the terms that are rarest in some window. Windows with the same rarest terms at the same distances
share an anchor, and the lists of an anchor meet in blocks of positions, so no document or term makes an unbounded group. Where all lists of an
anchor have a place in a block, places at the right distances are candidates for the phrase and places near one another for a match
with words between; both are settled on the words of that block."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructType

from .shared import Scratch, bit_table, passes, row_key, staged
from .words import ALNUM, slices, split_words

#: Most window terms looked for in one pass over the documents; a larger benchmark is searched in several blocks.
TERMS_PER_BLOCK = 1_000_000
#: Lists that are intersected for each window.
RAREST = 3
#: Positions in a block of a document.
BLOCK = 4096


def windows_of(benchmark: DataFrame, size: int = 10, text: str = "text", item_id: str = "item_id") -> DataFrame:
    """``win`` (hash of the phrase), ``phrase`` (its words, a space between), ``terms`` (word hashes in order) and ``items`` (ids, sorted) of every distinct window.

    ``size`` consecutive words of an item; an item of fewer words, but some, is one window. Items without words have none."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                words = split_words(batch.column("text"), ALNUM)
                h, data = words.hashes().view(np.int64), words.data.tobytes()
                spans = list(zip(words.start.tolist(), words.end.tolist(), strict=True))
                terms, phrases, ids, items = [], [], [], batch.column("item").to_pylist()
                for d in range(words.n_docs):
                    first, n = int(words.bounds[d]), int(words.bounds[d + 1] - words.bounds[d])
                    for i in range(first, first + max(1, n - size + 1) if n else first):
                        end = min(i + size, first + n)
                        terms.append(h[i:end].tolist())
                        phrases.append(b" ".join([data[x:y] for x, y in spans[i:end]]))
                        ids.append(items[d])
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(phrases, pa.binary()).cast(pa.string()), pa.array(terms, pa.list_(pa.int64()))], names=["item", "phrase", "terms"])

    own = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), F.col(text).alias("text"))
    got = own.mapInArrow(cut, "item string, phrase string, terms array<long>")
    return got.groupBy("phrase").agg(F.xxhash64("phrase").alias("win"), F.first("terms").alias("terms"), F.sort_array(F.collect_set("item")).alias("items"))


def _hits(hashes: np.ndarray, wanted: np.ndarray, small: np.ndarray) -> np.ndarray:
    """Places of ``hashes`` that are in the sorted ``wanted``; ``small`` is a bit table that settles most at once."""
    maybe = np.flatnonzero(small[(hashes & np.uint64(0xFFFFF)).astype(np.int64)])
    at = np.minimum(np.searchsorted(wanted, hashes[maybe]), len(wanted) - 1)
    return maybe[wanted[at] == hashes[maybe]]


def _small(wanted: np.ndarray) -> np.ndarray:
    small = np.zeros(1 << 20, bool)
    small[(wanted & np.uint64(0xFFFFF)).astype(np.int64)] = True
    return small


def term_counts(docs: DataFrame, terms: np.ndarray, text: str = "text") -> DataFrame:
    """``term``, ``n``: occurrences of the given word hashes in whole texts; each task adds up its own first."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = shared.value
        small, total = _small(wanted), np.zeros(len(wanted), np.int64)
        for whole in batches:
            for batch in slices(whole, "text"):
                h = split_words(batch.column("text"), ALNUM).hashes()
                total += np.bincount(np.searchsorted(wanted, h[_hits(h, wanted, small)]), minlength=len(wanted))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(wanted[some].view(np.int64)), pa.array(total[some])], names=["term", "n"])

    return docs.select(F.col(text).alias("text")).mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))


def postings(docs: DataFrame, terms: np.ndarray, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The index: ``term``, ``_k`` (``row_key(doc_id, text)``) and ``pos`` (word number) of every occurrence of the given word hashes."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = shared.value
        small = _small(wanted)
        for whole in batches:
            for batch in slices(whole, "text"):
                words = split_words(batch.column("text"), ALNUM)
                h = words.hashes()
                at = _hits(h, wanted, small)
                key = batch.column("_k").to_numpy()[words.doc[at]]
                yield pa.RecordBatch.from_arrays([pa.array(h[at].view(np.int64)), pa.array(key), pa.array((at - words.bounds[words.doc[at]]).astype(np.int32))], names=["term", "_k", "pos"])

    return docs.select(row_key(doc_id, text).alias("_k"), F.col(text).alias("text")).mapInArrow(post, "term long, _k long, pos int")


def _terms(rows: DataFrame) -> np.ndarray:
    return np.sort(rows.toArrow().column("term").to_numpy().view(np.uint64))


def anchors(docs: DataFrame, windows: DataFrame, text: str = "text", rarest: int = RAREST) -> DataFrame:
    """``win``, ``anchor``, ``first`` (offset of the anchor's first term in the window) and ``lists`` (``term``, ``place``, ``step``: distance from the first): the rarest distinct terms of each window by corpus counts.

    A window with a term that no document has is left out: it can't occur."""
    one = windows.select("win", F.posexplode("terms").alias("offset", "term")).groupBy("win", "term").agg(F.min("offset").alias("offset"))
    counts = term_counts(docs, _terms(one.select("term").distinct()), text)
    known = one.join(counts, "term", "left").withColumn("absent", F.max(F.col("n").isNull()).over(Window.partitionBy("win")))
    ranked = known.where("not absent").withColumn("at", F.row_number().over(Window.partitionBy("win").orderBy("n", "term"))).where(F.col("at") <= rarest)
    own = ranked.groupBy("win").agg(F.sort_array(F.collect_list(F.struct("offset", "term"))).alias("own"))
    lists = F.transform("own", lambda x, i: F.struct(x["term"].alias("term"), i.alias("place"), (x["offset"] - F.col("first")).alias("step")))
    own = own.withColumn("first", F.col("own")[0]["offset"]).withColumn("lists", lists)
    return own.select("win", F.xxhash64("lists").alias("anchor"), "first", "lists")


def _meet(places: np.ndarray, steps: list[int], low: int, high: int, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """``places``: positions times eight plus the list's number. Positions of the first list from ``low`` to ``high`` that all others agree with; and those with all others within ``reach`` words."""
    each = [np.unique(places[places & 7 == k] >> 3) for k in range(len(steps))]
    first = each[0][(each[0] >= low) & (each[0] < high)]
    exact, near = np.ones(len(first), bool), np.ones(len(first), bool)
    for own, step in zip(each[1:], steps[1:], strict=True):
        exact &= np.isin(first + step, own)
        at = np.searchsorted(own, first)
        before, after = own[np.maximum(at - 1, 0)], own[np.minimum(at, len(own) - 1)]
        near &= np.minimum(np.abs(first - before), np.abs(after - first)) <= reach
    return first[exact], first[near]


def candidates(docs: DataFrame, windows: DataFrame, size: int, slop: int | None = None, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``_k``, ``block``, ``win``, ``start`` (of the window, where the anchor's lists agree; ``near`` false) and, with ``slop``, the first anchor term's place where its others are near."""
    schema = "_k long, block int, win long, start int, near boolean"
    own = staged(anchors(docs, windows, text), "anchors")
    if own.isEmpty():
        return docs.sparkSession.createDataFrame([], schema)
    reach = size + (slop or 0)
    lists = own.select("anchor", "lists").dropDuplicates(["anchor"])
    terms = lists.select("anchor", F.size("lists").alias("need"), F.inline("lists"))
    index = staged(postings(docs, _terms(terms.select("term").distinct()), text, doc_id), "postings")
    own_block = F.floor(F.col("pos") / BLOCK).cast("int")
    # A place near a block's border stands in the block beside it too.
    blocks = F.array_distinct(F.array(own_block, F.greatest(F.floor((F.col("pos") - reach) / BLOCK).cast("int"), F.lit(0)), F.floor((F.col("pos") + reach) / BLOCK).cast("int")))
    index = index.select("term", "_k", "pos", F.explode(F.when((F.col("pos") % BLOCK < reach) | (F.col("pos") % BLOCK >= BLOCK - reach), blocks).otherwise(F.array(own_block))).alias("block"))
    met = index.join(F.broadcast(terms), "term").groupBy("anchor", "_k", "block")
    place = F.col("pos").cast("long") * 8 + F.col("place")
    met = met.agg(F.collect_list(place).alias("places"), F.bit_or(F.call_function("shiftleft", F.lit(1), F.col("place"))).alias("met"), F.first("need").alias("need"))
    met = met.where(F.col("met") == F.call_function("shiftleft", F.lit(1), F.col("need").cast("int")) - 1).join(F.broadcast(lists), "anchor")

    def agree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [], [], [], []
            for a, k, b, places, steps in zip(*(batch.column(x).to_pylist() for x in ("anchor", "_k", "block", "places", "steps")), strict=True):
                exact, near = _meet(np.array(places, np.int64), steps, b * BLOCK, (b + 1) * BLOCK, reach)
                for found, flag in ((exact, False), (near, True))[: 1 if slop is None else 2]:
                    out[0].extend([a] * len(found))
                    out[1].extend([k] * len(found))
                    out[2].extend(found.tolist())
                    out[3].extend([flag] * len(found))
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, (pa.int64(), pa.int64(), pa.int32(), pa.bool_()), strict=True)], names=["anchor", "_k", "at", "near"])

    found = met.select("anchor", "_k", "block", "places", F.col("lists.step").alias("steps")).mapInArrow(agree, "anchor long, _k long, at int, near boolean")
    start = F.when(F.col("near"), F.col("at")).otherwise(F.col("at") - F.col("first"))
    found = found.join(F.broadcast(own.select("win", "anchor", "first")), "anchor").select("_k", "win", start.alias("start"), "near").where("start >= 0")
    return found.select("_k", F.floor(F.col("start") / BLOCK).cast("int").alias("block"), "win", "start", "near")


def _word_blocks(docs: DataFrame, keys: DataFrame, reach: int, text: str, doc_id: str) -> DataFrame:
    """``_k``, ``block``, ``words`` (a space between) of the documents in ``keys``: the block's own words and ``reach`` more on either side."""
    shared = docs.sparkSession.sparkContext.broadcast(bit_table(keys, "_k"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            key = whole.column("_k").to_numpy().view(np.uint64)
            for batch in slices(whole.filter(pa.array(passes(key, shared.value))), "text"):
                words = split_words(batch.column("text"), ALNUM)
                data, key = words.data.tobytes(), batch.column("_k").to_pylist()
                spans = list(zip(words.start.tolist(), words.end.tolist(), strict=True))
                rows = [], [], []
                for d in range(words.n_docs):
                    a, b = int(words.bounds[d]), int(words.bounds[d + 1])
                    for i, low in enumerate(range(a, b, BLOCK)):
                        rows[0].append(key[d])
                        rows[1].append(i)
                        rows[2].append(b" ".join([data[x:y] for x, y in spans[max(a, low - reach) : min(b, low + BLOCK + reach)]]))
                yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.int32()), pa.array(rows[2], pa.binary()).cast(pa.string())], names=["_k", "block", "words"])

    own = docs.select(row_key(doc_id, text).alias("_k"), F.col(text).alias("text"))
    return own.mapInArrow(cut, "_k long, block int, words string").join(keys, "_k", "left_semi")


def _near(words: list[bytes], at: int, phrase: list[bytes], most: int) -> bool:
    """Whether ``most`` consecutive words about place ``at`` hold all words of the phrase, each as often as it does."""
    need, have, missing = Counter(phrase), Counter(), len(phrase)
    own = words[max(0, at - most + 1) : at + most]
    for i, w in enumerate(own):
        have[w] += 1
        missing -= have[w] <= need[w]
        if i >= most:
            out = own[i - most]
            missing += have[out] <= need[out]
            have[out] -= 1
        if not missing:
            return True
    return False


def confirmed(docs: DataFrame, found: DataFrame, windows: DataFrame, size: int, slop: int | None = None, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``_k``, ``ranges`` (of words inside a phrase, merged), ``wins`` and ``near_wins``: candidates held against the words of their block, byte for byte."""
    found = staged(found.join(windows.select("win", "phrase"), "win"), "candidates")
    asked = found.groupBy("_k", "block").agg(F.collect_set(F.struct("start", "win", "phrase", "near")).alias("asked"))
    reach = size + (slop or 0)
    # A written table between the two maps: in one stage they would take two Python workers for each task.
    blocks = staged(_word_blocks(docs, staged(found.select("_k").distinct(), "asked"), reach, text, doc_id), "blocks")
    both = blocks.join(asked, ["_k", "block"])

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [], [], []
            for block, words, asked in zip(*(batch.column(x) for x in ("block", "words", "asked")), strict=True):
                own, low = words.as_py().encode().split(b" "), max(0, block.as_py() * BLOCK - reach)
                mark, wins, near = np.zeros(len(own) + 2, np.int8), set(), set()
                for x in asked.as_py():
                    at, phrase = x["start"] - low, x["phrase"].encode().split(b" ")
                    if not x["near"]:
                        if own[at : at + len(phrase)] == phrase:
                            mark[at + 1 : at + 1 + len(phrase)] = 1
                            wins.add(x["win"])
                    elif x["win"] not in near and _near(own, at, phrase, len(phrase) + slop):
                        near.add(x["win"])
                out[0].append((np.flatnonzero(np.diff(mark)) + low).reshape(-1, 2).tolist())
                out[1].append(sorted(wins))
                out[2].append(sorted(near))
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("_k"), pa.array(out[0], pa.list_(longs)), pa.array(out[1], longs), pa.array(out[2], longs)], names=["_k", "ranges", "wins", "near_wins"])

    return both.mapInArrow(confirm, "_k long, ranges array<array<long>>, wins array<long>, near_wins array<long>").where("size(wins) + size(near_wins) > 0")


def decontaminate(docs: DataFrame, benchmark: DataFrame, size: int = 10, slop: int | None = None, text: str = "text", doc_id: str = "doc_id", item_text: str = "text", item_id: str = "item_id") -> DataFrame:
    """Per row of ``docs``: ``row`` (the input's columns), ``n_words``, ``n_hit`` (words inside any occurrence of a window), ``items`` (sorted ids), ``spans``,
    and ``near_items``: with ``slop``, items with a window whose words all stand, in any order, among as many consecutive words and ``slop`` more.

    The benchmark is a query set, searched in blocks of bounded size against the index of all documents. Null and empty texts have no words;
    very long ones are searched block by block. Repeated rows each get the result of their text; repeated items all count, and of items with equal windows all are named."""
    with Scratch() as scratch:
        windows = staged(windows_of(benchmark, size, item_text, item_id), "windows")
        total = windows.agg(F.sum(F.size("terms"))).first()[0] or 0
        blocks = 1 + int(total) // TERMS_PER_BLOCK
        found = None
        for i in range(blocks):
            own = windows.where(F.pmod("win", F.lit(blocks)) == i)
            part = confirmed(docs, candidates(docs, own, size, slop, text, doc_id), own, size, slop, text, doc_id)
            found = part if found is None else found.unionByName(part)
        found = staged(found, "confirmed")
        scratch.keep(windows, found)

    def named(wins: str, to: str) -> DataFrame:
        pairs = found.select("_k", F.explode(wins).alias("win")).distinct().join(windows.select("win", "items"), "win")
        return pairs.select("_k", F.explode("items").alias("item")).groupBy("_k").agg(F.sort_array(F.collect_set("item")).alias(to))

    hits = found.where("size(ranges) > 0").groupBy("_k").agg(F.sort_array(F.array_distinct(F.flatten(F.collect_list("ranges")))).alias("ranges"))
    hits = hits.join(named("wins", "items"), "_k", "full").join(named("near_wins", "near_items"), "_k", "full")
    own = docs.select(F.struct("*").alias("row")).withColumn("_k", row_key(f"row.{doc_id}", f"row.{text}"))
    own = own.join(staged(hits, "hits"), "_k", "left").select("row", "ranges", "items", "near_items")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, text, inside="row"):
                counts = split_words(batch.column("row").field(text), ALNUM).counts
                spans = []
                for ranges in batch.column("ranges"):
                    merged: list[list[int]] = []
                    for a, b in ranges.as_py() or ():
                        if merged and a <= merged[-1][1]:
                            merged[-1][1] = max(b, merged[-1][1])
                        else:
                            merged.append([a, b])
                    spans.append(merged)
                n_hit = [sum(b - a for a, b in x) for x in spans]
                lists = [pa.array([x or [] for x in batch.column(k).to_pylist()], pa.list_(pa.string())) for k in ("items", "near_items")]
                yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(counts.astype(np.int64)), pa.array(n_hit, pa.int64()), lists[0], pa.array(spans, pa.list_(pa.list_(pa.int32()))), lists[1]], names=["row", "n_words", "n_hit", "items", "spans", "near_items"])

    schema = StructType().add("row", own.schema["row"].dataType).add("n_words", LongType()).add("n_hit", LongType())
    return own.mapInArrow(measure, schema.add("items", ArrayType(StringType())).add("spans", ArrayType(ArrayType(IntegerType()))).add("near_items", ArrayType(StringType())))
