"""Language-model scoring with a probabilistic suffix tree over words.

Contexts are the words before a token, the beginning of the text counted as one. The tree grows from the root: a context is
tested when it is frequent and both runs one word shorter, its suffix and its beginning, are in the tree; it enters if its
next-word distribution diverges from its suffix's by more than chance gives. So every suffix of a context is in the tree.
Distributions are smoothed with the shorter context's, down to add-one unigrams; a token is scored in the longest context
of the tree before it.

Levels are counted one after the other: a run of words is the context of one level and a context with its next word
of the level before, so that each level's counts say which contexts the next one has. It goes on while contexts pass
the test; there is no limit of length. The tree is a table and scores add up: what a context takes from all words (``rest``)
and what a word in its list differs from that are values of keys, so a text's score is one sum over a join.
"""

from __future__ import annotations

from collections.abc import Generator, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Scratch, bit_tables, dropped, passes, staged
from .words import mix, slices, split_words

#: Occurrences from which a context is tested, and from which a word stands in a context's list, at every size.
CONTEXT_LEAST, PAIR_LEAST = 50, 3
#: Every task holds the keys of this share of the training tokens: at most its inverse (2 million) words, and as many contexts and pairs of each of the first levels. The join has the others.
HELD_SHARE, HELD_LEVELS = 5e-7, 3
#: Rows that a task adds up before it passes them on, and texts.
ROWS_HELD, TEXTS_HELD = 1_500_000, 1 << 16
#: Rows of the tree in a bucket of the join.
BUCKET_ROWS = 1 << 18
#: Bytes of symbols that are worked on at once.
SLICE = 4 << 20
BEGIN, END = np.uint64(0x5BE6A1F0C3D2E487), np.uint64(0xE4D1C7B2A3958677)
#: Tells a context's own key from that of the pair it is one level below.
_CONTEXT = np.uint64(0x3C79AC492BA7B653)


def hashed(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``learn`` and ``symbols``: the hashes of a text's words and END, eight bytes each. Texts are split once; all else reads these."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                words = split_words(batch.column("text"))
                at = words.bounds[1:] + np.arange(words.n_docs)
                symbols = np.insert(words.hashes(), words.bounds[1:], END)
                offsets = np.concatenate(([0], 8 * (at + 1))).astype(np.int32)
                column = pa.Array.from_buffers(pa.binary(), words.n_docs, [None, pa.py_buffer(offsets), pa.py_buffer(symbols)])
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("learn"), column], names=["doc_id", "learn", "symbols"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "learn", "text").mapInArrow(make, f"doc_id {kind}, learn boolean, symbols binary")


def _tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of all rows; the row of each, and how many stand before it in its row; symbols of each row."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1 + column.offset)[column.offset :]
    symbols = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].view(np.uint64)
    bounds = (offsets - offsets[0]) >> 3
    n = np.diff(bounds)
    return symbols, np.repeat(np.arange(len(n)), n), np.arange(len(symbols)) - np.repeat(bounds[:-1], n), n


def _pair(context: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    return mix(mix(context) + symbol)


def _levels(symbols: np.ndarray, place: np.ndarray, depth: int) -> Generator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray], np.ndarray | None, None]:
    """For each level: places of symbols with so many before them (the beginning is one); their contexts, the keys of context and symbol, and the keys one level below.

    The caller sends back which of them go on. A context's suffix and its beginning are in the tree if it is, so a place
    is only on the next level if it and the one before it went on."""
    key, live = symbols, np.ones(len(symbols), bool)
    for level in range(1, depth + 1):
        if level == 1:
            at = np.arange(len(symbols))
            context = np.concatenate((np.array([BEGIN]), key[:-1]))[: len(key)]
            context[place == 0] = BEGIN
        else:
            at = np.flatnonzero(live[1:] & live[:-1] & (place[1:] >= level - 1)) + 1
            context = key[at - 1]
        below, own = key[at], _pair(context, symbols[at])
        on = yield level, at, context, own, below
        key, live = np.empty_like(symbols), np.zeros(len(symbols), bool)
        key[at] = own
        live[at if on is None else at[on]] = True


def _signed(x: np.uint64) -> int:
    return int(np.array([x]).view(np.int64)[0])


def _find(values: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each value in a sorted table, and whether it is there."""
    if not len(table):
        return np.zeros(len(values), np.int64), np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(table, values), len(table) - 1)
    return at, table[at] == values


def _starts(table: np.ndarray) -> np.ndarray:
    """Where the keys of each run of leading bits begin in a sorted table; a run has one or two keys of evenly spread ones."""
    bits = max(1, len(table).bit_length() - 1)
    return np.concatenate(([0], np.cumsum(np.bincount((table >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)))).astype(np.int32)


def _find_by(values: np.ndarray, table: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As ``_find``, for many values in no order: each begins where its leading bits do, and what some steps don't settle is searched for."""
    if not len(table):
        return np.zeros(len(values), np.int64), np.zeros(len(values), bool)
    last = len(table) - 1
    at = np.minimum(starts[(values >> np.uint64(64 - (len(starts).bit_length() - 1))).astype(np.int64)], last).astype(np.int64)
    key = table[at]
    found, on = key == values, np.flatnonzero((key < values) & (at < last))
    for _ in range(8):
        if not len(on):
            break
        at[on] += 1
        key, wanted = table[at[on]], values[on]
        found[on] = key == wanted
        on = on[(key < wanted) & (at[on] < last)]
    if len(on):
        at[on], found[on] = _find(values[on], table)
    return at, found


def _pieces(columns: list[np.ndarray], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Columns as batches of 2^17 rows, so that no large buffer crosses to the JVM."""
    for at in range(0, len(columns[0]), 1 << 17):
        yield pa.RecordBatch.from_arrays([pa.array(c[at : at + (1 << 17)]) for c in columns], names=names)


def vocabulary(tokens: DataFrame) -> DataFrame:
    """``h``, ``n``: the hash of every distinct word of the texts to learn from and its count; each task adds up its own first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, held = [], 0
        for whole in batches:
            for batch in slices(whole, "symbols", SLICE):
                symbols = _tokens(batch.column("symbols"))[0]
                h, n = np.unique(symbols[symbols != END], return_counts=True)
                known.append((h, n))
                held += len(h)
                if held > ROWS_HELD:
                    yield from _summed(known)
                    known, held = [], 0
        if known:
            yield from _summed(known)

    def _summed(known):
        h, place = np.unique(np.concatenate([h for h, _ in known]), return_inverse=True)
        n = np.bincount(place, weights=np.concatenate([n for _, n in known]), minlength=len(h))
        return _pieces([h.view(np.int64), n.astype(np.int64)], ["h", "n"])

    return tokens.where("learn").select("symbols").mapInArrow(count, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))


def next_counts(tokens: DataFrame, level: int, shared: Broadcast) -> DataFrame:
    """``context``, ``symbol``, ``n``: how often each word follows each context of one level. ``shared``: filters of contexts by level, and one of pairs.

    Rows that the filter of the level's contexts, those of the first levels or the one of the pairs one level below do not let through are not
    made: a pair is not more frequent than the one a word shorter. What they let through too much is for joins to drop."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        contexts, shorter = shared.value
        held, rows = [], 0

        def summed():
            context, symbol = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            key = _pair(context, symbol)
            by = np.argsort(key)  # in any order among equals, which np.unique has to keep
            key = key[by]
            at = np.flatnonzero(np.concatenate((np.ones(min(len(key), 1), bool), key[1:] != key[:-1])))
            return _pieces([context[by[at]].view(np.int64), symbol[by[at]].view(np.int64), np.diff(np.append(at, len(key)))], ["context", "symbol", "n"])

        for whole in batches:
            for batch in slices(whole, "symbols", SLICE):
                symbols, _, place, _ = _tokens(batch.column("symbols"))
                levels, on = _levels(symbols, place, level), None
                for d in range(1, level + 1):
                    _, at, context, _, below = levels.send(on)
                    on = passes(context, contexts[d]) if d in contexts else None
                use = np.flatnonzero(on)
                use = use[passes(below[use], shorter)]
                held.append((context[use], symbols[at[use]]))
                rows += len(use)
                if rows > ROWS_HELD:
                    yield from summed()
                    rows = 0
        if held:
            yield from summed()

    return tokens.where("learn").select("symbols").mapInArrow(count, "context long, symbol long, n long").groupBy("context", "symbol").agg(F.sum("n").alias("n"))


def _keyed(rows: DataFrame, level: int) -> DataFrame:
    """``key`` of each context and symbol, and ``below``, the key of the pair with the context's suffix (``short``), beside ``context``, ``n`` and ``whole``."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            context, symbol, short = (batch.column(k).to_numpy(zero_copy_only=False).view(np.uint64) for k in ("context", "symbol", "short"))
            below = symbol if level == 1 else _pair(short, symbol)
            keys = [pa.array(k.view(np.int64)) for k in (_pair(context, symbol), below)]
            yield pa.RecordBatch.from_arrays([*keys, batch.column("context"), batch.column("n"), batch.column("whole")], names=["key", "below", "context", "n", "whole"])

    return rows.select("context", "symbol", "short", "n", "whole").mapInArrow(make, "key long, below long, context long, n long, whole long")


@dataclass
class SuffixTree:
    """``grown`` for a level that fits in memory; tests hold the tables against it."""

    words: np.ndarray
    counts: np.ndarray
    floor: float  # log10 of the tokens, kinds and one more
    ends: int
    contexts: list[np.ndarray] = field(default_factory=list)
    rest: list[np.ndarray] = field(default_factory=list)  # log10 factor of the shorter context for words not in the list
    pairs: list[np.ndarray] = field(default_factory=list)
    scores: list[np.ndarray] = field(default_factory=list)

    def unigram(self, symbols: np.ndarray) -> np.ndarray:
        """log10 probability by add-one counts of words that every task knows; NaN for others."""
        at, known = _find(symbols, self.words)
        out = np.full(len(symbols), np.nan)
        out[known] = np.log10(self.counts[at[known]] + 1.0) - self.floor
        return out

    def grow(self, context: np.ndarray, symbol: np.ndarray, n: np.ndarray, total: np.ndarray, below: np.ndarray) -> None:
        """Test and add contexts of the next depth. ``total``: the context's count; ``below``: the word's probability one word shorter."""
        names, place = np.unique(context, return_inverse=True)
        size = len(names)
        whole = np.zeros(size)
        whole[place] = total
        kinds = np.bincount(place, minlength=size).astype(float)
        listed, shorter = np.bincount(place, weights=n, minlength=size), np.bincount(place, weights=below, minlength=size)
        other, other_below = np.maximum(whole - listed, 0), np.maximum(1 - shorter, 1e-9)
        gain = np.bincount(place, weights=n * np.log(n / whole[place] / below), minlength=size) + np.where(other > 0, other * np.log(np.maximum(other, 1e-9) / whole / other_below), 0)
        keep = 2 * gain > kinds + 3 * np.sqrt(2 * kinds)
        p = (n + kinds[place] * below) / (whole + kinds)[place]
        left = np.maximum(1 - np.bincount(place, weights=p, minlength=size), 1e-9)
        own = keep[place]
        code = _pair(context[own], symbol[own])
        by = np.argsort(code)
        self.contexts.append(names[keep])
        self.rest.append(np.log10(left / other_below)[keep])
        self.pairs.append(code[by])
        self.scores.append(np.log10(p[own])[by])


def grown(counts: DataFrame) -> DataFrame:
    """Test the contexts of a level. ``counts``: ``key``, ``below``, ``context``, ``n``, ``whole`` (the context's count) and ``blp`` (log10 probability one word shorter).

    Returns the pairs of the contexts that enter, with ``rest``, the context's factor for all words, ``lp``, the pair's log10 probability, and ``value``,
    what that differs from the shorter context's and ``rest``."""
    below, n, whole = F.pow(F.lit(10.0), "blp"), F.col("n"), F.col("whole")
    sums = counts.groupBy("context").agg(F.max("whole").alias("whole"), F.count("*").alias("kinds"), F.sum("n").alias("listed"), F.sum(below).alias("shorter"), F.sum(n * F.log(n / whole / below)).alias("gain"))
    other, kinds = F.greatest(whole - F.col("listed"), F.lit(0)), F.col("kinds")
    other_below = F.greatest(1 - F.col("shorter"), F.lit(1e-9))
    gain = F.col("gain") + F.when(other > 0, other * F.log(other / whole / other_below)).otherwise(0.0)
    left = F.greatest(1 - (F.col("listed") + kinds * F.col("shorter")) / (whole + kinds), F.lit(1e-9))
    kept = sums.where(2 * gain > kinds + 3 * F.sqrt(2 * kinds)).select("context", "kinds", F.log10(left / other_below).alias("rest"))
    lp = F.log10((n + kinds * below) / (whole + kinds))
    both = counts.join(kept, "context")
    return both.select("key", "below", "context", "n", "whole", "rest", lp.alias("lp"), (lp - F.col("blp") - F.col("rest")).alias("value"))


def learn_tree(tokens: DataFrame, vocab: DataFrame, ends: int, floor: float, context_least: int = CONTEXT_LEAST, pair_least: int = PAIR_LEAST) -> tuple[DataFrame, int]:
    """``key``, ``value``, ``n``, ``level`` (0: words) and ``listed`` (or a context), and the number of levels; counts cover all rows to learn from."""
    spark = tokens.sparkSession
    row = lambda h: spark.createDataFrame([(_signed(h), ends)] if ends else [], "key long, n long")
    words = vocab.select(F.col("h").alias("key"), "n").unionByName(row(END))
    tree = words.select("key", F.log10(F.col("n") + 1.0).alias("value"), "n", F.lit(0).alias("level"), F.lit(True).alias("listed"))
    contexts = vocab.select(F.col("h").alias("key"), "n").unionByName(row(BEGIN)).where(F.col("n") >= context_least).select("key", "n", F.lit(0).cast("long").alias("short"))
    pairs = words.where(F.col("n") >= pair_least).select("key", "n", (F.log10(F.col("n") + 1.0) - floor).alias("lp"))
    level, first = 0, {}
    while not contexts.isEmpty():
        own, shorter = bit_tables(contexts.select("key"), pairs.select("key"))
        shared = spark.sparkContext.broadcast(({**first, level + 1: own}, shorter))
        if level < HELD_LEVELS:
            first[level + 1] = own
        rows = next_counts(tokens, level + 1, shared).where(F.col("n") >= pair_least)
        rows = rows.join(contexts.select(F.col("key").alias("context"), F.col("n").alias("whole"), "short"), "context")
        known = staged(_keyed(rows, level + 1).join(pairs.select(F.col("key").alias("below"), F.col("lp").alias("blp")), "below"), "known", tidy=True)
        shared.destroy()
        pairs = staged(grown(known), "pairs", tidy=True)
        dropped(known)
        if pairs.isEmpty():
            break
        level += 1
        own = pairs.groupBy("context").agg(F.first("rest").alias("value"), F.first("whole").alias("n"))
        own = own.select(F.col("context").bitwiseXOR(F.lit(_signed(_CONTEXT))).alias("key"), "value", "n", F.lit(level).alias("level"), F.lit(False).alias("listed"))
        tree = tree.unionByName(own).unionByName(pairs.select("key", "value", "n", F.lit(level).alias("level"), F.lit(True).alias("listed")))
        contexts = pairs.where(F.col("n") >= context_least).select("key", "n", F.col("below").alias("short"))
    return tree, level


def score_texts(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", learn: str = "learn", context_least: int = CONTEXT_LEAST, pair_least: int = PAIR_LEAST, held_share: float = HELD_SHARE) -> DataFrame:
    """Score every whole text; the model and the counts come from the rows where ``learn`` is true.

    Returns ``doc_id``, ``learn``, ``n_tokens`` (words and the end), ``n_known``, ``train_tokens``, ``base_score`` (add-one unigrams) and
    ``score`` (log10 probability under the tree). Null texts count as empty: the end alone. Repeated rows are each
    returned and each counted; very long texts are read whole, a run of their own each. Without rows to learn from, all tokens are unknown.
    Keys of little share are looked up in the whole tree by a join on buckets of keys. With ``pair_least`` = 1 no count is left out of any list."""
    spark = docs.sparkSession
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.coalesce(F.col(learn), F.lit(False)).alias("learn"))
    with Scratch() as scratch:
        tokens = staged(hashed(own), "tokens", tidy=True)
        vocab = staged(vocabulary(tokens), "vocabulary", tidy=True)
        ends = tokens.where("learn").count()
        words, kinds = vocab.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
        total = words + ends
        floor = float(np.log10(total + kinds + (ends > 0) + 1))
        tree, depth = learn_tree(tokens, vocab, ends, floor, context_least=context_least, pair_least=pair_least)
        tree = staged(tree, "tree", tidy=True)
        scratch.keep(tree, tokens)
    often = (F.col("n") >= held_share * total) & (F.col("level") <= HELD_LEVELS)
    rare = tree.where(~often)
    top = tree.where(often).select("key", "value", "level", "listed").toArrow()
    key, value, kind = top.column("key").to_numpy().view(np.uint64), top.column("value").to_numpy(), 2 * top.column("level").to_numpy() + top.column("listed").to_numpy()
    by, held = np.lexsort((key, kind)), {}
    for k in np.unique(kind).tolist():
        these = by[kind[by] == k]
        held[k // 2, bool(k % 2)] = key[these], value[these]
    del top, key, value, by
    # Contexts are few: with a table of their own, hardly any position is taken for one that is not there.
    shared = spark.sparkContext.broadcast((held, bit_tables(rare.where("not listed").select("key"), rare.where("listed").select("key"), bits=26)))
    bits = max(3, int(np.ceil(np.log2(max(rare.count(), 1) / BUCKET_ROWS))))
    parts = _own_parts(tokens, shared, depth, floor, bits)
    rare = rare.select(F.shiftrightunsigned("key", 64 - bits).cast("int").alias("bucket"), "key", "value", (F.col("level") == 0).alias("word"))
    return _looked_up(parts, rare).select("doc_id", "learn", "n_tokens", F.col("known").alias("n_known"), F.lit(int(total)).cast("long").alias("train_tokens"), F.col("base").alias("base_score"), "score")


def _planes(x: np.ndarray) -> bytes:
    """Numbers as bytes, the first byte of all before the second of all, so that leading zeros of small ones compress."""
    return np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.itemsize).T.tobytes()


def _numbers(data: bytes, kind: str) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def _own_parts(tokens: DataFrame, shared: Broadcast, depth: int, floor: float, bits: int) -> DataFrame:
    """What tasks can tell of texts by the keys they hold, and what they have to ask for.

    Texts go in runs (``chunk``), numbered by ``row`` in each. A text has a row with its sums so far. For each bucket of keys a run has one row: the distinct
    ``keys`` it asks for, sorted and as differences, how ``many`` places ask for each, and the ``rows`` of these, so a key is sent once for a run and not for each text."""
    kind = tokens.schema["doc_id"].dataType.simpleString()
    none_held = (np.zeros(0, np.uint64), np.zeros(0), np.zeros(3, np.int32))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rare = shared.value
        held = {name: (table, values, _starts(table)) for name, (table, values) in held.items()}
        chunk, texts, asked, n_asked = TaskContext.get().partitionId() << 32, 0, [], 0

        def questions() -> pa.RecordBatch:
            row, key = (np.concatenate(k) for k in zip(*asked, strict=True))
            by = np.argsort(key)
            row, key = row[by].astype(np.uint32), key[by]
            first = np.flatnonzero(np.concatenate((np.ones(min(len(key), 1), bool), key[1:] != key[:-1])))
            key, many = key[first], np.diff(np.append(first, len(row))).astype(np.uint32)
            cuts = np.searchsorted(key, np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)).tolist() + [len(key)]
            ends = np.append(first, len(row)).tolist()
            out = [(b, _planes(np.diff(key[i:j], prepend=np.uint64(0))), _planes(many[i:j]), _planes(row[ends[i] : ends[j]])) for b, (i, j) in enumerate(zip(cuts, cuts[1:], strict=False)) if i < j]
            m = len(out)
            columns = [pa.array([b for b, *_ in out], pa.int32()), pa.array([chunk] * m, pa.int64()), pa.array([texts] * m, pa.int64())]
            columns += [pa.nulls(m, t) for t in (doc_type, pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64())]
            return pa.RecordBatch.from_arrays([*columns, *[pa.array([o[k] for o in out], pa.binary()) for k in (1, 2, 3)]], names=names)

        names = ["bucket", "chunk", "row", "doc_id", "learn", "n_tokens", "known", "base", "score", "keys", "many", "rows"]
        for whole in batches:
            for batch in slices(whole, "symbols", SLICE):
                symbols, doc, place, sizes = _tokens(batch.column("symbols"))
                n, doc_type = len(sizes), batch.column("doc_id").type

                def add(to, at, keys, name):
                    """Add the values of the keys held; note those to be asked for. True for either."""
                    nonlocal n_asked
                    table, values, starts = held.get(name, none_held)
                    i, found = _find_by(keys, table, starts)
                    own, rest = np.flatnonzero(found), np.flatnonzero(~found)
                    to[at[own]] += values[i[own]]
                    rest = rest[passes(keys[rest], rare[int(name[1])])]
                    asked.append((texts + doc[at[rest]], keys[rest]))
                    n_asked += len(rest)
                    some = found.copy()
                    some[rest] = True
                    return found, some

                base, extra = np.full(len(symbols), -floor), np.zeros(len(symbols))
                known, _ = add(base, np.arange(len(symbols)), symbols, (0, True))
                levels, on = _levels(symbols, place, depth), None
                for level in range(1, depth + 1):
                    _, at, context, key, _ = levels.send(on)
                    _, on = add(extra, at, context ^ _CONTEXT, (level, False))  # only what follows a shorter context can follow a longer one
                    add(extra, at[on], key[on], (level, True))
                base, extra = np.bincount(doc, weights=base, minlength=n), np.bincount(doc, weights=extra, minlength=n)
                sums = [sizes, np.bincount(doc[known], minlength=n), base, base + extra]
                home = pa.array(np.full(n, chunk % (1 << bits)), pa.int32())
                yield pa.RecordBatch.from_arrays([home, pa.array(np.full(n, chunk)), pa.array(texts + np.arange(n)), batch.column("doc_id"), batch.column("learn"), *map(pa.array, sums), *[pa.nulls(n, pa.binary())] * 3], names=names)
                texts += n
                if n_asked > ROWS_HELD or texts > TEXTS_HELD:
                    yield questions()
                    chunk, texts, asked, n_asked = chunk + 1, 0, [], 0
        if texts:
            yield questions()

    return tokens.mapInArrow(read, f"bucket int, chunk long, row long, doc_id {kind}, learn boolean, n_tokens long, known long, base double, score double, keys binary, many binary, rows binary")


def _looked_up(parts: DataFrame, rare: DataFrame) -> DataFrame:
    """Sums of each text: its own and what the tree has for the keys its run asked for. A bucket has some ``BUCKET_ROWS`` keys of the tree and what is asked of them; no key is asked twice by a run."""
    kind = parts.schema["doc_id"].dataType.simpleString()
    names = ["chunk", "row", "doc_id", "learn", "n_tokens", "known", "base", "score", "more_known", "more_base", "more_score"]

    def answers(asked: pa.Table, tree: pa.Table) -> pa.Table:
        by = np.argsort(key := tree.column("key").to_numpy().view(np.uint64))
        key, value, word = key[by], tree.column("value").to_numpy()[by], tree.column("word").to_numpy()[by]
        whole = asked.filter(pc.is_null(asked.column("keys")))
        whole = whole.select(names[:8])
        for k in names[8:]:
            whole = whole.append_column(k, pa.nulls(len(whole), pa.binary()))
        own, out = asked.filter(pc.is_valid(asked.column("keys"))), []
        for chunk, texts, keys, many, rows in zip(*(own.column(k).to_pylist() for k in ("chunk", "row", "keys", "many", "rows")), strict=True):
            at, found = _find(np.cumsum(_numbers(keys, "u8"), dtype=np.uint64), key)
            many = _numbers(many, "u4")
            row, at = _numbers(rows, "u4")[np.repeat(found, many)], np.repeat(at[found], many[found])
            if len(row):
                sums = [np.bincount(row[word[at]], minlength=texts).astype(np.uint32), np.bincount(row, weights=value[at] * word[at], minlength=texts), np.bincount(row, weights=value[at], minlength=texts)]
                out.append((chunk, *map(_planes, sums)))
        m = len(out)
        columns = [pa.array([o[0] for o in out], pa.int64()), *[pa.nulls(m, whole.schema.field(k).type) for k in names[1:8]], *[pa.array([o[k] for o in out], pa.binary()) for k in (1, 2, 3)]]
        return pa.concat_tables([whole, pa.Table.from_arrays(columns, schema=whole.schema)])

    def summed(rows: pa.Table) -> pa.Table:
        whole = rows.filter(pc.is_valid(rows.column("row"))).sort_by("row")
        more = rows.filter(pc.is_null(rows.column("row")))
        out = [whole.column(k) for k in ("doc_id", "learn", "n_tokens")]
        for k, form in (("known", "u4"), ("base", "f8"), ("score", "f8")):
            own = whole.column(k).to_numpy().copy()
            for x in more.column(f"more_{k}"):
                own += _numbers(x.as_py(), form).astype(own.dtype)
            out.append(pa.chunked_array([own]))
        return pa.Table.from_arrays(out, names=["doc_id", "learn", "n_tokens", "known", "base", "score"])

    fields = f"doc_id {kind}, learn boolean, n_tokens long, known long, base double, score double"
    both = parts.groupBy("bucket").cogroup(rare.groupBy("bucket")).applyInArrow(answers, f"chunk long, row long, {fields}, more_known binary, more_base binary, more_score binary")
    return both.groupBy("chunk").applyInArrow(summed, fields)
