"""N-gram Jaccard join, split by size: fixed-size subsets for small sets, inverted lists for large ones.

Sets are the distinct five-word shingles of whole texts, as 64-bit hashes. Sets that are equal form a
class and only classes are joined. One global order ranks shingles by how often their hash bucket occurs
in the corpus, rarest first, so that passages which many documents share stand last. The buckets grow with the corpus up to a
table of fixed size: where many shingles share one, those that stand in ten or fifty documents are not told from unique ones, and
their lists put documents that have little in common into large bundles.

With overlap at least ``alpha`` needed, two sets share ``k`` of the first ``n - alpha + k`` shingles of each. Small
sets are found by the pairs (k = 2) among those, large sets by single shingles (k = 1); the boundary is
the size of least estimated cost. Lists of candidates that are short give all their pairs. Long ones
give each member's pair with a head, another one for each list. Lists whose members are then still in several components
are put together into bundles. The sets of a bundle are held against each other in blocks of bounded size, as bits over
the shingles of two blocks, and only what joins components leaves the task.

A pair is a candidate only where enough of both sets stands behind the place they share: at its first common
shingle, the rest of each set from there on holds the whole overlap. Candidates are then held against bitmaps
of four to eight bits for each shingle. A shingle whose bit the other set lacks is not shared, which bounds the overlap
from above and never drops a similar pair; whole sets are read for the rest only.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import Scratch, dropped, bit_table, passes, row_key, staged
from .words import mix, shingle_sets, slices, split_words, spread

#: Buckets of shingle counts, the least and the most of them, as bits.
BUCKET_BITS, MOST_BITS = 18, 24
#: Classes that a task remembers in order not to give them twice; what it gives twice is dropped later.
SEEN = 1 << 18
#: Shingles in a block of sets, for bundles of up to eight blocks and for larger ones; and sets in a block of bitmaps.
BLOCK, LARGE_BLOCK = 1 << 16, 1 << 22
FEW, MANY = 256, 1 << 12
#: Lists up to this length give all pairs of members.
SHORT_LIST = 8
#: Estimated list entries met for each posting of a single shingle, against one for each subset enumerated.
SCAN_COST = 4.0


def _least(n, percent: int):
    """The least overlap of a set of ``n`` with any partner."""
    return (percent * n + 99) // 100


def _sets(batch: pa.RecordBatch, width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for part in slices(batch, "text"):
        values, at = shingle_sets(split_words(part.column("text")), width)
        yield part, values, at


def _classes(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each set; 0 for empty ones."""
    n = np.diff(at)
    c, some = np.zeros(len(n), np.uint64), np.flatnonzero(n > 0)
    if len(some):
        c[some] = mix(np.add.reduceat(mix(values), at[:-1][some]) + n[some].astype(np.uint64))
    return c


def _bitmap(values: np.ndarray) -> bytes:
    """A bit for each hash value modulo the size, the power of two from four bits for each value on."""
    size = max(64, 1 << int(4 * len(values) - 1).bit_length()) if len(values) else 64
    marks = np.zeros(size, bool)
    marks[(values & np.uint64(size - 1)).astype(np.int64)] = True
    return np.packbits(marks, bitorder="little").tobytes()


def _most_shared(x: pa.Array, y: pa.Array, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Upper bounds of the overlaps of pairs of sets from their bitmaps; the wider one of two is folded to the other's size."""
    out = np.minimum(n, m)
    (a, p), (b, q) = ((np.frombuffer(z.buffers()[1], np.int32, len(z) + 1, 4 * z.offset), np.frombuffer(z.buffers()[2], np.uint8)) for z in (x, y))
    sizes = np.stack((np.diff(a), np.diff(b)), axis=1)
    for one, two in np.unique(sizes, axis=0).tolist():
        own = np.flatnonzero((sizes[:, 0] == one) & (sizes[:, 1] == two))
        step = max(1, (4 << 20) // max(one, two))
        for at in range(0, len(own), step):
            k = own[at : at + step]
            left, right = p[a[k][:, None] + np.arange(one)], q[b[k][:, None] + np.arange(two)]
            size = min(one, two)
            left, right = (np.bitwise_or.reduce(z.reshape(len(k), -1, size), axis=1).view(np.uint64) for z in (left, right))
            more = np.bitwise_count(left & ~right).sum(axis=1), np.bitwise_count(right & ~left).sum(axis=1)
            out[k] = np.minimum(n[k] - more[0].astype(np.int64), m[k] - more[1].astype(np.int64))
    return out


def _possible(pairs: DataFrame, maps: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a``, ``b`` whose bitmaps allow the similarity. ``maps``: ``c``, ``n``, ``bits``."""

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m = (np.asarray(batch.column(k)) for k in ("n", "m"))
            most = _most_shared(batch.column("xb"), batch.column("yb"), n, m)
            mask = pa.array(100 * most >= percent * (n + m - most))
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(mask), batch.column("b").filter(mask)], names=["a", "b"])

    left, right = maps.toDF("a", "n", "xb"), maps.toDF("b", "m", "yb")
    return pairs.join(left, "a").join(right, "b").select("a", "b", "n", "m", "xb", "yb").mapInArrow(test, "a long, b long")


def profiles(docs: DataFrame, width: int = 5, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``_k`` (key of the row), ``doc_id``, ``n`` (set size), ``c`` (class: 64-bit hash of the set; 0 if empty), ``bits`` (its bitmap) for every row."""

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for part, values, at in _sets(whole, width):
                n, c = np.diff(at), _classes(values, at)
                bits = [_bitmap(values[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("_k"), part.column("doc_id"), pa.array(n), pa.array(c.view(np.int64)), pa.array(bits, pa.binary())], names=["_k", "doc_id", "n", "c", "bits"])

    own = docs.select(row_key(doc_id, text).alias("_k"), F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return own.mapInArrow(profile, "_k long, doc_id long, n long, c long, bits binary")


def _bucket_bits(shingles: int) -> int:
    """So many buckets that some sixteen shingles share one, up to a table of 16 MB: the more do, the fewer repeated shingles stand out from the unique ones."""
    return min(MOST_BITS, max(BUCKET_BITS, (shingles >> 4).bit_length()))


def _levels(counts: np.ndarray) -> np.ndarray:
    """Counts as bytes: square roots, in steps of about the spread that chance gives a bucket, and logarithms from 4,096 on."""
    return np.where(counts < 4096, np.rint(2 * np.sqrt(counts)), np.minimum(255, 128 + np.rint(8 * np.log2(np.maximum(counts, 4096) / 4096)))).astype(np.uint8)


#: The count that a level stands for.
_COUNT = np.array([q * q / 4 if q <= 128 else 4096 * 2 ** ((q - 128) / 8) for q in range(256)]).astype(np.int64)


def _bucket_counts(docs: DataFrame, width: int, text: str, bits: int = BUCKET_BITS) -> np.ndarray:
    """How many shingles of the corpus fall in each of 2^``bits`` hash buckets, as levels; each task sums its own first and gives them by pieces of the table."""
    shift, piece = np.uint64(64 - bits), 1 << 10

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << bits, np.int32)
        for whole in batches:
            for _, values, _ in _sets(whole, width):
                np.add.at(total, (values >> shift).view(np.int64), np.int32(1))
        rows = total.reshape(-1, piece)
        for at in range(0, len(rows), 1 << 10):
            part = rows[at : at + (1 << 10)]
            most = part.max(axis=1)
            some = np.flatnonzero(most)
            if len(some):
                packed = [part[k].astype(np.uint8 if most[k] < 256 else np.int32).tobytes() for k in some.tolist()]
                yield pa.RecordBatch.from_arrays([pa.array(at + some), pa.array(packed, pa.binary())], names=["b", "n"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, total = -1, np.zeros(piece, np.int64)

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([_levels(total).tobytes()], pa.binary())], names=["b", "n"])

        for batch in batches:
            for b, n in zip(batch.column("b").to_pylist(), batch.column("n"), strict=True):
                if b != at:
                    if at >= 0:
                        yield out()
                    at, total = b, np.zeros(piece, np.int64)
                own = n.as_buffer()
                total += np.frombuffer(own, np.uint8 if own.size == piece else np.int32)
        if at >= 0:
            yield out()

    rows = docs.select(F.col(text).alias("text")).mapInArrow(count, "b long, n binary")
    rows = staged(rows.repartition("b").sortWithinPartitions("b").mapInArrow(merge, "b long, n binary"), "counts")
    got = rows.toArrow()
    dropped(rows)
    out = np.zeros(((1 << bits) // piece, piece), np.uint8)
    for b, n in zip(got.column("b").to_pylist(), got.column("n"), strict=True):
        out[b] = np.frombuffer(n.as_buffer(), np.uint8)
    return out.reshape(-1)


def size_boundary(sizes: dict[int, int], percent: int, scan_cost: float = SCAN_COST) -> int:
    """The set size up to which subsets are enumerated: least total of subsets below and list entries above."""
    if not sizes:
        return 0
    n = np.array(sorted(sizes))
    f = np.array([sizes[k] for k in n.tolist()], float)
    prefix = n - _least(n, percent) + 1
    subset, scan = f * (prefix + 1) * prefix / 2, f * prefix * (1 + scan_cost)
    below, above = np.concatenate(([0], np.cumsum(subset))), np.concatenate((np.cumsum(scan[::-1])[::-1], [0]))
    ends = np.concatenate(([0], n))
    single = np.concatenate(([0], np.cumsum(f * prefix)))
    band = single - single[np.searchsorted(n, np.ceil(percent * (ends + 1) / 100))]
    return int(ends[np.argmin(below + above + np.maximum(band, 0))])


def _signatures(docs: DataFrame, counts: np.ndarray, boundary: int, width: int, percent: int, text: str) -> DataFrame:
    """``sig``, ``salt``, ``c``, ``n``, ``rest`` (shingles from the place on) and ``single``: a row for every subset or prefix shingle of every class (copies in one task once).

    Where the bucket of a signature is so full that its list may be long, the list is dealt out by class over ``salt``."""
    shared = docs.sparkSession.sparkContext.broadcast(counts)
    room = int(max(512, 4 * sum(_COUNT @ np.bincount(part, minlength=256) for part in np.array_split(counts, 1 + (len(counts) >> 16))) / len(counts)))
    least_single = _least(boundary + 1, percent)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, seen = shared.value, set()
        shift = np.uint64(65 - len(table).bit_length())
        for whole in batches:
            for _, values, at in _sets(whole, width):
                sig, cls, size, single, full, rest = [], [], [], [], [], []
                for a, b, c in zip(at[:-1].tolist(), at[1:].tolist(), _classes(values, at).tolist(), strict=True):
                    n = b - a
                    if n < 3:
                        continue  # two of two or one of one: such sets are similar only if equal
                    s = values[a:b]
                    if c in seen:
                        continue
                    if len(seen) < SEEN:
                        seen.add(c)
                    often = table[(s >> shift).astype(np.int64)]
                    prefix = n - _least(n, percent) + 2
                    order = np.argsort(often, kind="stable")[:prefix]
                    s, often, rows = s[order], _COUNT[often[order]], 0
                    if n <= boundary:
                        i, j = np.triu_indices(len(s), 1)
                        sig.append(mix(mix(s[i]) + s[j]))
                        full.append(np.minimum(often[i], often[j]))
                        rest.append(n - j + 1)
                        single.append(np.zeros(len(i), bool))
                        rows += len(i)
                    if n >= least_single:
                        sig.append(s[: prefix - 1])
                        full.append(often[: prefix - 1])
                        rest.append(n - np.arange(len(sig[-1])))
                        single.append(np.ones(len(sig[-1]), bool))
                        rows += len(sig[-1])
                    cls.append(np.full(rows, c, np.uint64))
                    size.append(np.full(rows, n, np.int32))
                if sig:
                    cls, full = np.concatenate(cls), np.concatenate(full)
                    sig = np.concatenate(sig)
                    salt = np.where(full <= room, 0, 1 + (mix(cls ^ mix(sig)) % (full // room + 1).astype(np.uint64)).astype(np.int32)).astype(np.int32)
                    yield pa.RecordBatch.from_arrays([pa.array(sig.view(np.int64)), pa.array(salt), pa.array(cls.view(np.int64)), pa.array(np.concatenate(size)), pa.array(np.concatenate(rest).astype(np.int32)), pa.array(np.concatenate(single))], names=["sig", "salt", "c", "n", "rest", "single"])

    return docs.select(F.col(text).alias("text")).mapInArrow(sign, "sig long, salt int, c long, n int, rest int, single boolean")


def _scan_lists(rows: DataFrame, boundary: int, percent: int) -> DataFrame:
    """Run through sorted lists: pairs (``kind`` 0: a, b) and the members of long or salted lists (``kind`` 1: sig, b, n, rest).

    Rows stream by; only the run of one short list is held."""
    # ``single`` lists join small with large sets and large with each other; two small sets meet in the subsets.
    # Members stand in another random order in every list, so each is held against another head in each.
    own = rows.repartition("sig", "salt", "single").sortWithinPartitions("sig", "single", "salt", F.xxhash64("sig", "c"), "c")

    names = ["kind", "sig", "a", "b", "n", "rest"]

    def pairs(sig, c, n, rest, x, y):
        """Pairs that sizes and the rests behind the shared place allow."""
        need = -(-percent * (n[x] + n[y]) // (100 + percent))
        ok = (np.minimum(n[x], n[y]) * 100 >= percent * np.maximum(n[x], n[y])) & (need <= np.minimum(rest[x], rest[y])) & (c[x] != c[y])
        x, y = x[ok], y[ok]
        none = pa.nulls(len(x), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(np.zeros(len(x), np.int8)), pa.array(sig[x]), pa.array(np.minimum(c[x], c[y])), pa.array(np.maximum(c[x], c[y])), none, none], names=names)

    def emit(keys, c, n, rest, going_on: bool):
        """Whole runs. ``going_on``: the first is the rest of a long one."""
        start = np.flatnonzero(np.concatenate(([True], (keys[1:] != keys[:-1]).any(axis=1))))
        length = np.diff(np.append(start, len(keys)))
        long = (length > SHORT_LIST) | (keys[start, 1] > 0)
        long[0] |= going_on
        for k in range(2, SHORT_LIST + 1):
            at = start[(length == k) & ~long]
            for i, j in combinations(range(k), 2):
                x, y = at + i, at + j
                use = (keys[x, 2] == 0) | (np.maximum(n[x], n[y]) > boundary)
                if use.any():
                    yield pairs(keys[:, 0], c, n, rest, x[use], y[use])
        if long.any():
            member, head = spread(length[long], start[long]), np.repeat(start[long], length[long])
            yield pairs(keys[:, 0], c, n, rest, head, member)
            yield pa.RecordBatch.from_arrays([pa.array(np.ones(len(member), np.int8)), pa.array(keys[member, 0]), pa.array(c[head]), pa.array(c[member]), pa.array(n[member]), pa.array(rest[member])], names=names)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, going_on = np.zeros((0, 3), np.int64), False
        c, n, rest = (np.zeros(0, np.int64) for _ in range(3))
        for batch in batches:
            fields = [batch.column(x).to_numpy(zero_copy_only=False).astype(np.int64) for x in ("sig", "salt", "single", "c", "n", "rest")]
            keys = np.concatenate((keys, np.stack(fields[:3], axis=1)))
            c, n, rest = (np.concatenate(x) for x in zip((c, n, rest), fields[3:], strict=True))
            if not len(c):
                continue
            # A class may stand several times in a list, once for each task that met it.
            fresh = np.concatenate(([True], (keys[1:] != keys[:-1]).any(axis=1) | (c[1:] != c[:-1])))
            keys, c, n, rest = keys[fresh], c[fresh], n[fresh], rest[fresh]
            cut = int(np.argmax((keys == keys[-1]).all(axis=1)))  # the last run may go on in the next batch
            if cut:
                yield from emit(keys[:cut], c[:cut], n[:cut], rest[:cut], going_on)
                keys, c, n, rest, going_on = keys[cut:], c[cut:], n[cut:], rest[cut:], False
            if len(c) > 100_000:  # a very long list: its members pass, its head stays
                yield from emit(keys, c, n, rest, going_on)
                keys, c, n, rest, going_on = keys[:1], c[:1], n[:1], rest[:1], True
        if len(c):
            yield from emit(keys, c, n, rest, going_on)

    return own.mapInArrow(scan, "kind byte, sig long, a long, b long, n long, rest long")


def _similar(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Exact Jaccard similarity of class pairs: ``a``, ``b``, ``inter``, ``total`` (size of the union)."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = batch.column("xs"), batch.column("ys")
            inter, total = [], []
            for i in range(batch.num_rows):
                p, q = np.frombuffer(x[i].as_buffer(), np.uint64), np.frombuffer(y[i].as_buffer(), np.uint64)
                at = np.minimum(np.searchsorted(q, p), len(q) - 1)
                k = int((q[at] == p).sum())
                inter.append(k)
                total.append(len(p) + len(q) - k)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(inter, pa.int64()), pa.array(total, pa.int64())], names=["a", "b", "inter", "total"])

    own = pairs.join(sets.select(F.col("c").alias("a"), F.col("s").alias("xs")), "a").join(sets.select(F.col("c").alias("b"), F.col("s").alias("ys")), "b")
    return own.select("a", "b", "xs", "ys").mapInArrow(compare, "a long, b long, inter long, total long")


def components(links: DataFrame, nodes: DataFrame) -> DataFrame:
    """``c``, ``comp``: the least class reachable, by joining every node to the least neighbour of its component again and again.

    Each round halves distances at least (min-label with shortcutting) and is cut off by a written table."""
    edges = links.select("a", "b").where("a <> b").distinct()
    edges = staged(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    label = staged(nodes.select("c", F.col("c").alias("comp")), "label")
    while True:
        near = edges.join(label.select(F.col("c").alias("b"), "comp"), "b").groupBy(F.col("a").alias("c")).agg(F.min("comp").alias("near"))
        step = staged(label.select("c", "comp").join(near, "c", "left").select("c", F.least("comp", "near").alias("next"), "comp"), "step")
        hop = step.select(F.col("c").alias("next"), F.col("next").alias("far"))
        dropped(label)
        new = staged(step.join(hop, "next", "left").select("c", F.least("next", "far").alias("comp"), F.col("comp").alias("old")), "label")
        done = new.where("comp <> old").isEmpty()
        dropped(step)
        label = new
        if done:
            dropped(edges)
            return label.select("c", "comp")


def _set_table(docs: DataFrame, keys: DataFrame, width: int, text: str, doc_id: str) -> DataFrame:
    """``c``, ``s``: sorted shingle hashes of the classes in ``keys``, which have ``k``, the key of one row of the class. Texts are hashed where they lie;
    a bit table of fixed size stops most others before that, and a join the rest."""
    shared = docs.sparkSession.sparkContext.broadcast(bit_table(keys, "k"))

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = set()
        for all_ in batches:
            whole = all_.filter(pa.array(passes(all_.column("_k").to_numpy().view(np.uint64), shared.value)))
            for _, values, at in _sets(whole, width):
                c = _classes(values, at)
                use = [i for i in np.flatnonzero(np.diff(at) > 0).tolist() if c[i] not in done]
                if len(done) < SEEN:
                    done.update(c[use].tolist())
                yield pa.RecordBatch.from_arrays([pa.array(c[use].view(np.int64)), pa.array([values[at[i] : at[i + 1]].tobytes() for i in use], pa.binary())], names=["c", "s"])

    own = docs.select(row_key(doc_id, text).alias("_k"), F.col(text).alias("text")).mapInArrow(collect, "c long, s binary")
    return own.join(keys.select("c"), "c", "left_semi").dropDuplicates(["c"])


def jaccard_components(docs: DataFrame, percent: int = 75, width: int = 5, text: str = "text", doc_id: str = "doc_id", scan_cost: float = SCAN_COST) -> DataFrame:
    """Connected components of documents whose shingle sets have 100 * intersection >= ``percent`` * union.

    Returns ``_k`` (``row_key(doc_id, text)``), ``doc_id``, ``n_shingles``, ``component_id`` (the least ``doc_id`` of the
    component) and ``component`` (its hash, NULL for empty sets) for every row. Fewer words than ``width``: the whole sequence is one shingle. Null texts and texts without
    words have an empty set and are linked with nothing. Null ids never give a component its id while
    another is there. Repeated rows are each returned. Sets are told apart by 64-bit hashes."""
    with Scratch() as scratch:
        own = staged(profiles(docs, width, text, doc_id), "profiles")
        classes = staged(own.where("n > 0").groupBy("c").agg(F.min("doc_id").alias("least"), F.first("n").alias("n"), F.first("bits").alias("bits"), F.min("_k").alias("k")), "classes")
        sizes = {r[0]: r[1] for r in classes.groupBy("n").count().collect()}  # as many rows as there are set sizes
        boundary = size_boundary(sizes, percent, scan_cost)
        counts = _bucket_counts(docs, width, text, _bucket_bits(sum(n * k for n, k in sizes.items())))
        found = staged(_scan_lists(_signatures(docs, counts, boundary, width, percent, text), boundary, percent), "lists")
        maps, row_of = classes.select("c", "n", "bits"), classes.select("c", "k")
        all_pairs = staged(found.where("kind = 0").select("a", "b").distinct(), "pairs")
        long = staged(found.where("kind = 1").select("sig", F.col("b").alias("c"), "n", "rest").distinct(), "long")
        dropped(found)
        pairs = staged(_possible(all_pairs, maps, percent), "possible")
        dropped(all_pairs)
        ends = pairs.select(F.col("a").alias("c")).unionByName(pairs.select(F.col("b").alias("c"))).distinct()
        nodes = staged(ends.unionByName(long.select("c")).distinct(), "nodes")
        ends = staged(ends.join(row_of, "c"), "ends")
        sets = staged(_set_table(docs, ends, width, text, doc_id), "sets")
        links = _similar(pairs, sets, percent).where(100 * F.col("inter") >= percent * F.col("total")).select("a", "b")
        links = staged(links, "links")
        dropped(pairs, ends, sets)
        label = components(links, nodes)
        dropped(links, nodes)
        members = _open_members(long, label, percent)
        dropped(long)
        if members is not None:
            # Bitmaps first, and whole sets of the members that they leave a partner. Links found now join components, so components are the nodes.
            bundles, members = members, staged(_with_partner(members, maps, percent), "partnered")
            dropped(bundles)
            need = staged(members.select("c").distinct().join(row_of, "c"), "need")
            sets = staged(_set_table(docs, need, width, text, doc_id), "sets")
            more = staged(_joined(members, sets, percent), "joined")
            dropped(members, need, sets)
            again = components(more, more.select(F.col("a").alias("c")).unionByName(more.select(F.col("b").alias("c"))).distinct())
            label = label.join(again.toDF("comp", "far"), "comp", "left").select("c", F.coalesce("far", "comp").alias("comp"))
        # Names: the least document id of the classes of a component.
        named = classes.join(label, "c", "left").select("c", F.coalesce("comp", "c").alias("comp"), "least")
        names = named.groupBy("comp").agg(F.min("least").alias("component_id"))
        final = staged(named.select("c", "comp").join(names, "comp").select("c", "component_id", F.col("comp").alias("component")), "components")
        scratch.keep(own, final)
    got = own.where("n > 0").join(final, "c").select("_k", "doc_id", F.col("n").alias("n_shingles"), "component_id", "component")
    return got.unionByName(own.where("n = 0").select("_k", "doc_id", F.lit(0).cast("long").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(None).cast("long").alias("component")))


def _open_members(long: DataFrame, label: DataFrame, percent: int) -> DataFrame | None:
    """``bundle``, ``c``, ``comp``, ``n``: members of long lists in which several components meet; None without any.

    Members that sizes and rests allow no partner in the list are left out of it. A list's bundle is the least hash among its members, and then among
    the lists that its members stand in: the many lists of a group of copies become one bundle."""
    with Scratch() as scratch:
        tagged = staged(long.join(label, "c"), "tagged")
        several = (F.min("comp") < F.max("comp")).alias("several")
        lists = tagged.groupBy("sig").agg(several, F.min("n").alias("least"), F.max("rest").alias("most")).where("several").drop("several")
        room = percent * (F.col("n") + F.col("least")) <= (100 + percent) * F.least("rest", "most")
        live = staged(tagged.join(staged(lists, "lists"), "sig").where(room).select("sig", "c", "comp", "n"), "live")
        open_ = staged(live.groupBy("sig").agg(several, F.min(F.xxhash64("c")).alias("bundle")).where("several").drop("several"), "open")
        if open_.isEmpty():
            return None
        own = staged(live.join(open_, "sig"), "listed")
        near = staged(own.groupBy("c").agg(F.min("bundle").alias("near")), "near")
        wide = staged(own.join(near, "c").groupBy("sig").agg(F.min("near").alias("wide")), "wide")
        members = staged(own.join(wide, "sig").groupBy(F.col("wide").alias("bundle"), "c").agg(F.first("comp").alias("comp"), F.first("n").alias("n")), "members")
        scratch.keep(members)
        return members


def _dealt(members: DataFrame, amount: Column, least: int, most: int) -> DataFrame:
    """``members`` with their ``block`` in the bundle, once for every two blocks ``i`` and ``j`` that meet. A bundle has as many blocks as its ``amount``
    asks for, ``least`` a block for up to eight of them and ``most`` for more, and no more than it has members."""
    count = F.when(amount <= 8 * least, F.ceil(amount / least)).otherwise(8 + F.floor(amount / most))
    own = members.join(members.groupBy("bundle").agg(F.least(count, F.count("*")).cast("int").alias("blocks")), "bundle")
    own = own.withColumn("block", F.pmod(F.xxhash64("c", "bundle"), F.col("blocks")).cast("int"))
    own = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return own.withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")}).drop("blocks", "other")


def _sides(part: pa.Table) -> tuple[np.ndarray, np.ndarray, bool]:
    """The rows of the first and of the second block, and whether both are the same."""
    block, i, j = part.column("block").to_numpy(), part.column("i")[0].as_py(), part.column("j")[0].as_py()
    return np.flatnonzero(block == i), np.flatnonzero(block == j), i == j


def _runs(rows: np.ndarray, width: int) -> list[np.ndarray]:
    """``rows`` in runs whose bitmaps of ``width`` bytes have 16 MB together."""
    step = max(1, (16 << 20) // width)
    return [rows[k : k + step] for k in range(0, len(rows), step)]


def _with_partner(members: DataFrame, maps: DataFrame, percent: int) -> DataFrame:
    """The ``members`` whose bitmap allows the similarity with that of a member of another component of the bundle."""

    def meet(part: pa.Table) -> pa.Table:
        n, comp, c = (part.column(k).to_numpy() for k in ("n", "comp", "c"))
        bits = [np.frombuffer(x.as_buffer(), np.uint8) for chunk in part.column("bits").chunks for x in chunk]
        width = np.array([len(x) for x in bits])
        one, two, _ = _sides(part)
        hit = np.zeros(len(n), bool)
        for a in np.unique(width[one]).tolist() if len(one) else []:
            for b in np.unique(width[two]).tolist() if len(two) else []:
                size = min(a, b)

                def folded(rows, size=size):
                    return np.bitwise_or.reduce(np.stack([bits[k] for k in rows]).reshape(len(rows), -1, size), axis=1).view(np.uint64)

                for x in _runs(one[width[one] == a], a):
                    left = folded(x)
                    for y in _runs(two[width[two] == b], b):
                        right = folded(y)
                        for k, row in zip(x.tolist(), left, strict=True):
                            other = np.flatnonzero(comp[y] != comp[k])
                            if len(other):
                                more = np.bitwise_count(row & ~right[other]).sum(axis=1, dtype=np.int64), np.bitwise_count(right[other] & ~row).sum(axis=1, dtype=np.int64)
                                m = n[y[other]]
                                most = np.minimum(n[k] - more[0], m - more[1])
                                close = 100 * most >= percent * (n[k] + m - most)
                                hit[y[other[close]]] = True
                                hit[k] |= close.any()
        got = np.flatnonzero(hit)
        bundle = part.column("bundle").to_numpy()
        return pa.table({"bundle": pa.array(bundle[got]), "c": pa.array(c[got]), "comp": pa.array(comp[got]), "n": pa.array(n[got])})

    own = _dealt(members, F.count("*"), FEW, MANY).join(maps.select("c", "bits"), "c")
    return own.groupBy("bundle", "i", "j").applyInArrow(meet, "bundle long, c long, comp long, n long").distinct()


def _tiles(sizes: np.ndarray) -> list[np.ndarray]:
    """Runs of at most 512 sets that have ``BLOCK`` shingles together, or a set alone that has more."""
    ends, out, first = np.cumsum(sizes), [], 0
    while first < len(sizes):
        last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + BLOCK, side="right")))
        last = min(last, first + 512)
        out.append(np.arange(first, last))
        first = last
    return out


def _shared(sets: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the sets ``x`` with the sets ``y``: sets become bits over the shingles that stand in several of them."""
    both = np.concatenate((x, y))
    size = np.array([len(sets[k]) for k in both])
    value, place, seen = np.unique(np.concatenate([sets[k] for k in both]), return_inverse=True, return_counts=True)
    column = np.cumsum(seen > 1) - 1
    use = seen[place] > 1
    width = max(64, -(-int(column[-1] + 1) // 64) * 64)
    bits = np.zeros((len(both), width), bool)
    bits[np.repeat(np.arange(len(both)), size)[use], column[place[use]]] = True
    packed = np.packbits(bits, axis=1).view(np.uint64)
    left, right = packed[: len(x)], packed[len(x) :]
    return np.stack([np.bitwise_count(right & row).sum(axis=1, dtype=np.int64) for row in left])


def _joined(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links ``a``, ``b`` between components: every two blocks of a bundle meet in one task, which gives no more links than it has members."""

    def meet(part: pa.Table) -> pa.Table:
        comp = part.column("comp").to_numpy()
        sets = [np.frombuffer(s.as_buffer(), np.uint64) for chunk in part.column("s").chunks for s in chunk]
        n = np.array([len(s) for s in sets])
        one, two, alone = _sides(part)
        names, where = np.unique(comp, return_inverse=True)
        label = np.arange(len(names))
        left, right = _tiles(n[one]), _tiles(n[two])
        for p, x in enumerate(left):
            for y in right[p if alone else 0 :]:
                x_, y_ = one[x], two[y]
                if len(np.unique(label[where[np.concatenate((x_, y_))]])) == 1:
                    continue
                inter = _shared(sets, x_, y_)
                close = 100 * inter >= percent * (n[x_][:, None] + n[y_] - inter)
                for i, j in zip(*np.nonzero(close & (where[x_][:, None] != where[y_])), strict=True):
                    s, t = label[where[x_[i]]], label[where[y_[j]]]
                    if s != t:
                        label[label == max(s, t)] = min(s, t)
        moved = np.flatnonzero(label != np.arange(len(names)))
        return pa.table({"a": pa.array(names[label[moved]], pa.int64()), "b": pa.array(names[moved], pa.int64())})

    own = _dealt(members, F.sum("n"), BLOCK, LARGE_BLOCK).join(sets, "c").select("bundle", "i", "j", "block", "comp", "s")
    return own.groupBy("bundle", "i", "j").applyInArrow(meet, "a long, b long")
