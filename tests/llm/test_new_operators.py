"""Packing, importance resampling and ranked search against brute force; and their odd cases."""

import math
import random
import re
import time
import zlib
from collections import Counter
from hashlib import sha256

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from soundings.llm import importance, lexical, packing
from soundings.llm.shared import new_path, staged

from .conftest import ODD, SCHEMA

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def some_texts(n, seed, most=400):
    rng = random.Random(seed)
    common = ["The", "of", "AND", "é", "a1"]
    rare = ["".join(rng.choices("abcdefgÀ漢9", k=rng.randint(2, 14))) for _ in range(600)]
    texts = [" ".join(rng.choice(common) if rng.random() < 0.4 else rng.choice(rare) + rng.choice(["", ".", "-x"]) for _ in range(rng.randint(0, most) if i % 5 else rng.randint(0, 12))) for i in range(n)]
    return texts + texts[: n // 4]  # copies


def as_docs(spark, texts):
    return spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], SCHEMA)


# 11 Packing


def pieces_of(texts, end_id, most):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(WORD_BPE)
    library.no_truncation()
    library.no_padding()
    for d, t in texts:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, end_id]
        at = 0
        while at < len(ids):
            left = len(ids) - at
            size = most if left >= most else 1 << (left.bit_length() - 1)
            yield d, at, size, zlib.crc32(np.array(ids[at : at + size], "<u4").tobytes()), len(ids)
            at += size


@pytest.mark.parametrize("most", [2048, 64, 1])
def test_pieces_are_binary_and_hold_every_id_once(spark, most):
    texts = [*enumerate(some_texts(30, 3)), (99, "word " * 5000), (100, None), (101, "")] if most > 1 else [(0, "a b c"), (1, None)]
    path = new_path(spark, "packed")
    packing.write_packed(spark.createDataFrame(texts, "doc_id long, text string").repartition(3), path, WORD_BPE, 1, most)
    got = packing.sequence_digests(packing.read_packed(spark, path)).collect()
    assert sorted((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == sorted(pieces_of(texts, 1, most))
    assert len({r.sequence_id for r in got}) == len(got) and {r.offset for r in got} == {0}
    assert all(r.length & (r.length - 1) == 0 and r.length <= most for r in got)


def test_a_bucket_reads_its_own_folder(spark):
    path = new_path(spark, "packed")
    packing.write_packed(as_docs(spark, some_texts(30, 4)), path, WORD_BPE, 1)
    one = packing.read_packed(spark, path, length=64)
    assert {len(r.ids) for r in one.collect()} == {64}
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*length[^\]]* = 64", plan) and one.count() == packing.read_packed(spark, path).where("length = 64").count()


def test_packing_of_odd_rows(spark, odd, clashing, empty):
    want = sorted(pieces_of([(r[0], r[1]) for r in ODD], 1, 2048), key=str)
    for docs in (odd, clashing):
        path = new_path(spark, "packed")
        packing.write_packed(docs, path, WORD_BPE, 1)
        got = packing.sequence_digests(packing.read_packed(spark, path)).collect()
        assert sorted(((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got), key=str) == want
    path = new_path(spark, "packed")
    packing.write_packed(empty, path, WORD_BPE, 1)
    assert packing.sequence_digests(packing.read_packed(spark, path)).count() == 0
    with pytest.raises(ValueError, match="power of two"):
        packing.write_packed(empty, new_path(spark, "packed"), WORD_BPE, 1, most=1000)


# 12 Importance resampling


def resampled(texts, target, percent, least, longest, buckets, seed):
    def features(t):
        w = WORD.findall((t or "").translate(LOWER))
        return [" ".join(w[i : i + k]) for k in range(1, longest + 1) for i in range(len(w) - k + 1)], len(w)

    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = Counter(), Counter()
    for _, x in texts:
        s.update(map(bucket, features(x)[0]))
    for x in target:
        t.update(map(bucket, features(x)[0]))
    s_all, t_all = sum(s.values()), sum(t.values())
    out, drawn = [], []
    for d, x in texts:
        f, n = features(x)
        total = sum(math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets)))) for b in map(bucket, f))
        weight = total // len(f) if f else 0
        h = int(sha256(f"{seed}:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        row = [d, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None]
        out.append(row)
        if n >= least:
            drawn.append(row)
    drawn.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for i, row in enumerate(drawn[: percent * len(drawn) // 100]):
        row[4] = i + 1
    return sorted(map(tuple, out), key=str)


@pytest.mark.parametrize(("percent", "least", "longest", "buckets"), [(10, 20, 1, 10_000), (40, 5, 3, 97), (100, 0, 2, 1000), (0, 20, 1, 10)])
def test_weights_and_draw_are_those_of_a_plain_loop(spark, percent, least, longest, buckets):
    texts = list(enumerate(some_texts(120, 5)))
    target = ["the of é a1", None, some_texts(1, 9)[0], ""]
    got = importance.resample(spark.createDataFrame(texts, "doc_id long, text string").repartition(5), spark.createDataFrame([(t,) for t in target], "text string"), percent, least, longest, buckets, 7)
    assert sorted((tuple(r) for r in got.collect()), key=str) == resampled(texts, target, percent, least, longest, buckets, 7)


def test_words_and_runs_by_bytes():
    for t in [*some_texts(20, 6), "\x00a\x7fB_c`d{e\u00a0f\u0085 ١ ½", "", "  "]:
        own = WORD.findall(t.translate(LOWER))
        assert [w.decode() for w in importance.words_of(t.encode())] == own
        runs = list(importance.longer_runs([w.encode() for w in own], 3))
        assert runs == [[zlib.crc32(" ".join(own[i : i + k]).encode()) for i in range(len(own) - k + 1)] for k in (2, 3)]


def test_resampling_of_odd_rows(spark, odd, clashing, empty):
    target = spark.createDataFrame([("one two three",), (None,)], "text string")
    want = resampled([(r[0], r[1]) for r in ODD], ["one two three", None], 50, 1, 1, 100, 2024)
    for docs in (odd, clashing):
        got = sorted((tuple(r) for r in importance.resample(docs, target, 50, 1, 1, 100).collect()), key=str)
        assert [r[:4] for r in got] == [r[:4] for r in want]  # which of equal scores and ids is drawn goes by the text
        assert sorted(r[4] for r in got if r[4]) == sorted(r[4] for r in want if r[4])
    assert importance.resample(empty, target).count() == 0
    assert importance.resample(odd, target.limit(0)).count() == len(ODD)
    assert importance.bucket_counts(empty).sum() == 0


def test_a_task_that_empties_its_tables_counts_the_same(spark, monkeypatch):
    docs = as_docs(spark, some_texts(60, 8))
    whole = importance.bucket_counts(docs, longest=2)
    monkeypatch.setattr(importance, "HELD", 3)
    known = importance._Known(lambda c: c)
    assert [known[b"w%d" % i] for i in range(9)] == [zlib.crc32(b"w%d" % i) for i in range(9)] and len(known) <= 3
    assert (importance.bucket_counts(docs, longest=2) == whole).all()


# 13 Ranked lexical search


def searched(texts, items, depth):
    docs = [(d, Counter(TERM.findall((t or "").translate(LOWER)))) for d, t in texts]
    docs = [(d, c, sum(c.values())) for d, c in docs if c]
    n_docs, n_terms = len(docs), sum(n for _, _, n in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    out = []
    for i, text in items:
        asked = Counter(TERM.findall((text or "").translate(LOWER)))
        scores = []
        for d, c, n in docs:
            m = 25 + 75 * n * n_docs // n_terms
            s = sum(q * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t, q in asked.items() if t in c)
            if s > 0:
                scores.append((-s, d is None, d))
        out += [(i, r + 1, d, -s) for r, (s, _, d) in enumerate(sorted(scores, key=lambda x: x[:2] + (x[2] or 0,))[:depth])]
    return sorted(out, key=str)


ITEMS = [("a", "The of é"), ("b", "and AND and a1 the"), ("c", None), ("d", ""), ("e", "nothing-here qqqqq"), ("f", "漢9 ab c"), ("b", "and AND and a1 the")]


@pytest.mark.parametrize(("depth", "held"), [(10, 1 << 20), (3, 1500), (500, 1 << 20)])
def test_search_finds_the_exact_first(spark, depth, held):
    texts = list(enumerate(some_texts(250, 11)))
    items = ITEMS + [(f"t{i}", t[: 40 + 30 * i]) for i, t in enumerate(some_texts(20, 11)[:12])]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(6)
    got = lexical.ranked_search(docs, spark.createDataFrame(items, "item_id string, text string"), depth, items_held=held)
    assert sorted((tuple(r) for r in got.collect()), key=str) == searched(texts, items, depth)


def test_bounds_are_never_below_scores_and_mostly_near(spark):
    texts = some_texts(300, 12)
    asked = lexical.Asked.of(pa.table({"item_id": ["x", "y"], "text": ["The of " + texts[1], "and é a1 " + texts[2]]}))
    docs = as_docs(spark, texts)
    index = lexical.read_texts(docs, spark.sparkContext.broadcast(asked)).where("bits is not null").collect()
    counted = [Counter(TERM.findall(t.translate(LOWER))) for t in texts]
    n = [sum(c.values()) for c in counted]
    df = np.zeros(len(asked.hashes), np.int64)
    names = {}
    words = lexical.split_words(pa.array(["The of " + texts[1], "and é a1 " + texts[2]]), lexical.ALNUM)
    for k, t in zip(np.searchsorted(asked.hashes, words.hashes()), range(len(words.start)), strict=True):
        names[int(k)] = words.text(t).decode()
        df[k] = sum(names[int(k)] in c for c in counted)
    asked = asked.weighed(df, sum(x > 0 for x in n), sum(n))
    assert sum(len(r.doc_id) for r in index) == sum(x > 0 for x in n)
    close = total = 0
    for r in index:
        assert r.n == [n[d] for d in r.doc_id]
        bound = lexical.upper_bounds(bytes(r.bits), r.width, np.array(r.n), np.array(r.top), asked)
        for i, item in enumerate(("x", "y")):
            pairs = [(names[int(t)], int(w)) for t, w, k in zip(asked.term, asked.weight, asked.item, strict=True) if k == i]
            for c, d in enumerate(r.doc_id):
                score = sum(w * int(lexical.worth(np.int64(counted[d][t]), np.int64(n[d]), asked)) for t, w in pairs if t in counted[d])
                assert bound[i, c] >= score
                close += bound[i, c] <= 1.3 * score + 1_000_000
                total += 1
    assert close > 0.7 * total


def test_search_over_odd_rows(spark, odd, clashing, empty):
    items = spark.createDataFrame([("i", "one two id word"), (None, "漢字 six another"), ("z", None)], "item_id string, text string")
    want = searched([(r[0], r[1]) for r in ODD], [("i", "one two id word"), (None, "漢字 six another"), ("z", None)], 10)
    for docs in (odd, clashing):
        assert sorted((tuple(r) for r in lexical.ranked_search(docs, items).collect()), key=str) == want
    assert lexical.ranked_search(empty, items).count() == 0
    assert lexical.ranked_search(odd, items.limit(0)).count() == 0
    named = lexical.ranked_search(odd.withColumnRenamed("doc_id", "d").withColumnRenamed("text", "t"), items.withColumn("extra", F.lit(1)), text="t", doc_id="d")
    assert named.count() == len(want)


def test_a_written_table_leaves_no_shuffle_files(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        names = disk.getAllFiles()
        return {n for n in (names.apply(i).getName() for i in range(names.size())) if n.startswith("shuffle_")}

    before = shuffled()
    out = staged(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.sum("id").alias("n")), "sums")
    end = time.time() + 20
    while shuffled() - before and time.time() < end:
        time.sleep(0.2)
    assert not shuffled() - before
    assert sorted(map(tuple, out.collect())) == sorted((k, sum(range(k, 1000, 7))) for k in range(7))
