"""Each operator against a brute-force version, the library it must equal, or held-out accuracy; and its odd cases."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from soundings.llm import bpe, decontam, langid, linededup, neardup, quality, sampling, suffixtree, tokens, toxicity, urls, words
from soundings.llm.shared import new_path, passes

from .conftest import ODD, SCHEMA

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
BYTE_BPE, WORD_BPE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
TEXTS = ["", " ", "a  b\n\n c\t d", "x  y   z", "İstanbul ΣΑΣ é \u0085 q", "it's we'll I'D 12345 ٣٤ 漢字かな 😀😀 !!!??\x1c\x1d a\x1c b", "naïve—café ---- ...", "aaaaaaaaaa bbbbbbb hahahahahaha" * 3, "don.t a.b 's 's. (x) É,b", "½ ª º × x÷y", "foo<|endoftext|> bar  <|startoftext|>x"]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# Words


def test_words_are_those_of_the_pattern():
    texts = [t for t in (r[1] for r in ODD) if t is not None] + TEXTS
    got = words.split_words(pa.array([*texts, None]))
    mine = [[got.text(i).decode() for i in range(got.bounds[d], got.bounds[d + 1])] for d in range(got.n_docs)]
    assert mine == [WORD.findall(t.translate(LOWER)) for t in texts] + [[]]


def test_hashes_agree_between_batches():
    a, b = words.split_words(pa.array(["one two", "three one"])), words.split_words(pa.array(["zzz", "one"]))
    assert a.hashes()[0] == a.hashes()[3] == b.hashes()[1]
    assert len(set(words.split_words(pa.array([" ".join(f"w{i}" for i in range(50_000))])).hashes().tolist())) == 50_000


def test_chunks_lie_end_to_end():
    got = words.split_chunks(pa.array(TEXTS))
    for d, t in enumerate(TEXTS):
        assert b"".join(got.text(i) for i in range(got.bounds[d], got.bounds[d + 1])).decode() == t


# 1 Toxicity


def _toxic_texts(n, seed):
    rng = np.random.default_rng(seed)
    vocab = ["".join(rng.choice(list("abcdefghij"), 5)) for _ in range(300)]
    out = []
    for i in range(n):
        w = list(rng.choice(vocab, int(rng.integers(5, 120))))
        if i % 3 == 0:
            for k in rng.integers(0, len(w), 2):
                w[k] = "zwork" + str(rng.choice(vocab))
        out.append((" ".join(w), int(i % 3 == 0)))
    return out


def test_toxicity_finds_held_out_texts():
    learn, test = _toxic_texts(400, 1), _toxic_texts(200, 2)
    net = toxicity.train([t for t, _ in learn], [y for _, y in learn], 1 / 3)
    p = net.scores(words.split_words(pa.array([t for t, _ in test])))
    y = np.array([y for _, y in test])
    assert (p[y == 1] >= 0.7).mean() > 0.9 and (p[y == 0] >= 0.7).mean() < 0.05
    assert net.scores(words.split_words(pa.array(["", None]))).tolist() == [net.prior] * 2


def test_toxicity_gradients_are_right():
    rng = np.random.default_rng(0)
    f = lambda *s: rng.normal(0, 0.5, s).astype(np.float32)
    h, d = toxicity.HIDDEN, 2 * toxicity.PART
    net = toxicity.GatedNetwork(f(1, 1), f(1, 1), [[f(d, 3 * h), f(h, 3 * h), f(3 * h)] for _ in range(2)], f(2 * h), f(2 * h + 1))
    batch = [(f(7, d), 1.0), (f(toxicity.WINDOW, d), 0.0)]

    def loss():
        x = np.zeros((2 * toxicity.WINDOW + 1, d), np.float32)
        mask = np.zeros((2, toxicity.WINDOW), bool)
        for i, (w, _) in enumerate(batch):
            x[i * toxicity.WINDOW : i * toxicity.WINDOW + len(w)], mask[i, : len(w)] = w, True
        states, _ = net.states(net.project(x), np.arange(2 * toxicity.WINDOW).reshape(2, -1), mask, False)
        z = net.pool(states, mask)[2].astype(float)
        return np.mean([np.log1p(np.exp(-z[0])), np.log1p(np.exp(z[1]))])

    params = [p for layer in net.layers for p in layer] + [net.look, net.out]
    before = [p.copy() for p in params]
    speed = [np.zeros_like(p) for p in params]
    toxicity._step(net, params, [np.full_like(s, 1e12) for s in speed], batch, 0.0)
    captured = [np.zeros_like(p) for p in params]
    d_input = toxicity._step(net, params, captured, batch, 0.0)  # speeds now hold squared gradients
    assert d_input.shape == (7 + toxicity.WINDOW, d)
    for at in ((2, 1), (9, 5)):
        window, step = batch[0][0] if at[0] < 7 else batch[1][0], (at[0] if at[0] < 7 else at[0] - 7, at[1])
        old = window[step]
        window[step] = old + 1e-2
        up = loss()
        window[step] = old - 1e-2
        down = loss()
        window[step] = old
        assert abs((up - down) / 2e-2 - float(d_input[at])) < 0.05 * abs(float(d_input[at])) + 1e-3
    for p, b, g2 in zip(params, before, captured, strict=True):
        i = np.unravel_index(int(np.argmax(g2)), p.shape)
        p[i] = b[i] + 1e-2
        up = loss()
        p[i] = b[i] - 1e-2
        down = loss()
        p[i] = b[i]
        assert abs(abs(up - down) / 2e-2 - float(g2[i]) ** 0.5) < 0.05 * float(g2[i]) ** 0.5 + 1e-3


def test_toxicity_embeddings_learn():
    learn = _toxic_texts(200, 1)
    short, long = (toxicity.train([t for t, _ in learn], [y for _, y in learn], 1 / 3, rounds=1, epochs=k) for k in (1, 6))
    for one, two in ((short.word, long.word), (short.char, long.char)):
        moved = np.abs(one - two).max(axis=1)
        assert (moved > 1e-3).sum() > 100 and (moved == 0).any()


def test_toxicity_odd_rows(spark, odd, empty, clashing):
    labels = spark.createDataFrame([(4, 1), (5, 0), (7, 1), (1, 0), (None, 1), (9, None)], "doc_id long, toxic int")
    net = toxicity.fit(odd, labels)
    for docs in (odd, clashing):
        out = toxicity.score(docs, net)
        assert out.count() == len(ODD) and out.where("score is null or score < 0 or score > 1").isEmpty()
    assert toxicity.fit(empty, labels) is None
    assert toxicity.score(empty, None).isEmpty() and toxicity.score(odd, None).where("score <> 0").isEmpty()


# 2 Line dedup


def _dedup(docs, least):
    """Positions that lie in a repeated run, by comparing every pair of starts."""
    order = [(i, t.split("\n")) for i, t in docs]
    lines = [(i, n, x, len(WORD.findall(x))) for i, ls in order for n, x in enumerate(ls)]
    solid = [x for x in lines if x[3]]
    gone = set()
    for b in range(len(solid)):
        for a in range(b):
            k = w = 0
            while b + k < len(solid) and solid[a + k][0] == solid[a][0] and solid[b + k][0] == solid[b][0] and solid[a + k][2] == solid[b + k][2]:
                w += solid[b + k][3]
                k += 1
            if w >= least:
                first, last = solid[b][1], solid[b + k - 1][1]
                gone |= {(solid[b][0], n) for n in range(first, last + 1)}
    return {i: "\n".join(x for n, x in enumerate(ls) if (i, n) not in gone) for i, ls in order}


@pytest.mark.parametrize("seed", range(4))
def test_line_dedup_equals_brute_force(spark, seed):
    rng = np.random.default_rng(seed)
    pool = ["", "a b", "c", "d e f g", "h i j k l m", "n", "o p q"]
    docs = [(i, "\n".join(rng.choice(pool, int(rng.integers(1, 12))))) for i in range(12)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["row"]["doc_id"]: r["row"]["text"] for r in linededup.line_dedup(df, min_words=7).collect()}
    assert got == _dedup(docs, 7)


def test_line_dedup_odd_rows(spark, odd, empty, clashing):
    for docs in (odd, clashing):
        out = linededup.line_dedup(docs)
        assert out.count() == len(ODD) and out.select("row.*").columns == docs.columns
    passage = " ".join(f"w{i}" for i in range(55))
    both = spark.createDataFrame([(1, f"x\n{passage}\ny"), (2, f"{passage}\nz"), (3, passage), (3, passage)], "doc_id long, text string")
    got = rows(linededup.line_dedup(both).selectExpr("row.doc_id", "row.text", "emptied"))
    assert got == [(1, f"x\n{passage}\ny", False), (2, "z", False), (3, "", True), (3, "", True)]
    assert linededup.line_dedup(empty).isEmpty()


# 3 Token ids


def test_token_ids_round_trip(spark, odd, empty):
    from tokenizers import Tokenizer

    tk = Tokenizer.from_file(BYTE_BPE)
    docs = [(i, t) for i, t in enumerate(TEXTS)] + [(100, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    path = new_path(spark, "ids")
    tokens.write_token_ids(df, path, BYTE_BPE, 2)
    back = tokens.read_token_ids(spark, path)
    got = {r["doc_id"]: (r["start"], r["ids"]) for r in back.collect()}
    at = 0
    for i, t in docs:
        ids = [*tk.encode(t or "", add_special_tokens=False).ids, 2]
        assert got[i] == (at, ids)
        at += len(ids)
    digest = {r["doc_id"]: (r["n_tokens"], r["ids_crc32"]) for r in tokens.id_digests(back).collect()}
    assert digest == {i: (len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, (_, x) in got.items()}
    assert "EqualTo(doc_id,3)" in back.where("doc_id = 3")._jdf.queryExecution().toString()
    named = df.selectExpr("concat('d', doc_id) as doc_id", "text")
    path = new_path(spark, "ids")
    tokens.write_token_ids(named, path, BYTE_BPE, 2)
    mine = tokens.id_digests(tokens.read_token_ids(spark, path, "string")).collect()
    assert {r["doc_id"]: r["ids_crc32"] for r in mine} == {f"d{i}": x[1] for i, x in digest.items()}
    clash = odd.withColumns({n: F.lit(n) for n in ("part", "ids", "start_in_part", "tie")})
    for docs, n in ((odd, len(ODD)), (clash, len(ODD)), (empty, 0)):
        path = new_path(spark, "ids")
        tokens.write_token_ids(docs, path, BYTE_BPE, 2)
        assert tokens.id_digests(tokens.read_token_ids(spark, path)).count() == n


def test_token_id_files_are_read_in_parts(spark):
    """A filter on ids reads the row groups that may hold them and no others: by least and greatest ids, and by Bloom filters between those."""
    docs = spark.range(0, 40_000, 2).selectExpr("id as doc_id", "concat('text ', id) as text").coalesce(1)
    path = new_path(spark, "ids")
    tokens.write_token_ids(docs, path, BYTE_BPE, 2, stripe_mb=1, index_stride=1000)
    for wanted, most, found in ((20_000, 1000, 1), (20_001, 0, 0)):
        own = spark.read.schema("part int, doc_id long, start_in_part long, ids array<int>").orc(path).where(F.col("doc_id") == wanted)
        plan = own._jdf.queryExecution().executedPlan()
        assert plan.executeCollect().__len__() == found
        while "Scan" not in plan.nodeName():
            plan = plan.children().head()
        assert plan.metrics().get("numOutputRows").get().value() <= most


# 4 Quality rules


def _quality(t):
    w = WORD.findall(t or "")
    seen = defaultdict(list)
    for i in range(len(w) - 4):
        seen[tuple(w[i : i + 5])].append(i)
    hit = {i + k for p in seen.values() if len(p) > 1 for i in p for k in range(5)}
    lines = [x for x in (t or "").split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(hit)


def test_quality_metrics_equal_brute_force(spark, odd, empty, clashing):
    rng = np.random.default_rng(3)
    texts = [" ".join(rng.choice(list("abc"), int(rng.integers(0, 40)))) + "\n#a\n#a" for _ in range(40)] + TEXTS + [r[1] for r in ODD]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in quality.quality_rules(df).collect():
        want = _quality(texts[r["row"]["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (want[0] < 10 or 100 * want[4] > 20 * want[0]) and not (r["base_failed"] and r["kept"])
    assert quality.quality_rules(clashing).count() == len(ODD) and quality.quality_rules(empty).isEmpty()


def test_quality_plan_is_one_projection(odd):
    plan = quality.quality_rules(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


# 5 URL filters


def test_url_filter_verdicts(spark):
    rules = (urls.UrlRule("block", "net"), urls.UrlRule("allow", "example.net", "/en/"))
    pages = [(1, "HTTP://WWW.Example.NET/en/x?q"), (2, "https://a.example.net/de/"), (3, "https://net"), (4, "http://bad.org/p.html#t"), (5, "https://www.bad.org/p/"), (6, "https://bad.org/q"), (7, None), (8, "no scheme"), (9, ""), (4, "http://bad.org/p.html#t")]
    df = spark.createDataFrame(pages, "page_id long, url string").withColumns({"host": F.lit("x"), "_key": F.lit("x"), "row": F.lit(1)})
    listed = spark.createDataFrame([("http://bad.org/p",), (None,), ("http://bad.org/p/",), ("junk",)], "url string")
    got = rows(urls.url_filter(df, listed, rules, blocks=4).select("row.page_id", "host", "path", "rule", "verdict"))
    assert got == sorted([
        (1, "www.example.net", "/en/x", "example.net/en/", "allow"), (2, "a.example.net", "/de/", "net/", "block"), (3, "net", "", None, "allow"), (4, "bad.org", "/p.html", None, "block"), (4, "bad.org", "/p.html", None, "block"),
        (5, "www.bad.org", "/p/", None, "block"), (6, "bad.org", "/q", None, "allow"), (7, "", "", None, "allow"), (8, "", "", None, "allow"), (9, "", "", None, "allow"),
    ], key=str)
    assert urls.url_filter(df.limit(0), listed, rules).isEmpty()
    assert urls.url_filter(df, listed.limit(0), rules).where("verdict = 'block'").count() == 1
    # A very long url, and list entries of one canonical form.
    far = "http://long.org/" + "a/" * 100_000
    more = spark.createDataFrame([(1, far), (2, far + "b")], "page_id long, url string")
    same = spark.createDataFrame([(far,), ("https://www." + far[7:] + "/",), (far,)], "url string")
    assert rows(urls.url_filter(more, same, rules).select("row.page_id", "verdict")) == [(1, "block"), (2, "allow")]
    # One block lets very many through; the exact join takes them back.
    many = spark.range(3000).selectExpr("id as page_id", "concat('http://h.org/', id) as url")
    out = urls.url_filter(many, many.where("page_id % 3 = 0").select("url"), rules, blocks=1)
    assert out.where("(verdict = 'block') <> (row.page_id % 3 = 0)").isEmpty()


@pytest.mark.parametrize(("n", "blocks"), [(0, 64), (2_000, 64), (2_049, 128), (10_000_000, 1 << 19), (10**9, 1 << 20)])
def test_filter_grows_with_its_list(n, blocks):
    assert urls.blocks_for(n) == blocks


def test_bloom_filter_lets_all_listed_through(spark):
    keys = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("key"))
    bits = urls.build_filter(keys, blocks=64)
    assert bits.count() <= 64
    probe = spark.range(10_000).select(F.concat(F.lit("k"), "id").alias("key"), "id")
    probe = probe.select("*", *urls._place(F.col("key"), 4096)).join(urls.build_filter(keys, blocks=4096), "_block", "left")
    hit = F.lit(True)
    for j in range(urls.WORDS_PER_BLOCK):
        hit = hit & (F.col(f"_w{j}").bitwiseAND(F.col(f"_m{j}")) == F.col(f"_m{j}"))
    got = {r["id"] for r in probe.where(hit).collect()}
    assert set(range(5000)) <= got and len(got) < 5200


# 6 Language model


def test_scores_and_counts(spark, odd, empty, clashing):
    rng = np.random.default_rng(5)
    pairs = ["the cat sat", "a dog ran", "der hund lief", "die katze sass"]
    docs = [(i, " ".join(rng.choice(pairs, 30))) for i in range(60)] + [(100, None), (101, ""), (102, "never seen words"), (3, "the cat sat")]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("learn", F.col("doc_id") % 4 != 0)
    got = suffixtree.score_texts(df).collect()
    assert len(got) == len(docs)
    count = defaultdict(int)
    for i, t in docs:
        if i % 4:
            for w in [*WORD.findall((t or "").translate(LOWER)), None]:
                count[w] += 1
    n, v = sum(count.values()), len(count)
    by = defaultdict(list)
    for i, t in docs:
        w = [*WORD.findall((t or "").translate(LOWER)), None]
        by[i].append((len(w), sum(count[x] > 0 for x in w), round(sum(np.log10((count[x] + 1) / (n + v + 1)) for x in w), 6)))
    mine = defaultdict(list)
    for r in got:
        mine[r["doc_id"]].append((r["n_tokens"], r["n_known"], round(r["base_score"], 6)))
        assert r["train_tokens"] == n and r["score"] <= 0
    assert {k: sorted(x) for k, x in mine.items()} == {k: sorted(x) for k, x in by.items()}
    held = [r for r in got if r["doc_id"] % 4 == 0 and r["n_tokens"] > 10 and r["n_known"] == r["n_tokens"]]
    assert held and all(r["score"] > r["base_score"] for r in held)
    for docs in (odd, clashing):
        assert suffixtree.score_texts(docs.withColumn("learn", F.col("doc_id") > 2)).count() == len(ODD)
    assert suffixtree.score_texts(odd.withColumn("learn", F.lit(False))).where("n_known > 0").isEmpty()
    assert suffixtree.score_texts(empty.withColumn("learn", F.lit(True))).isEmpty()


def test_keys_are_found_by_their_leading_bits():
    """Unsorted keys are looked up as by binary search, spread evenly or not; the filter lets the same keys through as one that tests both bits of all."""
    rng = np.random.default_rng(3)
    asked = rng.integers(0, 2**64, 5000, dtype=np.uint64)
    for table in (asked[:3000], asked[:1], asked[:0], np.arange(500, dtype=np.uint64), np.array([0, 2**64 - 1], np.uint64)):
        table = np.unique(table)
        values = np.concatenate([asked, table, table + np.uint64(1)])
        at, found = suffixtree._find_by(values, table, suffixtree._starts(table))
        assert (found == np.isin(values, table)).all() and (table[at[found]] == values[found]).all()
    bits = rng.integers(0, 2**32, 64, dtype=np.uint32)
    both = [bits[x >> 5] >> np.uint32(x & 31) & 1 and bits[y >> 5] >> np.uint32(y & 31) & 1 for x, y in ((k & 2047, k >> 11 & 2047) for k in asked.tolist())]
    assert (passes(asked, bits) == np.array(both, bool)).all()


def test_tree_distributions_add_up_to_one():
    tree = suffixtree.SuffixTree(np.array([1, 2, 3], np.uint64), np.array([50, 30, 20]), float(np.log10(104)), 5)
    context, symbol = np.array([9, 9], np.uint64), np.array([1, 2], np.uint64)
    below = 10 ** tree.unigram(symbol)
    tree.grow(context, symbol, np.array([10.0, 80.0]), np.array([100.0, 100.0]), below)
    assert len(tree.contexts[0]) == 1
    listed = (10 ** tree.scores[0]).sum()
    assert abs(listed + 10 ** tree.rest[0][0] * (1 - below.sum()) - 1) < 1e-9


def _tree_scores(docs, context_least, pair_least):
    """Brute force: contexts of any length whose suffix and beginning are in the tree, level by level while one enters."""
    texts = [(learn, ["<", *WORD.findall(t.translate(LOWER)), ">"]) for t, learn in docs]
    uni = defaultdict(int)
    for learn, w in texts:
        for x in w[1:] if learn else []:
            uni[x] += 1
    floor, trees = sum(uni.values()) + len(uni) + 1, []

    def chain(context, x, level):
        if not level:
            return (uni[x] + 1) / floor
        rest, listed = trees[level - 1].get(context[-level:], (None, {})) if len(context) >= level else (None, {})
        return listed[x] if x in listed else (1 if rest is None else rest) * chain(context, x, level - 1)

    while True:
        level = len(trees) + 1
        n = defaultdict(lambda: defaultdict(int))
        for learn, w in texts:
            for i in range(level, len(w)) if learn else []:
                n[tuple(w[i - level : i])][w[i]] += 1
        kept = {}
        for c, follow in n.items():
            whole = sum(follow.values())
            own = {x: k for x, k in follow.items() if k >= pair_least}
            grows = level == 1 or (c[1:] in trees[-1] and c[:-1] in trees[-1] and c[-1] in trees[-1][c[:-1]][1])
            if grows and whole >= context_least and own:
                below = {x: chain(c, x, level - 1) for x in own}
                gain = sum(k * np.log(k / whole / below[x]) for x, k in own.items())
                other, other_below = whole - sum(own.values()), max(1 - sum(below.values()), 1e-9)
                gain += other * np.log(other / whole / other_below) if other else 0
                if 2 * gain > len(own) + 3 * np.sqrt(2 * len(own)):
                    p = {x: (k + len(own) * below[x]) / (whole + len(own)) for x, k in own.items()}
                    kept[c] = (max(1 - sum(p.values()), 1e-9) / other_below, p)
        if not kept:
            return level - 1, [sum(np.log10(chain(tuple(w[:i]), w[i], level - 1)) for i in range(1, len(w))) for _, w in texts]
        trees.append(kept)


@pytest.mark.parametrize(("held_share", "pair_least"), [(0.0, 3), (0.01, 1), (1.0, 3)])
def test_tree_scores_equal_brute_force_at_any_depth(spark, held_share, pair_least):
    """A word that only the fourth before it tells needs four levels; keys held by tasks and keys of the join give the same."""
    rng = np.random.default_rng(8)
    docs = []
    for i in range(80):
        w = [str(x) for x in rng.choice(list("abc"), 4)]
        while len(w) < 60:
            w.append(w[-4] if rng.random() < 0.9 else str(rng.choice(list("abcde"))))
        docs.append((" ".join(w), i % 5 > 0))
    levels, want = _tree_scores(docs, 20, pair_least)
    assert levels >= 4
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(docs)], "doc_id long, text string, learn boolean")
    got = {r["doc_id"]: r["score"] for r in suffixtree.score_texts(df, context_least=20, pair_least=pair_least, held_share=held_share).collect()}
    assert np.allclose([got[i] for i in range(len(docs))], want, rtol=0, atol=1e-6)


# 7 Near duplicates


def _components(docs, percent=75):
    sets = {}
    for k, (i, t) in enumerate(docs):
        w = WORD.findall((t or "").translate(LOWER))
        sets[k] = {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else set()
    parent = list(range(len(docs)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a in sets:
        for b in range(a):
            inter = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * inter >= percent * (len(sets[a]) + len(sets[b]) - inter):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    group = defaultdict(list)
    for k in range(len(docs)):
        if docs[k][0] is not None:
            group[find(k)].append(docs[k][0])
    return sorted(((i, len(sets[k]), min(group[find(k)], default=None)) for k, (i, _) in enumerate(docs)), key=str)


def _near_texts(seed, families=4, size=14):
    rng = np.random.default_rng(seed)
    docs, shared = [], [f"s{i}" for i in range(40)]
    for f in range(families):
        base = [f"f{f}w{i}" for i in range(int(rng.integers(4, 60)))] + (shared if f % 2 else [])
        for _ in range(size):
            w = list(base)
            for _ in range(int(rng.integers(0, 4))):
                w[int(rng.integers(0, len(w)))] = f"x{rng.integers(0, 5)}"
            docs.append(" ".join(w))
    return [(i, t) for i, t in enumerate(docs)]


@pytest.mark.parametrize(("seed", "short", "boundary"), [(0, 8, None), (1, 2, None), (2, 2, 0), (3, 3, 1000), (4, 1, 20)])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, seed, short, boundary):
    """Short lists, long lists, subsets alone and single shingles alone give the same components."""
    monkeypatch.setattr(neardup, "SHORT_LIST", short)
    if boundary is not None:
        monkeypatch.setattr(neardup, "size_boundary", lambda *a, **k: boundary)
    docs = _near_texts(seed)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert rows(neardup.jaccard_components(df).select("doc_id", "n_shingles", "component_id")) == _components(docs)


@pytest.mark.parametrize(("block", "percent_own"), [(1 << 16, 14), (600, 14), (600, 30), (1 << 16, 8)])
def test_near_duplicates_of_one_wide_group(spark, monkeypatch, block, percent_own):
    """Copies that lie about the threshold from one another, and texts of which most is one shared passage: many components in the same long lists."""
    monkeypatch.setattr(neardup, "BLOCK", block)
    rng = np.random.default_rng(percent_own)
    base, docs = [f"b{i}" for i in range(70)], []
    for _ in range(60):
        w = list(base)
        for at in rng.choice(70, int(rng.integers(0, 4)), replace=False):
            w[at] = f"x{rng.integers(0, 1000)}"
        docs.append(" ".join(w))
    passage = [f"p{i}" for i in range(100)]
    for i in range(60):
        own = [f"d{i}w{k}" for k in range(int(rng.integers(0, percent_own)))]
        docs.append(" ".join(passage + own if i % 2 else own + passage))
    docs = [(i, t) for i, t in enumerate(docs)]
    got = rows(neardup.jaccard_components(spark.createDataFrame(docs, "doc_id long, text string")).select("doc_id", "n_shingles", "component_id"))
    assert got == _components(docs)
    assert len({r[2] for r in got}) > 2


def test_equal_polynomials_are_told_apart(spark):
    """The Thue-Morse word of 1,024 letters and its complement collide under any polynomial modulo 2^64."""
    from tokenizers import Tokenizer

    word = "a"
    for _ in range(10):
        word += word.translate(str.maketrans("ab", "ba"))
    other = word.translate(str.maketrans("ab", "ba"))
    h = words.split_words(pa.array([word, other, f"x {word}"])).hashes()
    assert h[0] != h[1] and h[0] == h[3]
    docs = spark.createDataFrame([(1, word), (2, other), (3, word)], "doc_id long, text string")
    assert rows(neardup.jaccard_components(docs).select("doc_id", "component_id")) == [(1, 1), (2, 2), (3, 1)]
    bench = spark.createDataFrame([("i", word)], "item_id string, text string")
    assert rows(decontam.decontaminate(docs, bench).select("row.doc_id", "n_hit")) == [(1, 1), (2, 0), (3, 1)]
    scored = suffixtree.score_texts(docs.withColumn("learn", F.col("doc_id") != 2)).select("doc_id", "n_known")
    assert rows(scored) == [(1, 2), (2, 1), (3, 2)]
    for texts in ([word, other], [other, word]):
        byte_ids, word_ids = ([Tokenizer.from_file(path).encode(t, add_special_tokens=False).ids for t in texts] for path in (BYTE_BPE, WORD_BPE))
        assert tokens.ChunkEncoder(BYTE_BPE).ids(pa.array(texts))[0].tolist() == sum(byte_ids, [])
        df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
        assert rows(bpe.bpe_encode(df, WORD_BPE)) == list(enumerate(word_ids))


def test_words_that_share_a_hash_are_told_apart_by_bytes(monkeypatch):
    monkeypatch.setattr(words.Words, "hashes", lambda self: (self.end - self.start).astype(np.uint64))
    own = words.split_words(pa.array(["ab cd ab abcdefghij abcdefghik", "abcdefghij zz"]))
    first, strings, place = own.distinct()
    assert [strings[k] for k in place] == [own.text(i) for i in range(len(own.start))] and len(set(strings)) == len(strings) == len(first)


def test_near_duplicates_odd_rows(spark, odd, empty, clashing):
    want = _components([(r[0], r[1]) for r in ODD])
    for docs in (odd, clashing):
        assert rows(neardup.jaccard_components(docs).select("doc_id", "n_shingles", "component_id")) == want
    assert neardup.jaccard_components(empty).isEmpty()


def test_buckets_follow_the_corpus_and_unlike_texts_form_no_long_lists(spark, monkeypatch):
    """Sixteen texts share one shingle and nothing else. Where very many shingles share a bucket, it may stand in the prefix of them all."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    docs = [(i, " ".join([*(word() for _ in range(60)), *(f"w{i % 25}{k}" for k in range(5)), *(word() for _ in range(60))])) for i in range(400)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    monkeypatch.setattr(neardup, "BUCKET_BITS", 4)
    found, lists = neardup._open_members, []

    def members(long, label, percent):
        lists.append(long.count())
        return found(long, label, percent)

    monkeypatch.setattr(neardup, "_open_members", members)
    assert {tuple(r) for r in neardup.jaccard_components(df).select("doc_id", "component_id").collect()} == {(i, i) for i in range(400)}
    assert lists == [0]


def test_bucket_counts_are_sums_over_all_tasks(spark):
    docs = [(i, " ".join(f"w{(i * k) % 37}" for k in range(1 + i % 50))) for i in range(300)] + [(1000 + i, "one two three four five") for i in range(300)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    want = np.zeros(1 << 16, np.int64)
    for text in (t for _, t in docs):
        values, _ = words.shingle_sets(words.split_words(pa.array([text])), 5)
        np.add.at(want, (values >> np.uint64(48)).astype(np.int64), 1)
    assert (neardup._bucket_counts(df, 5, "text", 16) == neardup._levels(want)).all() and want.max() >= 300
    counts = np.unique(np.concatenate((np.arange(70_000), 2 ** np.arange(12, 28))))
    level = neardup._levels(counts).astype(int)
    assert (np.diff(level) >= 0).all() and (np.abs(neardup._COUNT[level] - counts) <= np.maximum(1.2 * np.sqrt(counts) / 2 + 1, counts * 0.05)).all()


def test_bitmaps_never_hide_a_similar_pair():
    rng = np.random.default_rng(9)
    for _ in range(300):
        a = rng.integers(0, 1 << 62, int(rng.integers(1, 200)), dtype=np.uint64)
        b = np.unique(np.concatenate((a[: int(rng.integers(0, len(a) + 1))], rng.integers(0, 1 << 62, int(rng.integers(0, 80)), dtype=np.uint64))))
        a = np.unique(a)
        if len(b):
            one, two = (pa.array([b"skipped", neardup._bitmap(x)], pa.binary()).slice(1) for x in (a, b))
            most = neardup._most_shared(one, two, np.array([len(a)]), np.array([len(b)]))
            assert len(most) == 1 and most[0] >= len(np.intersect1d(a, b))


# 8 Language identification


def test_language_of_held_out_texts(spark, odd, empty, clashing):
    rng = np.random.default_rng(1)
    stems = {"aa": ["th", "er", "ing", "nd"], "bb": ["sch", "ei", "ung", "ö"], "cc": ["oue", "aux", "é", "ment"]}
    make = lambda k: " ".join("".join(rng.choice(stems[k], int(rng.integers(1, 4)))) for _ in range(40))
    docs = [(i, make(k), k) for i, k in enumerate(["aa", "bb", "cc"] * 40)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    model = langid.fit(df.where(sampling.fold("doc_id", 5) != 0))
    out = langid.predict(df, model).select("row.doc_id", "row.lang", "lang_pred", "score", "rejected").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in out]) > 0.98 and np.mean([r["rejected"] for r in out]) < 0.02
    for docs in (odd, clashing):
        got = langid.predict(docs, model)
        assert got.count() == len(ODD)
        assert got.where("row.text is null or not row.text rlike '\\\\p{L}'").where("lang_pred <> 'und' or not rejected or score <> 0").isEmpty()
    assert langid.fit(empty) is None and langid.predict(odd, None).where("lang_pred <> 'und'").isEmpty() and langid.predict(empty, model).isEmpty()


# 9 Decontamination

TOKEN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _contaminated(docs, items):
    wins = defaultdict(set)
    for i, t in items:
        w = TOKEN.findall((t or "").translate(LOWER))
        for k in range(max(1, len(w) - 9) if w else 0):
            wins[tuple(w[k : k + 10])].add("" if i is None else str(i))
    out = []
    for i, t in docs:
        w = TOKEN.findall((t or "").translate(LOWER))
        mark, ids = [0] * len(w), set()
        for size in {len(k) for k in wins}:
            for k in range(len(w) - size + 1):
                if tuple(w[k : k + size]) in wins:
                    ids |= wins[tuple(w[k : k + size])]
                    mark[k : k + size] = [1] * size
        out.append((i, len(w), sum(mark), ",".join(sorted(ids))))
    return sorted(out, key=str)


def test_decontamination_equals_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(2)
    word = lambda: f"w{rng.zipf(1.3) % 50}"
    items = [(k, " ".join(word() for _ in range(n))) for k, n in enumerate((0, 1, 2, 9, 10, 11, 25, 30))] + [(7, None), (None, "w1 w2, W3"), (8, "q q q q q q q q q q q q")]
    docs = [(i, " ".join([word() for _ in range(30)] + (items[i % 9][1] or "").split()[:12] + [word() for _ in range(10)])) for i in range(40)] + [(90, "q " * 30), (91, None), (92, ""), (93, "W1 w2; w3")]
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = decontam.decontaminate(df, bench).select("row.doc_id", "n_words", "n_hit", F.array_join("items", ","))
    assert rows(got) == _contaminated(docs, items)
    monkeypatch.setattr(decontam, "TERMS_PER_BLOCK", 100)  # several blocks
    got = decontam.decontaminate(df, bench).select("row.doc_id", "n_words", "n_hit", F.array_join("items", ","))
    assert rows(got) == _contaminated(docs, items)


def test_decontamination_odd_rows(spark, odd, empty, clashing):
    bench = spark.createDataFrame([(1, "one two three four five six"), (2, "")], "item_id long, text string")
    for docs in (odd, clashing):
        out = decontam.decontaminate(docs, bench)
        assert out.count() == len(ODD) and out.where("n_hit > 0").count() == 2
    assert decontam.decontaminate(empty, bench).isEmpty()
    assert decontam.decontaminate(odd, bench.limit(0)).where("n_hit > 0").isEmpty()


def test_proximity_equals_brute_force(spark, monkeypatch):
    """All words of a window, each as often as there, in any order among ``slop`` more consecutive words."""
    rng = np.random.default_rng(6)
    word = lambda: f"w{rng.zipf(1.2) % 60}"
    items = [(k, " ".join(word() for _ in range(n))) for k, n in enumerate((3, 5, 10, 14))]
    docs = []
    for i in range(30):
        w = items[i % 4][1].split()[:10]
        for _ in range(int(rng.integers(0, 7))):
            w.insert(int(rng.integers(0, len(w) + 1)), word())
        w = [w[k] for k in rng.permutation(len(w))] if i % 3 == 0 else w
        docs.append((i, " ".join([word() for _ in range(15)] + w + [word() for _ in range(15)])))
    docs += [(90, items[2][1].split()[0] + " " + items[2][1].split()[1]), (91, None)]
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")

    def near(text, slop):
        w, out = (text or "").split(), set()
        for i, t in items:
            t = t.split()
            for k in range(max(1, len(t) - 9)):
                own = t[k : k + 10]
                for a in range(len(w)):
                    part = w[a : a + len(own) + slop]
                    if all(part.count(x) >= own.count(x) for x in own):
                        out.add(str(i))
        return sorted(out)

    monkeypatch.setattr(decontam, "BLOCK", 16)
    for slop in (0, 4):
        got = {r["doc_id"]: r["near_items"] for r in decontam.decontaminate(df, bench, slop=slop).select("row.doc_id", "near_items").collect()}
        assert got == {i: near(t, slop) for i, t in docs}


def test_decontamination_of_a_long_text_in_blocks(spark):
    """A short item on every place of a very long text, a phrase across a border of blocks, and items with equal windows."""
    filler = [f"f{i}" for i in range(decontam.BLOCK - 5)]
    phrase = [f"p{i}" for i in range(10)]
    docs = [(1, "hot " * 50_000), (2, " ".join(filler + phrase + filler)), (2, " ".join(filler + phrase + filler)), (3, " ".join(filler + phrase[1:] + filler))]
    items = [("a", "hot"), ("b", " ".join(phrase)), ("c", " ".join(phrase)), ("b", None)]
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id string, text string")
    got = rows(decontam.decontaminate(df, bench).select("row.doc_id", "n_hit", F.array_join("items", ","), F.size("spans")))
    n = decontam.BLOCK - 5
    assert got == [(1, 50_000, "a", 1), (2, 10, "b,c", 1), (2, 10, "b,c", 1), (3, 0, "", 0)]
    assert decontam.decontaminate(df, bench).where("row.doc_id = 2").first()["spans"] == [[n, n + 10]]


# 10 BPE


def test_bpe_equals_the_library(spark, odd, empty, clashing):
    from tokenizers import Tokenizer

    tk = Tokenizer.from_file(WORD_BPE)
    tk.no_truncation()
    tk.no_padding()
    docs = list(enumerate(TEXTS)) + [(50, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    ids = {r["doc_id"]: r["ids"] for r in bpe.bpe_encode(df, WORD_BPE).collect()}
    text = {r["doc_id"]: r["text"] for r in bpe.bpe_decode(bpe.bpe_encode(df, WORD_BPE), WORD_BPE).collect()}
    digest = {r["doc_id"]: tuple(r)[1:] for r in bpe.bpe_digests(df, WORD_BPE).collect()}
    for i, t in docs:
        want = tk.encode(t or "", add_special_tokens=False).ids
        back = tk.decode(want, skip_special_tokens=False)
        assert ids[i] == want and text[i] == back
        assert digest[i] == (len(want), hashlib.sha256(" ".join(map(str, want)).encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest())
    for docs in (odd, clashing):
        assert bpe.bpe_digests(docs, WORD_BPE).count() == len(ODD)
    assert bpe.bpe_digests(empty, WORD_BPE).isEmpty()


def test_compatible_neighbours_are_those_exact_merging_leaves():
    coder, rng = bpe.WordEncoder.of(WORD_BPE), np.random.default_rng(0)
    names = {i: s for s, i in coder.ids.items()}
    inner = np.array([i for i, s in names.items() if not any(ord(c) >= coder.END for c in s)])
    a, b = rng.choice(inner, 3000), rng.choice(np.array(list(names)), 3000)
    fits = coder.compatible(a, b)
    for x, y, ok in zip(a.tolist(), b.tolist(), fits.tolist(), strict=True):
        assert ok == (coder.exact(names[x] + names[y]) == [x, y])


# The pipeline


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline

    rng = np.random.default_rng(4)
    vocab = ["".join(rng.choice(list("aeioulmnrst"), 4)) for _ in range(200)]
    make = lambda n: " ".join(rng.choice(vocab, n))
    item = make(30)
    near = make(80).split()
    docs = [(i, make(60), "en") for i in range(30)] + [(40, " ".join(near), "en"), (41, " ".join([*near[:-1], "zzz"]), "en"), (50, make(20) + " " + item, "en"), (60, None, "en"), (61, "12345", "en")]
    df = spark.createDataFrame([(i, t, k, "s", len(t or "")) for i, t, k in docs], SCHEMA)
    df.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert {r["doc_id"] for r in out.collect()} == set(range(30)) | {40}
    docs = corpus_pipeline.table(spark, str(tmp_path), "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == df.columns


def test_pipeline_stages_take_odd_rows(spark, tmp_path, clashing, empty):
    """Nulls, empty, blank and very long texts, repeated rows and ids, names that clash with those used inside, and empty tables, stage by stage."""
    import corpus_pipeline

    spark.createDataFrame([("i", "another text with the same id")], "item_id string, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    none = tmp_path / "none"
    spark.createDataFrame([], "item_id string, text string").write.parquet(str(none / "benchmark.parquet"))
    key = lambda df: rows(df.select("doc_id", F.coalesce(F.substring("text", 1, 12), F.lit("?"))))
    stages = dict(corpus_pipeline.STAGES)
    seen = {n: stages[n](spark, clashing, str(tmp_path)) for n in ("language", "lines", "near_duplicates", "decontaminated")}
    for name, out in seen.items():
        assert out.columns == clashing.columns, name
    letters = [r for r in ODD if r[1] and re.search("[a-zÀ-ɏ漢字]", r[1])]
    assert set(key(seen["language"])) <= {(r[0], r[1][:12]) for r in letters} and len(key(seen["language"])) >= 5
    # The long text on one line is a run of its own, and none repeats.
    assert key(seen["lines"]) == key(clashing)
    assert len(key(seen["near_duplicates"])) == len(ODD) - 1
    assert key(seen["decontaminated"]) == sorted(((r[0], "?" if r[1] is None else r[1][:12]) for r in ODD if r[1] != "another text with the same id"), key=str)
    assert key(stages["decontaminated"](spark, clashing, str(none))) == key(clashing)
    assert stages["tokens"](spark, clashing, "").count() == len(ODD)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).isEmpty(), name


def test_one_row_of_each_group_stays(spark, odd, empty):
    """Repeated rows, a repeated id with similar texts, groups of null ids only, and rows without words."""
    import corpus_pipeline

    left = rows(corpus_pipeline.near_duplicates(spark, odd, ""))
    assert left == sorted(set(ODD[:6]) | set(ODD[7:]), key=str) and len(left) == len(ODD) - 1
    a, b, c = ([f"{k}{i}" for i in range(80)] for k in "abc")
    texts = [" ".join(x) for w in (a, b, c) for x in (w, [*w[:-1], "z"])]
    docs = [(7, texts[0]), (7, texts[1]), (7, texts[0]), (None, texts[0]), (None, texts[2]), (None, texts[3]), (None, texts[2]), (9, texts[4]), (8, texts[5]), (None, texts[4]), (1, ""), (1, ""), (2, None)]
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in docs], SCHEMA)
    got = [(r["doc_id"], r["text"]) for r in corpus_pipeline.near_duplicates(spark, df, "").collect()]
    assert len(got) == 6 and sorted(x for x in got if not x[1]) == [(1, ""), (1, ""), (2, None)]
    (x, s), (y, t), (z, u) = sorted((x for x in got if x[1]), key=lambda r: r[1])
    assert (x, y, z) == (7, None, 8) and s in texts[:2] and t in texts[2:4] and u == texts[5]
    assert corpus_pipeline.near_duplicates(spark, empty, "").isEmpty()
