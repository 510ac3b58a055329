"""Toxicity: a bidirectional gated recurrent network with attention pooling over word and character inputs, trained in numpy.

A text is scored in overlapping windows of 24 words, one from every twelfth word on, so that every passage of up to twelve words stands whole in one;
its score is that of its worst window. Texts carry one label each, so training picks each text's worst window under the current network and
learns from those; embeddings of words and of character n-grams learn with the gates.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructType

from .sampling import per_class
from .words import Words, mix, slices, split_words, spread

WINDOW, STRIDE = 24, 12
HIDDEN, PART = 8, 4
BITS = 18
GRAMS = (4, 5)


def _distinct(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Each word's place among the distinct ones; their word buckets; their character n-grams as (bucket, owner)."""
    h = words.hashes()
    _, first, place = np.unique(h, return_index=True, return_inverse=True)
    h = h[first]
    start, size = words.start[first], words.end[first] - words.start[first]
    # Blank-enclosed copies of the distinct words, end to end.
    to = np.cumsum(size + 2) - (size + 2)
    data = np.full(int((size + 2).sum()), 0x20, np.uint64)
    data[spread(size, to + 1)] = words.data[spread(size, start)]
    owner = np.repeat(np.arange(len(size)), size + 2)
    buckets, owners = [], []
    for n in GRAMS:
        m = len(data) - n + 1
        if m <= 0:
            continue
        key = np.zeros(m, np.uint64)
        for k in range(n):
            key = (key << np.uint64(8)) | data[k : k + m]
        one = np.flatnonzero(owner[:m] == owner[n - 1 :])
        buckets.append((mix(key[one] + np.uint64(n)) >> np.uint64(64 - BITS)).astype(np.int64))
        owners.append(owner[one])
    none = np.zeros(0, np.int64)
    return place, (mix(h) >> np.uint64(64 - BITS)).astype(np.int64), np.concatenate(buckets or [none]), np.concatenate(owners or [none])


def _windows(bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, length and row of every window: one each ``STRIDE`` words until the end is covered."""
    n = np.diff(bounds)
    many = np.where(n > 0, 1 + np.maximum(0, -(-(n - WINDOW) // STRIDE)), 0)
    row = np.repeat(np.arange(len(n)), many)
    begin = spread(many, np.zeros(len(n), np.int64)) * STRIDE
    return bounds[:-1][row] + begin, np.minimum(WINDOW, n[row] - begin), row


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class GatedNetwork:
    """Two gated layers (forward and back), attention over their states, one output. Arrays are float32."""

    word: np.ndarray
    char: np.ndarray
    layers: list[list[np.ndarray]]  # for each direction: input, recurrent and bias of update, reset and candidate
    look: np.ndarray
    out: np.ndarray
    scale: float = 1.0
    shift: float = 0.0
    prior: float = 0.5

    def inputs(self, word: np.ndarray, bucket: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """A row for each distinct word: its own embedding and the sum of its n-grams'; a row of zeros for padding."""
        x = np.zeros((len(word) + 1, 2 * PART), np.float32)
        x[:-1, :PART] = self.word[word]
        for k in range(PART):
            x[:-1, PART + k] = np.bincount(owner, weights=self.char[bucket, k], minlength=len(word))
        return x

    def states(self, projected: list[np.ndarray], index: np.ndarray, mask: np.ndarray, keep: bool):
        """Hidden states of both directions for windows of word indexes; with ``keep``, what the way back needs too."""
        n, length = index.shape
        states, kept = np.zeros((length, n, 2 * HIDDEN), np.float32), []
        for side, (x, (_, u, _)) in enumerate(zip(projected, self.layers, strict=True)):
            h = np.zeros((n, HIDDEN), np.float32)
            for t in range(length) if side == 0 else range(length - 1, -1, -1):
                p, q = x[index[:, t]], h @ u
                zr = p[:, : 2 * HIDDEN] + q[:, : 2 * HIDDEN]
                np.negative(zr, out=zr)
                np.exp(zr, out=zr)
                zr += 1
                np.reciprocal(zr, out=zr)
                z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
                c = np.tanh(p[:, 2 * HIDDEN :] + r * q[:, 2 * HIDDEN :])
                new = c + z * (h - c)
                m = mask[:, t, None]
                if keep:
                    kept.append((side, t, h, z, r, c, q[:, 2 * HIDDEN :], m))
                h = np.where(m, new, h)
                states[t, :, side * HIDDEN : (side + 1) * HIDDEN] = h
        return states, kept

    def pool(self, states: np.ndarray, mask: np.ndarray):
        a = np.where(mask.T, states @ self.look, -1e9)
        a = np.exp(a - a.max(axis=0))
        a /= a.sum(axis=0)
        pooled = np.einsum("tn,tnh->nh", a, states)
        return a, pooled, pooled @ self.out[:-1] + self.out[-1]

    def project(self, x: np.ndarray) -> list[np.ndarray]:
        return [x @ w + b for w, _, b in self.layers]

    def logits(self, words: Words, batch: int = 4096) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The logit of every window of a run of texts, its row, and its first word."""
        if not len(words.start):
            return np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.int64)
        place, word, bucket, owner = _distinct(words)
        projected = [p.astype(np.float32) for p in self.project(self.inputs(word, bucket, owner))]
        begin, size, row = _windows(words.bounds)
        steps, scores = np.arange(WINDOW), np.zeros(len(begin))
        for i in range(0, len(begin), batch):
            b, s = begin[i : i + batch], size[i : i + batch]
            mask = steps < s[:, None]
            index = np.where(mask, place[np.minimum(b[:, None] + steps, len(place) - 1)], len(word))
            states, _ = self.states(projected, index, mask, keep=False)
            scores[i : i + batch] = self.pool(states, mask)[2]
        return scores, row, begin

    def scores(self, words: Words) -> np.ndarray:
        """Calibrated probability of each text: its worst window; the prior where it has no word."""
        logit, row, _ = self.logits(words)
        worst = np.full(words.n_docs, -np.inf)
        np.maximum.at(worst, row, logit)
        return np.where(np.isinf(worst), self.prior, _sigmoid(self.scale * np.where(np.isinf(worst), 0, worst) + self.shift))


def _log_odds(bucket: np.ndarray, doc: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """For each bucket, how much likelier it stands in a toxic text, where that is beyond chance; at most 3 either way."""
    code = np.unique(doc.astype(np.int64) << BITS | bucket)
    seen, label = code & ((1 << BITS) - 1), toxic[code >> BITS]
    p = np.bincount(seen[label], minlength=1 << BITS) + 0.5
    q = np.bincount(seen[~label], minlength=1 << BITS) + 0.5
    odds = np.log(p / (toxic.sum() + 1)) - np.log(q / ((~toxic).sum() + 1))
    sure = np.abs(odds) > 3.5 * np.sqrt(1 / p + 1 / q)
    return np.clip(np.where(sure, odds, 0), -3, 3)


def train(texts: list[str], labels: list[int], prior: float, rounds: int = 3, epochs: int = 4, batch: int = 128, rate: float = 0.03, seed: int = 11) -> GatedNetwork:
    """Fit on whole texts. The first coordinate of each embedding starts at its log odds; all weights, the embeddings too, then learn by gradients.

    Every round takes each toxic text's worst window and, of each clean one, its worst and a random window. A fifth of the
    texts calibrates: a logistic of the worst logit, weighted to the share ``prior`` of toxic texts."""
    rng = np.random.default_rng(seed)
    toxic = np.array(labels, bool)
    back = rng.random(len(texts)) < 0.2
    parts, total, at = [], 0, 0
    for i, t in enumerate(texts):
        total += len(t)
        if total > 1 << 20 or i == len(texts) - 1:
            parts.append((at, i + 1, split_words(pa.array(texts[at : i + 1], pa.large_string()))))
            at, total = i + 1, 0
    size = 1 << BITS
    net = GatedNetwork(
        np.zeros((size, PART), np.float32), np.zeros((size, PART), np.float32),
        [[rng.normal(0, 0.3, (2 * PART, 3 * HIDDEN)).astype(np.float32), rng.normal(0, 0.3, (HIDDEN, 3 * HIDDEN)).astype(np.float32), np.zeros(3 * HIDDEN, np.float32)] for _ in range(2)],
        rng.normal(0, 0.3, 2 * HIDDEN).astype(np.float32), rng.normal(0, 0.3, 2 * HIDDEN + 1).astype(np.float32), prior=prior,
    )
    for table, which in ((net.word, 0), (net.char, 1)):
        codes, docs = [], []
        for a, b, words in parts:
            place, word, bucket, owner = _distinct(words)
            pair = np.unique(words.doc.astype(np.int64) * (len(word) + 1) + place)
            d, w = pair // (len(word) + 1), pair % (len(word) + 1)
            if which == 0:
                codes.append(word[w].astype(np.int32))
                docs.append((d + a).astype(np.int32))
            else:
                by = np.argsort(owner, kind="stable")
                n = np.bincount(owner, minlength=len(word))
                first = np.cumsum(n) - n
                grams = np.unique(np.repeat(d + a, n[w]) << BITS | bucket[by][spread(n[w], first[w])])
                codes.append((grams & (size - 1)).astype(np.int32))
                docs.append((grams >> BITS).astype(np.int32))
        codes, docs = np.concatenate(codes), np.concatenate(docs)
        own = ~back[docs]
        table[:, 0] = _log_odds(codes[own], docs[own], toxic)
        table[:, 1:] = rng.normal(0, 0.02, (size, PART - 1))
    params = [p for layer in net.layers for p in layer] + [net.look, net.out]
    speed = [np.full(p.shape, 1e-3, np.float32) for p in params]
    pace = [np.full((size, 1), 1e-3, np.float32) for _ in range(2)]
    for _ in range(rounds):
        chosen = []
        for a, b, words in parts:
            logit, row, begin = net.logits(words)
            if not len(row):
                continue
            order = np.lexsort((-logit, row))
            worst = order[np.concatenate(([True], row[order][1:] != row[order][:-1]))]
            other = rng.permutation(len(row))[: len(worst)]
            other = other[~toxic[row[other] + a]]
            place, word, bucket, owner = _distinct(words)
            bucket, many = bucket[np.argsort(owner, kind="stable")].astype(np.int32), np.bincount(owner, minlength=len(word))
            first = np.cumsum(many) - many
            for w in np.concatenate((worst, other)):
                if not back[row[w] + a]:
                    n = min(WINDOW, words.bounds[row[w] + 1] - begin[w])
                    own = place[begin[w] : begin[w] + n]
                    chosen.append((word[own].astype(np.int32), bucket[spread(many[own], first[own])], many[own], float(toxic[row[w] + a])))
        for _ in range(epochs):
            order = rng.permutation(len(chosen))
            for i in range(0, len(order), batch):
                own = [chosen[k] for k in order[i : i + batch]]
                word, bucket, many = (np.concatenate([c[k] for c in own]) for k in range(3))
                x = net.inputs(word, bucket, np.repeat(np.arange(len(word)), many))
                ends = np.cumsum([len(c[0]) for c in own])
                d = _step(net, params, speed, [(x[e - len(c[0]) : e], c[3]) for c, e in zip(own, ends, strict=True)], rate)
                _learn(net.word, pace[0], word, d[:, :PART], rate)
                _learn(net.char, pace[1], bucket, np.repeat(d[:, PART:], many, axis=0), rate)
    worst, gold = [], []
    for a, b, words in parts:
        logit, row, _ = net.logits(words)
        top = np.full(b - a, -np.inf)
        np.maximum.at(top, row, logit)
        use = np.flatnonzero(np.isfinite(top) & back[a:b])
        worst.append(top[use])
        gold.append(toxic[a:b][use])
    x, y = np.concatenate(worst), np.concatenate(gold).astype(float)
    if 0 < y.sum() < len(y):
        weight = np.where(y == 1, prior / y.mean(), (1 - prior) / (1 - y.mean()))
        mid, wide = x.mean(), x.std() + 1e-9
        s, t = 1.0, 0.0
        for _ in range(400):  # logistic regression in one variable, lightly held back
            p = _sigmoid(s * (x - mid) / wide + t)
            g = weight * (p - y)
            s, t = s - 0.5 * (np.mean(g * (x - mid) / wide) + 1e-3 * s), t - 0.5 * np.mean(g)
        net.scale, net.shift = max(s, 0.0) / wide, t - max(s, 0.0) * mid / wide
    return net


def _step(net: GatedNetwork, params: list[np.ndarray], speed: list[np.ndarray], rows: list[tuple[np.ndarray, float]], rate: float) -> np.ndarray:
    """One adaptive gradient step on the logistic loss of a batch of windows, through time in both directions.

    Returns the gradients of the inputs, those of all windows end to end."""
    n = len(rows)
    x = np.zeros((n * WINDOW + 1, 2 * PART), np.float32)
    mask = np.zeros((n, WINDOW), bool)
    for i, (w, _) in enumerate(rows):
        x[i * WINDOW : i * WINDOW + len(w)] = w
        mask[i, : len(w)] = True
    index = np.arange(n * WINDOW).reshape(n, WINDOW)
    y = np.array([t for _, t in rows], np.float32)
    states, kept = net.states(net.project(x), index, mask, keep=True)
    a, pooled, logit = net.pool(states, mask)
    d = ((_sigmoid(logit) - y) / n).astype(np.float32)
    grads = [np.zeros_like(p) for p in params]
    g_look, g_out = grads[-2], grads[-1]
    g_out[:-1], g_out[-1] = pooled.T @ d, d.sum()
    d_pool = d[:, None] * net.out[:-1]
    d_states = a[:, :, None] * d_pool
    d_a = np.einsum("tnh,nh->tn", states, d_pool)
    d_score = a * (d_a - (a * d_a).sum(axis=0))
    g_look += np.einsum("tn,tnh->h", d_score, states)
    d_states += d_score[:, :, None] * net.look
    d_input = np.zeros_like(x)
    carry = [np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)]
    for side, t, h, z, r, c, qc, m in reversed(kept):
        gw, gu, gb = grads[3 * side : 3 * side + 3]
        u = net.layers[side][1]
        dh = carry[side] + d_states[t, :, side * HIDDEN : (side + 1) * HIDDEN]
        dn = np.where(m, dh, 0)
        dc = dn * (1 - z) * (1 - c * c)
        dz = dn * (h - c) * z * (1 - z)
        dr = dc * qc * r * (1 - r)
        dp = np.concatenate((dz, dr, dc), axis=1)
        dq = np.concatenate((dz, dr, dc * r), axis=1)
        gw += x[index[:, t]].T @ dp
        gb += dp.sum(axis=0)
        d_input[index[:, t]] += dp @ net.layers[side][0].T
        gu += h.T @ dq
        carry[side] = np.where(m, dn * z, dh) + dq @ u.T
    for p, g, s in zip(params, grads, speed, strict=True):
        s += g * g
        p -= rate * g / np.sqrt(s)
    return d_input[index[mask]]


def _learn(table: np.ndarray, pace: np.ndarray, at: np.ndarray, grad: np.ndarray, rate: float) -> None:
    """One adaptive step of the rows of an embedding table that a batch has used."""
    rows, place = np.unique(at, return_inverse=True)
    g = np.stack([np.bincount(place, weights=grad[:, k], minlength=len(rows)) for k in range(grad.shape[1])], axis=1).astype(np.float32)
    pace[rows] += (g * g).mean(axis=1, keepdims=True)
    table[rows] -= rate * g / np.sqrt(pace[rows])


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", label: str = "toxic", per_label: int = 1500, key: str = "doc_id") -> GatedNetwork | None:
    """Fit on about ``per_label`` (1,500) whole texts of each label, a documented bound. None unless both labels are there.

    The rows of ``labels`` (``key``, ``label``) are drawn first, so only as many texts as that meet the join."""
    own = labels.where(F.col(label).isin(0, 1)).select(key, label)
    share = own.agg(F.avg(F.col(label).cast("double"))).first()[0]
    if share is None or share in (0.0, 1.0):
        return None
    drawn = per_class(own, label, per_label, (key,))
    got = docs.where(F.col(text).isNotNull()).select(key, text).join(F.broadcast(drawn), key).select(text, label).collect()
    got = sorted((r[1], r[0]) for r in got)
    return train([t for _, t in got], [y for y, _ in got], float(share)) if len({y for y, _ in got}) == 2 else None


def score(docs: DataFrame, net: GatedNetwork | None, text: str = "text") -> DataFrame:
    """``row`` (the input's columns) and ``score`` of every whole text. One map over rows, no shuffle.

    Texts without words, null ones too, get the share of toxic texts among those learned from; without a network all get 0.
    Very long texts are scored whole, window after window. Repeated rows each get their score; equal texts get equal ones."""
    own = docs.select(F.struct("*").alias("row"))
    if net is None:
        return own.select("row", F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(net)  # a fixed number of buckets

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, text, inside="row"):
                p = shared.value.scores(split_words(batch.column("row").field(text)))
                yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(p.astype(float))], names=["row", "score"])

    return own.mapInArrow(run, StructType().add("row", own.schema["row"].dataType).add("score", DoubleType()))
