"""Byte-pair encoding by speculation: greedy longest match, a vectorised check of neighbours, exact merging where it fails."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .words import Words, slices, split_chunks, split_pieces, spread

CACHE_SIZE = 200_000


#: The file's own split pattern for ASCII, with letters up to U+024F counted in; texts beyond that go through the library's splitter.
_PLAIN = re.compile(r"[\x21-\x7e\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u01ba]+")
_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+|[0-9]|[^a-z0-9\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+")


def _byte_names() -> list[str]:
    """The printable character that byte-level vocabularies use for each byte: printable bytes stand for themselves, others follow from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return [chr(b) if b in own else chr(0x100 + rest.index(b)) for b in range(256)]


_BYTES = _byte_names()
_ASCII_LETTERS = re.compile(r"[a-z]+")


class WordEncoder:
    """A tokenizer of word pieces with word ends, from the file of the tokenizers library.

    A word is a string of symbols: one character for each byte, the last one moved up by ``END``.
    The library's own normalizer and splitter make the words; ids come from the merges here."""

    END = 0x400
    _own: dict[str, WordEncoder] = {}

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        vocab, suffix = spec["model"]["vocab"], spec["model"]["end_of_word_suffix"]
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.names = {i: t for t, i in vocab.items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}

        def symbols(token: str) -> str:
            if token.endswith(suffix) and token != suffix:
                token = token[: -len(suffix)]
                return token[:-1] + chr(ord(token[-1]) + self.END)
            return token

        self.ids = {symbols(t): i for t, i in vocab.items() if t not in self.special}
        n = max(self.names) + 1
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        self.rank = {(vocab[a], vocab[b]): r for r, (a, b) in enumerate(pairs)}
        made_by = {(vocab[a], vocab[b]): vocab[a + b] for a, b in pairs}
        self.product = [vocab[a + b] for a, b in pairs]
        # Merge order by id: 0 for what no merge makes, else its rank + 1.
        self.order = np.zeros(n, np.int64)
        self.left, self.right = np.full(n, -1), np.full(n, -1)
        for (a, b), c in made_by.items():
            self.order[c] = self.rank[a, b] + 1
            self.left[c], self.right[c] = a, b
        codes = np.array([a * n + b for a, b in made_by], np.int64)
        by = np.argsort(codes)
        self.codes, self.code_order, self.n = codes[by], np.array([self.rank[p] + 1 for p in made_by])[by], n
        self.reach: dict[str, int] = {}  # the longest token by its first two symbols
        for t in self.ids:
            self.reach[t[:2]] = max(self.reach.get(t[:2], 1), len(t))
        made = np.flatnonzero(self.left >= 0)
        self.sound = np.ones(n, bool)  # tokens that exact merging leaves whole
        self.sound[made] = self.compatible(self.left[made], self.right[made], self.order[made])
        for c in made[np.argsort(self.order[made])]:
            self.sound[c] &= self.sound[self.left[c]] and self.sound[self.right[c]]
        self.cache: dict[str, tuple[int, ...]] = {}

    @classmethod
    def of(cls, path: str) -> WordEncoder:
        if path not in cls._own:
            cls._own[path] = cls(path)
        return cls._own[path]

    def compatible(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray | None = None) -> np.ndarray:
        """Whether no merge joins the neighbours ``a`` and ``b`` before each is complete.

        The later made of the two is taken apart again and again; a merge over the border that comes
        before the part it would have used was consumed speaks against the pair."""
        a, b = a.copy(), b.copy()
        limit = np.full(len(a), np.iinfo(np.int64).max) if limit is None else limit.copy()
        good, live = np.ones(len(a), bool), np.arange(len(a))
        while len(live):
            x, y = a[live], b[live]
            code = x * self.n + y
            at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
            merged = (self.codes[at] == code) & (self.code_order[at] < limit[live])
            good[live[merged]] = False
            more = ~merged & ((self.left[x] >= 0) | (self.left[y] >= 0))
            live, x, y = live[more], x[more], y[more]
            first = self.order[x] > self.order[y]  # else the right one, which of equals is made later
            limit[live] = np.where(first, self.order[x], self.order[y] + 1)
            a[live] = np.where(first, self.right[x], x)
            b[live] = np.where(first, y, self.left[y])
        return good

    def greedy(self, word: str) -> list[int]:
        at, out, ids, reach = 0, [], self.ids, self.reach
        while at < len(word):
            for end in range(min(len(word), at + reach.get(word[at : at + 2], 1)), at, -1):
                found = ids.get(word[at:end])
                if found is not None:
                    out.append(found)
                    at = end
                    break
            else:
                raise ValueError(f"no token for {word[at]!r}")
        return out

    def exact(self, word: str) -> list[int]:
        """Merge the lowest ranked pair, leftmost first, until none is left."""
        parts = [self.ids[c] for c in word]
        rank, none = self.rank.get, 1 << 60
        ranks = [rank(p, none) for p in zip(parts, parts[1:], strict=False)]
        while ranks and (low := min(ranks)) != none:
            i = ranks.index(low)
            parts[i : i + 2] = [self.product[low]]
            del ranks[i]
            if i:
                ranks[i - 1] = rank((parts[i - 1], parts[i]), none)
            if i < len(ranks):
                ranks[i] = rank((parts[i], parts[i + 1]), none)
        return parts

    def encode_words(self, words: list[str]) -> list[tuple[int, ...]]:
        """Ids of distinct words: proposed for all, then checked at once, then merged exactly where a check failed."""
        proposed = [self.greedy(w) for w in words]
        n = np.fromiter(map(len, proposed), np.int64, len(proposed))
        flat = np.array([i for p in proposed for i in p], np.int64)
        owner = np.repeat(np.arange(len(words)), n)
        bad = np.zeros(len(words), bool)
        bad[owner[~self.sound[flat]]] = True
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        code, place = np.unique(flat[inner] * self.n + flat[inner + 1], return_inverse=True)
        fits = self.compatible(code // self.n, code % self.n)[place]
        bad[owner[inner[~fits]]] = True
        for i in np.flatnonzero(bad):
            proposed[i] = self.exact(words[i])
        return [tuple(p) for p in proposed]

    def encode_chunks(self, chunks: list[str]) -> list[tuple[int, ...]]:
        split, wanted = [], {}
        normal, pieces = self.library.normalizer.normalize_str, self.library.pre_tokenizer.pre_tokenize_str
        letters, plain = _ASCII_LETTERS.fullmatch, _PLAIN.fullmatch
        for chunk in chunks:
            if letters(chunk):
                words = [chunk[:-1] + chr(ord(chunk[-1]) + self.END)]
            elif plain(chunk) and "<|" not in chunk:
                words = []
                for w in _WORDS.findall(chunk.lower()):
                    w = w if w.isascii() else "".join([_BYTES[b] for b in w.encode()])
                    words.append(w[:-1] + chr(ord(w[-1]) + self.END))
            elif any(s in chunk for s in self.special):
                split.append(None)
                continue
            else:
                words = [w[:-1] + chr(ord(w[-1]) + self.END) for w, _ in pieces(normal(chunk))]
            for w in words:
                if w not in self.cache:
                    wanted[w] = ()
            split.append(words)
        new = list(wanted)
        wanted = dict(zip(new, self.encode_words(new), strict=True)) if new else {}
        out = []
        for chunk, words in zip(chunks, split, strict=True):
            if words is None:
                out.append(tuple(self.library.encode(chunk, add_special_tokens=False).ids))
            elif len(words) == 1:
                out.append(self.cache[words[0]] if words[0] in self.cache else wanted[words[0]])
            else:
                out.append(tuple(i for w in words for i in (self.cache[w] if w in self.cache else wanted[w])))
        if len(self.cache) < CACHE_SIZE:  # words that are chunks of their own are in the cache of chunks
            self.cache |= {w: wanted[w] for words in split if words and len(words) > 1 for w in words if w in wanted}
        return out


class TextEncoder:
    """Ids of whole texts by their distinct chunks; a bounded cache keeps frequent chunks between batches."""

    _own: dict[str, TextEncoder] = {}

    def __init__(self, path: str) -> None:
        self.words = WordEncoder.of(path)
        self.cache: dict[bytes, tuple[int, ...]] = {}

    @classmethod
    def of(cls, path: str) -> TextEncoder:
        if path not in cls._own:
            cls._own[path] = cls(path)
        return cls._own[path]

    @staticmethod
    def _split(texts: pa.Array) -> Words:
        """White space and case make no difference to the ids, except where a special token may stand."""
        exact = pc.any(pc.match_substring(texts, "<|")).as_py()
        return split_chunks(texts) if exact else split_pieces(texts)

    def distinct(self, texts: pa.Array):
        """The chunks of the texts, the ids of each distinct chunk, and each chunk's place among those."""
        chunks = self._split(texts)
        _, keys, place = chunks.distinct()
        found = [self.cache.get(k) for k in keys]
        new = [i for i, x in enumerate(found) if x is None]
        for i, ids in zip(new, self.words.encode_chunks([keys[i].decode() for i in new]), strict=True):
            found[i] = ids
            if len(self.cache) < CACHE_SIZE:
                self.cache[keys[i]] = ids
        return chunks, found, place


def bpe_encode(docs: DataFrame, tokenizer: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id`` and ``ids`` (array<int>) of every whole text; null and empty texts have no ids. One map over rows, no shuffle.

    Repeated rows are each encoded. Strings of special tokens in a text become those tokens, as in the library."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = TextEncoder.of(tokenizer)
        for whole in batches:
            for batch in slices(whole, "text"):
                chunks, found, place = coder.distinct(batch.column("text"))
                n = np.fromiter(map(len, found), np.int64, len(found))
                flat = np.array([i for x in found for i in x], np.int32)
                each = n[place] if len(place) else np.zeros(0, np.int64)
                ids = flat[spread(each, (np.cumsum(n) - n)[place])] if len(each) else flat
                offsets = np.concatenate(([0], np.cumsum(each)))[chunks.bounds]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))], names=["doc_id", "ids"])

    own = docs.selectExpr(f"`{doc_id}` as doc_id", f"`{text}` as text")
    kind = own.schema["doc_id"].dataType.simpleString()
    return own.mapInArrow(encode, f"doc_id {kind}, ids array<int>")


def bpe_decode(rows: DataFrame, tokenizer: str) -> DataFrame:
    """``doc_id`` and ``text`` of ``ids``: the file names no decoder, so token strings are joined by one space. Null ids give null, no ids give empty text; repeated rows are each decoded."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = WordEncoder.of(tokenizer).names
        for batch in batches:
            texts = [None if x is None else " ".join([names[i] for i in x]) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", "ids").mapInArrow(decode, f"doc_id {kind}, text string")


def bpe_digests(docs: DataFrame, tokenizer: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Encode and decode every whole text; return counts and SHA-256 of the ids (decimal, one space between) and of the decoded text.

    Null and empty texts have no ids and decode to empty text; very long texts are encoded whole, a run of their own each; repeated rows are each returned,
    equal texts with equal digests; special tokens written out in a text become those tokens.

    Decimal and decoded forms are made once for each distinct chunk of a batch and joined for each text."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = TextEncoder.of(tokenizer)
        names = coder.words.names
        for whole in batches:
            for batch in slices(whole, "text"):
                chunks, found, place = coder.distinct(batch.column("text"))
                n = np.fromiter(map(len, found), np.int64, len(found))
                decimal = [" ".join(map(str, x)).encode() for x in found]
                decoded = [" ".join([names[i] for i in x]).encode() for x in found]
                each = n[place] if len(place) else np.zeros(0, np.int64)
                full = np.flatnonzero(each > 0)  # chunks of white space alone have no ids
                at = np.searchsorted(full, chunks.bounds).tolist()
                order = place[full].tolist()
                total = np.concatenate(([0], np.cumsum(each)))[chunks.bounds]
                a, b = [], []
                for i in range(batch.num_rows):
                    own = order[at[i] : at[i + 1]]
                    a.append(hashlib.sha256(b" ".join([decimal[k] for k in own])).hexdigest())
                    b.append(hashlib.sha256(b" ".join([decoded[k] for k in own])).hexdigest())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.diff(total)), pa.array(a), pa.array(b)], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    own = docs.selectExpr(f"`{doc_id}` as doc_id", f"`{text}` as text")
    kind = own.schema["doc_id"].dataType.simpleString()
    return own.mapInArrow(digest, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
