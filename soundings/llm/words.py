"""Words of whole Arrow columns as numpy arrays: spans, 64-bit hashes and shingles.

A text column is one byte buffer with offsets, so splitting and hashing take a few
passes over that buffer and no loop over texts or words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLANK = np.zeros(256, bool)
BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Bytes of words made of digits, lower-case letters and everything beyond ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_ODD = 0x9E3779B97F4A7C15
_BASE = 0xD6E8FEB86659FD93


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of uint64 values (an invertible finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Masks that keep the first k bytes of a block of eight.
_HEAD = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)


@dataclass
class Words:
    """Words of a run of documents. ``doc`` is the row of each word, ``bounds`` the first word of each row."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    bounds: np.ndarray
    n_docs: int

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def _blocks(self, which: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Blocks of eight bytes of the words (all, or those numbered in ``which``) end to end, the last of each filled up with zeros; how many each has, and its first."""
        start, end = (self.start, self.end) if which is None else (self.start[which], self.end[which])
        size = end - start
        many = (size + 7) >> 3
        first = np.cumsum(many) - many
        padded = np.concatenate((self.data, np.zeros(8, np.uint8)))
        eight = np.ndarray((len(self.data) + 1,), np.uint64, padded, strides=(1,))
        values = eight[start]
        if len(many) == int(many.sum()):
            return values & _HEAD[size], many, first
        step = np.arange(int(many.sum())) - np.repeat(first, many)
        values = eight[np.repeat(start, many) + 8 * step]
        return values & _HEAD[np.minimum(np.repeat(size, many) - 8 * step, 8)], many, first

    def hashes(self) -> np.ndarray:
        """64-bit hashes; equal words have equal ones in every batch and task. Each block of eight bytes is mixed with its place
        in the word before blocks are added up, so no structure of a word carries over to its hash."""
        values, many, first = self._blocks()
        if len(values) == len(many):
            h = mix(values + np.uint64(_BASE))
        else:
            step = (np.arange(len(values)) - np.repeat(first, many)).astype(np.uint64)
            h = np.add.reduceat(mix(values + mix(step * np.uint64(_ODD)) * np.uint64(3) + np.uint64(_BASE)), first)
        return mix(h + (self.end - self.start).astype(np.uint64) * np.uint64(_ODD))

    def distinct(self) -> tuple[np.ndarray, list[bytes], np.ndarray]:
        """First place and bytes of each distinct word, and for each word its number among them. Words are told apart by their bytes:
        those that share a hash are held against each other, and where two differ all are sorted out one by one."""
        _, first, place = np.unique(self.hashes(), return_index=True, return_inverse=True)
        data = self.data.tobytes()
        size = self.end - self.start
        same = bool((size == size[first][place]).all())
        if same and len(size):
            own, many, _ = self._blocks()
            heads, of, begin = self._blocks(first)
            same = bool((own == heads[spread(of[place], begin[place])]).all())
        if not same:
            known: dict[bytes, int] = {}
            words = [data[a:b] for a, b in zip(self.start.tolist(), self.end.tolist(), strict=True)]
            place = np.array([known.setdefault(w, len(known)) for w in words], np.int64)
            first = np.unique(place, return_index=True)[1]
        return first, [data[a:b] for a, b in zip(self.start[first].tolist(), self.end[first].tolist(), strict=True)], place

    def text(self, i: int) -> bytes:
        return self.data[self.start[i] : self.end[i]].tobytes()


def split_words(column: pa.Array, inside: np.ndarray | None = None) -> Words:
    """Words of a string column; A-Z is lowered first. ``inside`` marks the bytes of a word (default: all but white space)."""
    inside = ~BLANK if inside is None else inside
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1 + column.offset)[column.offset :]
    raw = column.buffers()[2]
    data = LOWER[np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]]] if raw is not None else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    n = len(data)
    word = inside[data]
    edge = np.zeros(n + 1, bool)  # a text ends here, so a word does
    edge[offsets] = True
    before = np.concatenate(([False], word[:-1])) if n else word
    start = np.flatnonzero(word & (~before | edge[:-1]))
    after = np.concatenate((word[1:], [False])) if n else word
    end = np.flatnonzero(word & (~after | edge[1:])) + 1
    bounds = np.searchsorted(start, offsets)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(bounds))
    return Words(data, start, end, doc, bounds, len(offsets) - 1)


# The UTF-8 forms of white space beyond ASCII.
_WIDE_BLANKS = [c.encode() for c in "\u0085\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"]


_LETTER = np.zeros(256, bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = True
_STOP = np.zeros(256, bool)
_STOP[list(b'.,;:!?"()')] = True


def _stops(data: np.ndarray) -> np.ndarray:
    """Places between an ASCII letter and a stop: words and runs of stops are tokens apart on either side."""
    letter, stop = _LETTER[data], _STOP[data]
    return (letter[:-1] & stop[1:]) | (stop[:-1] & letter[1:])


def split_pieces(column: pa.Array) -> Words:
    """Words as in ``split_words``, cut between letters and stops too."""
    words = split_words(column)
    at = np.flatnonzero(_stops(words.data)) + 1
    if not len(at):
        return words
    start = np.sort(np.concatenate((words.start, at)))
    end = np.sort(np.concatenate((words.end, at)))
    inner = at[np.searchsorted(words.end, at, side="right") == np.searchsorted(words.start, at, side="left") - 1]
    if len(inner) != len(at):  # a text's end lies between the two
        start, end = np.sort(np.concatenate((words.start, inner))), np.sort(np.concatenate((words.end, inner)))
    first = np.append(words.start, len(words.data))[words.bounds]
    bounds = np.searchsorted(start, first)
    bounds[-1] = len(start)
    return Words(words.data, start, end, np.repeat(np.arange(words.n_docs), np.diff(bounds)), bounds, words.n_docs)


def split_chunks(column: pa.Array) -> Words:
    """Cut texts before each space or line feed that follows a character other than white space,
    after such a line feed, and between letters and stops.

    No token of the public tokenizers spans such a place, so chunks can be encoded one by one.
    The chunks of a text, end to end, are the text."""
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1 + column.offset)[column.offset :]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    solid = (data > 0x20) & (data != 0x7F)
    cut = ((data[1:] == 0x20) | (data[1:] == 0x0A)) & solid[:-1]
    cut = np.flatnonzero(cut) + 1
    wide = data[cut - 1] >= 0x80
    if wide.any():
        at, bad = cut[wide], np.zeros(int(wide.sum()), bool)
        for blank in _WIDE_BLANKS:
            same = at >= len(blank)
            for k in range(1, len(blank) + 1):
                same &= data[np.maximum(at - k, 0)] == blank[-k]
            bad |= same
        keep = np.ones(len(cut), bool)
        keep[np.flatnonzero(wide)[bad]] = False
        cut = cut[keep]
    edge = np.zeros(len(data) + 1, bool)
    edge[cut] = True
    feed = cut[(data[cut] == 0x0A) & (cut + 1 < len(data))]
    edge[feed[_LETTER[data[feed + 1]]] + 1] = True
    if len(data) > 1:
        edge[1:-1] |= _stops(data)
    edge[offsets] = True
    places = np.flatnonzero(edge)
    start, end = places[:-1], places[1:]
    bounds = np.searchsorted(start, offsets)
    return Words(data, start, end, np.repeat(np.arange(len(offsets) - 1), np.diff(bounds)), bounds, len(offsets) - 1)


def spread(lengths: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Indexes of runs laid end to end: run i has ``lengths[i]`` entries from ``begins[i]`` on."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(begins - before, lengths) + np.arange(int(lengths.sum()))


def slices(batch: pa.RecordBatch, column: str, most: int = 2 << 20, inside: str | None = None) -> Iterator[pa.RecordBatch]:
    """Runs of rows whose texts hold about ``most`` bytes, so that scratch arrays stay small; a longer text is a run of its own.

    The texts are ``column``, or the field of that name of the struct column ``inside``."""
    texts = batch.column(inside).field(column) if inside else batch.column(column)
    sizes = np.asarray(pc.binary_length(texts).fill_null(0), np.int64)
    total, first = 0, 0
    for i, size in enumerate(sizes):
        if total and total + size > most:
            yield batch.slice(first, i - first)
            total, first = 0, i
        total += size
    if first < batch.num_rows:
        yield batch.slice(first)
    pa.default_memory_pool().release_unused()  # workers live on between tasks


def shingle_sets(words: Words, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of every row, end to end, and where each row begins.

    A row with fewer words than ``width``, but some, has its whole word sequence as its one shingle.
    """
    h, n = words.hashes(), words.counts
    out, sizes = [], np.zeros(words.n_docs, np.int64)
    steps = mix(np.arange(1, width + 1, dtype=np.uint64) * np.uint64(_BASE)) | np.uint64(1)
    full = np.zeros(0, np.uint64)
    if len(h) >= width:
        full = np.zeros(len(h) - width + 1, np.uint64)
        for k in range(width):
            full += mix(h[k : len(h) - width + 1 + k] + steps[k]) * steps[k]
        full = mix(full)
    for d in range(words.n_docs):
        a, b = words.bounds[d], words.bounds[d + 1]
        if b - a >= width:
            s = np.sort(full[a : b - width + 1])
            s = s[np.concatenate(([True], s[1:] != s[:-1]))]
        elif b > a:
            s = np.array([b - a], np.uint64)
            for k in range(b - a):
                s = mix(s * np.uint64(_ODD) + h[a + k])
        else:
            continue
        out.append(s)
        sizes[d] = len(s)
    return (np.concatenate(out) if out else np.zeros(0, np.uint64)), np.concatenate(([0], np.cumsum(sizes)))
