"""Substring dedup on words by recompression.

Names are hashes of what they stand for, so that all tasks name alike without asking one another. Two levels follow on the words'
names: runs of one word become a symbol; then neighbours become one symbol where a coin of the left name is 0 and of the right
one is 1. Whether two symbols merge depends on these two alone, so equal substrings get the same symbols inside: of a window of
13 words all second-level boundaries from offset 3 to 10 are set by the window itself, and, as a symbol other than a run has at
most 4 words, one is there (a run counts as a boundary at each of its words). A window's key is the smallest name of the 6
words around such a boundary. Windows of one key in a row are a high-level symbol; shared ones reveal repeats, and the words
themselves, compared as bytes, verify them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .windows import MASK48, Batch, Runs, alike, covered, mixed, names, pieces, ranges, runs_of, spans_of

WINDOW = 13
_FAR = np.uint64(2**64 - 1)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_CHUNK, _PIECE = 1 << 19, 1 << 18


class Words:
    """Words of a batch: its texts with one space after each word and nothing else between them, the words' byte bounds there, their
    names (hashes), and each document's bounds among the words."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        starts, ends, parts, bounds, at, n = [], [], [], [np.zeros(1, np.int64)], 0, 0
        for a, b in _chunks(offsets):
            # a space after each document ends its last word
            stop = offsets[a + 1 : b + 1] - offsets[a]
            chunk = np.insert(data[offsets[a] : offsets[b]], stop, 0x20)
            part = ~_SPACE[chunk]
            before = np.concatenate([[False], part[:-1]])
            kept = part | before
            place, first = np.cumsum(kept) - kept, part & ~before
            starts.append(place[first] + at)
            ends.append(place[before & ~part] + at)
            parts.append(np.where(part, chunk, np.uint8(0x20))[kept])
            bounds.append(np.cumsum(first)[stop + np.arange(len(stop))] + n)
            at, n = at + len(parts[-1]), int(bounds[-1][-1])
        self.data = np.concatenate(parts) if parts else np.zeros(0, np.uint8)
        self.start = np.concatenate(starts) if starts else np.zeros(0, np.int64)
        self.end = np.concatenate(ends) if ends else np.zeros(0, np.int64)
        self.bounds, self.size = np.concatenate(bounds), len(self.start)
        self.name = names(self.data, self.start, self.end)


def _chunks(offsets: np.ndarray, most: int = _CHUNK):
    """(first, last + 1) of consecutive documents of ``most`` bytes or one document."""
    a = 0
    while a < len(offsets) - 1:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + most, side="right")) - 1)
        yield a, b
        a = b


def boundaries(x: np.ndarray, fresh: np.ndarray) -> np.ndarray:
    """Where a second-level symbol begins or a run goes on; x: names of words; fresh: where a document starts."""
    same = np.zeros(len(x) + 1, bool)
    same[1:-1] = (x[1:] == x[:-1]) & ~fresh[1:]
    run = same[:-1] | same[1:]  # words of a run of two or more
    coin = mixed(x, 101) & np.uint64(1)
    first = ~same[:-1]  # a run is one symbol
    merge = (coin[:-1] == 0) & (coin[1:] == 1) & ~run[:-1] & ~run[1:] & ~fresh[1:]
    first[1:] &= ~merge
    at = np.flatnonzero(first)
    size = np.diff(np.append(at, len(x)))
    second = np.minimum(at + 1, len(x) - 1)
    pair = (size == 2) & ~run[at]
    name = np.where(pair, mixed(x[at] ^ mixed(x[second], 103), 105), mixed(x[at] ^ size.astype(np.uint64), 107))
    coin = mixed(name, 109) & np.uint64(1)
    merge = (coin[:-1] == 0) & (coin[1:] == 1) & ~run[at[:-1]] & ~run[at[1:]] & ~fresh[at[1:]]
    out = first.copy()
    out[at[1:][merge]] = False
    return out | same[:-1]


class WordScheme:
    window = WINDOW

    def symbols(self, data: np.ndarray, offsets: np.ndarray) -> Words:
        return Words(data, offsets)

    def runs(self, w: Words) -> Runs:
        return Runs.joined([self._runs(w.name[lo:hi], bounds, doc, lo) for doc, lo, hi, bounds in pieces(w.bounds, WINDOW, _PIECE) if hi - lo >= WINDOW])

    def _runs(self, x: np.ndarray, bounds: np.ndarray, doc: int, lo: int) -> Runs:
        n = len(x)
        fresh = np.zeros(n + 1, bool)
        fresh[bounds] = True
        fresh = fresh[:-1]
        gram = np.full(n, _FAR)  # at a boundary p: the name of words p - 3 to p + 2
        g = np.zeros(n - 5, np.uint64)
        for j in range(6):
            g = mixed(g ^ x[j : n - 5 + j], 211 + j)
        gram[3 : n - 2] = g
        gram[~boundaries(x, fresh)] = _FAR
        low = gram
        for step in (1, 2, 4):  # smallest of 8 in a row
            low = np.minimum(low[: len(low) - step], low[step:])
        m = n - WINDOW + 1
        key = low[3 : 3 + m]
        left = np.repeat(bounds[1:], np.diff(bounds)) - np.arange(n)
        first, count = runs_of(key, left[:m] >= WINDOW, fresh[:m])
        return Runs((np.searchsorted(bounds, first, side="right") - 1 + doc).astype(np.int32), (first + lo).astype(np.int32), count.astype(np.int32), mixed(key[first], 307) & MASK48)

    def span(self, w: Words, first: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Byte range of n windows from the first on."""
        return w.start[first], w.end[first + n + WINDOW - 2]

    def windows(self, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Number of windows of each string, words and single spaces."""
        spaces = np.concatenate([[0], np.cumsum(data == 0x20)])
        return spaces[start + size] - spaces[start] + 2 - WINDOW

    def compare(self, data: np.ndarray, start: np.ndarray, size: np.ndarray, count: np.ndarray, ids: np.ndarray, row: np.ndarray) -> np.ndarray:
        """For each window of some strings, whether one of a smaller id has its 13 words too; compared as bytes."""
        data = data[ranges(start, size)]
        last = np.cumsum(size)
        space = np.flatnonzero(data == 0x20)
        # words of all strings, in a row: a string's first word starts with it, its last one ends with it
        begin = np.sort(np.concatenate([last - size, space + 1]))
        end = np.sort(np.concatenate([last, space]))
        words = count + WINDOW - 1
        w = ranges(np.cumsum(words) - words, count)
        a, b, d = begin[w], end[w + WINDOW - 1], np.repeat(ids, count)
        group = alike(data, a, b, names(data, a, b))
        order = np.lexsort((d, group))
        new = np.concatenate([[True], group[order][1:] != group[order][:-1]])
        hit = np.empty(len(d), bool)
        hit[order] = d[order] > d[order][new][np.cumsum(new) - 1]
        return hit


_DONE = "doc_id long, n_words long, n_removed long, spans array<struct<first:bigint,last:bigint>>, kept string"


def _finish(b: Batch, mask: np.ndarray) -> pa.Table:
    w = b.symbols
    spans, _, removed = spans_of(mask, w.bounds)
    # kept words with the space after each, but the one after a document's last
    left = np.repeat(~mask, w.end - w.start + 1)
    kept = np.flatnonzero(~mask)
    upto = np.searchsorted(kept, w.bounds[1:])
    some = upto > np.searchsorted(kept, w.bounds[:-1])
    left[w.end[kept[upto[some] - 1]]] = False
    ends = np.concatenate([w.start, [len(w.data)]])[w.bounds]
    at = np.concatenate([[0], np.cumsum(left)])[ends].astype(np.int32)
    text = pa.Array.from_buffers(pa.string(), len(w.bounds) - 1, [None, pa.py_buffer(at.tobytes()), pa.py_buffer(w.data[left].tobytes())])
    return pa.table({"doc_id": b.ids, "n_words": pa.array(np.diff(w.bounds).astype(np.int64)), "n_removed": pa.array(removed.astype(np.int64)), "spans": spans.cast(pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))), "kept": text})


def repeated_words(documents: DataFrame) -> DataFrame:
    """Per document row: doc_id, n_words, n_removed, spans (words, from 0, both ends included), kept (words joined by a space).

    Removed is each word covered by a window of 13 words that also starts in a document with a smaller id. Null text: no words.
    A null doc_id is neither smaller nor larger than another: nothing of it is removed or removes. Rows that share
    an id don't remove one another. Windows end with their document. An empty table gives no rows; further columns are
    left out. A text has to fit a Python worker, with about 40 bytes of memory a byte.
    """
    return covered(documents, WordScheme(), F.col("doc_id"), F.col("text"), _finish, _DONE)
