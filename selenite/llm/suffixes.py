"""Suffix dedup on bytes: merged Burrows-Wheeler transforms find the 50-byte strings that an earlier document has too.

A window's key is the smallest hash of its 20-byte strings, so equal windows, wherever they are, meet under one key, and what
must be ordered together is split by key instead of standing in one index of the whole corpus. Runs of windows that are equal
byte for byte are one string there. The distinct ones: each shard (the strings of some batches) gets its BWT, the
transforms are merged by interleave refinement, seven symbols a round, to a depth of 50, and each interval of the merged order
is one repeated string, with the smallest id that has it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from . import bwt
from .windows import MASK48, Batch, Runs, covered, eights, mixed, names, pieces, ranges, runs_of, spans_of

WINDOW, GRAM, SHARDS = 50, 20, 32
#: Rounds of refinement after the first symbol, seven symbols each.
ROUNDS = (WINDOW - 1) // bwt.PACK
_CHUNK = 1 << 18


class Bytes:
    """Bytes of a batch and each document's bounds."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.bounds, self.size = data, offsets, len(data)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the 20 bytes from each place on."""
    n = len(data) - GRAM + 1
    eight = eights(data)
    h = eight[:n] * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(32)
    h += eight[8 : 8 + n]
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    h += eight[12 : 12 + n]
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(32)
    return h


def shared_context(data: np.ndarray, length: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Which strings may have a 50-byte window with another id's: the gram that is their key has 15 more bytes of any window on
    its right or its left, and strings that share a window share these 35 bytes. Strings with the gram twice are kept."""
    more = (WINDOW - GRAM) // 2
    start = np.cumsum(length) - length
    left = (np.repeat(start + length, length) - np.arange(len(data)))[: len(data) - GRAM + 1]
    h = np.where(left >= GRAM, gram_hashes(data), np.uint64(2**64 - 1))
    at = np.flatnonzero(h == np.repeat(np.minimum.reduceat(h, start), length)[: len(h)])
    own = np.searchsorted(start, at, side="right") - 1
    kept = np.bincount(own, minlength=len(length)) > 1
    first = np.zeros(len(length), np.int64)
    first[own] = at
    for there, a in ((first + GRAM + more <= start + length, first), (first - more >= start, first - more)):
        i = np.flatnonzero(there)
        if len(i):
            name = names(data, a[i], a[i] + GRAM + more)
            order = np.argsort(name, kind="stable")
            new = np.flatnonzero(np.concatenate([[True], name[order][1:] != name[order][:-1]]))
            d = ids[i[order]]
            several = np.minimum.reduceat(d, new) != np.maximum.reduceat(d, new)
            kept[i[order[np.repeat(several, np.diff(np.append(new, len(i))))]]] = True
    return kept


class ByteScheme:
    window = WINDOW

    def symbols(self, data: np.ndarray, offsets: np.ndarray) -> Bytes:
        return Bytes(data, offsets)

    def runs(self, b: Bytes) -> Runs:
        return Runs.joined([self._runs(b.data[lo:hi], bounds, doc, lo) for doc, lo, hi, bounds in pieces(b.bounds, WINDOW, _CHUNK) if hi - lo >= WINDOW])

    def _runs(self, x: np.ndarray, bounds: np.ndarray, doc: int, lo: int) -> Runs:
        low = gram_hashes(x)
        span = WINDOW - GRAM + 1
        step = 1
        while 2 * step <= span:  # smallest of ``step`` in a row, then of ``span``
            low = np.minimum(low[:-step], low[step:])
            step *= 2
        key = np.minimum(low[: len(low) - (span - step)], low[span - step :])
        m = len(x) - WINDOW + 1
        size = np.diff(bounds)
        left = np.repeat(bounds[1:].astype(np.int32), size)[:m] - np.arange(m, dtype=np.int32)
        fresh = np.zeros(len(x) + 1, bool)
        fresh[bounds] = True
        first, count = runs_of(key, left >= WINDOW, fresh[:m])
        return Runs((np.searchsorted(bounds, first, side="right") - 1 + doc).astype(np.int32), (first + lo).astype(np.int32), count.astype(np.int32), mixed(key[first], 307) & MASK48)

    def span(self, b: Bytes, first: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Byte range of n windows from the first on."""
        return first, first + n + WINDOW - 1

    def windows(self, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Number of windows of each string."""
        return size - WINDOW + 1

    def compare(self, data: np.ndarray, start: np.ndarray, size: np.ndarray, count: np.ndarray, ids: np.ndarray, row: np.ndarray) -> np.ndarray:
        """For each window of some strings, whether one of a smaller id has its 50 bytes too. row: the batch's place, for the shard."""
        data = data[ranges(start, size)]
        kept = np.flatnonzero(shared_context(data, size, ids))
        out = np.zeros(int(count.sum()), bool)
        if len(kept):
            self._merge(out, data, kept, row[kept] % SHARDS, ids, count, size)
        return out

    def _merge(self, out: np.ndarray, data: np.ndarray, kept: np.ndarray, shard: np.ndarray, ids: np.ndarray, count: np.ndarray, length: np.ndarray) -> None:
        """Sets out where a window of the ``kept`` strings is also in one of a smaller id; shard: of each of these."""
        strings = [kept[shard == s] for s in np.unique(shard)]
        base, window = np.cumsum(length) - length, np.cumsum(count) - count
        z, place, interval = bwt.repeated([(data[ranges(base[k], length[k])], length[k]) for k in strings], ROUNDS)
        if not len(z):
            return
        doc, at = np.empty(len(z), np.int64), np.empty(len(z), np.int64)
        for s, k in enumerate(strings):
            mine = np.flatnonzero(z == s)
            start = np.cumsum(length[k] + 1) - (length[k] + 1)
            string = np.searchsorted(start, place[mine], side="right") - 1
            doc[mine] = ids[k[string]]
            at[mine] = window[k[string]] + place[mine] - start[string]
        starts = np.flatnonzero(np.concatenate([[True], interval[1:] != interval[:-1]]))
        least = np.minimum.reduceat(doc, starts)
        out[at[doc > np.repeat(least, np.diff(np.append(starts, len(doc))))]] = True


_DONE = "doc_id long, n_bytes long, n_removed long, spans array<struct<first:bigint,last:bigint>>, kept binary"


def _finish(b: Batch, mask: np.ndarray) -> pa.Table:
    bounds = b.offsets
    spans, _, removed = spans_of(mask, bounds)
    kept = b.bytes[~mask]
    at = np.concatenate([[0], np.cumsum(~mask)])[bounds].astype(np.int32)
    binary = pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(at.tobytes()), pa.py_buffer(kept.tobytes())])
    return pa.table({"doc_id": b.ids, "n_bytes": pa.array(np.diff(bounds).astype(np.int64)), "n_removed": pa.array(removed.astype(np.int64)), "spans": spans.cast(pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))), "kept": binary})


def repeated_bytes(documents: DataFrame) -> DataFrame:
    """Per document row: doc_id, n_bytes, n_removed, spans (bytes, from 0, both ends included), kept (the remaining bytes).

    Removed is each byte covered by a 50-byte string that also starts in a document with a smaller id; matches don't cross
    documents. Null text: empty. A null doc_id is neither smaller nor larger than another: nothing of it is removed or
    removes. Rows that share an id don't remove one another. An empty table gives no rows; further columns are left out.
    A text has to fit a Python worker, with about 60 bytes of memory a byte.
    """
    return covered(documents, ByteScheme(), F.col("doc_id"), F.col("text"), _finish, _DONE)


def without_repeats(documents: DataFrame) -> DataFrame:
    """``documents`` with what repeated_bytes() removes cut out of text, and n_removed (bytes) added or replaced.

    Only characters of which every byte is covered go, so that what is left is UTF-8. A text that is cut stays null only if
    it was null. All other columns stay as they are.
    """
    base = documents.drop("n_removed")
    columns = base.columns
    mine = {c: f"_{i}" for i, c in enumerate(columns) if c != "text"}  # names that can't clash with the exchange's own

    def finish(b: Batch, mask: np.ndarray) -> pa.Table:
        if len(mask):
            starts = np.flatnonzero((b.bytes & 0xC0) != 0x80)
            mask = np.repeat(np.logical_and.reduceat(mask, starts), np.diff(np.append(starts, len(mask))))
        t = _finish(b, mask)
        text = pc.if_else(pc.is_valid(b.table["text"].combine_chunks()), t["kept"].combine_chunks(), pa.scalar(None, pa.binary())).cast(pa.string())
        return pa.table({c: text if c == "text" else b.table[mine[c]] for c in columns} | {"n_removed": t["n_removed"]})

    schema = StructType(list(base.schema.fields)).add("n_removed", LongType())
    return covered(documents, ByteScheme(), F.col("doc_id"), F.col("text"), finish, schema, tuple(F.col(c).alias(m) for c, m in mine.items()))
