"""Windows of symbols that also start in a document with a smaller id: the exchange that substring and suffix dedup share.

A scheme (words or bytes) gives every window a key that its content alone sets, and consecutive windows of one key are a
run. Documents are dealt into batches of bounded size. Three rounds follow, each a plan over the same dealt documents:

1. Each batch sends its distinct keys, packed by bucket of the key, with the smallest id and the number of distinct runs. A bucket
   answers which keys several documents have; windows of all other keys are free. A key of very many distinct runs is
   hot.
2. Each batch sends the bytes of its distinct runs of shared keys; of hot keys every window on its own, dealt by a hash of the whole
   window. A bucket first finds runs that are equal byte for byte, then, by the scheme's own method, equal windows among the
   distinct runs of a key, and answers with a bit for each window.
3. Each batch joins the answers into covered symbols.

Hashes only propose: whatever is removed was compared as bytes. Runs are reduced in a batch before they travel, so that a text,
line or passage that any share of the documents has counts once a batch; arrays travel packed, and no step holds more
than a batch or a bucket.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import blocks_for, text_bytes, trimmed

BATCH_BYTES = 6 << 20
#: Buckets of the second round for each of the first.
FINER = 4
#: Distinct runs of one key from which on its windows are dealt one by one; the results are the same.
HOT_RUNS = 1 << 16
MASK48 = np.uint64((1 << 48) - 1)
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
#: Byte ranges longer than this are hashed and compared one by one.
_LONG = 256


def mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A hash of 64-bit values."""
    x = (x ^ np.uint64(salt)) * _A
    x = (x ^ x >> np.uint64(31)) * _B
    return x ^ x >> np.uint64(29)


def eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as a number; zeros follow the end."""
    wide = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.lib.stride_tricks.as_strided(wide[:8].view(np.uint64), (len(data) + 1,), (1,))


def _first_bytes(x: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Of each eight bytes the first n."""
    return np.where(n < 8, x & ((np.uint64(1) << (np.minimum(n, 7) * 8).astype(np.uint64)) - np.uint64(1)), x)


def names(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte ranges, eight bytes at a time."""
    size = end - start
    out = mixed(size.astype(np.uint64), 77)
    at = np.flatnonzero(size <= _LONG)
    eight = eights(data)
    k = 0
    while len(at):
        out[at] = mixed(out[at] ^ _first_bytes(eight[start[at] + k], size[at] - k), 11 + k)
        k += 8
        at = at[size[at] > k]
    for i in np.flatnonzero(size > _LONG):
        out[i] = xxhash.xxh64_intdigest(data[start[i] : end[i]].tobytes(), 5)
    return out


def same(data: np.ndarray, start: np.ndarray, end: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Whether each byte range equals that with the number ``other``, byte for byte."""
    size = end - start
    out = size == size[other]
    open_ = out & (other != np.arange(len(other)))
    at = np.flatnonzero(open_ & (size <= _LONG))
    eight = eights(data)
    k = 0
    while len(at):
        left = size[at] - k
        equal = _first_bytes(eight[start[at] + k] ^ eight[start[other[at]] + k], left) == 0
        out[at[~equal]] = False
        at = at[equal & (left > 8)]
        k += 8
    for i in np.flatnonzero(open_ & (size > _LONG)):
        j = other[i]
        out[i] = np.array_equal(data[start[i] : end[i]], data[start[j] : end[j]])
    return out


def alike(data: np.ndarray, start: np.ndarray, end: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Group numbers of byte ranges: equal exactly where the bytes are. The hashes ``h`` propose groups, the bytes decide; ranges
    that only their hash has in common are told apart one by one."""
    order = np.argsort(h, kind="stable")
    new = np.concatenate([[True], h[order][1:] != h[order][:-1]])[: len(h)]
    group = np.empty(len(h), np.int64)
    group[order] = np.cumsum(new) - 1
    lead = order[new]
    apart: dict[tuple[int, bytes], int] = {}
    for i in np.flatnonzero(~same(data, start, end, lead[group])).tolist():
        group[i] = apart.setdefault((int(group[i]), data[start[i] : end[i]].tobytes()), len(lead) + len(apart))
    return group


def packed(a: np.ndarray) -> bytes:
    """64-bit values as planes of as many bytes as the largest needs; zero bytes of small values then compress away."""
    a = np.ascontiguousarray(a).view(np.uint64)
    n = max(1, (int(a.max(initial=0)).bit_length() + 7) // 8)
    return bytes([n]) + a.view(np.uint8).reshape(-1, 8)[:, :n].T.tobytes()


def unpacked(b: bytes) -> np.ndarray:
    n = b[0]
    planes = np.frombuffer(b, np.uint8, offset=1).reshape(n, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :n] = planes.T
    return out.view(np.uint64).ravel()


@dataclass
class Runs:
    """Runs of a batch: document (place in the batch), first window, number of windows, key."""

    doc: np.ndarray
    first: np.ndarray
    n: np.ndarray
    key: np.ndarray

    @classmethod
    def joined(cls, parts: list[Runs]) -> Runs:
        kinds = {"doc": np.int32, "first": np.int32, "n": np.int32, "key": np.uint64}  # a batch has under 2**31 symbols
        return cls(*(np.concatenate([getattr(p, f) for p in parts]).astype(kind, copy=False) if parts else np.zeros(0, kind) for f, kind in kinds.items()))


def pieces(bounds: np.ndarray, window: int, most: int) -> Iterator[tuple[int, int, int, np.ndarray]]:
    """(document, first symbol, end, bounds in the piece) of pieces of about ``most`` symbols: several short documents, or a part
    of a long one, of which neighbouring parts share window - 1 symbols, so that each window lies in one piece."""
    a = 0
    while a < len(bounds) - 1:
        b = max(a + 1, int(np.searchsorted(bounds, bounds[a] + most, side="right")) - 1)
        lo, hi = int(bounds[a]), int(bounds[b])
        if hi - lo <= most or b > a + 1:
            yield a, lo, hi, bounds[a : b + 1] - lo
        else:
            for start in range(lo, hi - window + 1, most):
                end = min(hi, start + most + window - 1)
                yield a, start, end, np.array([0, end - start])
        a = b


def runs_of(key: np.ndarray, valid: np.ndarray, fresh: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first window, number of windows) of runs of one key among valid windows; fresh: where a document starts."""
    before = np.concatenate([[False], valid[:-1]])
    new = valid & (fresh | ~before)
    new[1:] |= valid[1:] & (key[1:] != key[:-1])
    first = np.flatnonzero(new)
    count = np.concatenate([[0], np.cumsum(valid)])
    return first, np.diff(np.append(count[first], count[-1]))


def ranges(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """All of [first, first + n) of each, in a row."""
    total = int(n.sum())
    return np.arange(total) + np.repeat(first - (np.cumsum(n) - n), n)


def _starts(new: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(where each group starts, its size) from marks of the first of each group."""
    starts = np.flatnonzero(new)
    return starts, np.diff(np.append(starts, n))


class Batch:
    """A batch's documents, their runs, and its entries: runs distinct in their bytes, by key, each with the smallest id."""

    def __init__(self, table: pa.Table, scheme):
        ids, texts = table["doc_id"].combine_chunks(), table["text"].combine_chunks()
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.chunk(0) if texts.num_chunks else pa.array([], pa.binary())
        if isinstance(ids, pa.ChunkedArray):
            ids = ids.chunk(0) if ids.num_chunks else pa.array([], pa.int64())
        self.table, self.scheme, self.ids = table, scheme, ids
        known = np.asarray(ids.is_valid())
        self.id = np.asarray(ids.fill_null(0)).astype(np.int64)
        ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64) if len(texts) else np.zeros(1, np.int64)
        data = texts.buffers()[2]
        self.bytes = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None else np.zeros(0, np.uint8)
        self.offsets = ends - ends[0]
        self.symbols = scheme.symbols(self.bytes, self.offsets)
        self.runs = r = scheme.runs(self.symbols)
        at = np.flatnonzero(known[r.doc]) if len(r.doc) else np.zeros(0, np.int64)
        order = at[np.argsort(r.key[at], kind="stable")]
        k = r.key[order]
        new_key = np.concatenate([[True], k[1:] != k[:-1]])[: len(k)]
        starts, sizes = _starts(new_key, len(k))
        # only runs that have company under their key need their bytes looked at
        group = np.full(len(k), -1, np.int64)
        i = np.flatnonzero(np.repeat(sizes > 1, sizes))
        if len(i):
            a, b = scheme.span(self.symbols, r.first[order[i]].astype(np.int64), r.n[order[i]].astype(np.int64))
            g = alike(self.symbols.data, a, b, names(self.symbols.data, a, b))
            sub = np.lexsort((self.id[r.doc[order[i]]], g, k[i]))
            order[i], group[i] = order[i][sub], g[sub]
        new = new_key.copy()
        new[1:] |= group[1:] != group[:-1]
        self.lead = order[new]  # the run that stands for each entry: of the smallest id
        self.entry = np.full(len(r.key), -1, np.int32)
        self.entry[order] = np.cumsum(new) - 1
        self.doc = self.id[r.doc[self.lead]]
        self.of_key = (np.cumsum(new_key) - 1)[new]
        self.key, self.n_entries = k[starts], np.bincount(self.of_key, minlength=len(starts))
        id_ = self.id[r.doc[order]]
        self.least = np.minimum.reduceat(id_, starts) if len(starts) else id_
        self.several = self.least != (np.maximum.reduceat(id_, starts) if len(starts) else id_)

    def codes(self, answers: pa.Table, n: int) -> np.ndarray:
        """Answers of the first round, by entry."""
        got = {b: p for b, r, p in zip(answers["bucket"].to_pylist(), answers["round"].to_pylist(), answers["answer"].to_pylist(), strict=True) if r == 1}
        out = np.zeros(len(self.key), np.uint8)
        for b, at in by_bucket(self.key, n, 1):
            out[at] = np.frombuffer(got[b], np.uint8)
        return out[self.of_key]

    def sent(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """What travels in the second round: (key, id, byte start, byte end, number of windows) of strings, and, by entry, where its
        windows start among all that travel; -1 for free entries. A hot entry is as many strings as windows."""
        whole, hot = np.flatnonzero(codes == SHARED), np.flatnonzero(codes == HOT)
        n = self.runs.n[self.lead].astype(np.int64)
        first = self.runs.first[self.lead].astype(np.int64)
        a, b = self.scheme.span(self.symbols, first[whole], n[whole])
        one = ranges(first[hot], n[hot])
        c, d = self.scheme.span(self.symbols, one, np.ones(len(one), np.int64))
        offset = np.full(len(codes), -1, np.int64)
        both = np.concatenate([whole, hot])
        offset[both] = np.cumsum(n[both]) - n[both]
        key = np.concatenate([self.key[self.of_key[whole]], names(self.symbols.data, c, d) & MASK48])
        return key, np.concatenate([self.doc[whole], np.repeat(self.doc[hot], n[hot])]), np.concatenate([a, c]), np.concatenate([b, d]), np.concatenate([n[whole], np.ones(len(one), np.int64)]), offset


def by_bucket(key: np.ndarray, n: int, salt: int) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, places of its keys in order)."""
    if not len(key):
        return
    bucket = (mixed(key, salt) % np.uint64(n)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    starts, sizes = _starts(np.concatenate([[True], bucket[1:] != bucket[:-1]]), len(bucket))
    for s, m in zip(starts, sizes, strict=True):
        yield int(bucket[s]), order[s : s + m]


FREE, SHARED, HOT = 0, 1, 2
_SENT = "bucket long, batch long, key binary, least binary, more binary"
_ANSWER = "batch long, bucket long, round int, answer binary"
_STRINGS = "bucket long, batch long, key binary, doc binary, size binary, bytes binary"


def _answers(t: pa.Table, number: int, parts: list[bytes]) -> pa.Table:
    return pa.table({"batch": t["batch"], "bucket": t["bucket"], "round": pa.array(np.full(len(parts), number, np.int32)), "answer": pa.array(parts, pa.binary())})


def _rows(rows: list[tuple], schema: str) -> pa.Table:
    fields = [f.split() for f in schema.split(", ")]
    return pa.table([pa.array([r[i] for r in rows], pa.int64() if kind == "long" else pa.binary()) for i, (_, kind) in enumerate(fields)], names=[f for f, _ in fields])


def decide(t: pa.Table) -> pa.Table:
    """Codes of the keys that batches sent to one bucket."""
    key, least, more = ([unpacked(x.as_py()) for x in t[c]] for c in ("key", "least", "more"))
    sizes = [len(k) for k in key]
    key, least, more = np.concatenate([np.cumsum(k) for k in key]), np.concatenate(least).view(np.int64), np.concatenate(more).astype(np.int64)
    order = np.argsort(key, kind="stable")
    k, d, m = key[order], least[order], more[order]
    starts, n = _starts(np.concatenate([[True], k[1:] != k[:-1]]), len(k))
    shared = (np.minimum.reduceat(d, starts) != np.maximum.reduceat(d, starts)) | np.maximum.reduceat(m & 1, starts).astype(bool)
    runs = np.add.reduceat((m >> 1) + 1, starts)
    # the only run of a key needs no other batch
    code = np.empty(len(order), np.uint8)
    code[order] = np.repeat(np.where(shared & (runs > 1), np.where(runs > HOT_RUNS, HOT, SHARED), FREE), n)
    return _answers(t, 1, [p.tobytes() for p in np.split(code, np.cumsum(sizes)[:-1])])


def settle(t: pa.Table, scheme) -> pa.Table:
    """For each window of the strings that batches sent to one bucket, whether an earlier document has it too."""
    key, doc, size = ([unpacked(x.as_py()) for x in t[c]] for c in ("key", "doc", "size"))
    rows = [len(k) for k in key]
    row = np.repeat(np.arange(len(rows)), rows)
    open_ = zstandard.ZstdDecompressor()
    data = np.concatenate([np.frombuffer(open_.decompress(x.as_py()), np.uint8) for x in t["bytes"]])
    key, doc, size = np.concatenate(key), np.concatenate(doc).view(np.int64), np.concatenate(size).astype(np.int64)
    start = np.cumsum(size) - size
    n = scheme.windows(data, start, size)
    group = alike(data, start, start + size, names(data, start, start + size) ^ mixed(key, 5))
    order = np.lexsort((doc, group))
    new = np.concatenate([[True], group[order][1:] != group[order][:-1]])
    rep = order[new]  # the string of the smallest id stands for those of equal bytes
    of = np.empty(len(key), np.int64)
    of[order] = np.cumsum(new) - 1
    whole = doc > doc[rep][of]
    # strings of one key, of several ids, are compared window by window
    k = np.argsort(key[rep], kind="stable")
    starts, sizes = _starts(np.concatenate([[True], key[rep][k][1:] != key[rep][k][:-1]]), len(k))
    d = doc[rep][k]
    met = np.sort(k[np.repeat(np.minimum.reduceat(d, starts) != np.maximum.reduceat(d, starts), sizes)])
    hit = np.zeros(int(n[rep].sum()), bool)
    at = np.cumsum(n[rep]) - n[rep]
    if len(met):
        r = rep[met]
        hit[ranges(at[met], n[r])] = scheme.compare(data, start[r], size[r], n[r], doc[r], row[r])
    own = np.cumsum(n) - n
    bits = np.ones(int(n.sum()), bool)
    i = np.flatnonzero(~whole)
    bits[ranges(own[i], n[i])] = hit[ranges(at[of[i]], n[i])]
    ends = np.cumsum([int(x.sum()) for x in np.split(n, np.cumsum(rows)[:-1])])[:-1]
    return _answers(t, 2, [np.packbits(b).tobytes() for b in np.split(bits, ends)])


def _one(f):
    """Functions of a group: Spark tells their kind by their number of parameters."""
    g = trimmed(f)
    return lambda t: g(t)


def _two(f):
    g = trimmed(f)
    return lambda left, right: g(left, right)


def covered(documents: DataFrame, scheme, doc_id: Column, text: Column, finish, schema: StructType | str, more: tuple[Column, ...] = ()) -> DataFrame:
    """The rows that finish(batch, mask of covered symbols) makes of each batch; it finds the columns ``more`` in batch.table.

    A batch depends on a row's id, text and partition of the input, so that rows that are alike don't all lie in one; a
    partition that is computed again after a loss has the same number.
    """
    docs = documents.select(doc_id.cast("long").alias("doc_id"), text.cast("string").alias("text"), *more)
    more = docs.columns[2:]
    n = blocks_for(text_bytes(docs), BATCH_BYTES, 32)
    docs = docs.select(F.pmod(F.xxhash64("doc_id", "text", F.spark_partition_id()), F.lit(n)).alias("batch"), "doc_id", F.col("text").cast("binary").alias("text"), *more)

    def send(t: pa.Table) -> pa.Table:
        b, rows = Batch(t, scheme), []
        home = t["batch"][0].as_py()
        for bucket, at in by_bucket(b.key, n, 1):
            rows.append((bucket, home, packed(np.diff(b.key[at], prepend=np.uint64(0))), packed(b.least[at]), packed((b.n_entries[at] - 1) * 2 + b.several[at])))
        return _rows(rows, _SENT)

    first = docs.groupBy("batch").applyInArrow(_one(send), _SENT).groupBy("bucket").applyInArrow(_one(decide), _ANSWER)

    def send_strings(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = []
        if left.num_rows:
            b = Batch(left, scheme)
            key, doc, start, end, *_ = b.sent(b.codes(right, n))
            home, close = left["batch"][0].as_py(), zstandard.ZstdCompressor(level=1)
            for bucket, e in by_bucket(key, FINER * n, 2):
                size = end[e] - start[e]
                rows.append((bucket, home, packed(key[e]), packed(doc[e]), packed(size), close.compress(b.symbols.data[ranges(start[e], size)].tobytes())))
        return _rows(rows, _STRINGS)

    second = docs.groupBy("batch").cogroup(first.groupBy("batch")).applyInArrow(_two(send_strings), _STRINGS).groupBy("bucket").applyInArrow(_one(lambda t: settle(t, scheme)), _ANSWER)

    def join(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return pa.table({})
        b = Batch(left, scheme)
        key, _, _, _, m, offset = b.sent(b.codes(right, n))
        got = {k: np.frombuffer(p, np.uint8) for k, q, p in zip(right["bucket"].to_pylist(), right["round"].to_pylist(), right["answer"].to_pylist(), strict=True) if q == 2}
        bits, at = np.zeros(int(m.sum()), bool), np.cumsum(m) - m
        for bucket, e in by_bucket(key, FINER * n, 2):
            bits[ranges(at[e], m[e])] = np.unpackbits(got[bucket], count=int(m[e].sum()))
        r, use = b.runs, b.entry >= 0
        whole = np.zeros(len(r.key), bool)
        whole[use] = b.id[r.doc[use]] > b.doc[b.entry[use]]  # an earlier document of the batch has the same run
        edge = np.zeros(b.symbols.size + 1, np.int32)
        i = np.flatnonzero(whole)
        np.add.at(edge, r.first[i], 1)
        np.add.at(edge, r.first[i] + r.n[i] + scheme.window - 1, -1)
        i = np.flatnonzero(use & ~whole)
        i = i[offset[b.entry[i]] >= 0]
        if len(i):
            size = r.n[i].astype(np.int64)
            start = ranges(r.first[i].astype(np.int64), size)[bits[ranges(offset[b.entry[i]], size)]]
            np.add.at(edge, start, 1)
            np.add.at(edge, start + scheme.window, -1)
        return finish(b, np.cumsum(edge[:-1], dtype=np.int32) > 0)

    return docs.groupBy("batch").cogroup(first.unionByName(second).groupBy("batch")).applyInArrow(_two(join), schema)


def spans_of(mask: np.ndarray, bounds: np.ndarray) -> tuple[pa.ListArray, np.ndarray, np.ndarray]:
    """(array of struct(first, last) a document, spans a document, covered symbols a document) of a mask over documents' symbols."""
    fresh = np.zeros(len(mask) + 1, bool)
    fresh[bounds[:-1]] = True
    before = np.concatenate([[False], mask[:-1]]) & ~fresh[:-1] if len(mask) else mask
    start = np.flatnonzero(mask & ~before)
    after = np.concatenate([mask[1:], [False]]) & ~fresh[1:] if len(mask) else mask
    end = np.flatnonzero(mask & ~after)
    doc = np.searchsorted(bounds, start, side="right") - 1
    n = np.bincount(doc, minlength=len(bounds) - 1)
    made = pa.StructArray.from_arrays([pa.array(start - bounds[doc]), pa.array(end - bounds[doc])], ["first", "last"])
    covered_by = np.bincount(doc, weights=end - start + 1, minlength=len(bounds) - 1).astype(np.int64)
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), made), n, covered_by
