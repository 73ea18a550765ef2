"""SimHash near-dedup by Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into segments of 23, 23 and 18 bits. Four errors or fewer over three segments leave one of these:

* a segment without an error and another with at most two: key = the first as it is, and a Golay index of the other;
* one error in each of two segments, so that a half of each is free of errors, and at most two in the third: key = these
  halves, and a Golay index of the third.

A segment's Golay indices are those of all codewords of the perfect [23, 12, 7] code at distance 4 or less, one or six; two
words that differ in at most two bits always share one. So every pair that links meets under some key, and each meeting
is verified on the whole fingerprints. Keys travel as packed arrays by bucket, and a bucket returns a spanning set of links.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.relational import components
from .common import blocks_for, cut, row_sign, trim

ERRORS = 4
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
#: Generator polynomial of the binary Golay code, x^11 + x^9 + x^7 + x^6 + x^5 + x + 1; a fixed value.
GOLAY = 0b101011100011
#: (lowest bit, width) of each segment.
SEGMENTS = ((41, 23), (18, 23), (0, 18))
_BUCKET_BYTES = 8 << 20
_KEY_BYTES = 16 * 100  # of one fingerprint: about 96 keys, each with the fingerprint
#: Parts that the members of one component are dealt to where its smallest value is handed out.
_SALTS = 16


def fingerprint(text: str | None, words: int = 4, seed: int = 42) -> int:
    """Bits that more than half of the XXH64 hashes of the word shingles, repeats included, have set."""
    parts = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()  # bytes split at \x20, \x09-\x0D
    if not parts:
        return 0
    joined, n = b" ".join(parts), len(parts)
    if n <= words:
        return xxhash.xxh64_intdigest(joined, seed)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, n)) + np.arange(n)
    starts = np.concatenate([[0], ends[:-1] + 1])
    h = xxhash.xxh64_intdigest
    hashes = np.fromiter([h(joined[a:b], seed) for a, b in zip(starts[: n - words + 1].tolist(), ends[words - 1 :].tolist(), strict=True)], np.uint64, n - words + 1)
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        part = hashes[i : i + (1 << 16)].astype(">u8")
        counts += np.unpackbits(part.view(np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big")


def fingerprints(documents: DataFrame, words: int = 4, seed: int = 42, sign: Column | None = None) -> DataFrame:
    """doc_id, fp (the 64 bits as a long), and sign if given. Null or blank text: 0. One row per row; further columns are left out."""
    more = [] if sign is None else ["sign"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.fromiter((fingerprint(t.as_py(), words, seed) for t in b.column(1)), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64)), *b.columns[2:]], ["doc_id", "fp", *more])
            trim()

    cols = [F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *(sign.alias(c) for c in more)]
    return documents.select(*cols).mapInArrow(run, ", ".join(["doc_id long, fp long", *(f"{c} string" for c in more)]))


def _syndrome(x: np.ndarray) -> np.ndarray:
    """Remainder of 23-bit words by the generator polynomial."""
    x = x.astype(np.uint32)
    for bit in range(22, 10, -1):
        x = np.where(x >> bit & 1, x ^ np.uint32(GOLAY << (bit - 11)), x)
    return x


@lru_cache(1)
def golay_errors() -> np.ndarray:
    """[syndrome, 6]: all error patterns of weight 4 or less with that syndrome, padded with -1."""
    out = np.full((2048, 6), -1, np.int64)
    n = np.zeros(2048, np.int64)
    patterns = np.array([sum(1 << b for b in c) for w in range(5) for c in combinations(range(23), w)], np.int64)
    for s, p in zip(_syndrome(patterns).tolist(), patterns.tolist(), strict=True):
        out[s, n[s]] = p
        n[s] += 1
    return out


def golay_indices(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """([n, 6] indices of the codewords at distance 4 or less from 23-bit words, which of them there are)."""
    errors = golay_errors()[_syndrome(x)]
    return (x.astype(np.int64)[:, None] ^ np.maximum(errors, 0)) >> 11, errors >= 0


def fuzzy_keys(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(keys, which fingerprint each is of): uint64 keys, under at least one of which any two linked fingerprints meet."""
    seg = [(fp >> np.uint64(low) & np.uint64((1 << width) - 1)).astype(np.int64) for low, width in SEGMENTS]
    halves = [(s >> (w // 2), s & ((1 << (w // 2)) - 1)) for s, (_, w) in zip(seg, SEGMENTS, strict=True)]
    fuzzy = [golay_indices(s) for s in seg]
    keys, who, family = [], [], 0
    for k in range(3):
        i, j = [x for x in range(3) if x != k]
        exact = [seg[i], seg[j], *((a << 12) | b for a in halves[i] for b in halves[j])]
        index, there = fuzzy[k]
        rows, cols = np.nonzero(there)
        for e in exact:
            keys.append((family << 40 | e[rows] << 12 | index[rows, cols]).astype(np.uint64))
            who.append(rows)
            family += 1
    return np.concatenate(keys), np.concatenate(who)


def _mixed(k: np.ndarray) -> np.ndarray:
    k = k * np.uint64(0x9E3779B97F4A7C15)
    return (k ^ k >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(20)


def _grown(fp: np.ndarray, errors: int) -> list[tuple[int, int]]:
    """Links that span the components of distinct fingerprints, grown one by one: len(fp) - components links."""
    left, out = fp, []
    while len(left):
        todo, left = [left[0]], left[1:]
        while todo and len(left):
            x = todo.pop()
            near = np.bitwise_count(left ^ x) <= errors
            out += [(int(x), int(y)) for y in left[near]]
            todo += list(left[near])
            left = left[~near]
    return out


def links_of(keys: np.ndarray, fp: np.ndarray, errors: int = ERRORS, few: int = 8) -> np.ndarray:
    """[n, 2] fingerprints that meet under a key and differ in at most ``errors`` bits; of larger meetings a spanning set."""
    order = np.argsort(keys, kind="stable")
    keys, fp = keys[order], fp[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    sizes = np.diff(np.append(starts, len(keys)))
    size_of = np.repeat(sizes, sizes)
    out = []
    for d in range(1, few):
        at = np.flatnonzero((keys[:-d] == keys[d:]) & (size_of[d:] <= few)) if len(keys) > d else []
        at = at[np.bitwise_count(fp[at] ^ fp[at + d]) <= errors] if len(at) else at
        if len(at):
            out.append(np.stack([fp[at], fp[at + d]], axis=1))
    for s in np.flatnonzero(sizes > few):
        grown = _grown(np.unique(fp[starts[s] : starts[s] + sizes[s]]), errors)
        if grown:
            out.append(np.array(grown, np.uint64))
    pairs = np.concatenate(out) if out else np.zeros((0, 2), np.uint64)
    pairs = pairs[pairs[:, 0] != pairs[:, 1]]
    return np.unique(np.sort(pairs, axis=1), axis=0)


def links(distinct: DataFrame, errors: int = ERRORS) -> DataFrame:
    """a, b: links between distinct fingerprints (column fp), enough to span every component."""
    n = blocks_for(distinct.count() * _KEY_BYTES, _BUCKET_BYTES, 32)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for first in range(0, len(fp), 4096):
                keys, who = fuzzy_keys(fp[first : first + 4096])
                bucket = (_mixed(keys) % np.uint64(n)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                keys, who, bucket = keys[order], fp[first : first + 4096][who[order]], bucket[order]
                starts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
                ends = np.append(starts[1:], len(bucket))
                yield pa.RecordBatch.from_arrays([pa.array(bucket[starts]), pa.array([keys[s:e].tobytes() for s, e in zip(starts, ends, strict=True)], pa.binary()), pa.array([who[s:e].tobytes() for s, e in zip(starts, ends, strict=True)], pa.binary())], ["bucket", "keys", "fps"])

    def meet(t: pa.Table) -> pa.Table:
        keys, fps = (np.concatenate([np.frombuffer(x.as_py(), np.uint64) for x in t[c]]) for c in ("keys", "fps"))
        found = links_of(keys, fps, errors)
        del keys, fps
        trim()
        return pa.table({"a": pa.array(found[:, 0].copy().view(np.int64)), "b": pa.array(found[:, 1].copy().view(np.int64))})

    return distinct.select("fp").mapInArrow(deal, "bucket long, keys binary, fps binary").groupBy("bucket").applyInArrow(meet, "a long, b long").distinct()


def near_duplicates(documents: DataFrame, words: int = 4, errors: int = ERRORS, seed: int = 42) -> DataFrame:
    """doc_id, fp (long), component_id: smallest doc_id reachable over fingerprints that differ in at most ``errors`` (0-4) bits.

    Null or blank texts have fingerprint 0, which links like any other. One row per row, repeated rows included. Rows without
    an id get the component's smallest id, null if it has none. An empty table gives no rows; further columns are left
    out. Equal fingerprints are one node with its smallest id, so copies, however many, are never paired.
    """
    rows = cut(fingerprints(documents, words, seed))
    return rows.join(_least(rows, F.col("doc_id"), errors), "fp").select("doc_id", "fp", F.col("least").alias("component_id"))


def _least(rows: DataFrame, value: Column, errors: int) -> DataFrame:
    """fp, least: the smallest ``value`` of the rows in the component of each fingerprint."""
    if not 0 <= errors <= ERRORS:
        raise ValueError(f"errors: 0 to {ERRORS}")
    distinct = cut(rows.groupBy("fp").agg(F.min(value).alias("first")))
    roots = components(links(distinct, errors))
    named = distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", "first", "root")
    # a component of any share of the fingerprints is dealt out; one of a single fingerprint needs no join
    linked = named.filter("root IS NOT NULL").withColumn("salt", F.pmod(F.xxhash64("fp"), F.lit(_SALTS)))
    least = linked.groupBy("root").agg(F.min("first").alias("least")).select("root", "least", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(_SALTS - 1).cast("long"))).alias("salt"))
    return linked.join(least, ["root", "salt"]).select("fp", "least").unionByName(named.filter("root IS NULL").select("fp", F.col("first").alias("least")))


def one_of_each(documents: DataFrame, words: int = 4, errors: int = ERRORS, seed: int = 42) -> DataFrame:
    """``documents`` with one row of each near-duplicate group, that of the smallest id; columns unchanged.

    Decided by row, whatever rows share its id: of rows of one id in a group, and in a group without ids, the one of the smallest
    hash of the whole row stays. A row is found again by its id and that hash, so rows that are alike in all columns are one.
    """
    rows = cut(fingerprints(documents, words, seed, row_sign(documents)))
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "sign")
    gone = rows.join(_least(rows, place, errors), "fp").filter(place != F.col("least")).select(F.col("doc_id").alias("_gone"), F.col("sign").alias("_gone_sign")).distinct()
    signed = documents.withColumns({"_id": F.col("doc_id").cast("long"), "_sign": row_sign(documents)})
    kept = signed.join(gone, signed["_id"].eqNullSafe(gone["_gone"]) & (signed["_sign"] == gone["_gone_sign"]), "left_anti")
    if rows.groupBy("doc_id", "sign").count().filter("count > 1").limit(1).count():
        kept = kept.dropDuplicates(["_id", "_sign"])
    return kept.drop("_id", "_sign")


def hex_of(fp: Column) -> Column:
    """16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
