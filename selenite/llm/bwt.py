"""Burrows-Wheeler transforms of collections of short strings, and their merge by iterative interleave refinement."""

from __future__ import annotations

import numpy as np

#: Symbols of one sort key: 9 bits each, 0 ends a string.
PACK = 7


def suffix_order(data: np.ndarray, lengths: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """Of the suffixes, sorted by their first ``depth`` symbols or more: places, first symbols, first seven symbols packed, symbols
    before the end; and how many there are.

    The text is the strings, each with an end symbol, 0, smaller than any other and unlike any other end. Prefix doubling
    from packed keys; only suffixes that are still tied are sorted again.
    """
    total = len(data) + len(lengths)
    end = np.cumsum(lengths + 1) - 1
    text = np.zeros(total + PACK, np.uint16)
    inner = np.ones(total, bool)
    inner[end] = False
    text[:total][inner] = data
    text[:total][inner] += np.uint16(1)
    left = np.repeat(end, lengths + 1).astype(np.int32) - np.arange(total, dtype=np.int32)
    packed = np.zeros(total, np.int64)
    for j in range(PACK):
        packed <<= 9
        packed |= np.where(left >= j, text[j : j + total], 0)
    order = np.argsort(packed, kind="stable")
    key = packed[order]
    new = np.concatenate([[True], key[1:] != key[:-1]]) | (left[order] < PACK)
    reach = PACK
    while reach < depth:
        tied = ~new
        tied[:-1] |= ~new[1:]
        at = np.flatnonzero(tied)
        if not len(at):
            break
        rank = np.empty(total, np.int64)
        rank[order] = np.maximum.accumulate(np.where(new, np.arange(total), 0))
        where = order[at]
        key = rank[where] * total + rank[np.minimum(where + reach, total - 1)]
        again = np.argsort(key, kind="stable")
        order[at] = where[again]
        key = key[again]
        new[at] = np.concatenate([[True], key[1:] != key[:-1]])
        reach *= 2
    return order, text[order], packed[order], left[order], total


class Shard:
    """BWT of a collection of strings, in packed symbols: for each suffix in order its place, first symbol and first seven
    symbols, and the place of the suffix that starts seven symbols earlier, -1 where its string doesn't reach so far."""

    def __init__(self, data: np.ndarray, lengths: np.ndarray, depth: int):
        self.places, self.first, self.packed, left, self.size = suffix_order(data, lengths, depth)
        self.whole = left >= PACK
        into = np.arange(self.size, dtype=np.int32) - np.repeat(np.cumsum(lengths + 1) - lengths - 1, lengths + 1).astype(np.int32)
        self.before = np.where(into[self.places] >= PACK, self.places - PACK, -1)


def _dealt(c: np.ndarray) -> np.ndarray:
    """Stable order of numbers below 2**32, by two passes over 16 bits."""
    order = np.argsort((c & 0xFFFF).astype(np.uint16), kind="stable")
    return order[np.argsort((c[order] >> 16).astype(np.uint16), kind="stable")]


def merged(shards: list[Shard], rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """(shard of each suffix in the merged order, number of its interval): suffixes of one interval share 1 + 7 * rounds symbols.

    The interleave starts from the first symbols alone. Each round reads the packed BWT under the interleave so far and deals
    the shard numbers out by what it reads, which makes the interleave right for seven symbols more; an interval is split
    where these or the interval that a suffix came from change. No suffix is compared or sorted again: what the rounds
    order are the shards' packed symbols, numbered once. Ends differ from one another, so a suffix shorter than the depth is
    alone in its interval.
    """
    sizes = [s.size for s in shards]
    shift = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(shards)), sizes).astype(np.uint8 if len(shards) <= 256 else np.uint16)
    total = len(owner)
    whole, packed = np.concatenate([s.whole for s in shards]), np.concatenate([s.packed for s in shards])
    by_key = np.argsort(packed, kind="stable")  # the shards' parts are in order already, so this merges them
    number = np.empty(total, np.int32)
    number[by_key] = np.cumsum(np.concatenate([[0], packed[by_key][1:] != packed[by_key][:-1]]))
    fixed = ~whole[by_key]
    slots = np.flatnonzero(~fixed)
    at_fixed, z_fixed = np.flatnonzero(fixed), owner[by_key[fixed]]
    del packed, by_key
    rank = np.empty(total, np.int32)  # of a place: its suffix among all shards' suffixes
    rank[np.concatenate([s.places + k for s, k in zip(shards, shift, strict=True)])] = np.arange(total, dtype=np.int32)
    before = np.concatenate([np.where(s.before >= 0, s.before + k, -1) for s, k in zip(shards, shift, strict=True)])
    symbols = np.where(before >= 0, number[rank[before]], -1)  # the packed BWT
    del rank, before, number
    first = np.concatenate([s.first for s in shards])
    deal = np.argsort(first, kind="stable")
    z, c = owner[deal], first[deal]
    block = np.cumsum(np.concatenate([[True], (c[1:] != c[:-1]) | (c[1:] == 0)]), dtype=np.int32)
    apart = np.concatenate([[True], np.diff(slots) != 1]) if len(slots) else np.zeros(0, bool)
    read = np.empty(total, np.int32)
    for _ in range(rounds):
        read[np.argsort(z, kind="stable")] = symbols
        there = np.flatnonzero(read >= 0)
        source = there[_dealt(read[there])]
        c, b = read[source], block[source]
        new = np.ones(total, bool)
        if len(slots):
            new[slots] = apart | np.concatenate([[True], (c[1:] != c[:-1]) | (b[1:] != b[:-1])])
        fresh = np.empty_like(z)
        fresh[slots], fresh[at_fixed] = z[source], z_fixed
        z, block = fresh, np.cumsum(new, dtype=np.int32)
    return z, block


def repeated(shards: list[tuple[np.ndarray, np.ndarray]], rounds: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(shard, place in its text, interval) of every suffix that shares its first 1 + 7 * rounds symbols with another; texts have
    an end symbol after each string. shards: (data, lengths of its strings)."""
    made = [Shard(d, n, 1 + PACK * rounds) for d, n in shards]
    z, block = merged(made, rounds)
    place = np.empty(len(z), np.int64)
    place[np.argsort(z, kind="stable")] = np.concatenate([s.places for s in made])
    same = block[1:] == block[:-1]
    at = np.flatnonzero(np.concatenate([[False], same]) | np.concatenate([same, [False]]))
    return z[at].astype(np.int64), place[at], block[at]
