"""Toxicity: a convolutional text classifier over hashed word embeddings, trained here in numpy.

A word's embedding is the sum of two rows of one hashed table: its own and that of its first letters, which relates inflected
forms. Filters of several widths slide over the words, each takes its maximum over
the whole text, and a logistic layer weighs the maxima. As a filter is linear before its maximum, its response at a place is the
sum of two table rows per word of its width, so that scoring looks rows up instead of multiplying.

The first dimension starts from each bucket's standardised log odds in the toxic class. A part of the training rows sets, for
each language that the text itself shows, the threshold, which is then moved to one common value.

All labelled rows are learned from, by Spark. Words become buckets once and are dealt to streams; counts by bucket are sums over
all rows; in each pass every stream learns from its rows, starting from the same model, and what the streams moved is averaged by bucket;
thresholds come from counts of all rows kept back, by language, label and score. The driver holds one model and such counts, whatever
the number of rows.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import langid
from .common import cut as written

WORD = langid.WORD
BUCKETS, DIMS, WIDTHS, FILTERS, PREFIX = 1 << 16, 8, (1, 2, 3), 8, 4
#: Rows of a stream, at least, and the most streams of a pass; documents that all passes learn from in turn, so that few rows are
#: passed six times and many twice; documents of a step.
STREAM, STREAMS, TURNS, STEP = 3000, 96, 24_000, 64
#: Languages with a place of their own in the model, those of most rows; the others are one. Bins of a score.
LANGS, BINS = 64, 1 << 12
#: Scores from here on mean toxic.
CUT = 0.7
_CHUNK, _SEEN = 1 << 15, 1 << 18


class _Ids(dict):
    """Buckets of a word and of its beginning, as one number; 0 pads. Remembers a bounded number of words."""

    def __missing__(self, word: str) -> int:
        if len(self) > 500_000:
            self.clear()
        own, start = (1 + zlib.crc32(x.encode("utf-8", "surrogatepass")) % (BUCKETS - 1) for x in (word, f"^{word[:PREFIX]}"))
        self[word] = n = own << 16 | start
        return n


_IDS = _Ids()


def ids_of(text: str | None) -> np.ndarray:
    """[words, 2]: buckets of each word of a text and of its beginning."""
    words = WORD.findall((text or "").lower())
    both = np.fromiter(map(_IDS.__getitem__, words), np.int64, len(words))
    return np.stack([both >> 16, both & 0xFFFF], axis=1)


class _Seen(dict):
    """Words seen so far, a bounded number, with their responses to all parts of all filters in one row each; row 0 pads."""

    def __init__(self, model: Model):
        t = model.tables()
        self.all = np.concatenate([part for n in WIDTHS for part in t[n]], axis=1)
        self.rows = np.zeros((_SEEN, self.all.shape[1]), np.float32)
        self.new: list[int] = []

    def __missing__(self, word: str) -> int:
        self.new.append(_IDS[word])
        self[word] = n = len(self) + 1
        return n

    def rows_of(self, words: list[str], size: int) -> np.ndarray:
        if len(self) + len(words) + 1 >= _SEEN:
            self.clear()
        at = np.zeros(size, np.int64)
        start = len(self) + 1
        at[: len(words)] = [self[w] for w in words]
        if self.new:
            both = np.array(self.new)
            self.rows[start : start + len(both)] = self.all[both >> 16] + self.all[both & 0xFFFF]
            self.new = []
        return self.rows[at]


class Model:
    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.e = rng.normal(0, 0.05, (BUCKETS, DIMS)).astype(np.float32)
        self.e[0] = 0
        self.w = {n: rng.normal(0, 0.2, (n, DIMS, FILTERS)).astype(np.float32) for n in WIDTHS}
        for n in WIDTHS:
            self.w[n][:, 0, :] += np.linspace(0.2, 1.0, FILTERS, dtype=np.float32) / n
        self.b = {n: np.zeros(FILTERS, np.float32) for n in WIDTHS}
        self.out = np.full(len(WIDTHS) * FILTERS, 0.3, np.float32)
        self.bias = np.float32(-2.0)
        self.langs: Langs | None = None
        self.cuts: dict[int, float] = {}
        self.cut = 0.5
        self._tables = self._joined = self._seen = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_tables": None, "_joined": None, "_seen": None}

    def tables(self) -> dict[int, list[np.ndarray]]:
        if self._tables is None:
            self._tables = {n: [self.e @ self.w[n][j] for j in range(n)] for n in WIDTHS}
        return self._tables

    def pooled(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(maximum of each filter over the text, place of each maximum), before the bias; the text is padded at its end."""
        size = len(WIDTHS) * FILTERS
        top, place = np.full(size, -np.inf, np.float32), np.zeros(size, np.int64)
        if self._joined is None:
            self._joined = np.concatenate([part for n in WIDTHS for part in self.tables()[n]], axis=1)
        for first in range(0, max(1, len(ids)), _CHUNK):
            m = max(1, min(_CHUNK, len(ids) - first))
            part = ids[first : first + m + WIDTHS[-1] - 1]
            r = np.zeros((m + WIDTHS[-1] - 1, self._joined.shape[1]), np.float32)
            r[: len(part)] = self._joined[part[:, 0]] + self._joined[part[:, 1]]
            at, sums = 0, []
            for n in WIDTHS:
                s = r[:m, at : at + FILTERS]
                for j in range(1, n):
                    at += FILTERS
                    s = s + r[j : m + j, at : at + FILTERS]
                at += FILTERS
                sums.append(s)
            s = np.concatenate(sums, axis=1)
            a = s.argmax(axis=0)
            v = s[a, np.arange(size)]
            place = np.where(v > top, a + first, place)
            top = np.maximum(top, v)
        return top, place

    def responses(self, words: list[str]) -> np.ndarray:
        """Largest response of each filter over the words, before the bias: one row per word, summed along each filter's width."""
        if self._seen is None:
            self._seen = _Seen(self)
        top = np.full(len(WIDTHS) * FILTERS, -np.inf, np.float32)
        for first in range(0, max(1, len(words)), _CHUNK):
            m = max(1, min(_CHUNK, len(words) - first))
            r = self._seen.rows_of(words[first : first + m + WIDTHS[-1] - 1], m + WIDTHS[-1] - 1)
            at, best = 0, []
            for n in WIDTHS:
                sums = r[:m, at : at + FILTERS]
                for j in range(1, n):
                    at += FILTERS
                    sums = sums + r[j : m + j, at : at + FILTERS]
                at += FILTERS
                best.append(sums.max(axis=0))
            top = np.maximum(top, np.concatenate(best))
        return top

    def raw(self, words: list[str]) -> float:
        x = np.maximum(self.responses(words) + np.concatenate([self.b[n] for n in WIDTHS]), 0)
        return float(1 / (1 + np.exp(-np.clip(x @ self.out + self.bias, -30, 30))))

    def score(self, text: str | None) -> float:
        """0 to 1; CUT or more from the threshold of the language that the text shows on.

        Below the lowest threshold and from the highest on, the language doesn't matter and isn't looked for.
        """
        words = WORD.findall((text or "").lower())
        s = self.raw(words)
        low, high = min([self.cut, *self.cuts.values()]), max([self.cut, *self.cuts.values()])
        if s < low:
            return 0.9 * CUT * s / low
        if s >= high:
            return CUT + 0.1 * (1 - CUT) + 0.9 * (1 - CUT) * (s - high) / max(1 - high, 1e-9)
        c = self.cuts.get(self.langs.of(ids_of(text)), self.cut)
        return 0.9 * CUT + 0.1 * CUT * (s - low) / (c - low) if s < c else CUT + 0.1 * (1 - CUT) * (s - c) / (high - c)

    def of_ids(self, ids: np.ndarray) -> float:
        """raw() from the words' buckets."""
        x = np.maximum(self.pooled(ids)[0] + np.concatenate([self.b[n] for n in WIDTHS]), 0)
        return float(1 / (1 + np.exp(-np.clip(x @ self.out + self.bias, -30, 30))))


class Learner:
    """Adam on the logistic loss, step by step; the gradient reaches a filter and the embeddings through the place of its maximum."""

    def __init__(self, model: Model, n: dict[int, int], rate: float = 0.02, state: np.ndarray | None = None):
        self.model, self.rate, self.moved = model, rate, set()
        rows = n.get(0, 0) + n.get(1, 0)
        self.weight = {k: 0.5 / max(n.get(k, 0), 1) * rows for k in (0, 1)}
        self.dense = [model.out, np.array([model.bias], np.float32), *[model.w[k] for k in WIDTHS], *[model.b[k] for k in WIDTHS]]
        self.slow, self.fast, self.steps = [np.zeros_like(v) for v in self.dense], [np.zeros_like(v) for v in self.dense], 0.0
        if state is not None:
            self._unpack(state)

    def _unpack(self, state: np.ndarray) -> None:
        at = 0
        for v in (*self.dense, *self.slow, *self.fast):
            v[...] = state[at : at + v.size].reshape(v.shape)
            at += v.size
        self.steps, self.model.bias = float(state[at]), self.dense[1][0]

    def state(self) -> np.ndarray:
        """Filters and weights with their moments, and the steps done, in one row of numbers."""
        return np.concatenate([*(v.ravel().astype(np.float64) for v in (*self.dense, *self.slow, *self.fast)), [self.steps]])

    def step(self, docs: list[np.ndarray], y: list[int]) -> None:
        m = self.model
        self.steps += 1
        m._tables = m._joined = None
        g_out, g_bias = np.zeros_like(m.out), np.zeros(1, np.float32)
        g_w, g_b = {n: np.zeros_like(m.w[n]) for n in WIDTHS}, {n: np.zeros_like(m.b[n]) for n in WIDTHS}
        for ids, label in zip(docs, y, strict=True):
            top, place = m.pooled(ids)
            pre = top + np.concatenate([m.b[n] for n in WIDTHS])
            x = np.maximum(pre, 0)
            p = 1 / (1 + np.exp(-np.clip(x @ m.out + m.bias, -30, 30)))
            g = np.float32((p - label) * self.weight[label] / len(docs))
            g_out += g * x
            g_bias += g
            gx = g * m.out * (pre > 0)
            for k, n in enumerate(WIDTHS):
                own = slice(k * FILTERS, (k + 1) * FILTERS)
                g_b[n] += gx[own]
                for j in range(n):
                    at = place[own] + j
                    pair = np.where((at < len(ids))[:, None], ids[np.minimum(at, len(ids) - 1)], 0) if len(ids) else np.zeros((FILTERS, 2), np.int64)
                    g_w[n][j] += ((m.e[pair[:, 0]] + m.e[pair[:, 1]]) * gx[own, None]).T
                    for side in (0, 1):
                        np.subtract.at(m.e, pair[:, side], 0.5 * self.rate * gx[own, None] * m.w[n][j].T)
                    self.moved.update(pair[gx[own] != 0].ravel().tolist())
        m.e[0] = 0
        grads = [g_out + 1e-4 * m.out, g_bias, *[g_w[n] + 1e-4 * m.w[n] for n in WIDTHS], *[g_b[n] for n in WIDTHS]]
        for v, slow, fast, grad in zip(self.dense, self.slow, self.fast, grads, strict=True):
            slow += 0.1 * (grad - slow)
            fast += 0.001 * (grad * grad - fast)
            v -= (self.rate * (slow / (1 - 0.9**self.steps)) / (np.sqrt(fast / (1 - 0.999**self.steps)) + 1e-8)).astype(np.float32)
        m.bias, m._seen = self.dense[1][0], None

    def learn(self, rows: Iterable[tuple[np.ndarray, int]]) -> None:
        docs, y = [], []
        for ids, label in rows:
            docs.append(ids)
            y.append(label)
            if len(docs) == STEP:
                self.step(docs, y)
                docs, y = [], []
        if docs:
            self.step(docs, y)
        self.model._tables = self.model._joined = None


class Langs:
    """Languages by hashed words: log frequencies of buckets, a word's own and its beginning's, less their mean over the languages."""

    def __init__(self, counts: np.ndarray):
        totals, seen = counts.sum(axis=1, keepdims=True), (counts.sum(axis=0) > 0).sum()
        logs = np.log(counts + 0.5) - np.log(totals + 0.5 * seen)
        self.table = np.where(counts.sum(axis=0) > 1, logs - logs.mean(axis=0), 0).astype(np.float32).T

    def of(self, ids: np.ndarray) -> int:
        """The likeliest language, by its place; -1 for a text without words."""
        return int(self.table[ids.ravel()].sum(axis=0, dtype=np.float64).argmax()) if len(ids) and self.table.shape[1] else -1


def counted(rows: Iterable[tuple[np.ndarray, int, int, bool]], counts: dict[int, np.ndarray]) -> None:
    """Adds rows (ids, toxic, place of the language or -1, kept back) to counts by bucket: documents of a label at -1 (toxic) and -2
    (not) but for those kept back, words of each language at its place."""
    for ids, toxic, lang, check in rows:
        if not check:
            counts[toxic - 2][np.unique(ids)] += 1
        if lang >= 0:
            np.add.at(counts[lang], ids.ravel(), 1)


def started(counts: dict[int, np.ndarray], n: dict[int, int], langs: int, seed: int) -> Model:
    """An unlearned model from counts by bucket. First dimension: how many standard deviations a bucket's document frequency differs in
    its log between the classes."""
    model = Model(seed)
    none = np.zeros(BUCKETS, np.int64)
    model.langs = Langs(np.array([counts.get(k, none) for k in range(langs)], np.float64).reshape(langs, BUCKETS))
    n1, n0, f1, f0 = max(n.get(1, 0), 1.0), max(n.get(0, 0), 1.0), counts.get(-1, none), counts.get(-2, none)
    both = (f1 + f0 + 1) / (n1 + n0 + 2)
    a1, a0 = 4 * both, 4 * both  # a prior of four documents of either class
    odds = np.log((f1 + a1) / (n1 + 4)) - np.log((f0 + a0) / (n0 + 4))
    model.e[:, 0] = np.clip(odds / np.sqrt(1 / (f1 + a1) + 1 / (f0 + a0)), -3, 12) / 4
    model.e[0] = 0
    return model


def best_cut(bins: dict[tuple[int, int], int]) -> float:
    """Threshold of the best F1 from rows by (bin of the score, label): the middle between its last bin and the next one."""
    at = sorted({b for b, _ in bins}, reverse=True)
    yes, all_ = (np.cumsum([sum(bins.get((b, k), 0) for k in labels) for b in at]) for labels in ((1,), (0, 1)))
    k = int(np.argmax(2 * yes / (all_ + max(yes[-1], 1))))
    low = at[k + 1] + 0.5 if k + 1 < len(at) else 0.0
    return float(np.clip((at[k] + 0.5 + low) / 2 / BINS, 0.02, 0.98))


def set_cuts(model: Model, bins: dict[tuple[int, int, int], int]) -> None:
    """The common threshold and those of languages with twenty toxic rows and others, from rows by (language shown, bin, label)."""
    every, by = Counter(), {}
    for (lang, b, label), n in bins.items():
        every[b, label] += n
        by.setdefault(lang, Counter())[b, label] += n
    model.cut = best_cut(every)
    for lang, c in by.items():
        if sum(n for (_, label), n in c.items() if label) >= 20 and any(not label for _, label in c):
            model.cuts[lang] = best_cut(c)


def binned(model: Model, rows: Iterable[tuple[np.ndarray, int]]) -> Counter:
    """Rows by (language shown, bin of the score, label)."""
    return Counter((model.langs.of(ids), min(BINS - 1, int(model.of_ids(ids) * BINS)), label) for ids, label in rows)


def fit_rows(rows: list[tuple[str | None, int, str | None]], seed: int = 7) -> Model:
    """A model from all rows (text, toxic, language or None), here; the language only teaches which language a text shows. fit() takes the
    same steps over tables."""
    ids, names = [ids_of(t) for t, _, _ in rows], [g for g, _ in Counter(g for _, _, g in rows if g).most_common(LANGS - 1)]
    place = {g: k for k, g in enumerate(names)}
    check = [k % 3 == 2 for k in range(len(rows))]
    both = lambda want: len({y for (_, y, _), c in zip(rows, check, strict=True) if c == want}) == 2
    if not (both(True) and both(False)):
        check = [False] * len(rows)
    n, counts = Counter(y for (_, y, _), c in zip(rows, check, strict=True) if not c), defaultdict(lambda: np.zeros(BUCKETS, np.int64))
    counted(((i, y, place.get(g, len(names)) if g else -1, c) for i, (_, y, g), c in zip(ids, rows, check, strict=True)), counts)
    model = started(counts, n, len(names) + 1, seed)
    if len(n) < 2:
        return model  # one class only: nothing to learn
    rng, learner = np.random.default_rng(seed), Learner(model, n)
    mine = [(i, y) for i, (_, y, _), c in zip(ids, rows, check, strict=True) if not c]
    for _ in range(passes(len(mine))):
        learner.learn(mine[k] for k in rng.permutation(len(mine)))
    set_cuts(model, binned(model, [(i, y) for i, (_, y, _), c in zip(ids, rows, check, strict=True) if c] or mine))
    return model


def passes(rows: int) -> int:
    return max(2, min(6, TURNS // max(rows, 1)))


def labelled(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """ids (array of both buckets of each word, as one number), toxic, lang, check (kept back for thresholds) of every labelled document whose
    id's crc32 mod 3 isn't 1, whole, written down in streams. A document with several labels counts as toxic if one says so; of
    several rows of one id the smallest text counts. Null texts, labels and ids are left out here, but scored."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).filter("doc_id IS NOT NULL AND toxic IS NOT NULL").filter(~langid.held_out(F.col("doc_id"), 3, 1))
    known = known.groupBy("doc_id").agg(F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    streams = max(1, min(STREAMS, known.count() // STREAM))
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).filter("text IS NOT NULL")
    rows = docs.join(known, "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"), F.min("lang").alias("lang"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first in range(0, b.num_rows, 256):
                part = b.slice(first, 256)
                ids = [(i[:, 0] << 16 | i[:, 1]).astype(np.uint32).view(np.int32) for i in map(ids_of, part.column("text").to_pylist())]
                ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids)))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("toxic"), part.column("lang"), lists], ["doc_id", "toxic", "lang", "ids"])

    words = rows.select("doc_id", "toxic", "lang", "text").mapInArrow(run, "doc_id long, toxic int, lang string, ids array<int>")
    check = F.pmod(F.xxhash64(F.lit("check"), "doc_id"), F.lit(3)) == 2
    dealt = words.withColumn("check", check).repartition(streams, "doc_id").sortWithinPartitions(F.xxhash64(F.lit("order"), "doc_id"), "doc_id")
    return written(dealt.drop("doc_id"))


def _rows_of(b: pa.RecordBatch) -> Iterator[np.ndarray]:
    """[words, 2] of each row of column ids."""
    lists = b.column(b.schema.get_field_index("ids"))
    flat = lists.values.to_numpy(zero_copy_only=False).view(np.uint32).astype(np.int64)
    ends = lists.offsets.to_numpy()
    for first, last in zip(ends[:-1], ends[1:], strict=True):
        yield np.stack([flat[first:last] >> 16, flat[first:last] & 0xFFFF], axis=1)


def _sums(df: DataFrame, run, schema: str, keys: list[str]) -> list[tuple]:
    """Sums of n by keys of what ``run`` makes of each task's rows."""
    t = df.mapInArrow(run, schema).groupBy(*keys).agg(F.sum("n").alias("n")).toArrow()
    return list(zip(*(t.column(c).to_pylist() for c in (*keys, "n")), strict=True))


def fit(documents: DataFrame, labels: DataFrame, seed: int = 7) -> Model:
    """A model from all labelled() rows. The languages of most rows have their own place, the others share one; the driver gets counts by
    bucket and one model a pass, already averaged."""
    rows = labelled(documents, labels)
    names = [r["lang"] for r in rows.filter("lang <> ''").groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGS - 1).collect()]
    place = {g: k for k, g in enumerate(names)}
    sizes = {(r["check"], r["toxic"]): r["count"] for r in rows.groupBy("check", "toxic").count().collect()}
    if not all((c, y) in sizes for c in (True, False) for y in (0, 1)):
        rows = rows.withColumn("check", F.lit(False))
        sizes = {(False, y): sum(n for (_, z), n in sizes.items() if z == y) for y in {z for _, z in sizes}}
    n = {y: k for (c, y), k in sizes.items() if not c}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, np.ndarray] = defaultdict(lambda: np.zeros(BUCKETS, np.int64))
        for b in batches:
            langs = [place.get(g, len(names)) if g else -1 for g in b.column("lang").to_pylist()]
            counted(zip(_rows_of(b), b.column("toxic").to_pylist(), langs, b.column("check").to_pylist(), strict=True), counts)
        for kind, c in counts.items():
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), kind, np.int32)), pa.array(at.astype(np.int32)), pa.array(c[at])], ["kind", "bucket", "n"])

    counts = {kind: np.zeros(BUCKETS, np.int64) for kind in range(-2, len(names) + 1)}
    for kind, bucket, k in _sums(rows, count, "kind int, bucket int, n long", ["kind", "bucket"]):
        counts[kind][bucket] = k
    model = started(counts, n, len(names) + 1, seed)
    if len(n) < 2:
        return model  # one class only: nothing to learn
    columns = [f"v{k}" for k in range(DIMS)]
    mine, state = rows.filter("NOT check").select("ids", "toxic"), Learner(model, n).state()
    for _ in range(passes(sum(n.values()))):

        def learn(batches: Iterator[pa.RecordBatch], model: Model = model, state: np.ndarray = state) -> Iterator[pa.RecordBatch]:
            learner = Learner(model, n, state=state)
            learner.learn((ids, y) for b in batches for ids, y in zip(_rows_of(b), b.column("toxic").to_pylist(), strict=True))
            if learner.steps > state[-1]:
                own = learner.state()
                own = np.concatenate([own, np.zeros(-len(own) % DIMS)]).reshape(-1, DIMS)
                moved = np.array(sorted(learner.moved), np.int64)
                at, v = np.concatenate([moved, BUCKETS + np.arange(len(own))]), np.concatenate([model.e[moved].astype(np.float64), own])
                yield pa.RecordBatch.from_arrays([pa.array(at), *[pa.array(np.ascontiguousarray(v[:, k])) for k in range(DIMS)]], ["at", *columns])

        got = mine.mapInArrow(learn, "at long, " + ", ".join(f"{c} double" for c in columns)).groupBy("at").agg(*[F.avg(c).alias(c) for c in columns]).toArrow()
        at, v = got.column("at").to_numpy(), np.stack([got.column(c).to_numpy() for c in columns], axis=1)
        model.e[at[at < BUCKETS]] = v[at < BUCKETS]
        model.e[0] = 0
        dense = at >= BUCKETS
        state = v[dense][np.argsort(at[dense])].ravel()[: len(state)]
    Learner(model, n, state=state)  # sets the filters and weights
    model._tables = model._joined = model._seen = None

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins: Counter = Counter()
        for b in batches:
            bins.update(binned(model, zip(_rows_of(b), b.column("toxic").to_pylist(), strict=True)))
        if bins:
            yield pa.RecordBatch.from_arrays([pa.array([key[k] for key in bins], pa.int32()) for k in range(3)] + [pa.array(list(bins.values()), pa.int64())], ["lang", "bin", "toxic", "n"])

    held = rows.filter("check") if (True, 1) in sizes else rows
    set_cuts(model, {(lang, b, y): k for lang, b, y, k in _sums(held.select("ids", "toxic"), score, "lang int, bin int, toxic int, n long", ["lang", "bin", "toxic"])})
    return model


def toxicity(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id, score of every row's whole text; null text as the empty one. Rows stay repeated; further columns are left out;
    an empty table gives no rows. A model fitted on one class or on nothing gives a constant below CUT or near it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([min(1.0, max(0.0, model.score(t.as_py()))) for t in b.column(1)], pa.float64())], ["doc_id", "score"])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, score double")
