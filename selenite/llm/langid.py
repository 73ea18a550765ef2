"""Language ID, word first: known words by their log frequency in each language, unseen ones by ever shorter character n-grams."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructType

from .common import cut, trim

#: Numbers that are no digits: fractions, powers, numerals.
_NUMBERS = "".join(c for c in map(chr, range(0x20000)) if c.isalnum() and not c.isalpha() and not c.isdecimal())
#: Runs of Unicode letters: word characters that are neither digits nor such numbers. Characters up to U+FFFF come first, by themselves:
#: the set of all is searched one by one beyond them, which takes seven times as long.
WORD = re.compile(rf"(?:[^\W\d_{re.sub('[^\0-\uffff]', '', _NUMBERS)}\U00010000-\U0010ffff]++|[^\W\d_{_NUMBERS}]++)++")
UNKNOWN = "und"
#: The model is fitted on the documents with the smallest id hashes of each language: so many of each, each up to so many
#: characters, and so many characters in all, dealt out evenly over the languages, of which so many, the largest, are learned.
FIT_EACH, FIT_CHARS, FIT_ALL, FIT_LANGS = 1000, 200_000, 32_000_000, 2000
SIZES = (5, 4, 3, 2, 1)
_CACHE = 1 << 16


def _vectors(counts: dict[str, list[int]], totals: list[int]) -> tuple[list[str], np.ndarray]:
    """Log frequency of each entry in each language, less the entry's mean, so that only differences count."""
    names = list(counts)
    if not names:
        return names, np.zeros((0, len(totals)), np.float32)
    c = np.array([counts[k] for k in names], np.float64)
    logs = np.log(c + 0.5) - np.log(np.array(totals, np.float64) + 0.5 * len(names))
    return names, (logs - logs.mean(axis=1, keepdims=True)).astype(np.float32)


class Model:
    """Tables of words and n-grams; built by fit()."""

    def __init__(self, langs: list[str], words: tuple[list[str], np.ndarray], grams: dict[int, tuple[list[str], np.ndarray]]):
        self.langs, self.words, self.grams = langs, words, grams
        self._ready = None

    def __getstate__(self) -> dict:
        return {"langs": self.langs, "words": self.words, "grams": self.grams, "_ready": None}

    @classmethod
    def fit(cls, rows: Iterator[tuple[str, str]], least: int = 2) -> Model:
        """From (text, language) pairs. Words and n-grams seen fewer than ``least`` times are left out."""
        by: dict[str, Counter] = {}
        for text, lang in rows:
            by.setdefault(lang, Counter()).update(WORD.findall((text or "").lower()))
        langs = sorted(by)

        def counted(each: list[Counter]) -> tuple[list[str], np.ndarray]:
            every: Counter = Counter()
            for c in each:
                every.update(c)
            return _vectors({w: [c[w] for c in each] for w, n in every.items() if n >= least}, [sum(c.values()) for c in each])

        words = counted([by[g] for g in langs])
        grams = {}
        for n in SIZES:
            each = []
            for g in langs:
                c: Counter = Counter()
                for w, k in by[g].items():
                    for x in cls.grams_of(w, n):
                        c[x] += k
                each.append(c)
            grams[n] = counted(each)
        return cls(langs, words, grams)

    @staticmethod
    def grams_of(word: str, n: int) -> list[str]:
        whole = f"^{word}$" if n > 1 else word
        return [whole[i : i + n] for i in range(len(whole) - n + 1)]

    def _unseen(self, word: str) -> np.ndarray:
        """The mean vector of the longest n-grams of which at least half are known."""
        for n, (table, vectors) in self._tables.items():
            grams = self.grams_of(word, n)
            known = [table[g] for g in grams if g in table]
            if known and 2 * len(known) >= len(grams):
                return vectors[known].mean(axis=0)
        return np.zeros(len(self.langs), np.float32)

    def _prepare(self) -> None:
        if self._ready is None:
            names, vectors = self.words
            self._ids = {w: i for i, w in enumerate(names)}
            self._rows = np.concatenate([vectors, np.zeros((_CACHE, len(self.langs)), np.float32)])
            self._known = self._next = len(names)
            self._tables = {n: ({g: i for i, g in enumerate(t)}, v) for n, (t, v) in self.grams.items()}
            self._ready = True

    def _id(self, word: str) -> int:
        if self._next == len(self._rows):  # forget the unseen words met so far
            self._ids = dict(list(self._ids.items())[: self._known])
            self._next = self._known
        self._rows[self._next] = self._unseen(word)
        self._ids[word] = at = self._next
        self._next += 1
        return at

    def scores(self, text: str | None) -> np.ndarray | None:
        """Log scores by language; None if the text has no letter or the model knows no language."""
        words = WORD.findall((text or "").lower())
        if not words or not self.langs:
            return None
        self._prepare()
        total = np.zeros(len(self.langs))
        for first in range(0, len(words), _CACHE // 2):
            ids, get = [], self._ids.get
            for w in words[first : first + _CACHE // 2]:
                i = get(w)
                if i is None:
                    if self._next == len(self._rows):  # what was looked up so far would be overwritten
                        total += self._rows[ids].sum(axis=0, dtype=np.float64)
                        ids = []
                    i = self._id(w)
                    get = self._ids.get
                ids.append(i)
            if ids:
                total += self._rows[ids].sum(axis=0, dtype=np.float64)
        return total

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language, probability by the scores); und and 0 without a letter."""
        s = self.scores(text)
        if s is None:
            return UNKNOWN, 0.0
        at = int(np.argmax(s))
        return self.langs[at], 1 / math.fsum(math.exp(max(-700.0, x - s[at])) for x in s)


def held_out(doc_id: Column, parts: int = 5, part: int = 0) -> Column:
    """crc32 of the id's text mod ``parts`` is ``part``; a null id counts as an empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(parts)) == part


def sample(rows: DataFrame, by: str, n: int, chars: int, groups: int) -> DataFrame:
    """``by``, h, text: of each value of ``by`` up to ``n`` ids, those with the smallest hashes h, with the smallest text of each.

    Only the ``groups`` values with the most ids count, and each takes up to its even share of ``chars`` characters. However
    often an id is repeated, it is one row. Ids are picked from their hashes and lengths alone, so that texts that aren't
    picked don't travel.
    """
    keyed = rows.withColumn("h", F.xxhash64("doc_id"))
    few = cut(keyed.groupBy(by).agg(F.approx_count_distinct("h").alias("ids")).orderBy(F.desc("ids"), by).limit(groups))
    # an id's hash is one of the smallest 8 n or so, or can't be among the n smallest
    near = F.col("h").cast("double") / 2.0**64 + 0.5 <= 8.0 * n / F.col("ids")
    share = F.lit(chars) / F.greatest(few.agg(F.count("*")).scalar(), F.lit(1))
    ids = keyed.join(F.broadcast(few), by).filter(near).groupBy(by, "h").agg(F.max(F.length("text")).alias("size")).filter(F.col("size") <= share)
    w = Window.partitionBy(by).orderBy("h")
    picked = ids.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= n).withColumn("upto", F.sum("size").over(w)).filter(F.col("upto") <= share).select(by, "h")
    # at most n * groups rows of 16 bytes and a short name
    return keyed.join(F.broadcast(picked), [by, "h"]).groupBy(by, "h").agg(F.min("text").alias("text"))


def fit(documents: DataFrame, fit_each: int = FIT_EACH, fit_chars: int = FIT_CHARS, fit_all: int = FIT_ALL, fit_langs: int = FIT_LANGS) -> Model:
    """A model from up to ``fit_each`` documents of each lang, outside the held-out part, whose text and lang are not null. So each
    of the ``fit_langs`` largest languages is learned at every size, unless all its documents are held out, longer than ``fit_chars``
    characters or than the language's share of ``fit_all``: those are not fitted on, but scored whole."""
    rows = documents.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    rows = rows.filter(~held_out(F.col("doc_id"))).filter("text IS NOT NULL AND lang IS NOT NULL").filter(F.length("text") <= fit_chars)
    got = sample(rows, "lang", fit_each, fit_all, fit_langs).select("lang", "h", "text").toArrow().to_pylist()
    got.sort(key=lambda r: (r["lang"], r["h"]))
    return Model.fit((r["text"], r["lang"]) for r in got)


def identify(documents: DataFrame, model: Model) -> DataFrame:
    """``documents`` with lang_pred and lang_score added after their columns; whole texts.

    Null text or a text without a letter: und, 0. If the model has no language, all are und. Rows stay as they are, repeated
    or not; columns of those names are replaced.
    """
    base = documents.drop("lang_pred", "lang_score")
    at = base.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [model.predict(t.as_py()) for t in b.column(at)]
            cols = [*b.columns, pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())]
            yield pa.RecordBatch.from_arrays(cols, [*b.schema.names, "lang_pred", "lang_score"])
            trim()

    schema = StructType(list(base.schema.fields)).add("lang_pred", StringType()).add("lang_score", DoubleType())
    return base.mapInArrow(run, schema)
