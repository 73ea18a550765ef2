"""The filter audit against a plain walk through every order, and its cases of odd rows."""

import itertools
import re

import pytest
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from selenite.llm import filters

DOCS = StructType([StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()), StructField("n", IntegerType()), StructField("A", StringType()), StructField("quality", StringType())])
LABELS = StructType([StructField("doc_id", LongType()), StructField("quality", IntegerType()), StructField("toxic", IntegerType()), StructField("part", StringType())])


def plain(docs, labels):
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    bad = {d for d, _, t in labels if t == 1 and d is not None}
    first = {}
    for d, text, _ in docs:
        if d is not None:
            first[text or ""] = min(d, first.get(text or "", d))
    rows = []
    for d, text, lang in docs:
        text = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(w) < 100,
            "B": 100 * len(set(w)) < 80 * len(w),
            "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)),
            "E": d is not None and first[text] < d,
        }
        rows.append((lang or "", {k for k in fails if fails[k]}, d in good, d in bad))
    out = {}
    for part in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in map("".join, itertools.permutations("ABCDE")):
            left = mine
            for step, k in enumerate(order, 1):
                gone = [r for r in left if k in r[1]]
                kept = [r for r in left if k not in r[1]]
                shapley[k] += len(gone)
                out[part, order, step] = [len(kept), len(gone), sum(k in r[1] for r in mine) - len(gone), sum(r[1] == {k} for r in mine), sum(r[2] for r in gone), sum(r[3] for r in gone)]
                left = kept
        for (p, order, step), v in out.items():
            if p == part:
                v.append(shapley[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def found(spark, docs, labels):
    d = spark.createDataFrame([(*r, 1, "x", "y") for r in docs], DOCS)
    lab = spark.createDataFrame([(*r, "z") for r in labels], LABELS)
    got = filters.audit(filters.flagged(d, lab))
    return {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in got.collect()}


LONG = " ".join(f"w{i}" for i in range(120))


@pytest.mark.parametrize(
    "docs, labels",
    [
        (
            [(1, LONG, "en"), (2, LONG, "de"), (2, LONG, "de"), (1, LONG, "fr"), (None, LONG, "en"), (3, None, None), (4, "", ""), (5, LONG.upper(), "en"), (6, "a # b", "en"), (7, "w " * 200, "en"), (8, LONG + " \U0001f600 $", "de"), (9, "\x0b\x1c x", "de")],
            [(1, 1, 0), (2, 0, 1), (2, 1, 0), (6, 1, 1), (99, 1, 1), (None, 1, 1), (5, None, None), (7, 0, 1)],
        ),
        ([(1, LONG, "en")], []),
        ([(i, "copy", "en") for i in range(50)] + [(0, "copy", "en")], [(0, 1, 1), (3, 1, 0)]),
    ],
)
def test_audit(spark, docs, labels):
    assert found(spark, docs, labels) == plain(docs, labels)


def test_empty(spark):
    assert found(spark, [], [(1, 1, 1)]) == {}


def test_very_long_text(spark):
    docs = [(1, "word A " * 300_000, "en"), (2, "word A " * 300_000, "en")]
    assert found(spark, docs, []) == plain(docs, [])
