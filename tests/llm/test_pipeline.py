"""Stages of the corpus pipeline against plain versions, each on what the stage before kept."""

import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F
from test_operators import covered, plain_fingerprint

import corpus_pipeline as P
from selenite.llm import decontam, langid

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    top, out = tmp_path_factory.mktemp("steps"), [spark.read.parquet(f"{DATA}/documents.parquet")]
    for k, (_, stage) in enumerate(P.STAGES):
        stage(spark, out[-1], DATA).write.parquet(str(top / str(k)))
        out.append(spark.read.parquet(str(top / str(k))))
    return out


def test_columns(steps):
    assert all(s.columns == list(P.COLUMNS) for s in steps[:-1])


def test_language_keeps_clear_documents(steps):
    model = langid.fit(steps[0])
    want = {r["doc_id"] for r in steps[0].collect() if model.predict(r["text"])[1] >= P.CLEAR}
    assert {r["doc_id"] for r in steps[1].collect()} == want and len(want) > 0.97 * steps[0].count()


def test_near_duplicates(steps):
    fps = {r["doc_id"]: plain_fingerprint(r["text"]) for r in steps[1].collect()}
    root = {i: i for i in fps}
    while True:
        new = {i: min(root[j] for j in fps if (fps[i] ^ fps[j]).bit_count() <= 4) for i in fps}
        if new == root:
            break
        root = new
    assert {r["doc_id"] for r in steps[2].collect()} == set(root.values())


def test_repeated_strings(steps):
    rows = sorted(steps[2].collect(), key=lambda r: r["doc_id"])
    got = {r["doc_id"]: r for r in steps[3].collect()}
    for r, m in zip(rows, covered([r["text"].encode() for r in rows], [r["doc_id"] for r in rows], 50), strict=True):
        at, left = 0, ""
        for ch in r["text"]:
            n = len(ch.encode())
            left += "" if all(m[at : at + n]) else ch
            at += n
        if left:
            assert got[r["doc_id"]]["text"] == left and got[r["doc_id"]]["n_chars"] == len(left)
        else:
            assert r["doc_id"] not in got


def test_benchmark_and_mixture(spark, steps):
    found = decontam.scan(steps[3], spark.read.parquet(f"{DATA}/benchmark.parquet"))
    bad = {r["doc_id"] for r in found.filter("n_hit > 0 AND 20 * n_hit >= n_words").collect()}
    kept = {r["doc_id"] for r in steps[4].collect()}
    assert kept == {r["doc_id"] for r in steps[3].collect()} - bad
    assert {r["doc_id"] for r in steps[5].collect()} <= kept and steps[5].groupBy("doc_id", "epoch").count().filter("count > 1").count() == 0


def test_run(spark, steps):
    a, b = (df.select(F.count("*"), F.bit_xor(F.xxhash64("doc_id", "epoch", "place"))).first() for df in (P.run(spark, DATA), steps[-1]))
    assert a == b


def test_the_rest_works_without_this_folder(tmp_path):
    top = os.path.dirname(os.path.abspath(P.__file__))
    for name in os.listdir(top):
        if name not in (".git", "corpus_pipeline.py", "selenite"):
            os.symlink(f"{top}/{name}", tmp_path / name)
    os.makedirs(tmp_path / "selenite")
    for name in os.listdir(f"{top}/selenite"):
        if name != "llm":
            os.symlink(f"{top}/selenite/{name}", tmp_path / "selenite" / name)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 40 and not any(k.startswith('op') or k == 'pipeline' for k in q); assert set(e.oracle_sql()) <= set(q)"
    # the entry file is a copy, so that imports start from the new folder
    os.remove(tmp_path / "__spark_entry__.py")
    (tmp_path / "__spark_entry__.py").write_text(open(f"{top}/__spark_entry__.py").read())
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
