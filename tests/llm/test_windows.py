"""The exchange of windows: bytes decide, hashes only propose, and hot keys are split."""

import numpy as np
import pytest
from test_operators import covered, docs_of, words

from selenite.llm import substrings, suffixes, windows

#: Texts of different content whose 64-bit mixes were equal in what was kept of them.
COLLIDING_WORDS = ["w0 w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11 ~t-MfF^ge>l)w#{u", "w0 w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11 rSp#0,@d84?\\emC]"]
COLLIDING_BYTES = ["FI%O6TTpFN'AI|/>U]>u-Pes!i\\*w's`=r5P4KYJ=/]n_#y>vW", "FI%O6TTpFN'AI|/>U]>u-Pes!i\\*w's`{{zNK&\\[rInhXmqzvW"]


def test_colliding_texts_stay(spark):
    assert all(len(t) == 50 for t in COLLIDING_BYTES)
    for texts in (COLLIDING_WORDS, COLLIDING_BYTES):
        for ids in ([1, 2], [2, 1]):
            df = docs_of(spark, texts, ids)
            assert {r["n_removed"] for r in substrings.repeated_words(df).collect()} == {0}
            assert {r["n_removed"] for r in suffixes.repeated_bytes(df).collect()} == {0}


def test_bytes_decide():
    rng = np.random.default_rng(9)
    parts = [bytes(rng.integers(97, 99, int(rng.integers(0, 12)), dtype=np.uint8)) for _ in range(600)] + [b"x" * 700, b"x" * 699 + b"y", b"x" * 700]
    data, size = np.frombuffer(b"".join(parts), np.uint8), np.array([len(p) for p in parts])
    start = np.cumsum(size) - size
    for h in (windows.names(data, start, start + size), np.zeros(len(parts), np.uint64), windows.names(data, start, start + size) % np.uint64(3)):
        g = windows.alike(data, start, start + size, h).tolist()
        assert len(set(g)) == len(set(parts)) == len(set(zip(g, parts, strict=True)))


@pytest.mark.parametrize("hot", [1, 3])
def test_hot_keys(spark, monkeypatch, hot):
    """Runs of one common passage with other surroundings in every document, dealt window by window; two hashes only."""
    monkeypatch.setattr(windows, "HOT_RUNS", hot)
    rng = np.random.default_rng(10)
    v = [f"q{i}" for i in range(25)]
    common = " ".join(rng.choice(v, 7))
    texts = [" ".join(rng.choice(v, int(rng.integers(3, 9)))) + " " + common + " " + " ".join(rng.choice(v[:3], 8)) for _ in range(50)]
    texts += texts[:5] + ["a " * 60, "a " * 70]
    ids = list(range(len(texts)))[::-1]
    for made, seqs, n in ((substrings.repeated_words, [words(t) for t in texts], 13), (suffixes.repeated_bytes, [t.encode() for t in texts], 50)):
        want = {i: sum(m) for i, m in zip(ids, covered(seqs, ids, n), strict=True)}
        assert {r["doc_id"]: r["n_removed"] for r in made(docs_of(spark, texts, ids)).collect()} == want


def test_weak_hashes_do_no_harm(spark, monkeypatch):
    """With names that tell almost nothing apart, results stay exact."""
    real = windows.names
    rng = np.random.default_rng(12)
    v = [f"z{i}" for i in range(12)]
    texts = [" ".join(rng.choice(v, int(rng.integers(5, 60)))) for _ in range(25)]
    texts += [texts[0] + " end", "start " + texts[1], texts[2]]
    data = [(t.encode(), 50, suffixes.ByteScheme()) for t in texts], [(t, 13, substrings.WordScheme()) for t in texts]
    monkeypatch.setattr(windows, "names", lambda *a: real(*a) % np.uint64(2))
    monkeypatch.setattr(substrings, "names", lambda *a: real(*a) % np.uint64(5))
    import pyarrow as pa

    for rows, seqs, n in ((data[0], [t.encode() for t in texts], 50), (data[1], [words(t) for t in texts], 13)):
        scheme = rows[0][2]
        b = windows.Batch(pa.table({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": pa.array([t.encode() for t in texts], pa.binary())}), scheme)
        a, e = scheme.span(b.symbols, b.runs.first.astype(int), b.runs.n.astype(int))
        seen = {}
        for i in range(len(a)):
            seen.setdefault((int(b.runs.key[i]), b.symbols.data[a[i] : e[i]].tobytes()), set()).add(int(b.entry[i]))
        assert all(len(s) == 1 for s in seen.values()) and len({next(iter(s)) for s in seen.values()}) == len(seen)
