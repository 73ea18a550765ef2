"""The operators of the llm folder against brute force, on small tables with nulls, ties, repeats and odd texts."""

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from selenite.llm import bwt, chat, decontam, langid, mixing, simhash, substrings, suffixes, topk, toxicity, urls
from selenite.llm.common import table

DATA = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, texts, ids=None):
    rows = [(i, t, "en", "s", len(t or "")) for i, t in zip(ids or range(len(texts)), texts, strict=True)]
    return spark.createDataFrame(rows, DOCS).withColumns({"batch": F.lit(1), "fp": F.lit("x"), "key": F.lit(0), "n_words": F.lit("clash")})


@pytest.fixture(scope="module")
def texts():
    rng = np.random.default_rng(5)
    vocabulary = ["a", "b", "the", "of", "ré", "über", "x" * 300, *(f"w{i}" for i in range(60))]
    passage = " ".join(rng.choice(vocabulary, 40))
    out = []
    for _ in range(60):
        t = " ".join(rng.choice(vocabulary, int(rng.integers(1, 90))))
        if rng.random() < 0.5:
            t += "\n" + passage[int(rng.integers(0, 60)) :] + " " + " ".join(rng.choice(vocabulary, 5))
        out.append(t)
    out += [None, "", " \t\n", "a " * 200, "a " * 190 + "b", "the " * 40, out[3], out[3], out[7] + " more", "é" * 400, "é" * 399, "aé" * 300]
    return out


def words(t):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", t or "") if w]


def covered(seqs, ids, n):
    """Marks by brute force what a window of n that starts in a smaller id covers."""
    first = {}
    for i, s in zip(ids, seqs, strict=True):
        if i is not None:
            for j in range(len(s) - n + 1):
                k = tuple(s[j : j + n])
                first[k] = min(first.get(k, i), i)
    out = []
    for i, s in zip(ids, seqs, strict=True):
        m = [False] * len(s)
        for j in range(len(s) - n + 1):
            if i is not None and first[tuple(s[j : j + n])] < i:
                m[j : j + n] = [True] * n
        out.append(m)
    return out


IDS = [None, 7, 7]


def test_long_documents_in_pieces(texts):
    """Keys of windows don't depend on where a long document is cut."""
    for scheme, sizes in ((substrings.WordScheme(), (13, 40, 1 << 18)), (suffixes.ByteScheme(), (50, 300, 1 << 18))):
        module, name = (substrings, "_PIECE") if scheme.window == 13 else (suffixes, "_CHUNK")
        data = [(t or "").encode() for t in texts]
        flat, offsets = np.frombuffer(b"".join(data), np.uint8), np.concatenate([[0], np.cumsum([len(d) for d in data])])
        symbols, held, seen = scheme.symbols(flat, offsets), getattr(module, name), []
        for size in sizes:
            setattr(module, name, size)
            r = scheme.runs(symbols)
            key = np.zeros(symbols.size, np.uint64)
            for f, n, k in zip(r.first, r.n, r.key, strict=True):
                key[f : f + n] = k
            seen.append((int(r.n.sum()), key.tobytes()))
        setattr(module, name, held)
        assert len(set(seen)) == 1


def test_substrings(spark, texts):
    ids = [*range(100, 100 + len(texts) - 3), *IDS]
    seqs = [words(t) for t in texts]
    want = sorted((i if i is not None else -1, len(s), sum(m), " ".join(w for w, k in zip(s, m, strict=True) if not k)) for i, s, m in zip(ids, seqs, covered(seqs, ids, 13), strict=True))
    got = substrings.repeated_words(docs_of(spark, texts, ids)).collect()
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["n_words"], r["n_removed"], r["kept"]) for r in got) == want
    for r in got:
        assert sum(s["last"] - s["first"] + 1 for s in r["spans"]) == r["n_removed"]


def test_suffixes(spark, texts):
    ids = [*range(100, 100 + len(texts) - 3), *IDS]
    seqs = [(t or "").encode() for t in texts]
    masks = covered(seqs, ids, 50)
    want = sorted((i if i is not None else -1, len(s), sum(m), bytes(b for b, k in zip(s, m, strict=True) if not k)) for i, s, m in zip(ids, seqs, masks, strict=True))
    got = suffixes.repeated_bytes(docs_of(spark, texts, ids)).collect()
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["n_bytes"], r["n_removed"], bytes(r["kept"])) for r in got) == want
    cut = suffixes.without_repeats(docs_of(spark, texts, ids))
    assert cut.columns[:5] == DOCS.replace(" long", "").replace(" string", "").split(", ") and cut.schema["key"].dataType.simpleString() == "int"
    for r in cut.collect():
        assert (r["text"] is None) <= (r["n_removed"] == 0)


def test_no_documents(spark):
    none = docs_of(spark, ["x"]).limit(0)
    bench = spark.createDataFrame([(1, "x")], "item_id long, text string")
    for df in (substrings.repeated_words(none), suffixes.repeated_bytes(none), simhash.near_duplicates(none), decontam.scan(none, bench), mixing.mix(none), langid.identify(none, langid.fit(none)), suffixes.without_repeats(none)):
        assert df.count() == 0


def test_merged_transforms():
    rng = np.random.default_rng(1)
    strings = [rng.integers(97, 99, int(rng.integers(50, 120))).astype(np.uint8) for _ in range(30)]
    strings += [strings[0][5:70], strings[1], np.full(90, 97, np.uint8), np.full(60, 97, np.uint8)]
    groups = [strings[k::4] for k in range(4)]
    z, place, interval = bwt.repeated([(np.concatenate(g), np.array([len(s) for s in g])) for g in groups], 7)
    at = defaultdict(set)
    for k, g in enumerate(groups):
        base = 0
        for s in g:
            for j in range(len(s) - 49):
                at[s[j : j + 50].tobytes()].add((k, base + j))
            base += len(s) + 1
    got = defaultdict(set)
    for s, p, i in zip(z, place, interval, strict=True):
        got[int(i)].add((int(s), int(p)))
    assert sorted(map(sorted, got.values())) == sorted(sorted(v) for v in at.values() if len(v) > 1)


def plain_fingerprint(t, n=4):
    w = (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    w = words(w)
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + n]).encode(), 42) for i in range(max(1, len(w) - n + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash(spark, texts):
    texts = [*texts, texts[0].upper() + " Ä", "One", "one", "two words"]
    near = " ".join(f"n{i}" for i in range(300))
    texts += [near.replace(f"n{i} ", f"m{i} ") for i in range(0, 300, 9)]
    ids = list(range(len(texts)))
    fps = [plain_fingerprint(t) for t in texts]
    root = ids[:]
    for _ in ids:  # spread the smallest id over links until nothing changes
        new = [min(root[j] for j in ids if (fps[i] ^ fps[j]).bit_count() <= 4) for i in ids]
        if new == root:
            break
        root = new
    got = simhash.near_duplicates(docs_of(spark, texts)).select("doc_id", simhash.hex_of(F.col("fp")).alias("h"), "component_id").collect()
    assert {r["doc_id"]: (r["h"], r["component_id"]) for r in got} == {i: (f"{fps[i]:016x}", root[i]) for i in ids}
    kept = simhash.one_of_each(docs_of(spark, [*texts, "again"], [*ids, 3])).select("doc_id").collect()
    assert sorted(r[0] for r in kept) == sorted([*set(root), 3])  # the text "again" is like no other, whatever its id


def test_golay_keys_meet():
    rng = np.random.default_rng(2)
    x = rng.integers(0, 1 << 63, 3000, dtype=np.uint64) << np.uint64(1)
    y = x.copy()
    for _ in range(4):
        y ^= np.uint64(1) << rng.integers(0, 64, 3000, dtype=np.uint64)
    pairs = [set(zip(*map(np.ndarray.tolist, simhash.fuzzy_keys(v)[::-1]), strict=True)) for v in (x, y)]
    assert {w for w, _ in pairs[0] & pairs[1]} == set(range(3000))


def test_top_k(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(v) for v in rng.normal(0, 0.2, 40)]) for i in range(300)]
    rows += [(300, rows[4][1]), (301, rows[4][1]), (302, None), (303, [None, 1.0]), (304, [float("nan"), 1.0]), (305, [float("inf")]), (306, []), (None, rows[1][1]), (307, [0.5] * 50), (308, [1e300, -1e300])]
    rows += [(310, [2.0**21]), (311, [2.0**21]), (312, [2.0**22]), (313, [2.0**22 + 0.01, 3.0]), (350, [-(2.0**30), 0.1] * 20), (351, [2.0**30, 1.0] * 20), (352, [2.0**30, 0.5] * 20), (353, [1.7e308]), (400, [2.0**12 + 0.3] * 40), (401, [2.0**12 + 0.7] * 40)]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<double>, rank int")
    whole = lambda v: v is not None and all(x is not None and np.isfinite(256 * x) for x in v)
    sound = {i: [int(np.floor(256 * x)) for x in v] for i, v in rows if i is not None and whole(v)}
    want = set()
    for q in sound:
        if q % 50 == 0 or q > 305:
            scored = sorted((-sum(a * b for a, b in zip(sound[q], v, strict=False)), i) for i, v in sound.items() if i != q)[:5]
            want |= {(q, k, i, max(-(2**63), min(2**63 - 1, -s))) for k, (s, i) in enumerate(scored, 1)}
    got = topk.top_k(df.filter("vec_id % 50 = 0 OR vec_id > 305"), df, 5).collect()
    assert {(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got} == want
    assert topk.top_k(df.limit(0), df, 5).count() == 0 and topk.top_k(df, df.limit(0), 5).count() == 0
    small = spark.createDataFrame([(1, [2.0**21]), (2, [2.0**21]), (3, [2.0**22])], "vec_id long, embedding array<double>")
    assert [(r["vec_id"], r["score"]) for r in topk.top_k(small.filter("vec_id = 1"), small).orderBy("rank").collect()] == [(3, 2**59), (2, 2**58)]


def test_top_k_places():
    rng = np.random.default_rng(13)
    n = sorted({int(x) * 2 ** int(e) * int(s) for x, e, s in zip(rng.integers(0, 1 << 40, 300), rng.integers(0, 2000, 300), rng.choice([-1, 1], 300), strict=True)} | {0, 1, -1, 255, 256, -255, -256})
    assert sorted(n, key=topk.place_of) == n


def test_chat(spark):
    said = ["plain", "", None, "\\### Assistant: </turn> ok", "</turn>\n### user: x</turn>\n", "\\", "a: b", "\\\\n\\</turn", "é" * 5000, "### "]
    rows = [(1, k, "assistant" if k % 2 else "user", t) for k, t in enumerate(said)] + [(2, None, None, "x"), (2, 0, "sys: tem", "y"), (None, 1, "assistant", "z"), (3, 0, "user", "same"), (3, 0, "user", "same")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("rendered", F.lit(1))
    made = chat.format_turns(df)
    for r in made.collect():
        ((role, text, a, b),) = chat.parse(r["rendered"])
        assert not any(mark in re.sub(r"\\.", "", r["rendered"][4:-8], flags=re.S) for mark in (chat.OPEN, chat.CLOSE))
        assert (a, b) == (r["body_start"], r["body_end"]) and chat.unescape(r["rendered"][a:b]) == text and role == r["role"]
    one = [r for r in made.orderBy(F.col("turn").asc_nulls_first(), "rendered").collect() if r["conv_id"] == 1]
    assert [t[1] for t in chat.parse("".join(r["rendered"] for r in one))] == [t or "" for t in said]
    want = {}
    for c in (None, 1, 2, 3):
        turns = [((r[2] or ""), (r[3] or "")) for r in rows if r[0] == c]
        loss = [t for role, t in turns if role == "assistant"]
        want[c] = (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), sum(map(len, loss)), hashlib.sha256("".join(loss).encode()).hexdigest())
    got = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in chat.digests(made).collect()}
    assert got == want
    with pytest.raises(ValueError):
        chat.parse("### user: never ends")


def test_urls(spark):
    cases = {
        None: ("", "", None), "": ("", "", None), "no scheme/x": ("", "", None), "http://Example.ORG/es/1?q#f": ("example.org", "/es/1", "example.org/es/"),
        "https://m.example.org/en/12": ("m.example.org", "/en/12", "example.org/en/1"), "http://example.org/en/2": ("example.org", "/en/2", "org/"), "http://notexample.org/es/": ("notexample.org", "/es/", "org/"),
        "http://a.com/fr/": ("a.com", "/fr/", "com/fr/"), "http://a.com": ("a.com", "", None), "http://org": ("org", "", None), "x://y://z/w": ("y:", "//z/w", None), "http://ÀB.net\n/p": ("Àb.net\n", "/p", None),
    }
    df = spark.createDataFrame(list(enumerate(cases)), "page_id long, url string").withColumn("host", F.lit("clash"))
    model = urls.fit(spark)
    got = {r["page_id"]: r for r in urls.judge(df, model).collect()}
    for k, (url, (host, path, rule)) in enumerate(cases.items()):
        assert (got[k]["host"], got[k]["path"], got[k]["rule"]) == (host, path, rule), url
        assert got[k]["verdict"] == (("block" if rule.startswith("example") or rule == "com/de/" else "allow") if rule else "block" if got[k]["score"] >= 0.5 else "allow")
    seeds = spark.createDataFrame(urls.LABELLED, "url string, label int").select(F.monotonically_increasing_id().alias("page_id"), "url", "label")
    scored = urls.judge(seeds, model, rules=()).join(seeds, "page_id")
    assert scored.filter((F.col("verdict") == "block") != (F.col("label") == 1)).count() == 0


def test_decontamination(spark, monkeypatch):
    rng = np.random.default_rng(4)
    v = [f"t{i}" for i in range(30)]
    items = {1: " ".join(rng.choice(v, 30)), 2: "Short ITEM, here", 3: "one", 4: "", 5: None, 6: " ".join(rng.choice(v, 13)), 12: None}
    items[12] = items[6]
    texts = [" ".join(rng.choice(v, int(rng.integers(0, 60)))) for _ in range(30)]
    texts += [texts[0] + " " + items[1].upper() + "!", "x " + items[6], items[6] + " " + items[6], "a short item here one", "ONE", None, "", "é" * 9, " ".join(rng.choice(v, 2500)) + " " + items[1]]
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    split = lambda t: [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(low)) if w]
    grams = defaultdict(set)
    for i, t in items.items():
        w = split(t)
        for j in range(max(1, len(w) - 12) if w else 0):
            grams[tuple(w[j : j + 13])].add(str(i))
    want = {}
    for i, t in enumerate(texts):
        w = split(t)
        m, found = [0] * len(w), set()
        for n in {len(g) for g in grams}:
            for j in range(len(w) - n + 1):
                if hits := grams.get(tuple(w[j : j + n])):
                    found |= hits
                    m[j : j + n] = [1] * n
        want[i] = (len(w), sum(m), sorted(found))
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string").withColumn("key", F.lit(0))
    df = docs_of(spark, texts)
    for limits in ({}, {"PART_ANCHORS": 5}, {"BROADCAST_WINDOWS": 0, "BROADCAST_SPOTS": 0, "PART_ANCHORS": 1000}):  # as for larger benchmarks and more hits
        with monkeypatch.context() as m:
            for name, value in limits.items():
                m.setattr(decontam, name, value)
            rows = decontam.scan(df, bench).collect()
        assert {r["doc_id"]: (r["n_words"], r["n_hit"], list(r["items"])) for r in rows} == want and len(rows) == len(texts)
        for r in rows:
            assert r["n_hit"] == sum(s["last"] - s["first"] + 1 for s in r["spans"]) and all(a["last"] + 1 < b["first"] for a, b in zip(r["spans"], r["spans"][1:], strict=False))
    left = {r["doc_id"] for r in decontam.clean(df, bench).select("doc_id").collect()}
    assert left == {i for i, (n, h, _) in want.items() if not (h and 20 * h >= n)}
    assert decontam.scan(df, bench.limit(0)).filter("n_hit > 0").count() == 0


def spark_hash(*values):
    """Spark's xxhash64 of a row: each value's hash is the next one's seed, nulls are passed over."""
    h = 42
    for v in values:
        if v is not None:
            h = xxhash.xxh64_intdigest(v.encode() if isinstance(v, str) else v.to_bytes(8 if v.bit_length() > 31 or isinstance(v, Long) else 4, "little", signed=True), h)
    return h - (1 << 64) if h >> 63 else h


class Long(int):
    """A number that Spark holds as a long."""


def plain_mixture(rows, budget, block_tokens, seed=42):
    """Every row of the mixture by the rules of its docstring, source by source, document by document."""
    docs = defaultdict(list)
    for i, t, _, s, _ in rows:
        if words(t):
            docs[s or ""].append((i, len(words(t)), spark_hash(t)))
    names = sorted(docs)
    counts = [sum(d[1] for d in docs[s]) for s in names]
    budget = budget or sum(counts)
    _, weights = mixing.solve(counts, budget)
    out = []
    for s, total, weight in zip(names, counts, weights, strict=True):
        whole, rest = divmod(int(np.floor(weight * budget + 0.5)), total)
        n_blocks = -(-total // block_tokens)
        blocks = defaultdict(list)
        for d in docs[s]:
            blocks[spark_hash(seed, None if d[0] is None else Long(d[0]), Long(d[2])) % n_blocks].append(d)
        for epoch in range(whole + 1):
            place = lambda b: spark_hash(seed, Long(epoch), s, Long(b))  # noqa: E731, B023
            used = 0
            for b in sorted(blocks, key=lambda b: (place(b), b)):
                order = sorted(blocks[b], key=lambda d: (spark_hash(seed, Long(epoch), None if d[0] is None else Long(d[0]), Long(d[2])), -1 if d[0] is None else d[0], d[1], d[2]))
                for seat, d in enumerate(order):
                    if epoch < whole or used < rest:
                        out.append((epoch, place(b), s, b, seat, -1 if d[0] is None else d[0], d[1]))
                    used += d[1]
    return sorted(out)


def test_mixture(spark, monkeypatch):
    rng = np.random.default_rng(6)
    rows = [(i, "w " * int(rng.integers(1, 30)), "en", "big" if i % 3 == 0 else f"s{i % 7}", 1) for i in range(900)] + [(2000, None, None, None, 1), (2001, " ", "en", None, 1), (2002, "x y", "en", None, 1), (None, "x", "en", "s1", 1)]
    df = spark.createDataFrame(rows, DOCS).withColumn("tokens", F.lit("clash"))
    tokens = defaultdict(int)
    for r in rows:
        tokens[r[3] or ""] += len(words(r[1]))
    names = sorted(s for s in tokens if tokens[s])
    rows += [(7, "a b c d e", "en", "alike", 1)] * 40 + [(8, "x y", "en", "alike", 1)]
    df = spark.createDataFrame(rows, DOCS).withColumn("tokens", F.lit("clash")).repartition(5)
    tokens["alike"] = 202
    names = sorted(s for s in tokens if tokens[s])
    for budget, ranges in ((None, 4096), (3000, 1), (40000, 2)):
        monkeypatch.setattr(mixing, "RANGE_BLOCKS", ranges)
        got = sorted((r["epoch"], r["place"], r["source"], r["block"], r["seat"], r["doc_id"] if r["doc_id"] is not None else -1, r["n_tokens"]) for r in mixing.mix(df, budget, block_tokens=64).collect())
        assert got == plain_mixture(rows, budget, 64)
        assert len({r[:5] for r in got}) == len(got)
    flat, w = mixing.solve([900, 50, 50], 1000, 0.98, 100.0)
    assert flat < 1 and mixing.entropy(w) == pytest.approx(0.98 * np.log(3), abs=1e-6)
    _, w = mixing.solve([9000, 1], 9001, 1.0, 4.0)
    assert w[1] * 9001 <= 4.0001
    many = spark.range(3000).select(F.col("id").cast("string").alias("source"), (F.col("id") % 97 + 1).alias("tokens"))
    plan, n = mixing.plan_of(many, 1_000_000, 0.98, 4.0, 64)
    _, w = mixing.solve([i % 97 + 1 for i in range(3000)], 1_000_000)
    assert n == 3000 and np.allclose([r["weight"] for r in plan.orderBy(F.col("source").cast("int")).collect()], w, rtol=1e-9)


def test_language(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    got = langid.identify(docs, langid.fit(docs)).filter(langid.held_out(F.col("doc_id")))
    assert got.filter("lang_pred = lang").count() >= 0.98 * got.count()
    none = [None, "", "123 !?", "½", "² ³", "Ⅷ ①", "_ ٣"]
    odd = docs_of(spark, [*none, "É", "the and of with"])
    pred = [r["lang_pred"] for r in langid.identify(odd.withColumn("lang_pred", F.lit(3)), langid.fit(docs)).orderBy("doc_id").collect()]
    assert pred[: len(none)] == ["und"] * len(none) and "und" not in pred[len(none) :]
    assert "".join(langid.WORD.findall("".join(map(chr, range(0xD800))))) == "".join(c for c in map(chr, range(0xD800)) if c.isalpha())
    assert zlib.crc32(b"12") % 5 == [k for k in range(5) if spark.range(1).select(langid.held_out(F.lit(12), 5, k).alias("h")).first()["h"]][0]
    assert {r["lang_pred"] for r in langid.identify(odd, langid.fit(odd.limit(0))).collect()} == {"und"}


def test_toxicity(spark):
    rng = np.random.default_rng(7)
    v = [f"{a}{b}" for a in "bcdfgh" for b in ("an", "el", "ir", "os")]
    rows = []
    for i in range(500):
        w = list(rng.choice(v, int(rng.integers(5, 60))))
        bad = i % 3 == 0
        if bad:
            w.insert(int(rng.integers(0, len(w))), str(rng.choice(["zorg", "zorgen", "kwak"])))
        rows.append((" ".join(w), int(bad), "en"))
    model = toxicity.fit_rows(rows[:350])
    right = sum((model.score(t) >= toxicity.CUT) == bool(y) for t, y, _ in rows[350:])
    assert right >= 145
    text = rows[0][0]
    assert np.allclose(model.responses(toxicity.WORD.findall(text)), model.pooled(toxicity.ids_of(text))[0], atol=1e-4)
    long = " ".join(r[0] for r in rows) * 8
    assert np.allclose(model.responses(toxicity.WORD.findall(long)), model.pooled(toxicity.ids_of(long))[0], atol=1e-4)
    got = toxicity.toxicity(docs_of(spark, [None, "", "zorg", "bel"]), model).orderBy("doc_id").collect()
    assert all(0 <= r["score"] <= 1 for r in got) and got[2]["score"] >= toxicity.CUT > got[3]["score"]
    assert 0 <= toxicity.fit_rows([("a", 0, "en")]).score("x") <= 1
