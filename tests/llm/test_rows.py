"""Decisions made per row hold for that row, with null and repeated ids too."""

from collections import Counter

from pyspark.sql import Window
from pyspark.sql import functions as F
from test_operators import DOCS

from selenite.llm import decontam, langid, simhash, toxicity


def test_one_of_each_by_row(spark):
    words = [" ".join(f"{p}{i}" for i in range(60)) for p in "abcdef"]
    rows = [(1, words[0], "en"), (2, words[0], "en"), (2, words[1], "en"), (3, words[2], "en"), (3, words[3], "en"), (None, words[4], "en"), (None, words[4], "en"), (None, words[4], "de"), (None, words[0], "en"), (None, words[5], "en"), (3, words[2], "en"), (3, words[2], "de")]
    df = spark.createDataFrame([(i, t, g, "s", len(t)) for i, t, g in rows], DOCS)
    sets = []
    for parts in (1, 5):
        got = [tuple(r) for r in simhash.one_of_each(df.repartition(parts)).collect()]
        assert Counter((r[0], r[1]) for r in got) == Counter([(1, words[0]), (2, words[1]), (3, words[2]), (3, words[3]), (None, words[4]), (None, words[5])])
        sets.append(sorted(map(str, got)))
    assert sets[0] == sets[1]


def test_clean_by_row(spark):
    bench = spark.createDataFrame([(1, " ".join(f"t{i}" for i in range(13)))], "item_id long, text string")
    bad, good = "x " + " ".join(f"t{i}" for i in range(13)), "nothing of it here"
    rows = [(1, bad), (1, good), (None, bad), (None, good), (2, good), (3, bad), (4, None)]
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], DOCS)
    got = Counter((r["doc_id"], r["text"]) for r in decontam.clean(df, bench).collect())
    assert got == Counter([(1, good), (None, good), (2, good), (4, None)])


def test_rare_languages_are_learned(spark):
    """Three languages of 5 documents each beside one of 6000; the rare ones' words share no letter with it."""
    rows = [(i, "the cat sat on the mat", "en", "s", 22) for i in range(6000)]
    rare = {"el": "\u03b1\u03b2\u03b3 \u03b4\u03b5\u03b6", "ru": "\u0434\u0436\u0437 \u0438\u0439\u043a", "he": "\u05d0\u05d1\u05d2 \u05d3\u05d4\u05d5"}
    # ids with large hashes, so that the smallest hashes of all rows leave them out
    spots = spark.range(6000, 9000).filter(~langid.held_out(F.col("id"))).orderBy(F.desc(F.xxhash64("id"))).limit(15).collect()
    for k, r in enumerate(spots):
        lang = sorted(rare)[k % 3]
        rows.append((r["id"], rare[lang], lang, "s", 7))
    df = spark.createDataFrame(rows, DOCS)
    model = langid.fit(df)
    assert model.langs == ["el", "en", "he", "ru"]
    assert all(r["lang_pred"] == r["lang"] and r["lang_score"] > 0.5 for r in langid.identify(df, model).collect())


def test_samples_are_bounded(spark):
    """One id repeated 100,000 times is one document of the sample; characters are bounded too."""
    ids = [r["id"] for r in spark.range(3000).filter(~langid.held_out(F.col("id"))).collect()]
    one = ids[0]
    df = spark.range(100_000).select(F.lit(one).cast("long").alias("doc_id"), F.format_string("copy %06d", "id").alias("text"), F.lit("en").alias("lang"))
    df = df.unionByName(spark.createDataFrame([(i, f"text {i}", "en") for i in ids[1:]] + [(i, f"texte {i}", "fr") for i in ids], df.schema))
    got = langid.sample(df, "lang", 50, 10_000, 10).collect()
    least = {r["id"] for r in spark.createDataFrame([(i,) for i in ids], "id long").orderBy(F.xxhash64("id")).limit(50).collect()}
    h = {r["h"] for r in spark.createDataFrame([(i,) for i in least], "id long").select(F.xxhash64("id").alias("h")).collect()}
    assert {g: {r["h"] for r in got if r["lang"] == g} for g in ("en", "fr")} == {"en": h, "fr": h} and len(got) == 100
    assert sum(len(r["text"]) for r in langid.sample(df, "lang", 1000, 2000, 10).collect()) <= 2000
    assert {r["lang"] for r in langid.sample(df, "lang", 50, 10_000, 1).collect()} == {"en"}  # as many ids, so by name


def test_toxicity_sample_is_bounded(spark):
    ids = [r["id"] for r in spark.range(200).filter(~langid.held_out(F.col("id"), 3, 1)).collect()]
    docs = spark.range(20_000).select(F.lit(ids[0]).cast("long").alias("doc_id"), F.format_string("zorg %05d", "id").alias("text"), F.lit("en").alias("lang"))
    docs = docs.unionByName(spark.createDataFrame([(i, "bel" if i % 2 else "zorg", "en") for i in ids[1:]], docs.schema))
    labels = spark.createDataFrame([(i, 0 if i % 2 else 1) for i in ids] * 3 + [(None, 1), (ids[0], None)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    assert model.score("zorg") >= toxicity.CUT > model.score("bel")


def test_toxicity_learns_from_every_labelled_row(spark):
    """A word that only toxic documents beyond the 3000 smallest id hashes hold, and one in a long text alone, are learned too."""
    ids = spark.range(14_000).filter(~langid.held_out(F.col("id"), 3, 1)).select(F.col("id").alias("doc_id"), (F.col("id") % 2 == 0).cast("int").alias("toxic"), F.xxhash64("id").alias("h"))
    late = F.row_number().over(Window.partitionBy("toxic").orderBy("h")) > 3000
    bad = F.when(F.col("toxic") == 0, "bel").when(late, "zorg").otherwise("kwak")
    filler = F.concat_ws(" ", *[F.concat(F.lit("w"), F.pmod(F.xxhash64("doc_id", F.lit(k)), F.lit(50)).cast("string")) for k in range(5)])
    docs = ids.select("doc_id", F.concat_ws(" ", bad, filler).alias("text"), F.lit("en").alias("lang"))
    long = spark.range(20_000, 20_060).filter(~langid.held_out(F.col("id"), 3, 1)).select(F.col("id").alias("doc_id"), F.concat(F.lit("mord "), F.repeat(F.lit("w1 "), 70_000)).alias("text"), F.lit("en").alias("lang"))
    labels = ids.select("doc_id", "toxic").unionByName(long.select("doc_id", F.lit(1).alias("toxic")))
    model = toxicity.fit(docs.unionByName(long), labels)
    assert all(model.score(t) >= toxicity.CUT for t in ("zorg w1 w2", "kwak w3 w4", "mord w1 w2")) and model.score("bel w1 w2") < toxicity.CUT
