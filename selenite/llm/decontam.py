"""Benchmark decontamination: scan every document's word windows against a broadcast hash set of benchmark windows.

Only SQL expressions. Every benchmark window has an anchor, the pair of words in it that fewest windows have. One scan joins all
words of all documents, each with the next, with the table of anchors, which gives the spots; a second one builds the
windows around spots and joins them as whole text, so that a match needs no further check. The windows of a document are made in
blocks, so that a very long text never stands in memory as all its windows at once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import blocks_for, cut

WINDOW, BLOCK = 13, 1024
#: Benchmark windows that are broadcast (about 150 bytes each); with more, Spark joins the windows around spots by a shuffle.
BROADCAST_WINDOWS = 300_000
#: Anchors of one broadcast (about 100 bytes each); with more, the documents are scanned once for each so many.
PART_ANCHORS = 500_000
#: Bytes of spots that are broadcast; with more, blocks of words are joined with them by a shuffle.
BROADCAST_SPOTS = 64 << 20


def words_of(text: Column) -> Column:
    """Lower-cased (A-Z) words: runs of ASCII letters, digits and characters beyond ASCII."""
    low = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.array_remove(F.split(low, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def _joined(words: Column, start: Column, n: int) -> Column:
    """``n`` words from ``start`` (from 0), joined; word by word, as slice() would first copy the whole array."""
    return F.concat_ws(" ", *[F.get(words, start + j) for j in range(n)])


def _each(first: Column, last: Column, make) -> Column:
    """make(i) for i from first to last; empty if last is smaller."""
    return F.transform(F.when(last >= first, F.sequence(first, last)).otherwise(F.array().cast("array<int>")), make)


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """key (words joined by a space), len, items (distinct ids, as strings): the windows of all items.

    An item of fewer words than ``window``, but at least one, is one window; an item of none has no window. Null ids are
    left out. Pre-aggregated, so that a window that many items share is one row.
    """
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), words_of(F.col("text")).alias("w")).filter("item IS NOT NULL AND size(w) > 0")
    # concat_ws skips the nulls past a short item's end
    keys = items.select("item", F.least(F.size("w"), F.lit(window)).alias("len"), F.explode(_each(F.lit(0), F.greatest(F.size("w") - window, F.lit(0)), lambda i: _joined(F.col("w"), i, window))).alias("key"))
    return keys.groupBy("key", "len").agg(F.sort_array(F.collect_set("item")).alias("items"))


def anchors_of(grams: DataFrame, small: bool) -> DataFrame:
    """word, next: pairs of neighbours such that every window has one; of a window of one word the word, next null.

    Of each window it is the pair whose first word is in the fewest windows, the longest of these.
    """
    words = F.split("key", " ")
    pairs = grams.select("key", "len", F.explode(_each(F.lit(0), F.greatest(F.col("len") - 2, F.lit(0)), lambda i: F.struct(F.get(words, i).alias("word"), F.get(words, i + 1).alias("next")))).alias("p")).select("key", "len", "p.*")
    often = pairs.select("key", "len", "word").distinct().groupBy("word").agg(F.count("*").alias("often"))
    rarest = pairs.join(F.broadcast(often) if small else often, "word").groupBy("key", "len").agg(F.min(F.struct("often", -F.length("word"), "word", "next")).alias("m"))
    return rarest.select("m.word", "m.next").distinct()


def spots_of(documents: DataFrame, anchors: DataFrame, window: int) -> DataFrame:
    """doc_id, sign, b, ats: by text and block of words, where in it anchors stand from which a window of the block may hang.

    Texts that share id and hash share their spots, which is no harm: what hangs there is compared as text.
    """
    n = {r["one"]: r["n"] for r in anchors.groupBy(F.col("next").isNull().alias("one")).agg(F.count("*").alias("n")).collect()}
    base = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("sign"), words_of(F.col("text")).alias("word"))
    each = base.select("doc_id", "sign", F.posexplode(F.arrays_zip("word", F.slice("word", F.lit(2), F.size("word")).alias("next"))).alias("at", "p")).select("doc_id", "sign", "at", "p.word", "p.next")
    found = []
    for one, on in ((False, ["word", "next"]), (True, ["word"])):
        parts = blocks_for(n.get(one, 0), PART_ANCHORS, 0)
        mine = anchors.filter(F.col("next").isNull() == one).select(on)
        for k in range(parts):
            found.append(each.join(F.broadcast(mine.filter(F.pmod(F.xxhash64(*on), F.lit(parts)) == k)), on, "left_semi").select("doc_id", "sign", "at"))
    if not found:
        return each.limit(0).select("doc_id", "sign", F.col("at").alias("b"), F.array("at").alias("ats"))
    block = lambda c: F.floor(c / BLOCK).cast("int")
    rows = reduce(DataFrame.unionByName, found).select("doc_id", "sign", "at", F.explode(F.sequence(block(F.greatest(F.col("at") - max(window - 2, 0), F.lit(0))), block(F.col("at")))).alias("b"))
    return rows.groupBy("doc_id", "sign", "b").agg(F.sort_array(F.collect_set(F.col("at") - F.col("b") * BLOCK)).alias("ats"))


def scan(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, **more: Column) -> DataFrame:
    """Per document row: doc_id, n_words, n_hit, items (sorted strings), spans (array of struct(first, last) of words hit).

    Null text: no words. Null doc_id stays. Repeated rows are judged each on its own. Spans are maximal and in order. An empty
    table gives no rows, an empty benchmark no hits; further columns, whatever their names, are left out, but
    ``more`` adds such. One plan for benchmarks and documents of every size; what is broadcast is counted before. The one
    shuffle of all documents carries hits and one small row each, never texts.
    """
    grams = cut(benchmark_windows(benchmark, window))
    sizes = {r["len"]: r["n"] for r in grams.groupBy("len").agg(F.count("*").alias("n")).collect()}  # at most ``window`` rows
    small = sum(sizes.values()) <= BROADCAST_WINDOWS
    spots = cut(spots_of(documents, cut(anchors_of(grams, small)), window))
    weight = spots.agg(F.sum(F.size("ats") * 4 + 60).alias("n")).first()["n"] or 0
    spots = spots.select(F.col("doc_id").alias("_id"), F.col("sign").alias("_sign"), F.col("b").alias("_b"), "ats")
    docs = documents.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_sign"), words_of(F.col("text")).alias("w"), *(v.alias(k) for k, v in more.items()))
    own = ["rid", "doc_id", "n_words", *more]
    docs = docs.withColumn("n_words", F.size("w").cast("long"))
    # one block of words a row; block 0 also stands for the document itself
    last = F.floor(F.greatest(F.size("w") - 1, F.lit(0)) / BLOCK).cast("int")
    words = lambda b: _each(b * BLOCK, F.least((b + 1) * BLOCK + window - 1, F.size("w")) - 1, lambda i: F.get(F.col("w"), i))
    blocks = docs.select(*own, "text_sign", F.posexplode(F.transform(F.sequence(F.lit(0), last), words)).alias("b", "bw"))
    there = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_sign") == F.col("_sign")) & (F.col("b") == F.col("_b"))
    blocks = blocks.join(F.broadcast(spots) if weight <= BROADCAST_SPOTS else spots, there, "left").filter("b = 0 OR ats IS NOT NULL")

    def made(n: int) -> Column:
        ats = F.coalesce("ats", F.array().cast("array<int>"))
        starts = F.transform(ats, lambda p: _each(F.greatest(p - max(n - 2, 0), F.lit(0)), F.least(p, F.size("bw") - n, F.lit(BLOCK - 1)), lambda i: i))
        return F.transform(F.array_distinct(F.flatten(starts)), lambda i: F.struct(i.alias("at"), F.lit(n).alias("len"), _joined(F.col("bw"), i, n).alias("key")))

    itself = F.when(F.col("b") == 0, F.array(F.struct(F.lit(-1).alias("at"), F.lit(0).alias("len"), F.lit("").alias("key")))).otherwise(F.array().cast("array<struct<at:int,len:int,key:string>>"))
    rows = blocks.select(*own, "b", F.explode(F.concat(itself, *(made(n) for n in sorted(sizes)))).alias("g"))
    rows = rows.select(*own, (F.col("b").cast("long") * BLOCK + F.col("g.at")).alias("first"), F.col("g.len").alias("len"), F.col("g.key").alias("key"))
    hits = rows.join(F.broadcast(grams) if small else grams, ["key", "len"], "left").filter("len = 0 OR items IS NOT NULL")
    hits = hits.select(*own, F.when(F.col("len") > 0, F.col("first")).alias("first"), F.when(F.col("len") > 0, F.col("first") + F.col("len") - 1).alias("last"), "items")
    # hits that touch make a span
    order = Window.partitionBy("rid").orderBy(F.col("first").asc_nulls_first(), "last")
    reach = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    hits = hits.withColumn("fresh", F.when(reach.isNull() | (F.col("first") > reach + 1), 1).otherwise(0))
    hits = hits.withColumn("span", F.sum("fresh").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    named = lambda c: F.array_distinct(F.flatten(F.collect_list(c)))
    spans = hits.groupBy(*own, "span").agg(F.min("first").alias("first"), F.max("last").alias("last"), named("items").alias("items"))
    out = spans.groupBy(*own).agg(F.array_sort(F.collect_list(F.when(F.col("first").isNotNull(), F.struct("first", "last")))).alias("spans"), F.array_sort(named("items")).alias("items"))
    return out.select(*own[1:], "spans", "items", F.aggregate("spans", F.lit(0).cast("long"), lambda s, p: s + p["last"] - p["first"] + 1).alias("n_hit"))


def contaminated(n_hit: Column, n_words: Column, share: int = 20) -> Column:
    """At least one word in ``share`` is hit."""
    return (n_hit > 0) & (n_hit * share >= n_words)


def clean(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``documents`` without the contaminated ones, columns unchanged. Each row is judged by its own text, whatever rows share its
    id, rows without an id too. Ids and hashes of contaminated texts join by a shuffle unless Spark finds them small."""
    sign = F.sha2(F.col("text").cast("string"), 256)
    found = scan(documents, benchmark, window, sign=sign)
    bad = found.filter(contaminated(F.col("n_hit"), F.col("n_words"))).select(F.col("doc_id").alias("_bad"), F.col("sign").alias("_bad_sign")).distinct()
    signed = documents.withColumns({"_id": F.col("doc_id").cast("long"), "_sign": sign})
    return signed.join(bad, signed["_id"].eqNullSafe(bad["_bad"]) & (signed["_sign"] == bad["_bad_sign"]), "left_anti").drop("_id", "_sign")
