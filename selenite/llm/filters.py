"""Filter interaction audit: what each filter removes in every order of application, from one SQL CUBE over failure flags.

Rows are reduced to counts by part and flags first. CUBE over the flags and the part then sums every selection of flags: its row
in which all selected flags are false counts the survivors of that subset of filters, whatever order they are applied in. A step
of an order goes from one subset to a larger one, so all figures are differences of survivors: pairs of subsets, joined per step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

#: Whole words: what lies between ASCII white space.
WORDS = r"[^\x20\x09-\x0D]+"


def text_flags(text: Column) -> dict[str, Column]:
    """Failures that a text shows by itself; null is an empty text."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    words = F.regexp_extract_all(text, F.lit(WORDS), F.lit(0))
    n = F.size(words)
    return {
        "A": n < 100,
        "B": 100 * F.size(F.array_distinct(words)).cast("long") < 80 * n.cast("long"),
        "C": 100 * (F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))).cast("long") > 10 * F.length(text).cast("long"),
        "D": text.rlike(r"[#$%&*|]"),
    }


def flagged(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """part, A to E, n, good, toxic: counts of documents alike in part, flags and labels.

    Texts are read once and never travel: what does is the id, the flags and the text's SHA-256. E needs the smallest id of
    a text: rows of one text meet as one row for each part and label, with the smallest id and how many rows have it.
    """
    base = documents.select(F.col("doc_id"), F.col("text"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"))
    rows = base.select("doc_id", "part", F.unhex(F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256)).alias("sha"), *[c.alias(k) for k, c in text_flags(F.col("text")).items()])
    known = labels.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("bad"))
    rows = rows.join(known, "doc_id", "left").withColumns({k: F.coalesce(k, F.lit(False)) for k in ("good", "bad")})
    alike = ["part", "A", "B", "C", "D", "good", "bad"]
    # rows of one id first, so that the smallest id carries its number of rows; the join's dealing by doc_id serves this too
    by_id = rows.groupBy("doc_id", "sha", *alike).agg(F.count("*").alias("n"))
    of_text = by_id.groupBy("sha", *alike).agg(F.sum("n").alias("n"), F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))).alias("least"), F.sum(F.when(F.col("doc_id").isNull(), F.col("n"))).alias("nameless"))
    # a text has one row for each part and pair of labels by now
    met = of_text.withColumn("first", F.min("least.doc_id").over(Window.partitionBy("sha"))).withColumn("own", F.coalesce(F.when(F.col("least.doc_id") == F.col("first"), F.col("least.n")), F.lit(0)) + F.coalesce("nameless", F.lit(0)))
    split = met.select(*alike, F.explode(F.array(F.struct(F.lit(False).alias("E"), F.col("own").alias("k")), F.struct(F.lit(True).alias("E"), (F.col("n") - F.col("own")).alias("k")))).alias("s")).select(*alike, "s.*").filter("k > 0")
    return split.groupBy("part", "A", "B", "C", "D", "E").agg(F.sum("k").alias("n"), F.sum(F.when(F.col("good"), F.col("k")).otherwise(0)).alias("good"), F.sum(F.when(F.col("bad"), F.col("k")).otherwise(0)).alias("toxic"))


def survivors(counts: DataFrame, names: str, sums: tuple[str, ...] = ("n", "good", "toxic")) -> DataFrame:
    """part, mask and ``sums`` of what no filter of the subset fails; bit k of mask is the k-th of ``names``. Subsets without
    survivors have rows of zeros."""
    flags = [F.col(k) for k in names]
    selected = [1 - F.grouping(k) for k in flags]
    mask = sum((s * (1 << k) for k, s in enumerate(selected)), F.lit(0)).cast("int")
    cube = counts.cube("part", *names).agg(F.grouping("part").alias("all_parts"), mask.alias("mask"), *[F.sum(s).alias(s) for s in sums])
    none_fails = F.lit(True)
    for k in flags:
        none_fails = none_fails & (k.isNull() | ~k)  # null where the flag isn't selected
    found = cube.filter((F.col("all_parts") == 0) & none_fails).select("part", "mask", *sums)
    every = counts.select("part").distinct().select("part", F.explode(F.sequence(F.lit(0), F.lit((1 << len(names)) - 1))).alias("mask"))
    return every.join(found, ["part", "mask"], "left").select("part", "mask", *[F.coalesce(s, F.lit(0)).alias(s) for s in sums])


def steps(parts: DataFrame, names: str) -> DataFrame:
    """part, filter_order, step, letter, mask, place: every step of every order of ``names``; mask is of the filters before, place
    the letter's own bit."""
    letters = F.array(*[F.lit(k) for k in names])
    orders = parts.select("part", F.lit("").alias("filter_order"))
    for _ in names:
        orders = orders.select("part", "filter_order", F.explode(F.filter(letters, lambda k: ~F.col("filter_order").contains(k))).alias("k")).select("part", F.concat("filter_order", "k").alias("filter_order"))
    out = orders.select("part", "filter_order", F.explode(F.sequence(F.lit(1), F.lit(len(names)))).alias("step"))
    bits = sum((F.when(F.instr(F.substring(F.col("filter_order"), F.lit(1), F.col("step") - 1), k) > 0, 1 << i).otherwise(0) for i, k in enumerate(names)), F.lit(0))
    letter = F.substring(F.col("filter_order"), F.col("step"), F.lit(1))
    place = sum((F.when(letter == k, 1 << i).otherwise(0) for i, k in enumerate(names)), F.lit(0))
    return out.select("part", "filter_order", "step", letter.alias("letter"), bits.cast("int").alias("mask"), place.cast("int").alias("place"))


def audit(counts: DataFrame, names: str = "ABCDE") -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley and letter of every step of
    every order of the filters ``names``, from ``counts``: part, a boolean column for each name, n, good, toxic.

    A part's rows are there, zeros included, once it has a document; an empty table gives no rows. Null parts are the caller's
    to name.
    """
    all_ = (1 << len(names)) - 1
    s = cut(survivors(cut(counts), names))  # both are small; texts are read for the first alone
    at = lambda k: s.select("part", F.col("mask").alias(k), F.col("n").alias(f"{k}_n"), F.col("good").alias(f"{k}_good"), F.col("toxic").alias(f"{k}_toxic"))
    walk = steps(s.select("part").distinct(), names).withColumns({"before": F.col("mask"), "after": F.col("mask").bitwiseOR(F.col("place")), "none": F.lit(0), "only": F.col("place"), "others": F.lit(all_).bitwiseXOR(F.col("place")), "every": F.lit(all_)})
    for k in ("before", "after", "none", "only", "others", "every"):
        walk = walk.join(at(k), ["part", k])
    # an order's step is one of (filters before)! (filters after)! with the same subset, so a sum over all steps is Shapley's
    whole = walk.groupBy("part", "letter").agg(F.sum(F.col("before_n") - F.col("after_n")).alias("shapley"))
    fails = F.col("none_n") - F.col("only_n")
    removed = F.col("before_n") - F.col("after_n")
    return walk.join(whole, ["part", "letter"]).select(
        "part", "filter_order", "step", F.col("after_n").alias("kept"), removed.alias("removed"), (fails - removed).alias("redundant"), (F.col("others_n") - F.col("every_n")).alias("unique_fails"),
        (F.col("before_good") - F.col("after_good")).alias("good_lost"), (F.col("before_toxic") - F.col("after_toxic")).alias("toxic_lost"), "shapley",
    )
