"""Mixing sources to target weights by temperature.

Each source's share of tokens is raised to an exponent and normalised. The exponent is the largest one, at most 1, for which
the weights reach the target entropy (a share of the highest possible one) and no source is repeated more often than allowed;
both are found by bisection, many points a pass. A weight then becomes a token budget, and a source's budget as many whole
permutations of its blocks as fit, then a prefix of one more.

One hash of seed, epoch, source and block orders the blocks: what is published as ``place`` is what the prefix is taken by.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

BLOCK_TOKENS = 65_536
#: Blocks of one range of a source's permutation: running totals go over ranges first, then inside each.
RANGE_BLOCKS = 4096
#: Sources whose plan is broadcast (about 80 bytes each); with more, Spark joins it by a shuffle.
BROADCAST_SOURCES = 100_000
NO_SOURCE = ""
Moments = Callable[[list[float]], list[tuple[float, float]]]


def temperature_weights(tokens: list[int], exponent: float) -> list[float]:
    total = sum(tokens)
    raised = [(t / total) ** exponent if t else 0.0 for t in tokens]
    return [r / math.fsum(raised) for r in raised]


def entropy(weights: list[float]) -> float:
    return -math.fsum(w * math.log(w) for w in weights if w > 0)


def _largest(holds: Callable[[list[float]], list[bool]], low: float, high: float, points: int = 32, passes: int = 8) -> float:
    """The largest x in [low, high] for which holds(x), which is true up to some point; low if it never is."""
    for k in range(passes):
        xs = [low + (high - low) * i / points for i in range(1, points + 1)]
        yes = next((i for i, ok in enumerate(holds(xs)) if not ok), points)
        if yes == points:
            return high if k == 0 else xs[-1]
        low, high = (xs[yes - 1] if yes else low), xs[yes]
    return low


def exponent_of(moments: Moments, total: int, sources: int, least: int, budget: int, min_entropy: float, max_epochs: float) -> float:
    """Entropy falls and the smallest source's repetition falls as the exponent grows to 1, so the entropy target bounds it from
    above and the repetition limit from below; where they conflict, the limit holds. If the budget itself exceeds
    ``max_epochs`` passes over everything, the exponent is 1.

    moments: for each exponent a the sums of p^a and p^a ln p over the sources' shares p; nothing else of them is needed, as the
    smallest source is repeated most.
    """
    if not total:
        return 1.0
    goal = min_entropy * math.log(sources) - 1e-12
    mixed = _largest(lambda xs: [math.log(z) - a * s / z >= goal for a, (z, s) in zip(xs, moments(xs), strict=True)], 0.0, 1.0)
    fits = lambda xs: [(least / total) ** a / z * budget <= max_epochs * least for a, (z, _) in zip(xs, moments(xs), strict=True)]
    if not fits([mixed])[0]:
        mixed = 1.0 - _largest(lambda xs: fits([1.0 - x for x in xs]), 0.0, 1.0 - mixed)
    return mixed


def solve(tokens: list[int], budget: int, min_entropy: float = 0.98, max_epochs: float = 4.0) -> tuple[float, list[float]]:
    """(exponent, weights) of a list of token counts."""
    known = [t for t in tokens if t]
    total = sum(known)

    def moments(xs: list[float]) -> list[tuple[float, float]]:
        p = [t / total for t in known]
        return [(math.fsum(x**a for x in p), math.fsum(x**a * math.log(x) for x in p)) for a in xs]

    a = exponent_of(moments, total, len(known), min(known, default=0), budget, min_entropy, max_epochs)
    return a, temperature_weights(tokens, a) if total else [0.0] * len(tokens)


def plan_of(per: DataFrame, budget_tokens: int | None, min_entropy: float, max_epochs: float, block_tokens: int) -> tuple[DataFrame, int]:
    """(source, weight, n_blocks, whole, rest; number of sources) of a table of sources and their tokens, of any length: only sums
    over it reach the driver."""
    seen = per.agg(F.sum("tokens").alias("total"), F.count("*").alias("n"), F.min("tokens").alias("least")).first()
    total = int(seen["total"] or 0)
    budget = total if budget_tokens is None else int(budget_tokens)
    p = F.col("tokens") / F.lit(float(max(total, 1)))

    def moments(xs: list[float]) -> list[tuple[float, float]]:
        sums = per.agg(*[F.sum(F.pow(p, F.lit(a))) for a in xs], *[F.sum(F.pow(p, F.lit(a)) * F.log(p)) for a in xs]).first()
        return list(zip(sums[: len(xs)], sums[len(xs) :], strict=True))

    a = exponent_of(moments, total, int(seen["n"]), int(seen["least"] or 0), budget, min_entropy, max_epochs)
    z = moments([a])[0][0] if total else 1.0
    plan = per.withColumn("weight", F.pow(p, F.lit(a)) / F.lit(z))
    share = F.floor(F.col("weight") * budget + 0.5).cast("long")
    plan = plan.withColumns({"whole": F.floor(share / F.col("tokens")).cast("long"), "rest": share % F.col("tokens"), "n_blocks": F.ceil(F.col("tokens") / block_tokens).cast("long")})
    return plan.select("source", "weight", "n_blocks", "whole", "rest"), int(seen["n"])


def tokens_of(text: Column) -> Column:
    """Words between ASCII white space; null or blank text: 0. One walk over the text, no array of words."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def mix(documents: DataFrame, budget_tokens: int | None = None, min_entropy: float = 0.98, max_epochs: float = 4.0, seed: int = 42, block_tokens: int = BLOCK_TOKENS, tokens: Column | None = None) -> DataFrame:
    """The mixture: doc_id, source, n_tokens, weight, epoch (from 0), block, place, seat; one row each time a document is used.

    ``budget_tokens``: tokens of the mixture, by default as many as the documents have. Each source gets the documents
    of floor(budget / tokens) whole epochs, and of one more those that start before its budget is used up, so that it
    exceeds its budget by less than its last document. The mixture's order is (epoch, place, source, block, seat): place is a
    hash of seed, epoch, source and block, seat the number of a document in its block, by hashes of seed, epoch, id and text.
    Null source: the source "". Null or blank texts have no tokens and are used in no epoch. Rows that are alike in id,
    source and text are as many uses of one document, in a row. A null doc_id hashes as any value, its text sets the
    block. Empty tables give no rows; further columns are left out.

    A source of any share of the rows is dealt out by blocks: alike rows are counted and tokens summed before they are
    shuffled, and running totals go over ranges of blocks, then over the blocks of a range, then over the documents of a block.
    """
    text = F.xxhash64("text") if "text" in documents.columns else F.lit(0).cast("long")
    docs = documents.select("doc_id", F.coalesce("source", F.lit(NO_SOURCE)).alias("source"), (tokens if tokens is not None else tokens_of(F.col("text"))).cast("long").alias("n_tokens"), text.alias("sign")).filter("n_tokens > 0")
    docs = cut(docs)  # texts are read once; what follows goes over four small columns
    per = cut(docs.groupBy("source").agg(F.sum("n_tokens").alias("tokens")))
    plan, n = plan_of(per, budget_tokens, min_entropy, max_epochs, block_tokens)
    dealt = docs.groupBy("doc_id", "source", "n_tokens", "sign").agg(F.count("*").alias("copies")).join(F.broadcast(plan) if n <= BROADCAST_SOURCES else plan, "source")
    dealt = dealt.withColumns({"block": F.pmod(F.xxhash64(F.lit(seed), "doc_id", "sign"), F.col("n_blocks")), "size": F.col("n_tokens") * F.col("copies")})
    place = lambda epoch: F.xxhash64(F.lit(seed), epoch, "source", "block")
    # of the epoch after the whole ones, the blocks before the budget's end
    sums = dealt.filter("rest > 0").groupBy("source", "block", "rest", "whole", "n_blocks").agg(F.sum("size").alias("size")).withColumn("place", place(F.col("whole")))
    ranges = F.ceil(F.col("n_blocks") / RANGE_BLOCKS)
    sums = sums.withColumn("range", F.least(F.floor((F.col("place").cast("double") / 2.0**64 + 0.5) * ranges), ranges - 1))
    heads = sums.groupBy("source", "range").agg(F.sum("size").alias("head"))
    heads = heads.withColumn("ahead", F.sum("head").over(Window.partitionBy("source").orderBy("range")) - F.col("head")).select("source", "range", "ahead")
    inside = Window.partitionBy("source", "range").orderBy("place", "block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = sums.withColumn("upto", F.sum("size").over(inside)).join(heads, ["source", "range"])
    taken = sums.withColumn("before", F.col("ahead") + F.col("upto") - F.col("size")).filter("before < rest").select("source", "block", "before")
    part = dealt.join(taken, ["source", "block"]).withColumn("epoch", F.col("whole"))
    whole = dealt.filter("whole > 0").select("*", F.lit(None).cast("long").alias("before"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("whole") - 1)).alias("epoch"))
    used = part.select(whole.columns).unionByName(whole)
    seats = Window.partitionBy("source", "epoch", "block").orderBy(F.xxhash64(F.lit(seed), "epoch", "doc_id", "sign"), "doc_id", "n_tokens", "sign").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    used = used.withColumns({"start": F.col("before") + F.sum("size").over(seats) - F.col("size"), "seat": F.sum("copies").over(seats) - F.col("copies")})
    # copies that start before the budget's end
    fit = F.least(F.col("copies"), F.ceil((F.col("rest") - F.col("start")) / F.col("n_tokens")).cast("long"))
    used = used.withColumn("fit", F.when(F.col("before").isNull(), F.col("copies")).otherwise(fit)).filter("fit > 0")
    used = used.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("fit") - 1)))
    return used.select("doc_id", "source", "n_tokens", "weight", F.col("epoch").cast("int").alias("epoch"), "block", place(F.col("epoch")).alias("place"), (F.col("seat") + F.col("copy")).alias("seat"))
