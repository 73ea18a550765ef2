"""Joins, windows, groups, pages and checks over candidate tables. Rows that tie are ordered by what the caller names."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut


def last_wins(left: DataFrame, right: DataFrame, keys: list[str], order: list[str], how: str = "inner") -> DataFrame:
    """Equi-join with a lookup table in which the last row of a key, by ``order``, stands for the key."""
    w = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order])
    return left.join(right.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn"), keys, how)


def keep_best(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in ``order``."""
    return top_per_group(df, keys, order, 1)


def top_per_group(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """At most ``n`` rows of each key; planned with a group limit before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def diverse(df: DataFrame, key: str, order: list[Column], each: int, n: int) -> DataFrame:
    """Round robin over keys: the best of every key, then the second best, at most ``each`` of a key and ``n`` in all.

    Keys take turns in the order of their best rows. Adds turn (from 1).
    """
    w = Window.partitionBy(key).orderBy(*order)
    ranked = df.withColumn("turn", F.row_number().over(w)).filter(F.col("turn") <= each)
    return ranked.orderBy("turn", *order).limit(n)


def adjusted(df: DataFrame, p: str) -> DataFrame:
    """Benjamini-Hochberg q-values of column ``p``; adds fdr_q. Nulls aren't tested.

    The rank is one over all rows. Runs of equal p get one q, so only distinct p-values, with their counts, are ranked, by
    running(): up for the ranks, down for the smallest adjusted value from a p on. ``df`` is read once for that; what the
    two passes start from is written down.
    """
    counts = cut(df.filter(F.col(p).isNotNull()).groupBy(F.col(p).alias("_p")).agg(F.count("*").alias("_n")))
    cuts = cuts_of(counts, "_p")
    upto = cut(running(counts, "_p", F.col("_n"), "sum", "_upto", cuts=cuts))
    total = upto.agg(F.max("_upto")).scalar()
    q = running(upto, "_p", F.least(F.lit(1.0), F.col("_p") * total / F.col("_upto")), "min", "fdr_q", descending=True, cuts=cuts)
    return df.join(q.select("_p", "fdr_q"), df[p] == F.col("_p"), "left").drop("_p")


def cuts_of(df: DataFrame, key: str, parts: int | None = None) -> list:
    """Approximate quantiles of a key, a few numbers, that cut its order into ranges."""
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (df.agg(F.percentile_approx(key, [k / parts for k in range(1, parts)]).alias("c")).first()["c"] or []) if parts > 1 else []


def running(df: DataFrame, key: str, value: Column, how: str, name: str, descending: bool = False, parts: int | None = None, cuts: list | None = None) -> DataFrame:
    """Running sum, minimum or maximum of ``value`` over all rows in the order of a distinct key, without one task for all rows.

    cuts_of() the key, given or made here, cut the order into ranges: a row's range depends on its key alone.
    Ranges run on their own; what all ranges before add, one row a range, is joined.
    """
    make = {"sum": F.sum, "min": F.min, "max": F.max}[how]
    cuts = cuts_of(df, key, parts) if cuts is None else cuts
    part = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c < F.col(key))) if cuts else F.lit(0)
    ranged = df.withColumns({"_v": value, "_part": part})
    first = lambda c: F.col(c).desc() if descending else F.col(c).asc()
    inner = Window.partitionBy("_part").orderBy(first(key)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    heads = ranged.groupBy("_part").agg(make("_v").alias("_head"))
    earlier = Window.orderBy(first("_part")).rowsBetween(Window.unboundedPreceding, -1)  # over one row a range
    before = heads.select("_part", make("_head").over(earlier).alias("_before"))
    own = make("_v").over(inner)
    both = own + F.coalesce("_before", F.lit(0)) if how == "sum" else {"min": F.least, "max": F.greatest}[how](own, "_before")
    return ranged.join(F.broadcast(before), "_part").withColumn(name, both).drop("_v", "_part", "_before")


def at_ranks(df: DataFrame, value: Column, ranks: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """One row: total, the rows whose ``value`` isn't null, and for each name the value at its rank (from 0, a function of total) in
    ascending order, with name_before, how many rows have a smaller one. Ranks outside of the rows have nulls.

    A selection by ranges: approximate quantiles cut the values, the ranges are counted, and only those that hold a wanted rank
    are looked at value by value. No task and no buffer gets all of the values.
    """
    values = df.select(value.alias("_v")).filter("_v IS NOT NULL")
    cuts = cuts_of(values, "_v")
    part = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c < F.col("_v"))) if cuts else F.lit(0)
    ranged = values.withColumn("_part", part)
    heads = ranged.groupBy("_part").agg(F.count("*").alias("_n"))  # a row a range
    whole = Window.partitionBy()
    heads = heads.withColumns({"total": F.sum("_n").over(whole), "_from": F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))})
    asked = {"": lambda total: F.lit(0)} | ranks  # the first row, so that the total comes along
    wanted = F.array(*[F.struct(F.lit(name).alias("name"), rank(F.col("total")).cast("long").alias("rank")) for name, rank in asked.items()])
    held = F.filter(wanted, lambda w: (w["rank"] >= F.col("_from")) & (w["rank"] < F.col("_from") + F.col("_n")))
    picks = heads.select("_part", "_from", "total", F.explode(held).alias("w")).select("_part", "_from", "total", "w.*")
    single = ranged.join(F.broadcast(picks.select("_part").distinct()), "_part").groupBy("_part", "_v").agg(F.count("*").alias("_k"))
    upto = single.withColumn("_upto", F.sum("_k").over(Window.partitionBy("_part").orderBy("_v")))
    found = upto.join(F.broadcast(picks), "_part").filter(F.col("_from") + F.col("_upto") > F.col("rank"))
    found = found.groupBy("name").agg(F.first("total").alias("total"), F.min(F.struct("_v", (F.col("_from") + F.col("_upto") - F.col("_k")).alias("before"))).alias("at"))
    columns = [F.max(F.when(F.col("name") == name, F.col(f"at.{c}"))).alias(name + tag) for name in ranks for c, tag in (("_v", ""), ("before", "_before"))]
    return found.agg(F.coalesce(F.max("total"), F.lit(0)).alias("total"), *columns)


def quantiles(df: DataFrame, value: Column, shares: dict[str, float]) -> DataFrame:
    """One row: exact quantiles of all rows by name, between two values by their distance, without one buffer for all values."""
    at = lambda q: lambda total: (total - 1) * F.lit(q)
    ranks = {f"{name}_{side}": (lambda total, q=q, f=f: f(at(q)(total))) for name, q in shares.items() for side, f in (("low", F.floor), ("high", F.ceil))}
    found = at_ranks(df, value, ranks)
    between = lambda name, q: F.col(f"{name}_low") + (F.col(f"{name}_high") - F.col(f"{name}_low")) * (at(q)(F.col("total")) - F.floor(at(q)(F.col("total"))))
    return found.select(*[between(name, q).alias(name) for name, q in shares.items()])


def quantiles_by(df: DataFrame, keys: list[str], value: Column, shares: dict[str, float], margin: float = 0.0005) -> DataFrame:
    """``keys`` and exact quantiles by name of the rows of each of them, as quantiles() has them of all rows; keys have one broadcast row each.

    Approximate quantiles a little below and above each share cut a key's values into ranges, which are counted; only those that
    hold a wanted rank, mostly the narrow ones, are looked at value by value.
    """
    c = F.col
    values = df.select(*keys, value.alias("_v")).filter("_v IS NOT NULL")
    near = sorted({min(max(q + s * margin, 0.0), 1.0) for q in shares.values() for s in (-1, 1)})
    cuts = values.groupBy(*keys).agg(F.percentile_approx("_v", near, 10_000).alias("_cuts"))
    ranged = values.join(F.broadcast(cuts), keys).select(*keys, "_v", F.size(F.filter("_cuts", lambda x: x < c("_v"))).alias("_part"))
    key = Window.partitionBy(*keys)
    heads = ranged.groupBy(*keys, "_part").agg(F.count("*").alias("_n"))  # a few rows a key
    heads = cut(heads.withColumns({"_total": F.sum("_n").over(key), "_from": F.coalesce(F.sum("_n").over(key.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))}))
    at = lambda q: (c("_total") - 1) * F.lit(q)
    wanted = F.array(*[F.struct(F.lit(f"{name}_{side}").alias("name"), f(at(q)).alias("rank")) for name, q in shares.items() for side, f in (("low", F.floor), ("high", F.ceil))])
    held = F.filter(wanted, lambda w: (w["rank"] >= c("_from")) & (w["rank"] < c("_from") + c("_n")))
    picks = heads.select(*keys, "_part", "_from", "_total", F.explode(held).alias("w")).select(*keys, "_part", "_from", "_total", "w.*")
    single = ranged.join(F.broadcast(picks.select(*keys, "_part").distinct()), [*keys, "_part"]).groupBy(*keys, "_part", "_v").agg(F.count("*").alias("_k"))
    upto = single.withColumn("_upto", F.sum("_k").over(Window.partitionBy(*keys, "_part").orderBy("_v")))
    found = upto.join(F.broadcast(picks), [*keys, "_part"]).filter(c("_from") + c("_upto") > c("rank"))
    found = found.groupBy(*keys, "_total", "name").agg(F.min("_v").alias("_v")).groupBy(*keys, "_total").agg(*[F.max(F.when(c("name") == f"{n}_{side}", c("_v"))).alias(f"{n}_{side}") for n in shares for side in ("low", "high")])
    return found.select(*keys, *[(c(f"{n}_low") + (c(f"{n}_high") - c(f"{n}_low")) * (at(q) - F.floor(at(q)))).alias(n) for n, q in shares.items()])


def page(df: DataFrame, order: list[Column], offset: int, limit: int) -> DataFrame:
    return df.orderBy(*order).offset(offset).limit(limit)


def circular_page(df: DataFrame, order: list[Column], offset: int, limit: int, repeat: bool = False, key: Column | None = None) -> DataFrame:
    """``limit`` rows from ``offset`` on, starting over at the end; each row once at most, or, repeating, as often as needed.

    Repeating adds turn, the row's place on the page; only where all rows fit the page are they numbered.
    ``key``: a number that isn't null and whose ascending order ``order`` begins with. at_ranks() then tells which keys the page
    lies between, and only their rows are sorted, however far the offset is; without it, all rows up to the page's end are.
    """
    if key is None:
        index = {"total": df.count()}
    else:
        first = lambda total: F.lit(offset) % total
        last = lambda total: F.least(first(total) + limit, total) - 1
        over = lambda total: F.least(first(total) + limit - total, first(total)) - 1
        index = at_ranks(df, key, {"first": first, "last": last, "over": over}).first().asDict()
    total = index["total"]
    if not total:
        return df.limit(0).withColumn("turn", F.lit(0).cast("long")) if repeat else df.limit(0)
    start = offset % total
    over = min(max(0, start + limit - total), start)
    if key is None:
        head, again = df.orderBy(*order).offset(start).limit(limit), df.orderBy(*order).limit(over)
    else:
        head = df.filter(key.between(index["first"], index["last"])).orderBy(*order).offset(start - index["first_before"]).limit(limit)
        again = df.filter(key <= index["over"]).orderBy(*order).limit(over) if over else None
    once = head.unionByName(again) if over else head
    if not repeat:
        return once
    if total > limit:  # no row comes twice: the first part of the page, then what starts over
        parts = [(head, 0)] + ([(again, total - start)] if over else [])
        numbered = [d.withColumn("turn", F.row_number().over(Window.orderBy(*order)).cast("long") - 1 + k) for d, k in parts]  # over a page
        return numbered[0].unionByName(numbered[1]) if over else numbered[0]
    at = F.pmod(F.row_number().over(Window.orderBy(*order)) - 1 - start, F.lit(total)).cast("long")  # over fewer rows than a page
    return df.withColumn("turn", at).withColumn("turn", F.explode(F.sequence(F.col("turn"), F.lit(limit - 1).cast("long"), F.lit(total).cast("long"))))


def sorted_by(df: DataFrame, key: str, columns: dict[str, str], ties: list[Column]) -> list[Column]:
    """The order of a page by the name of a sort: descending, nulls as 0, then ties; an unknown name leaves the ties' order."""
    return [F.coalesce(F.col(columns[key]).try_cast("double"), F.lit(0.0)).desc(), *ties] if key in columns else ties


def first_hit(left: DataFrame, sources: list[tuple[DataFrame, str]], key: Column, value: str) -> DataFrame:
    """Left joins with lookups (table, key column) in turn; ``value`` is the first that isn't null."""
    out = left
    for k, (table, on) in enumerate(sources):
        t = table.select(F.col(on).alias(f"_k{k}"), F.col(value).alias(f"_v{k}"))
        out = out.join(t, key == F.col(f"_k{k}"), "left").drop(f"_k{k}")
    return out.withColumn(value, F.coalesce(*[F.col(f"_v{k}") for k in range(len(sources))])).drop(*[f"_v{k}" for k in range(len(sources))])


def nearby(left: DataFrame, right: DataFrame, on: list[str], reach: tuple[float, float], how: str, condition: Column, x: str = "x", y: str = "y", other: str = "o_") -> DataFrame:
    """Joins distinct rows of ``left`` with distinct ones of ``right`` (columns prefixed by ``other``) whose places can be within ``reach``,
    on equal ``on`` columns and grid cells; ``condition`` decides.

    Cells are four times as wide as the reach, and a row of the right side goes to those that its reach meets, mostly one or two.
    Rows are dealt once: equal ones are dropped where they meet.
    """
    cell = lambda c, r, by=0: F.floor((F.col(c) + by * r) / (4 * (r + 1))).cast("long")
    span = lambda c, r: F.explode(F.sequence(cell(c, r, -1), cell(c, r, 1)))
    cells = left.withColumns({"_gx": cell(x, reach[0]), "_gy": cell(y, reach[1])}).repartition(*on, "_gx", "_gy").distinct()
    dealt = right.withColumn("_gx", span(other + x, reach[0])).withColumn("_gy", span(other + y, reach[1])).repartition(*[other + c for c in on], "_gx", "_gy").distinct()
    keys = [F.col(c) == F.col(other + c) for c in on]
    both = cells.alias("l").join(dealt.alias("r"), reduce(Column.__and__, [*keys, F.col("l._gx") == F.col("r._gx"), F.col("l._gy") == F.col("r._gy"), condition]), how)
    return both.drop("_gx", "_gy")


def _class(w: Column, h: Column, least: int = 0) -> Column:
    """Size class of a box: the smallest k so that it fits into a square of 2 ** k."""
    return F.greatest(F.lit(least), F.ceil(F.log2(F.greatest(w, h, F.lit(1)).cast("double")))).cast("int")


def touching(boxes: DataFrame, marks: DataFrame, on: str, condition: Column, how: str, least: int = 6) -> DataFrame:
    """Semi or anti join of boxes (on, x, y, w, h) with marks (on, mx, my, mw, mh) that can touch them, on equal ``on`` and grid cells;
    ``condition`` decides.

    Boxes lie in the grid of their size class, a box in the cell of its corner; a mark goes, in every class that there is, to the
    cells in which a box that touches it may start. So one large box makes no more cells for the small ones. Cells are 2 ** ``least``
    wide at least. Equal marks are one. Dealt marks are many times their files, by which Spark would broadcast them: both sides
    are shuffled and sorted instead, and nothing of them passes the driver.
    """
    own = _class(F.col("w"), F.col("h"), least)
    classes = boxes.select(own.alias("k")).agg(F.collect_set("k")).scalar()  # some twenty numbers at most
    cell = lambda c, k: F.floor(c / F.pow(F.lit(2.0), k)).cast("long")
    k = F.col("_k")
    reach = lambda p, n: F.sequence(cell(F.col(p) - F.pow(F.lit(2.0), k), k), cell(F.col(p) + F.col(n), k))
    dealt = marks.distinct().withColumnRenamed(on, "_on").withColumn("_k", F.explode(classes)).withColumn("_mx", F.explode(reach("mx", "mw"))).withColumn("_my", F.explode(reach("my", "mh")))
    there = (F.col(on) == F.col("_on")) & (own == k) & (cell(F.col("x"), own) == F.col("_mx")) & (cell(F.col("y"), own) == F.col("_my"))
    return boxes.join(dealt.hint("merge"), there & condition, how)


def overlapping(boxes: DataFrame, on: str, most: float) -> DataFrame:
    """Pairs a, b (ids, a's priority the smaller) of boxes (``on``, _id, _p, x, y, w, h) that share more than ``most`` of the smaller one.

    Every box is at home in the cells of its size class, at most four, and visits those of the larger classes; a pair meets in the larger
    one's class, once, in the cell where what both share begins.
    """
    c = F.col
    cell = lambda v, k: F.floor(v / F.pow(F.lit(2.0), k)).cast("long")
    classed = boxes.withColumn("_c", _class(c("w"), c("h")))
    top = classed.agg(F.max("_c")).scalar()
    spread = lambda df: df.withColumn("_gx", F.explode(F.sequence(cell(c("x"), c("_k")), cell(c("x") + c("w"), c("_k"))))).withColumn("_gy", F.explode(F.sequence(cell(c("y"), c("_k")), cell(c("y") + c("h"), c("_k")))))
    home = spread(classed.withColumn("_k", c("_c"))).select(on, "_k", "_gx", "_gy", *[c(n).alias("o" + n) for n in ("_id", "_p", "x", "y", "w", "h")])
    visits = spread(classed.withColumn("_k", F.explode(F.sequence(c("_c"), top))))
    both = visits.join(home, [on, "_k", "_gx", "_gy"]).filter(((c("_c") < c("_k")) & (c("_id") != c("o_id"))) | (c("_p") < c("o_p")))
    begins = (cell(F.greatest("x", "ox"), c("_k")) == c("_gx")) & (cell(F.greatest("y", "oy"), c("_k")) == c("_gy"))
    wide = F.least(c("x") + c("w"), c("ox") + c("ow")) - F.greatest("x", "ox")
    high = F.least(c("y") + c("h"), c("oy") + c("oh")) - F.greatest("y", "oy")
    large = (wide > 0) & (high > 0) & (wide * high > most * F.least(c("w") * c("h"), c("ow") * c("oh")))
    first = c("_p") < c("o_p")
    return both.filter(begins & large).select(F.when(first, c("_id")).otherwise(c("o_id")).alias("a"), F.when(first, c("o_id")).otherwise(c("_id")).alias("b"))


def _stages(ranked: DataFrame, on: str, first: int) -> tuple[Column, int]:
    """(stage from 0, last stage) of boxes by their priority _p: about ``first`` boxes of the fullest ``on``, then thrice as many as in all stages
    before. Stages are cut at priorities of some thousand boxes; wherever they lie, a stage comes before all of lower priority."""
    most = ranked.groupBy(on).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    shares = []
    while first < most:
        shares.append(first / most)
        first *= 4
    if not shares:
        return F.lit(0), 0
    some = ranked.select("_p").orderBy(F.xxhash64("_p")).limit(4000).orderBy("_p").collect()
    kind = ranked.schema["_p"].dataType
    cut_at = lambda p: F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for f, v in zip(kind.fields, p, strict=True)])
    after = [(F.col("_p") > cut_at(some[int(s * len(some))]["_p"])).cast("int") for s in shares]
    return reduce(Column.__add__, after), len(shares)


def without_overlaps(boxes: DataFrame, on: str, order: list[str], most: float = 0.5, first: int = 4096) -> DataFrame:
    """Greedy suppression among the boxes of one ``on``: in ``order``, which has no ties but between equal rows, a box goes if a kept one
    shares more than ``most`` (under 1) of the smaller of both.

    Nothing is grouped by image. Rows of one place and size are one box, the first of them. Boxes come in stages of falling priority
    and growing number: those that a kept box takes go first, so that pairs, which grow with the square of how dense boxes lie, are only made
    among the few that are left. In each round the boxes that nothing undecided comes before are kept and take what
    they overlap with them; a round is two joins on the pairs left. Rounds are as many as the longest chain of boxes of falling
    priority that overlap, a few where priority doesn't follow place.
    """
    place = [on, *"xywh"]
    ranked = boxes.withColumn("_p", F.struct(*order))
    alone = cut(top_per_group(ranked.filter("w > 0 AND h > 0"), place, [F.col("_p")], 1).withColumn("_id", F.monotonically_increasing_id()))
    stage, last = _stages(alone, on, first)
    c = F.col
    wide = F.least(c("x") + c("w"), c("mx") + c("mw")) - F.greatest("x", "mx")
    high = F.least(c("y") + c("h"), c("my") + c("mh")) - F.greatest("y", "my")
    taken = (wide > 0) & (high > 0) & (wide * high > most * F.least(c("w") * c("h"), c("mw") * c("mh")))
    kept = None
    for k in range(last + 1):
        here = alone.filter(stage == k) if last else alone
        if kept is not None:
            here = cut(touching(here, kept.select(on, *[c(n).alias("m" + n) for n in "xywh"]), on, taken, "left_anti"))
        here = _undisputed(here, on, most)
        here = cut(here) if k < last else here
        kept = here if kept is None else kept.unionByName(here)
    return kept.select(boxes.columns).unionByName(boxes.filter("NOT (w > 0 AND h > 0)"))


def _undisputed(boxes: DataFrame, on: str, most: float) -> DataFrame:
    """without_overlaps() of distinct boxes with _id and _p, round by round."""
    left = cut(overlapping(boxes, on, most))
    gone = None
    while not left.isEmpty():
        firsts = left.select("a").distinct().join(left.select(F.col("b").alias("a")).distinct(), "a", "left_anti")
        out = cut(left.join(firsts, "a", "left_semi").select("b").distinct())
        gone = out if gone is None else gone.unionByName(out)
        left = cut(left.join(out, "b", "left_anti").join(out.withColumnRenamed("b", "a"), "a", "left_anti"))
    return boxes if gone is None else boxes.join(gone.withColumnRenamed("b", "_id"), "_id", "left_anti")


def by_suffix(left: DataFrame, right: DataFrame, key: str, name: str, value: str) -> DataFrame:
    """Left join with a lookup (name, value): equal names first, else the smallest of those of which one ends with the other.

    Either side's endings, of the lengths that the other side has, meet the other side's names by equality.
    """
    keys, names = left.select(key).distinct(), right.select(F.col(name).alias("_n"), F.col(value).alias("_v"))
    ends = lambda df, c, other, o: _fitting(df, c, other, o).withColumn("_end", F.explode(F.transform("_lengths", lambda n: F.right(F.col(c), n)))).drop("_lengths")
    longer = ends(keys, key, names, "_n").join(names, F.col("_end") == F.col("_n"))
    shorter = ends(names, "_n", keys, key).join(keys, F.col("_end") == F.col(key)).filter(F.length("_n") > F.length(key))
    pairs = longer.select(key, "_n", "_v").unionByName(shorter.select(key, "_n", "_v"))
    best = pairs.groupBy(key).agg(F.min_by("_v", F.struct((F.col(key) != F.col("_n")).alias("rest"), "_n")).alias(value))
    return left.join(best, key, "left")


def _fitting(df: DataFrame, own: str, other: DataFrame, o: str) -> DataFrame:
    """``df`` with _lengths: the distinct lengths, a few numbers, of the names of ``other`` that aren't longer than the row's own."""
    all_ = other.agg(F.collect_set(F.length(o)).alias("lengths")).scalar()
    return df.withColumn("_lengths", all_).withColumn("_lengths", F.filter("_lengths", lambda n: (n <= F.length(own)) & (n > 0)))


def containing(texts: DataFrame, parts: DataFrame, text: str, part: str) -> DataFrame:
    """text, part: distinct pairs of a text that holds a part. The substrings of a text that are as long as a part is meet the parts
    by equality, so no text is compared with all parts. Empty parts are in no text."""
    t, p = texts.select(text).distinct(), parts.select(part).distinct()
    starts = lambda n: F.sequence(F.lit(1), F.length(text) - n + 1)
    pieces = F.array_distinct(F.flatten(F.transform("_lengths", lambda n: F.transform(starts(n), lambda i: F.substring(F.col(text), i, n)))))
    return _fitting(t, text, p, part).withColumn("_piece", F.explode(pieces)).join(p, F.col("_piece") == F.col(part)).select(text, part)


def numbered(df: DataFrame, key: str, order: list[Column], name: str = "n") -> DataFrame:
    """Rows of each key numbered from 1 in ``order``."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(key).orderBy(*order)).cast("long"))


def linked_cells(df: DataFrame, node: str, base: str, reach: int) -> tuple[DataFrame, DataFrame]:
    """(cells, edges) of boxes whose places, whole numbers, are near if x and y differ by at most ``reach``, some pixels.

    Cells are ``reach`` + 1 wide, so that places of one cell are near each other; places of neighbouring cells are if the one farther
    along an axis has the smaller offset in its cell. A cell keeps, for each column of its pixels, the lowest and the highest place: a few
    numbers, however many boxes it holds. Linked cells of a row of cells make a run. cells: _b, _gx, _gy and _run, the smallest of the run's
    ``node`` s, which are unique; edges: pairs a, b of runs of rows that follow each other. A box without a place is a run of its own.
    """
    r, c = reach + 1, F.col
    place = df.select(c(base).alias("_b"), F.floor(c("x") / r).cast("long").alias("_gx"), F.floor(c("y") / r).cast("long").alias("_gy"), F.pmod("x", F.lit(r)).cast("short").alias("_i"), F.pmod("y", F.lit(r)).cast("short").alias("_j"), c(node).alias("_a"))
    place = place.withColumn("_lone", F.when(c("_b").isNull() | c("_i").isNull() | c("_j").isNull(), c("_a")))
    column = lambda how: [how(F.when(c("_i") == i, c("_j"))) for i in range(r)]
    cells = place.repartition("_b", "_gy").groupBy("_b", "_gy", "_gx", "_lone").agg(F.min("_a").alias("_a"), F.min("_i").alias("_left"), F.max("_i").alias("_right"), F.array(*column(F.min)).alias("_lo"), F.array(*column(F.max)).alias("_hi"))
    row = Window.partitionBy("_b", "_gy").orderBy("_gx")
    joined = (F.lag("_gx").over(row) == c("_gx") - 1) & (c("_left") < F.lag("_right").over(row)) & c("_lone").isNull()
    cells = cells.withColumn("_n", F.count_if(~F.coalesce(joined, F.lit(False))).over(row.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    cells = cells.withColumn("_run", F.min("_a").over(Window.partitionBy("_b", "_gy", "_n")))
    cells = cut(cells.select("_b", "_gy", "_gx", "_run", "_lo", "_hi"))
    low, high = cells.filter("_gx IS NOT NULL"), cells.select("_b", (c("_gy") + 1).alias("_gy"), c("_gx").alias("_g"), c("_run").alias("_r"), c("_hi").alias("_h"))
    low = low.select("_b", "_gy", "_gx", "_run", "_lo", F.array_min("_lo").alias("_low"))
    high = high.withColumns({"_high": F.array_max("_h"), "_d": F.explode(F.array(*map(F.lit, (-1, 0, 1))))}).withColumn("_gx", c("_g") + c("_d")).drop("_g")
    # of two cells in a slant, a column of the farther one meets those behind it
    upto = lambda a, i, how: how(*[F.get(a, F.lit(k)) for k in range(i)]) if i > 1 else F.get(a, F.lit(0))
    slant = lambda a, b, how, less: reduce(Column.__or__, [less(F.get(a, F.lit(i)), upto(b, i, how)) for i in range(1, r)], F.lit(False))
    right = slant("_h", "_lo", F.least, lambda h, lo: lo < h)
    left = slant("_lo", "_h", F.greatest, lambda lo, h: lo < h)
    near = F.when(c("_d") == 0, c("_low") < c("_high")).when(c("_d") == 1, right).otherwise(left)
    return cells, low.join(high, ["_b", "_gy", "_gx"]).filter(near).select(c("_run").alias("a"), c("_r").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, root (smallest node of its component) of the nodes of undirected edges (a, b).

    Alternating stars: every node links its larger neighbours to its smallest one, then itself and its smaller ones. Each
    round is a few joins on the edges, cut off by a checkpoint; the number of rounds grows with the logarithm of the longest
    path. Nothing is collected but a checksum.
    """
    down = cut(edges.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).filter("hi <> lo").distinct())
    known = None
    while True:
        mark = down.agg(F.count("*"), F.bit_xor(F.xxhash64("hi", "lo"))).first()
        if mark == known:
            roots = down.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct()
            return down.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionByName(roots)
        known = mark
        around = down.unionByName(down.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
        best = around.groupBy("hi").agg(F.min("lo").alias("top")).select("hi", F.least("top", "hi").alias("top"))
        up = around.join(best, "hi").filter("lo > hi").select(F.col("lo").alias("hi"), F.col("top").alias("lo")).distinct()
        best = up.groupBy("hi").agg(F.min("lo").alias("top"))
        side = up.join(best, "hi").filter("lo <> top").select(F.col("lo").alias("hi"), F.col("top").alias("lo"))
        down = cut(side.unionByName(best.select("hi", F.col("top").alias("lo"))).distinct())


def groups(df: DataFrame, node: str, base: str, reach: int) -> DataFrame:
    """``df`` with feature: the smallest node of the boxes that near ones chain together."""
    cells, edges = linked_cells(df, node, base, reach)
    roots = components(edges).withColumnRenamed("node", "_run")
    found = cells.filter("_gx IS NOT NULL").join(roots, "_run", "left").select("_b", "_gx", "_gy", F.coalesce("root", "_run").alias("feature"))
    at = lambda c: F.floor(F.col(c) / (reach + 1)).cast("long")
    there = (F.col(base) == F.col("_b")) & (at("x") == F.col("_gx")) & (at("y") == F.col("_gy"))
    return df.join(found, there, "left").withColumn("feature", F.coalesce("feature", node)).drop("_b", "_gx", "_gy")


def count_groups(df: DataFrame, node: str, base: str, reach: int, name: str) -> DataFrame:
    """One row: how many features groups() makes, told from the runs of cells alone."""
    cells, edges = linked_cells(df, node, base, reach)
    roots = components(edges).withColumnRenamed("node", "_run")
    return cells.select("_run").distinct().join(roots, "_run", "left").agg(F.countDistinct(F.coalesce("root", "_run")).alias(name))


def else_all(some: DataFrame, rest: DataFrame) -> DataFrame:
    """``some`` if it has a row, else ``rest``, which has its columns."""
    return some.unionByName(rest.filter(some.select(F.lit(1).alias("one")).limit(1).agg(F.count("*")).scalar() == 0).select(some.columns))


def merged(previous: DataFrame, current: DataFrame, key: str) -> DataFrame:
    """Upsert: all current rows and the previous ones whose key isn't seen again."""
    return current.unionByName(previous.join(current.select(key).distinct(), key, "left_anti"))


def budget_prefix(df: DataFrame, order: list[Column], cost: str, budget: float) -> DataFrame:
    """Rows in order until the cost first exceeds the budget; what follows is left out even if it would fit. For plan-sized
    tables: the running sum is one window over all rows."""
    w = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn("used", F.sum(cost).over(w)).filter(F.col("used") <= budget)


def violations(df: DataFrame, rules: dict[str, Column], keys: list[str]) -> DataFrame:
    """One row for each rule that a row breaks."""
    broken = F.array_compact(F.array(*(F.when(~F.coalesce(ok, F.lit(False)), name) for name, ok in rules.items())))
    return df.select(*keys, F.explode(broken).alias("problem"))


def missing_columns(df: DataFrame, required: list[str]) -> DataFrame:
    """name: required columns that a table lacks."""
    lacking = [c for c in required if c not in df.columns]
    return df.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, lacking)).cast("array<string>")).alias("name"))


def unknown(df: DataFrame, column: str, wanted: tuple[str, ...]) -> DataFrame:
    """name: wanted values that a column doesn't have."""
    asked = df.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, wanted))).alias("name"))
    return asked.join(df.select(F.col(column).alias("name")).distinct(), "name", "left_anti")
