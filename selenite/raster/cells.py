"""Relational raster kernels over cells (image key, y, x, v): windows, moments and joins instead of arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import rounded


def extent(df: DataFrame, keys: list[str]) -> DataFrame:
    """Height and width of each image, from dense cells."""
    return df.groupBy(*keys).agg((F.max("y") + 1).alias("height"), (F.max("x") + 1).alias("width"))


def box_mean(df: DataFrame, keys: list[str], value: str, size: int, name: str) -> DataFrame:
    """Moving mean over 2 * (size // 2) + 1 cells each way, edges replicated; two one-dimensional passes.

    A frame that leaves the image is completed by as many copies of its border cell as it lacks.
    """
    p = size // 2
    for axis, other, edge in (("x", "y", "width"), ("y", "x", "height")):
        w = Window.partitionBy(*keys, other).orderBy(axis)
        part = w.rowsBetween(-p, p)
        whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        last = F.max(axis).over(Window.partitionBy(*keys, other))
        low = F.greatest(F.lit(0), p - F.col(axis)) * F.first(value).over(whole)
        high = F.greatest(F.lit(0), F.col(axis) + p - last) * F.last(value).over(whole)
        df = df.withColumn(name, (F.sum(value).over(part) + low + high) / (2 * p + 1))
        value = name
    return df


def annulus(df: DataFrame, keys: list[str], value: str, inner: int, outer: int, name: str) -> DataFrame:
    """(v - ring mean) / (ring std + 1e-6); the ring lies between squares of two radii, with replicated edges."""
    k, m = 2 * inner + 1, 2 * outer + 1
    df = df.withColumn("_sq", F.col(value) * F.col(value))
    for source, tag in ((value, "v"), ("_sq", "s")):
        for n in (k, m):
            df = box_mean(df, keys, source, n, f"_{tag}{n}")
    ring = float(m * m - k * k)
    mean = (F.col(f"_v{m}") * (m * m) - F.col(f"_v{k}") * (k * k)) / ring
    square = (F.col(f"_s{m}") * (m * m) - F.col(f"_s{k}") * (k * k)) / ring
    std = F.sqrt(F.greatest(F.lit(0.0), square - mean * mean))
    return df.withColumn(name, (F.col(value) - mean) / (std + 1e-6)).drop("_sq", *[f"_{t}{n}" for t in "vs" for n in (k, m)])


def detail_mask(df: DataFrame, keys: list[str], value: str, size: int, z: float) -> DataFrame:
    """Cells whose distance from their box mean exceeds mean + z * std of all such distances; adds detail and score."""
    df = box_mean(df, keys, value, size, "_b").withColumn("detail", F.abs(F.col(value) - F.col("_b"))).drop("_b")
    stats = df.groupBy(*keys).agg(F.avg("detail").alias("_m"), (F.stddev_pop("detail") + 1e-6).alias("_s"))
    df = df.join(stats, keys) if keys else df.withColumns({c: stats.select(c).scalar() for c in ("_m", "_s")})
    return df.filter(F.col("detail") > F.col("_m") + z * F.col("_s")).withColumn("score", (F.col("detail") - F.col("_m")) / F.col("_s")).drop("_m", "_s")


def neighbour_edges(mask: DataFrame, keys: list[str], node: Column, eight: bool = True) -> DataFrame:
    """Links a, b between neighbouring cells of a mask: equi-joins on shifted places."""
    steps = [(0, 1), (1, 0), (1, 1), (1, -1)] if eight else [(0, 1), (1, 0)]
    own = mask.select(*keys, "y", "x", node.alias("a"))
    shifted = own.select(*keys, F.explode(F.array(*[F.struct(F.lit(dy).alias("dy"), F.lit(dx).alias("dx")) for dy, dx in steps])).alias("d"), "y", "x", F.col("a").alias("b"))
    shifted = shifted.select(*keys, (F.col("y") + F.col("d.dy")).alias("y"), (F.col("x") + F.col("d.dx")).alias("x"), "b")
    return own.join(shifted, [*keys, "y", "x"]).select("a", "b")


def measured(cells: DataFrame, boxes: DataFrame, keys: list[str], margin: int, tile: int = 16) -> DataFrame:
    """``keys``, label, contrast, polarity, sat_frac, dark_frac, bg_std and texture of boxes (``keys``, label, x, y, w, h) from their
    cells and those within ``margin`` of them.

    Cells and boxes meet by equal keys and tile: a cell lies in one tile, a box goes to every tile that its surroundings touch. So a
    cell is read once, whatever the number of boxes on it, and a large image is dealt out by tiles. Boxes without a cell
    have no row; without cells inside or around them they have no contrast.
    """
    at = lambda c: F.floor(c / tile).cast("int")
    spread = lambda p, n: F.explode(F.sequence(at(F.col(p) - margin), at(F.col(p) + F.col(n) + (margin - 1))))
    dealt = boxes.withColumn("_ty", spread("y", "h")).withColumn("_tx", spread("x", "w")).select(*keys, "label", *[F.col(c).alias("_" + c) for c in "xywh"], "_ty", "_tx")
    met = cells.withColumns({"_ty": at(F.col("y")), "_tx": at(F.col("x"))}).join(dealt, [*keys, "_ty", "_tx"])
    c = F.col
    within = lambda m: (c("x") >= c("_x") - m) & (c("x") < c("_x") + c("_w") + m) & (c("y") >= c("_y") - m) & (c("y") < c("_y") + c("_h") + m)
    fg, bg = F.when(within(0), c("v")), F.when(~within(0), c("v"))
    return met.filter(within(margin)).groupBy(*keys, "label").agg(
        rounded(F.abs(F.avg(fg) - F.avg(bg)) / (F.stddev_pop(bg) + 1e-6), 4).alias("contrast"),
        F.when(F.avg(fg) >= F.coalesce(F.avg(bg), F.lit(0.0)), "bright").otherwise("dark").alias("polarity"),
        rounded(F.avg((fg >= 253).cast("int")), 4).alias("sat_frac"),
        rounded(F.avg((fg <= 2).cast("int")), 4).alias("dark_frac"),
        rounded(F.stddev_pop(bg), 4).alias("bg_std"),
        rounded(F.stddev_pop(fg), 4).alias("texture"),
    )


def agreement(cells: DataFrame, boxes: DataFrame, group: str, margin: int) -> DataFrame:
    """Measured boxes (``group``, image, label, x, y, w, h, their measures) with agrees and disagrees: how many other images of the group
    show the same place with the same polarity and a comparable contrast, and how many don't. Images without a cell there count as neither.

    A box is measured in every image of its group, its own included, in one pass over the tiles; what it is in its own image
    then meets what it is in the others under its label, a row an image.
    """
    images = cells.select(group, "image").distinct().withColumnRenamed("image", "_image")
    everywhere = boxes.join(images, group)
    found = measured(cells.select("y", "x", "v", F.col("image").alias("_image")), everywhere.select("_image", "label", *"xywh"), ["_image"], margin)
    both = everywhere.join(found, ["_image", "label"], "left")
    own = F.col("_image") == F.col("image")
    w = Window.partitionBy("label")
    mine = {c: F.max(F.when(own, F.col(c))).over(w) for c in ("contrast", "polarity")}
    ratio = mine["contrast"] / (F.col("contrast") + 1e-6)
    ok = F.coalesce((F.col("polarity") == mine["polarity"]) & ratio.between(0.35, 2.8), F.lit(False))
    both = both.withColumn("_agrees", F.when(~own & F.col("polarity").isNotNull(), ok))
    counts = {"agrees": F.count_if("_agrees").over(w).cast("int"), "disagrees": F.count_if(~F.col("_agrees")).over(w).cast("int")}
    return both.withColumns(counts).filter(own).drop("_image", "_agrees")


def gradient(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Adds slope, |gx| + |gy|: central differences, one-sided at borders."""

    def along(axis: str, other: str) -> Column:
        w = Window.partitionBy(*keys, other).orderBy(axis)
        before, after, v = F.lag(value).over(w), F.lead(value).over(w), F.col(value)
        return F.abs(F.when(before.isNull(), after - v).when(after.isNull(), v - before).otherwise((after - before) / 2))

    return df.withColumn("slope", along("x", "y") + along("y", "x"))


def clipped_median(df: DataFrame, keys: list[str], value: str, clip: float = 3.0) -> DataFrame:
    """Per place: median of the values after moving them to within clip * 1.4826 * MAD of their median."""
    centre = df.groupBy(*keys).agg(F.median(value).alias("_m"))
    spread = df.join(centre, keys)
    mad = spread.groupBy(*keys).agg((F.median(F.abs(F.col(value) - F.col("_m"))) + 1e-6).alias("_mad"))
    reach = clip * 1.4826 * F.col("_mad")
    moved = F.greatest(F.col("_m") - reach, F.least(F.col("_m") + reach, F.col(value)))
    return spread.join(mad, keys).groupBy(*keys).agg(F.median(moved).alias("stacked"), F.count("*").alias("frames"))


def shifted(df: DataFrame, dx: int, dy: int, height: int | Column, width: int | Column) -> DataFrame:
    """Cells moved by dx, dy; what leaves the frame is dropped, what is uncovered is absent (0 after a left join)."""
    out = df.withColumns({"x": F.col("x") + dx, "y": F.col("y") + dy})
    return out.filter(F.col("x").between(F.lit(0), width - 1) & F.col("y").between(F.lit(0), height - 1))


def elongation(mask: DataFrame, keys: list[str]) -> DataFrame:
    """Angle of the principal axis, degrees mod 180, of at least 4 cells; closed form of the covariance."""
    g = mask.groupBy(*keys).agg(F.var_pop("x").alias("_xx"), F.var_pop("y").alias("_yy"), F.covar_pop("x", "y").alias("_xy"), F.count("*").alias("n"))
    angle = F.pmod(F.degrees(0.5 * F.atan2(2 * F.col("_xy"), F.col("_xx") - F.col("_yy"))), F.lit(180.0))
    return g.select(*keys, "n", F.when(F.col("n") >= 4, angle).alias("angle"))
