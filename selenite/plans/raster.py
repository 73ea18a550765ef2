"""Queries of the raster family: relational ones with SQL, kernels without."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import relational as R
from ..raster import bands as B
from ..raster import cells as X
from ..raster import kernels as K
from ..raster.spark import assembled, per_image
from ..session import cut
from ..sources.tables import BOXES, boxes, cells, frames, table
from .relational import rnd

Q: dict = {}
O: dict[str, str] = {}


def query(oracle: str | None = None):
    def add(f):
        Q[f.__name__] = f
        if oracle:
            O[f.__name__] = oracle
        return f

    return add


CELLS = "cells AS (SELECT CAST(event_id // 100 AS INTEGER) AS y, CAST(event_id % 100 AS INTEGER) AS x, value AS v FROM events), ext AS (SELECT max(y) AS my, max(x) AS mx FROM cells)"


def blurred(source: str, size: int, name: str, value: str = "v") -> str:
    """Mean over a square with clamped places: an independent form of the moving mean."""
    p = size // 2
    return f"""{name} AS (SELECT c.y, c.x, c.v, avg(n.{value}) AS b FROM cells c, ext, range(-{p}, {p} + 1) a(dy), range(-{p}, {p} + 1) e(dx), {source} n
WHERE n.y = greatest(0, least(my, c.y + dy)) AND n.x = greatest(0, least(mx, c.x + dx)) GROUP BY c.y, c.x, c.v)"""


@query(f"WITH {CELLS}, {blurred('cells', 5, 'blur')} SELECT y, x, {rnd('b', 5)} AS blurred FROM blur")
def box_blur(spark, d):
    return X.box_mean(cells(spark, d), [], "v", 5, "b").select("y", "x", C.rounded(F.col("b"), 5).alias("blurred"))


@query(f"""WITH {CELLS}, n AS (SELECT c.y, c.x, c.v, n.v AS o, abs(dy) <= 1 AND abs(dx) <= 1 AS core FROM cells c, ext, range(-3, 4) a(dy), range(-3, 4) e(dx), cells n
WHERE n.y = greatest(0, least(my, c.y + dy)) AND n.x = greatest(0, least(mx, c.x + dx)))
SELECT y, x, {rnd('(any_value(v) - avg(o)) / (stddev_pop(o) + 1e-6)', 5)} AS field FROM n WHERE NOT core GROUP BY y, x""")
def annulus_field(spark, d):
    return X.annulus(cells(spark, d), [], "v", 1, 3, "f").select("y", "x", C.rounded(F.col("f"), 5).alias("field"))


@query(f"""WITH {CELLS}, {blurred('cells', 9, 'blur')}, det AS (SELECT *, abs(v - b) AS detail FROM blur), st AS (SELECT avg(detail) AS m, stddev_pop(detail) + 1e-6 AS s FROM det)
SELECT y, x, {rnd('(detail - m) / s', 5)} AS score FROM det, st WHERE detail > m + 1.5 * s""")
def detail_mask(spark, d):
    return X.detail_mask(cells(spark, d), [], "v", 9, 1.5).select("y", "x", C.rounded(F.col("score"), 5).alias("score"))


def _labelled(spark, d):
    mask = cut(cells(spark, d).filter("v > 120").withColumn("node", F.col("y").cast("long") * 100 + F.col("x")))
    roots = R.components(X.neighbour_edges(mask, [], F.col("node"))).distinct()
    return mask.join(roots, "node", "left").withColumn("label", F.coalesce("root", "node"))


@query(f"""WITH RECURSIVE {CELLS}, m AS (SELECT y, x, v, y * 100 + x AS node FROM cells WHERE v > 120),
reach AS (SELECT node, node AS r FROM m UNION SELECT b.node, reach.r FROM reach JOIN m a ON a.node = reach.node JOIN m b ON abs(a.y - b.y) <= 1 AND abs(a.x - b.x) <= 1 AND a.node <> b.node)
, l AS (SELECT node, min(r) AS label FROM reach GROUP BY node)
SELECT label, count(*) AS n, min(x) AS x, min(y) AS y, max(x) - min(x) + 1 AS w, max(y) - min(y) + 1 AS h, {rnd('count(*) / CAST((max(x) - min(x) + 1) * (max(y) - min(y) + 1) AS DOUBLE)', 6)} AS fill, {rnd('avg(v)', 4)} AS score
FROM m JOIN l USING (node) GROUP BY label HAVING count(*) >= 3""")
def components(spark, d):
    g = _labelled(spark, d).groupBy("label").agg(F.count("*").alias("n"), F.min("x").alias("x"), F.min("y").alias("y"), (F.max("x") - F.min("x") + 1).alias("w"), (F.max("y") - F.min("y") + 1).alias("h"), C.rounded(F.avg("v"), 4).alias("score"))
    return g.filter("n >= 3").withColumn("fill", C.rounded(F.col("n") / (F.col("w") * F.col("h")), 6))


@query(f"""WITH {CELLS}, bx AS (SELECT n_nationkey AS k, n_nationkey * 3 % 80 AS bx, n_nationkey * 7 % 80 AS by2, 6 + n_regionkey AS s FROM nation),
j AS (SELECT k, v, x >= bx AND x < bx + s AND y >= by2 AND y < by2 + s AS fg FROM bx JOIN cells ON x >= bx - 5 AND x < bx + s + 5 AND y >= by2 - 5 AND y < by2 + s + 5)
SELECT k, CASE WHEN avg(v) FILTER (WHERE fg) >= avg(v) FILTER (WHERE NOT fg) THEN 'bright' ELSE 'dark' END AS polarity,
{rnd('abs(avg(v) FILTER (WHERE fg) - avg(v) FILTER (WHERE NOT fg)) / (stddev_pop(v) FILTER (WHERE NOT fg) + 1e-6)', 4)} AS contrast, {rnd('avg(CASE WHEN v >= 253 THEN 1.0 ELSE 0.0 END) FILTER (WHERE fg)', 4)} AS sat_frac, {rnd('stddev_pop(v) FILTER (WHERE fg)', 4)} AS texture FROM j GROUP BY k""")
def measure_fg_bg(spark, d):
    n = table(spark, d, "nation").select(F.col("n_nationkey").alias("k"), (F.col("n_nationkey") * 3 % 80).alias("bx"), (F.col("n_nationkey") * 7 % 80).alias("by"), (F.col("n_regionkey") + 6).alias("s"))
    boxes = n.select(F.col("k").alias("label"), F.col("bx").alias("x"), F.col("by").alias("y"), F.col("s").alias("w"), F.col("s").alias("h"))
    return X.measured(cells(spark, d), boxes, [], 5).select(F.col("label").alias("k"), "polarity", "contrast", "sat_frac", "texture")


@query(f"""WITH {CELLS}, g AS (SELECT *, lag(v) OVER r AS l, lead(v) OVER r AS rr, lag(v) OVER q AS u, lead(v) OVER q AS dn FROM cells WINDOW r AS (PARTITION BY y ORDER BY x), q AS (PARTITION BY x ORDER BY y)),
s AS (SELECT v, abs(CASE WHEN l IS NULL THEN rr - v WHEN rr IS NULL THEN v - l ELSE (rr - l) / 2 END) + abs(CASE WHEN u IS NULL THEN dn - v WHEN dn IS NULL THEN v - u ELSE (dn - u) / 2 END) AS slope FROM g)
SELECT {rnd('quantile_cont(slope, 0.95) / (stddev_pop(v) + 1e-6)', 4)} AS sharpness, {rnd('avg(slope)', 4)} AS mean_slope FROM s""")
def gradient_p95(spark, d):
    g = X.gradient(cells(spark, d), [], "v")
    p95 = R.quantiles(g, F.col("slope"), {"p95": 0.95}).scalar()
    return g.agg((F.stddev_pop("v") + 1e-6).alias("s"), C.rounded(F.avg("slope"), 4).alias("mean_slope")).select(C.rounded(p95 / F.col("s"), 4).alias("sharpness"), "mean_slope")


FRAMES = "f AS (SELECT label, vec_id, unnest(range(len(embedding))) AS x, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings)"


@query(f"""WITH {FRAMES}, m AS (SELECT label, x, quantile_cont(v, 0.5) AS m FROM f GROUP BY 1, 2), s AS (SELECT f.*, m.m, abs(v - m.m) AS dev FROM f JOIN m USING (label, x)), k AS (SELECT label, x, quantile_cont(dev, 0.5) + 1e-6 AS mad FROM s GROUP BY 1, 2)
SELECT label, CAST(x AS INTEGER) AS x, {rnd('quantile_cont(greatest(m - CAST(0.5 * 1.4826 AS DOUBLE) * mad, least(m + CAST(0.5 * 1.4826 AS DOUBLE) * mad, v)), 0.5)', 6)} AS stacked, count(*) AS frames FROM s JOIN k USING (label, x) GROUP BY 1, 2""")
def sigma_clip_stack(spark, d):
    return X.clipped_median(frames(spark, d), ["label", "x"], "v", 0.5).select("label", "x", C.rounded(F.col("stacked"), 6).alias("stacked"), "frames")


@query(f"WITH {FRAMES} SELECT label, CAST(x AS INTEGER) AS x, {rnd('stddev_pop(v)', 6)} AS residual, count(*) AS frames FROM f GROUP BY 1, 2")
def stack_residual(spark, d):
    return frames(spark, d).groupBy("label", "x").agg(C.rounded(F.stddev_pop("v"), 6).alias("residual"), F.count("*").alias("frames"))


@query(f"""WITH {FRAMES}, c AS (SELECT label, x, quantile_cont(v, 0.5) AS m FROM f GROUP BY 1, 2), o AS (SELECT *, m - quantile_cont(m, 0.5) OVER (PARTITION BY label) AS off FROM c), k AS (SELECT *, quantile_cont(abs(off), 0.5) OVER (PARTITION BY label) + 1e-6 AS mad FROM o)
SELECT f.label, f.vec_id, CAST(f.x AS INTEGER) AS x, {rnd('f.v - CASE WHEN abs(off) > 1.5 * 1.4826 * mad THEN off ELSE 0 END', 6)} AS v FROM f JOIN k USING (label, x)""")
def destripe(spark, d):
    f = frames(spark, d)
    col = f.groupBy("label", "x").agg(F.median("v").alias("m"))
    mid = col.groupBy("label").agg(F.median("m").alias("mm"))
    off = col.join(mid, "label").withColumn("off", F.col("m") - F.col("mm"))
    off = off.join(off.groupBy("label").agg((F.median(F.abs("off")) + 1e-6).alias("mad")), "label")
    fix = F.when(F.abs("off") > 1.5 * 1.4826 * F.col("mad"), F.col("off")).otherwise(0.0)
    return f.join(off.select("label", "x", "off", "mad"), ["label", "x"]).select("label", "vec_id", "x", C.rounded(F.col("v") - fix, 6).alias("v"))


@query(f"WITH {CELLS}, p AS (SELECT abs(a.v - b.v) AS df FROM cells a JOIN cells b ON a.y = b.y AND a.x + 1 = b.x) SELECT {rnd('avg(df)', 4)} AS mean_abs, {rnd('max(df)', 4)} AS max_abs, {rnd('quantile_cont(df, 0.95)', 4)} AS p95, CASE WHEN avg(df) < 60 THEN 'consistent' WHEN avg(df) < 140 THEN 'minor' WHEN avg(df) < 280 THEN 'notable' ELSE 'different' END AS verdict FROM p")
def diff_stats(spark, d):
    c = cells(spark, d)
    df = c.join(c.select("y", (F.col("x") - 1).alias("x"), F.col("v").alias("o")), ["y", "x"]).withColumn("df", F.abs(F.col("v") - F.col("o")))
    p95, m = R.quantiles(df, F.col("df"), {"p95": 0.95}).scalar(), F.avg("df")
    one = df.agg(C.rounded(m, 4).alias("mean_abs"), C.rounded(F.max("df"), 4).alias("max_abs"), F.when(m < 60, "consistent").when(m < 140, "minor").when(m < 280, "notable").otherwise("different").alias("verdict"))
    return one.withColumn("p95", C.rounded(p95, 4))


@query(f"WITH {CELLS}, s AS (SELECT y + 2 AS y, x - 3 AS x, v FROM cells, ext WHERE y + 2 <= my AND x - 3 >= 0), dd AS (SELECT c.y, c.x, abs(c.v - coalesce(s.v, 0)) AS df FROM cells c LEFT JOIN s USING (y, x)), st AS (SELECT quantile_cont(df, 0.5) AS m, stddev_pop(df) + 1e-6 AS sd FROM dd) SELECT y, x, {rnd('(df - m) / sd', 5)} AS z FROM dd, st WHERE (df - m) / sd > 1.5")
def shift_change(spark, d):
    c = cells(spark, d)
    e = X.extent(c, [])
    moved = X.shifted(c, -3, 2, e.select("height").scalar(), e.select("width").scalar()).withColumnRenamed("v", "o")
    dd = c.join(moved, ["y", "x"], "left").select("y", "x", F.abs(F.col("v") - F.coalesce("o", F.lit(0.0))).alias("df"))
    z = (F.col("df") - R.quantiles(dd, F.col("df"), {"median": 0.5}).scalar()) / dd.agg(F.stddev_pop("df") + 1e-6).scalar()
    return dd.withColumn("z", z).filter("z > 1.5").select("y", "x", C.rounded(F.col("z"), 5).alias("z"))


@query(f"WITH {CELLS}, m AS (SELECT y // 10 AS tile, y, x FROM cells WHERE v > 120), g AS (SELECT tile, count(*) AS n, var_pop(x) AS xx, var_pop(y) AS yy, covar_pop(x, y) AS xy FROM m GROUP BY tile) SELECT CAST(tile AS BIGINT) AS tile, n, {rnd('CASE WHEN n >= 4 THEN (degrees(0.5 * atan2(2 * xy, xx - yy)) % 180 + 180) % 180 END', 4)} AS angle FROM g")
def elongation(spark, d):
    m = cells(spark, d).filter("v > 120").withColumn("tile", F.floor(F.col("y") / 10).cast("long"))
    return X.elongation(m, ["tile"]).select("tile", "n", C.rounded(F.col("angle"), 4).alias("angle"))


@query(f"WITH {FRAMES}, a AS (SELECT *, cos(radians(least(label * 9.0, 89.9))) AS ci, cos(radians(least(vec_id % 60 * 1.0, 89.9))) AS ce FROM f) SELECT label, vec_id, CAST(x AS INTEGER) AS x, {rnd('CASE WHEN ci * ce < 1e-3 THEN v ELSE v / (ci * ce) END', 6)} AS lambert, {rnd('CASE WHEN ci + ce < 1e-3 THEN v ELSE v * ((ci + ce) / ci) END', 6)} AS lommel FROM a")
def photometry(spark, d):
    f, i, e = frames(spark, d), F.col("label") * 9.0, F.col("vec_id") % 60 * 1.0
    return f.select("label", "vec_id", "x", C.rounded(C.lambert(F.col("v"), i, e), 6).alias("lambert"), C.rounded(C.lommel_seeliger(F.col("v"), i, e), 6).alias("lommel"))


@query(f"WITH b AS (SELECT (l_tax * 100) AS a, l_discount * 1000 AS bb, l_quantity AS q, l_orderkey, l_linenumber, l_partkey FROM lineitem) SELECT l_orderkey, l_linenumber, l_partkey, {rnd('least(((a - bb) % 180 + 180) % 180, 180 - ((a - bb) % 180 + 180) % 180)', 4)} AS apart, {rnd('CASE WHEN q > 1 AND q < 89 THEN a * 0.5 * tan(radians(q)) END', 4)} AS height FROM b")
def shadow_geometry(spark, d):
    li = table(spark, d, "lineitem")
    a, b, q = F.col("l_tax") * 100, F.col("l_discount") * 1000, F.col("l_quantity")
    return li.select("l_orderkey", "l_linenumber", "l_partkey", C.rounded(C.axial_distance(a, b), 4).alias("apart"), C.rounded(C.height_from_shadow(a, F.lit(0.5), q), 4).alias("height"))


@query(f"WITH {FRAMES}, st AS (SELECT label, quantile_cont(v, 0.005) AS lo, quantile_cont(v, 0.995) AS hi FROM f GROUP BY label) SELECT f.label, vec_id, CAST(x AS INTEGER) AS x, {rnd('greatest(0.0, least(1.0, (v - lo) / (hi - lo)))', 6)} AS v FROM f JOIN st USING (label)")
def stretch(spark, d):
    f = frames(spark, d)
    st = f.groupBy("label").agg(F.percentile("v", F.lit(0.005)).alias("lo"), F.percentile("v", F.lit(0.995)).alias("hi"))
    return f.join(st, "label").select("label", "vec_id", "x", C.rounded(F.greatest(F.lit(0.0), F.least(F.lit(1.0), (F.col("v") - F.col("lo")) / (F.col("hi") - F.col("lo")))), 6).alias("v"))


def _images(spark, d):
    """Each label's vectors as the lines of an image."""
    line = F.row_number().over(Window.partitionBy("label").orderBy("vec_id")) - 1
    e = table(spark, d, "embeddings").select("label", line.alias("y"), "embedding").select("label", "y", F.posexplode("embedding").alias("x", "v"))
    return assembled(e, "label")


def _lines(spark, d):
    """Each label's vectors as the lines of an image, for kernels that go by bands of lines."""
    return B.lined(table(spark, d, "embeddings"), "label", "vec_id", "embedding")


@query()
def kernel_measures(spark, d):
    """Grid energy, roundness and median persistence of each image."""
    return B.measures(_lines(spark, d))


@query()
def kernel_phase_shift(spark, d):
    """Shift recovered between each image and itself moved by (3, 2)."""
    import numpy as np

    return per_image(_images(spark, d), lambda a: [dict(zip(("dx", "dy"), K.phase_shift(np.roll(a, (2, 3), (0, 1)), a), strict=True))], "image_id long, dx int, dy int")


@query()
def kernel_detect(spark, d):
    return B.detected(_lines(spark, d), 2.5, 3).select("image_id", *"xywh", "fill", "score", F.lit(1).alias("scale"))


@query()
def kernel_disparity(spark, d):
    import numpy as np

    def run(a):
        dx, dy = K.disparity(a, np.roll(a, (1, 2), (0, 1)), 3, 5)
        return [{"dx": float(np.median(dx)), "dy": float(np.median(dy))}]

    return per_image(_images(spark, d), run, "image_id long, dx double, dy double")


@query(f"""WITH RECURSIVE b AS MATERIALIZED (SELECT image, x, y, w, h, CAST(l_linenumber AS INT) AS scale, row_number() OVER (PARTITION BY image ORDER BY l_linenumber, l_orderkey, l_partkey, x, y, w, h) AS n FROM ({BOXES})),
r AS (SELECT DISTINCT image, CAST(0 AS BIGINT) AS n, CAST([] AS STRUCT(x INT, y INT, w INT, h INT, scale INT)[]) AS kept FROM b
UNION ALL SELECT r.image, b.n, CASE WHEN len(list_filter(kept, lambda k: 2 * greatest(0, least(k.x + k.w, b.x + b.w) - greatest(k.x, b.x)) * greatest(0, least(k.y + k.h, b.y + b.h) - greatest(k.y, b.y)) > least(k.w * k.h, b.w * b.h))) = 0
  THEN list_append(kept, {{'x': b.x, 'y': b.y, 'w': b.w, 'h': b.h, 'scale': b.scale}}) ELSE kept END FROM r JOIN b ON b.image = r.image AND b.n = r.n + 1)
SELECT image, k.x AS x, k.y AS y, k.w AS w, k.h AS h, k.scale AS scale FROM (SELECT image, unnest(arg_max(kept, n)) AS k FROM r GROUP BY image)""")
def kernel_nms(spark, d):
    """Greedy overlap removal among the boxes of an image, the line number as scale: joins over overlapping pairs, round by round."""
    b = boxes(spark, d).select("image", "l_orderkey", "l_partkey", *"xywh", F.col("l_linenumber").alias("scale"))
    return R.without_overlaps(b, "image", ["scale", "l_orderkey", "l_partkey", *"xywh"]).select("image", *"xywh", "scale")


@query()
def kernel_compare(spark, d):
    """Renderings of a footprint against its reference, the one of the smallest id."""
    return B.compared(_lines(spark, d), F.floor(F.col("image_id") / 2))


@query()
def kernel_evidence(spark, d):
    """The best box of each image with its measurements, flags' inputs and shape."""
    return B.evidence(_lines(spark, d), 2.5, 3)
