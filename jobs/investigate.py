"""From pixels to verdicts: finds what stands out in images, measures it, compares renderings of one scene, and judges it.

    python -m jobs.investigate EVENTS OUT [--config jobs/investigate.json]

EVENTS is a Parquet table of pixel values in reading order (event_id, value), cut into images of width x lines cells; a cell is
scale x scale pixels. OUT gets ``regions``, the measured boxes partitioned by scene, and ``verdicts``, one row for each box with its
score, verdict, advice and q-value, partitioned by verdict. Both are made anew by every run, so a run after a broken one gives
the same files.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from selenite.functions import columns as C
from selenite.functions import scoring as S
from selenite.operators import relational as R
from selenite.raster import cells as X
from selenite.session import cut

from .common import command, configured

LOG = logging.getLogger("investigate")
#: box, z: detection against the mean of box x box cells; margin: cells around a box that are its ground; renderings: images of a
#: scene, which show the same ground; level: q-values up to it survive.
DEFAULTS = {"width": 100, "lines": 100, "scale": 10, "renderings": 4, "box": 9, "z": 1.5, "min_cells": 3, "margin": 5, "contrast_bar": 1.5, "level": 0.05}


def cells_of(events: DataFrame, width: int, lines: int) -> DataFrame:
    """image, y, x, v of pixel values in reading order; rows without a place or a value are no cells."""
    at = F.col("event_id")
    size = width * lines
    image, y, x = F.floor(at / size), F.floor(F.pmod(at, F.lit(size)) / width), F.pmod(at, F.lit(width))
    return events.filter("event_id IS NOT NULL AND value IS NOT NULL").select(image.cast("long").alias("image"), y.cast("int").alias("y"), x.cast("int").alias("x"), F.col("value").alias("v"))


def detected(cells: DataFrame, conf: dict) -> DataFrame:
    """image, label, x, y, w, h, n: boxes in cells around connected cells that stand out from their surroundings."""
    place = F.col("image") * (conf["width"] * conf["lines"]) + F.col("y") * conf["width"] + F.col("x")
    mask = cut(X.detail_mask(cells, ["image"], "v", conf["box"], conf["z"]).select("image", "y", "x", place.alias("node")))
    roots = R.components(X.neighbour_edges(mask, ["image"], F.col("node"))).distinct()
    found = mask.join(roots, "node", "left").withColumn("label", F.coalesce("root", "node")).groupBy("image", "label")
    spans = found.agg(F.count("*").alias("n"), F.min("x").alias("x"), F.min("y").alias("y"), (F.max("x") - F.min("x") + 1).alias("w"), (F.max("y") - F.min("y") + 1).alias("h"))
    return spans.filter(F.col("n") >= conf["min_cells"])


def judged(regions: DataFrame, wide: float, high: float, contrast_bar: float) -> DataFrame:
    """Flags, interest, score, verdict, confidence, advice and q-value of measured boxes in pixels."""
    unknown = {k: F.lit(None).cast("double") for k in ("column_smear", "persistence", "shadow_alignment", "size_m")}
    df = regions.withColumns(unknown | {"smear_narrow": F.lit(False), "shadow_expected": F.lit(False), "xv_tested": F.lit(0), "xv_collapse": F.lit(0), "dtm_known_artifacts": F.lit(""), "matches": F.col("agrees"), "compactness": F.col("fill")})
    df = S.adjudicate(S.evaluate(df, wide, high), contrast_bar).withColumn("p", C.upper_tail(F.col("contrast")))
    return R.adjusted(df, "p").withColumns({"advice": S.advice(F.col("verdict")), "fdr_q": C.rounded(F.col("fdr_q"), 6)})


def run(spark: SparkSession, events: str, out: str, config: str | dict | None = None) -> DataFrame:
    """Writes regions and verdicts and returns the verdicts as they were written."""
    conf = DEFAULTS | config if isinstance(config, dict) else configured(spark, DEFAULTS, config)
    k = conf["scale"]
    values = spark.read.parquet(events)
    LOG.info("reading %d values of %s", values.count(), events)  # from the files' footers
    cells = cells_of(values, conf["width"], conf["lines"])
    cells = cells.withColumn("scene", F.floor(F.col("image") / conf["renderings"]))
    boxes = detected(cells, conf).withColumn("scene", F.floor(F.col("image") / conf["renderings"]))
    regions = X.agreement(cells, boxes, "scene", conf["margin"])
    known = [F.coalesce(c, F.lit(0.0)).alias(c) for c in ("contrast", "bg_std")]
    regions = regions.select("scene", "image", "label", *[(F.col(c) * k).alias(c) for c in "xywh"], C.rounded(F.col("n") / (F.col("w") * F.col("h")), 4).alias("fill"), *known, "polarity", "sat_frac", "dark_frac", "agrees", "disagrees")
    regions.write.mode("overwrite").partitionBy("scene").parquet(f"{out}/regions")
    regions = spark.read.schema(regions.schema).parquet(f"{out}/regions")  # a table without rows has no file to ask
    verdicts = judged(regions, conf["width"] * k, conf["lines"] * k, conf["contrast_bar"])
    verdicts = verdicts.select("scene", "image", "label", *"xywh", "polarity", "contrast", "fill", "agrees", "disagrees", F.array_join("flags", ",").alias("flags"), "interest", "score", "confidence", "advice", "fdr_q", (F.col("fdr_q") <= conf["level"]).alias("survives"), "verdict")
    verdicts.write.mode("overwrite").partitionBy("verdict").parquet(f"{out}/verdicts")
    done = spark.read.schema(verdicts.schema).parquet(f"{out}/verdicts")
    LOG.info("wrote %s to %s", {r["verdict"]: r["count"] for r in done.groupBy("verdict").count().collect()}, out)
    return done


if __name__ == "__main__":
    command(run, "Find, measure and judge what stands out in images.", ("events",))
