"""Parquet tables of a data folder, and the candidate tables derived from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession

#: Frame that derived boxes lie in.
WIDE = HIGH = 1000
#: Boxes with measurements, some of them unknown, one row per line of an order; plain SQL that other engines read too.
BOXES = """
SELECT concat('ESP_0', CAST(l_suppkey % 90 + 10 AS STRING), '00_', CAST(1000 + l_suppkey % 7 AS STRING), '_', CASE l_linenumber % 3 WHEN 0 THEN 'RED' WHEN 1 THEN 'MIRB' ELSE 'MRGB' END, '.browse.jpg') AS image,
  l_orderkey, l_partkey, l_suppkey, l_linenumber,
  CAST(l_partkey * 7 % 960 AS INT) AS x, CAST(l_orderkey * 13 % 970 AS INT) AS y,
  CAST(l_quantity AS INT) AS w, CAST(l_linenumber * 6 AS INT) AS h,
  l_extendedprice / 20000.0 AS contrast, l_discount * 5 AS fill, l_tax * 8 AS sat_frac, l_tax * 12 AS dark_frac,
  l_discount * 30 AS column_smear, l_quantity <= 6 AS smear_narrow, CASE WHEN l_partkey % 31 <> 0 THEN CAST(l_linenumber % 4 AS INT) END AS matches,
  CASE WHEN l_partkey % 23 <> 0 THEN CAST(l_suppkey % 3 AS INT) END AS agrees, CAST(l_partkey % 4 AS INT) AS xv_tested, CAST(l_partkey % 3 AS INT) AS xv_collapse,
  CASE WHEN l_partkey % 19 <> 0 THEN l_discount * 10 END AS persistence, CASE WHEN l_partkey % 37 <> 0 THEN l_tax * 12 END AS compactness, l_quantity / 2.0 AS bg_std,
  CASE WHEN l_suppkey % 17 = 0 THEN 'boxes' ELSE '' END AS dtm_known_artifacts,
  CASE WHEN l_linenumber % 2 = 0 THEN l_tax * 12 END AS shadow_alignment, l_linenumber = 2 AS shadow_expected, l_extendedprice / 20.0 AS size_m,
  CASE WHEN l_returnflag = 'A' THEN 'dark' ELSE 'bright' END AS polarity
FROM lineitem
"""
#: All that a band or a polarity of BOXES can be; a name without a band has the empty one.
BANDS, POLARITIES = ("", "MIRB", "MRGB", "RED"), ("bright", "dark")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(BOXES.replace("FROM lineitem", "FROM {lineitem}"), lineitem=table(spark, sf_dir, "lineitem"))


def boxes_by(spark: SparkSession, sf_dir: str, name: str, key: Column) -> DataFrame:
    """Boxes with a key made from their lines' columns, dealt and sorted by it: the lines travel and are sorted, which are narrower
    than what is derived from them."""
    lines = table(spark, sf_dir, "lineitem").withColumn(name, key).repartition(name).sortWithinPartitions(name)
    return spark.sql(BOXES.replace("FROM lineitem", f", {name} FROM {{lineitem}}"), lineitem=lines)


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as a raster of 100 columns: y, x, v."""
    return table(spark, sf_dir, "events").selectExpr("CAST(event_id DIV 100 AS INT) AS y", "CAST(event_id % 100 AS INT) AS x", "value AS v")


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """embeddings as images: label, vec_id (frame or line), x (place), v."""
    return table(spark, sf_dir, "embeddings").selectExpr("label", "vec_id", "posexplode(embedding) AS (x, e)").selectExpr("label", "vec_id", "x", "CAST(e AS DOUBLE) AS v")
