"""Readers of delimited text, event logs, directory listings and labels; writers of tables and logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def read_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """All-string rows of a file with a header; a missing file is an empty table. A byte order mark is dropped by the reader."""
    schema = StructType([StructField(c, StringType()) for c in columns])
    try:
        return spark.read.option("header", True).option("enforceSchema", False).option("mode", "PERMISSIVE").schema(schema).csv(path)
    except Exception as e:  # Spark raises its own type for a path that isn't there
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def log_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Lines of JSON logs: value (as it stands), r (its fields), broken, and place, in whose order the lines stand: file, block, line."""
    text = spark.read.text(path).select("value", F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("line")).alias("place"))
    parsed = text.filter(F.trim("value") != "").withColumn("r", F.from_json("value", f"{schema}, _broken string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"}))
    return parsed.withColumn("broken", F.col("r").isNull() | F.col("r._broken").isNotNull()).withColumn("r", F.col("r").dropFields("_broken"))


def read_events(spark: SparkSession, path: str, schema: str, limit: int | None = None) -> DataFrame:
    """JSON lines; blank and broken lines are dropped. ``limit``: the first good lines, in the order of files and lines."""
    if limit is None:
        return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)
    return log_lines(spark, path, schema).filter("NOT broken").orderBy("place").limit(limit).select("r.*")


def compact_log(spark: SparkSession, path: str, out: str, schema: str, lines: int = 1_000_000) -> dict[str, int]:
    """Writes the good lines of many small JSON logs into few files under ``out``, as they stand and in their order; what was kept and
    what was broken. ``out`` is written as a whole, so a compaction that broke off is simply done again."""
    every = log_lines(spark, path, schema)
    n = every.agg(F.count_if(~F.col("broken")).alias("kept"), F.count_if("broken").alias("broken")).first().asDict()
    good = every.filter("NOT broken").repartitionByRange(-(-max(n["kept"], 1) // lines), "place").sortWithinPartitions("place")
    good.select("value").write.mode("overwrite").text(out)
    return n


def number(text: Column, default: float | None = None) -> Column:
    """Nullable number of a text; with a default, blank and garbage give it."""
    value = F.trim(text).try_cast("double")
    return value if default is None else F.coalesce(value, F.lit(default))


def listing(html: Column) -> Column:
    """Array of struct(name, is_dir, modified, bytes) of a directory page; parents and sorted views are left out."""
    rows = F.regexp_extract_all(html, F.lit(r'(?i)<a href="([^"?/][^"?]*)">[^<]*</a>\s*(?:</td><td[^>]*>)?\s*(\d{2}-\w{3}-\d{4} \d{2}:\d{2}|\d{4}-\d{2}-\d{2} \d{2}:\d{2})?\s*(?:</td><td[^>]*>)?\s*([\d.]+[KMG]?|-)?'), F.lit(0))
    part = lambda r, k: F.regexp_extract(r, r'(?i)<a href="([^"?/][^"?]*)">[^<]*</a>\s*(?:</td><td[^>]*>)?\s*(\d{2}-\w{3}-\d{4} \d{2}:\d{2}|\d{4}-\d{2}-\d{2} \d{2}:\d{2})?\s*(?:</td><td[^>]*>)?\s*([\d.]+[KMG]?|-)?', k)
    from ..functions.columns import file_size

    return F.filter(F.transform(rows, lambda r: F.struct(F.rtrim(part(r, 1), F.lit("/")).alias("name"), part(r, 1).endswith("/").alias("is_dir"), part(r, 2).alias("modified"), F.coalesce(file_size(part(r, 3)), F.lit(0)).alias("bytes"))), lambda s: ~s["name"].isin("", "..", "."))


def pds3_fields(text: Column) -> Column:
    """Map of the plain ``KEY = value`` lines of a label, quotes and units kept; the last of a key wins."""
    lines = F.filter(F.split(text, r"\r?\n"), lambda s: s.rlike(r"^\s*[\w:^]+\s*=\s*\S"))
    entry = lambda s: F.struct(F.regexp_extract(s, r"^\s*([\w:^]+)\s*=", 1).alias("k"), F.trim(F.regexp_extract(s, r"=\s*(.*?)\s*$", 1)).alias("v"))
    entries = F.transform(lines, entry)
    keys = F.array_distinct(F.transform(entries, lambda e: e["k"]))
    last = lambda k: F.element_at(F.transform(F.filter(entries, lambda e: e["k"] == k), lambda e: e["v"]), -1)
    return F.map_from_arrays(keys, F.transform(keys, last))


def write_table(df: DataFrame, path: str, *by: str) -> None:
    """Parquet, committed as a whole; partitioned by columns if named."""
    w = df.write.mode("overwrite")
    (w.partitionBy(*by) if by else w).parquet(path)


def append_log(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)
