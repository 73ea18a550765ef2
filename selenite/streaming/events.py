"""Event logs as streams: counts by window, trailing throughput, and monotone upserts by batch."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EVENTS = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"


def read_stream(spark: SparkSession, path: str, schema: str = EVENTS, files: int = 1000) -> DataFrame:
    """New Parquet files of a folder as they come."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def tumbling(events: DataFrame, every: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Events and their value by window and type; state older than the watermark is dropped. Works on batches too."""
    by = events.withWatermark("ts", late) if events.isStreaming else events
    g = by.groupBy(F.window("ts", every).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum(F.floor(F.col("value") * 100 + 0.5).cast("long")).alias("cents"))
    return g.select(F.col("w.start").alias("window_start"), "event_type", "n", "cents")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    by = events.withWatermark("ts", late) if events.isStreaming else events
    g = by.groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count("*").alias("n"))
    return g.select("user_id", F.col("w.start").alias("session_start"), "n")


def trailing(events: DataFrame, key: str = "user_id", size: int = 50) -> DataFrame:
    """Mean of the last ``size`` values of each key after each batch; the state is that list of values."""
    from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

    def step(k: tuple, frames, state: GroupState):
        held = list(state.get[0]) if state.exists else []
        for f in frames:
            held = (held + f.sort_values("event_id")["value"].tolist())[-size:]
        state.update((held,))
        yield pd.DataFrame({key: [k[0]], "n": [len(held)], "mean_value": [sum(held) / len(held)]})

    return events.groupBy(key).applyInPandasWithState(step, f"{key} long, n long, mean_value double", "held array<double>", "update", GroupStateTimeout.NoTimeout)


def take_new(spark: SparkSession, table: str, schema: str, take, checkpoint: str, files: int = 1000) -> int:
    """Gives the files that ``table`` has got since the last call with this checkpoint to ``take`` (a foreachBatch function), then stops;
    the number of rows. Called again it goes on where it was, and a batch that was broken off comes again under its number."""
    table = table.rstrip("/")
    # as a pattern, the table may be a folder or, like many small ones, a single file
    new = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(f"{table[:-1]}[{table[-1]}]")
    query = new.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return sum(p["numInputRows"] for p in query.recentProgress)


def upsert_by_bucket(path: str, key: str, order: str, buckets: int = 16):
    """foreachBatch function that keeps the row of the largest ``order`` of each key in ``path``/latest; rows that are alike in order
    are settled by their other columns. Only the buckets that a batch touches are written.

    A batch leaves its own rows in ``path``/versions, in partitions of its number, and makes the touched buckets anew from there, so
    one that comes again changes nothing, and one that comes late doesn't undo a later one.
    """

    def merge(batch: DataFrame, number: int) -> None:
        spark, columns = batch.sparkSession, [c for c in batch.columns if c != key]
        dynamic = {"partitionOverwriteMode": "dynamic"}
        best = lambda df, *by: df.groupBy(key, *by).agg(F.max(F.struct(order, *[c for c in columns if c != order])).alias("r")).select(key, *by, *[F.col(f"r.{c}").alias(c) for c in columns])
        rows = best(batch).withColumns({"bucket": F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"), "batch": F.lit(number).cast("long")})
        rows.repartition("bucket").write.mode("overwrite").options(**dynamic).partitionBy("bucket", "batch").parquet(f"{path}/versions")
        versions = spark.read.schema(rows.schema).parquet(f"{path}/versions")
        touched = [r["bucket"] for r in versions.filter(F.col("batch") == number).select("bucket").distinct().collect()]  # ``buckets`` at most
        best(versions.filter(F.col("bucket").isin(touched)), "bucket").repartition("bucket").write.mode("overwrite").options(**dynamic).partitionBy("bucket").parquet(f"{path}/latest")

    return merge


def upsert_into(spark: SparkSession, path: str, key: str, order: str):
    """foreachBatch function that keeps the latest row of each key in a table of versions, each a folder of its own."""

    def merge(batch: DataFrame, number: int) -> None:
        both = batch if number == 0 else batch.unionByName(spark.read.parquet(f"{path}/v{number - 1}"))
        columns = [c for c in both.columns if c != key]
        latest = both.groupBy(key).agg(F.max_by(F.struct(*columns), order).alias("r")).select(key, *[F.col(f"r.{c}").alias(c) for c in columns])
        latest.write.mode("overwrite").parquet(f"{path}/v{number}")

    return merge
