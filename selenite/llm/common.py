"""What the operators of this folder share: tables, the shared folder and sizes."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut, shared_folder

__all__ = ["blocks_for", "cut", "row_sign", "shared_folder", "table", "text_bytes", "trimmed"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of a data folder, read by Spark alone (the folder may be in a store that only Spark opens)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def blocks_for(amount: int, each: int, least: int) -> int:
    """How many blocks of ``each`` hold ``amount``; at least ``least``, so that small inputs still spread."""
    return max(least, -(-int(amount) // each))


def text_bytes(df: DataFrame, text: str = "text") -> int:
    """UTF-8 bytes of all texts of a column; reads that column only."""
    return int(df.agg(F.sum(F.octet_length(text)).alias("n")).first()["n"] or 0)


def row_sign(df: DataFrame) -> Column:
    """A hash of the whole row, text and all other columns: rows of one hash are alike, and its order is total over the others."""
    rest = [F.col(c) for c in sorted(df.columns) if c != "text"]
    signs = [F.coalesce(F.sha2(F.col("text").cast("string"), 256), F.lit(""))] + ([F.sha2(F.to_json(F.struct(*rest)), 256)] if rest else [])
    return F.concat_ws("-", *signs)


def trim() -> None:
    """Gives memory that this worker has freed back to the machine; workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not the usual C library
        pass


def trimmed(f: Callable) -> Callable:
    """``f``, which trims after each call."""

    @functools.wraps(f)
    def run(*args):
        try:
            return f(*args)
        finally:
            trim()

    return run
