"""Corpus pipeline: five stages over documents, each written as Parquet and read again as the next one's input.

1. Language ID: documents without a letter or without a clear language go; a missing lang is filled in.
2. SimHash near-dedup: one document of each group stays.
3. Suffix-array dedup: bytes covered by a 50-byte string of a document with a smaller id go, by whole characters; a document
   of which nothing is left goes.
4. Benchmark decontamination: documents of which at least a twentieth of the words lie in benchmark windows go.
5. Mixing: one row each time that a document is used in the mixture.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from selenite.llm import decontam, langid, mixing, simhash, suffixes
from selenite.llm.common import shared_folder, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: A language is clear from this probability on.
CLEAR = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text shows a clear language; a null lang becomes the predicted one, another stays. Null, empty and letterless
    texts go. Each row is judged by its own text: repeated rows and rows of one id stay or go each on its own. An empty table
    stays empty; columns beyond those of documents are left out."""
    found = langid.identify(docs, langid.fit(docs)).filter((F.col("lang_pred") != langid.UNKNOWN) & (F.col("lang_score") >= CLEAR))
    return found.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group the row of the smallest id; among rows of one id, or without ids, that of the smallest hash of the whole row.
    Rows alike in all columns are one. Empty and null texts have fingerprint 0 and are one group."""
    return simhash.one_of_each(docs).select(*COLUMNS)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated strings, n_chars to match; rows of which nothing is left go, rows that were empty or null stay. Nothing
    is cut from a row without an id, and rows that share an id cut nothing from one another."""
    left = suffixes.without_repeats(docs).filter("n_removed = 0 OR text <> ''")
    return left.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that aren't contaminated, unchanged; each is judged by its own text, rows with null or repeated ids too."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def source_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture with default parameters: one row each time that a document is used. Blank texts are never used."""
    return mixing.mix(docs)


STAGES = [
    ("language ID", language_id),
    ("SimHash near-dedup", near_duplicates),
    ("suffix-array dedup", repeated_strings),
    ("benchmark decontamination", benchmark_passages),
    ("mixing sources", source_mixture),
]
#: SQL can't express the language model, the mixture's bisection and the hashes; tests hold each stage against a plain version.
ORACLE_SQL = None


def _removed(spark: SparkSession, path: str) -> None:
    """Deletes a folder wherever the cluster's file systems have it."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage. A stage's folder goes as soon as the next one's is written; the last one's stays, as the
    result reads it."""
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        if k:
            _removed(spark, f"{folder}/{k - 1}")
    return docs
