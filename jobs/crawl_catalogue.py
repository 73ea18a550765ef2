"""Crawl catalogue: keeps one row for each directory page, however often it has been crawled, and takes only what is new.

    python -m jobs.crawl_catalogue PAGES OUT [--config jobs/crawl_catalogue.json]

PAGES is a growing Parquet table (page_id, url, html); files that were read once aren't read again. OUT gets

* ``versions``: what each batch found out, one row for each page in it, partitioned by bucket of the URL and batch;
* ``catalogue``: the current row of each page, partitioned by bucket;
* ``checkpoint``: Spark's, which holds the files taken so far.

A batch writes its own partitions of versions, then makes the buckets that it touched anew from all their versions. Both are dynamic
partition overwrites from what doesn't change any more, so a batch that was broken off and comes again gives the same files.
"""

from __future__ import annotations

import logging

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from selenite.streaming.events import take_new

from .common import command, configured

LOG = logging.getLogger("crawl_catalogue")
#: buckets: how finely the catalogue is cut, fixed for the life of OUT; branches and max_chars: which pages the crawler may follow.
DEFAULTS = {"buckets": 16, "files_per_batch": 1000, "max_chars": 4000, "branches": ["en", "de"]}
PAGES = "page_id long, url string, html string"
LATEST = "page_id long, n_chars long, n_links long, n_folders long, status string"
VERSIONS = f"page string, host string, branch string, versions long, first_page_id long, latest struct<{LATEST.replace(' long', ': long').replace(' string', ': string')}>, bucket int, batch long"


def canonical(url: Column) -> Column:
    """A page's address without query and fragment, its scheme and host in small letters."""
    head = F.lower(F.regexp_extract(url, r"^[A-Za-z]+://[^/?#]*", 0))
    return F.concat(head, F.regexp_extract(url, r"^[A-Za-z]+://[^/?#]*([^?#]*)", 1))


def found(pages: DataFrame, config: dict) -> DataFrame:
    """One row for each page: how many versions are here, the first, and what the one of the largest page_id holds.

    Rows without an address or a page_id are left out. Versions of one page_id count each; of them the largest in all columns
    stands for the page, so the order of the rows doesn't matter.
    """
    page = canonical(F.col("url"))
    hrefs = F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit('href="([^"?]*)"'), F.lit(1))
    rows = pages.filter("page_id IS NOT NULL").withColumn("page", page).filter("page <> ''").withColumn("hrefs", hrefs)
    host, branch = F.regexp_extract("page", "://([^/]*)", 1), F.regexp_extract("page", "://[^/]*/([^/]*)", 1)
    size = F.length(F.coalesce("html", F.lit(""))).cast("long")
    status = F.when(~F.col("page").startswith("https://"), "refused").when(size > config["max_chars"], "too large").when(~branch.isin(*config["branches"]), "other branch").otherwise("fetch")
    latest = F.struct("page_id", size.alias("n_chars"), F.size("hrefs").cast("long").alias("n_links"), F.size(F.filter("hrefs", lambda h: h.startswith("/"))).cast("long").alias("n_folders"), status.alias("status"))
    rows = rows.select("page", host.alias("host"), branch.alias("branch"), "page_id", latest.alias("latest"))
    return rows.groupBy("page", "host", "branch").agg(F.count("*").alias("versions"), F.min("page_id").alias("first_page_id"), F.max("latest").alias("latest"))


def merged(versions: DataFrame) -> DataFrame:
    """The catalogue's rows from all versions: counts add up, the latest of the latest stays."""
    g = versions.groupBy("bucket", "page", "host", "branch").agg(F.sum("versions").alias("versions"), F.min("first_page_id").alias("first_page_id"), F.max("latest").alias("latest"))
    return g.select("page", "host", "branch", "versions", "first_page_id", "latest.*", "bucket")


def catalogue(spark: SparkSession, out: str) -> DataFrame:
    """The catalogue as it stands; empty before the first batch."""
    kind = f"page string, host string, branch string, versions long, first_page_id long, {LATEST}, bucket int"
    try:
        return spark.read.schema(kind).parquet(f"{out}/catalogue").drop("bucket")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], kind).drop("bucket")


def run(spark: SparkSession, pages: str, out: str, config: str | dict | None = None) -> DataFrame:
    """Takes the new files of ``pages`` into the catalogue in ``out`` and returns the whole of it."""
    conf = DEFAULTS | config if isinstance(config, dict) else configured(spark, DEFAULTS, config)
    replaced = {"partitionOverwriteMode": "dynamic"}

    def take(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = found(batch, conf).withColumns({"bucket": F.pmod(F.crc32("page"), F.lit(conf["buckets"])).cast("int"), "batch": F.lit(number).cast("long")})
        rows.repartition("bucket").write.mode("overwrite").options(**replaced).partitionBy("bucket", "batch").parquet(f"{out}/versions")
        versions = spark.read.schema(VERSIONS).parquet(f"{out}/versions")
        touched = [r["bucket"] for r in versions.filter(F.col("batch") == number).select("bucket").distinct().collect()]  # conf["buckets"] at most
        current = merged(versions.filter(F.col("bucket").isin(touched)))
        current.repartition("bucket").write.mode("overwrite").options(**replaced).partitionBy("bucket").parquet(f"{out}/catalogue")
        LOG.info("batch %d: wrote %d buckets", number, len(touched))

    read = take_new(spark, pages, PAGES, take, f"{out}/checkpoint", conf["files_per_batch"])
    now = catalogue(spark, out)
    LOG.info("read %d new rows of %s; the catalogue in %s has %d pages", read, pages, out, now.count())
    return now


if __name__ == "__main__":
    command(run, "Take new directory pages into the catalogue.", ("pages",))
