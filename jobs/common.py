"""What the jobs share: configuration, the command line, and counts for the log."""

from __future__ import annotations

import argparse
import json
import logging
from collections.abc import Callable

from pyspark.sql import SparkSession

from selenite.session import session


def configured(spark: SparkSession, defaults: dict, path: str | None = None) -> dict:
    """``defaults`` with the values of a JSON file, read by Spark, so that it may lie where the tables do. Unknown names are errors."""
    given = json.loads(spark.read.text(path, wholetext=True).first()[0]) if path else {}
    unknown = sorted(set(given) - set(defaults))
    if unknown:
        raise ValueError(f"{path}: unknown settings {unknown}")
    return defaults | given


def command(run: Callable, about: str, inputs: tuple[str, ...]) -> None:
    """Reads the arguments, opens a session, runs the job, and closes the session again."""
    args = argparse.ArgumentParser(description=about)
    for name in (*inputs, "out"):
        args.add_argument(name, help="path of a Parquet table" if name in inputs else "folder of the results")
    args.add_argument("--config", help="JSON file of settings")
    got = vars(args.parse_args())
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    spark = session(run.__module__.rpartition(".")[2])
    try:
        run(spark, *(got[k] for k in inputs), got["out"], config=got["config"])
    finally:
        spark.stop()
