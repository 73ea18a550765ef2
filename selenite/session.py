"""Session defaults."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

#: What every session of the engine starts from; sizes are left to the cluster's own settings.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",  # the JVM only interprets larger methods: such a stage is split instead
    "spark.ui.enabled": "false",
}


def session(app: str = "selenite", master: str | None = None, **conf: str) -> SparkSession:
    """A session with DEFAULTS; ``conf`` keys use ``__`` for dots and win over them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in (DEFAULTS | {k.replace("__", "."): v for k, v in conf.items()}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir. Where that is missing, a local session, as in tests, takes one of its
    machine; on a cluster that would be another folder on each machine, so there it is an error."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir names no folder that all machines share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="selenite-"))
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """``df``, written to the shared folder, so that later plans start there and survive the loss of executors."""
    shared_folder(df.sparkSession)
    return df.checkpoint()
