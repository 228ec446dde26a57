"""Session creation and the shared folder used for checkpoints and intermediate tables."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def get_session(app: str = "rillflow", master: str | None = None, **conf) -> SparkSession:
    """A session in UTC; adaptive execution is Spark's default. Shuffle partitions stay the cluster's choice."""
    builder = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC")
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Time bucketing is defined in UTC, whatever session the caller brings."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in spark.checkpoint.dir.

    Only a local session without that setting gets a temporary folder; on a cluster a
    machine-local folder would lose data, so a missing setting is an error there.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="rillflow-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")
