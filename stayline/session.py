"""Session settings and the shared working folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the plans are tuned for. They change physical strategy only, never results.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Line-grain joins on (uid, day) must hash on both columns: hashing on uid alone would
    # put all lines of one busy uid into one task.
    "spark.sql.requireAllClusterKeysForCoPartition": "true",
}


def build_session(app: str = "stayline", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the recommended settings; ``extra`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder, from ``spark.checkpoint.dir``; where that is unset, one in the session's warehouse,
    which executors share too."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    folder = configured or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/stayline-work"
    if folder.startswith("file:/") and not folder.startswith("file:///"):
        folder = "file:///" + folder.removeprefix("file:/")
    return folder


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path for one written table under the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def shuffled(df: DataFrame) -> DataFrame:
    """A table that grows with the data, for a join that shuffles both sides. The planner takes the size of its compressed files
    for that of its rows, and counts none that a generator adds, so it would send tables of millions of rows to the driver."""
    return df.hint("merge")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably, so that losing an executor costs no recomputation."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)
