"""Session settings for local runs and a starting point for a cluster."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Splits a join partition that one key fills.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Plans are built from many small expressions; recording where each one was
    # written doubles the time that takes.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.files.maxPartitionBytes": "128m",
}


def build_session(
    master: str | None = None,
    app_name: str = "ledgerloom",
    shuffle_partitions: int | None = None,
    **extra: str,
) -> SparkSession:
    """Without ``master`` the cluster's own settings apply.

    On a cluster give ``shuffle_partitions`` generously (input bytes / 128 MB):
    adaptive execution merges small partitions but does not divide large ones,
    skewed joins aside.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    settings = dict(SETTINGS)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for key, value in {**settings, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
