"""Session settings that the engine is meant to run with."""

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def session(master: str | None = None, shuffle_partitions: int | None = None, **more: str) -> SparkSession:
    """A session with SETTINGS; on a cluster leave master and shuffle_partitions to its configuration."""
    builder = SparkSession.builder.appName("inkwright").config(map=SETTINGS | more)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()
