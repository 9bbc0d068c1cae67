"""Tables written to the shared folder, to cut lineage in a way that outlives lost executors."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; a temporary one only where it is unset and Spark is local."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found
    set_ = spark.sparkContext._jsc.sc().getCheckpointDir()
    if set_.isDefined():
        return set_.get()
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    own = "file://" + tempfile.mkdtemp(prefix="inkwright-")
    spark.sparkContext.setCheckpointDir(own)
    return own


def _drop_all() -> None:
    for spark, path in _OWN:
        try:
            hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)
        except Exception:  # the JVM may have ended first
            return


def new_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, deleted when the driver ends."""
    if not _OWN:
        atexit.register(_drop_all)
    path = f"{shared_dir(spark)}/inkwright/{name}-{uuid.uuid4().hex}"
    _OWN.append((spark, path))
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """df, written as Parquet in the shared folder and read again."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
