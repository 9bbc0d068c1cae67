"""Resumable inference as a stream: each record once per model, failures tried again by the next run."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from inkwright.operators.evals import latest_success, pending


def article_stream(spark: SparkSession, path: str, schema: str, files_per_batch: int = 8) -> DataFrame:
    """Articles of Parquet files as they come."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def run(records: DataFrame, models: DataFrame, process: Callable[[DataFrame], DataFrame], results: str, checkpoint: str, log_schema: str) -> StreamingQuery:
    """Appends process(pending records) of each micro-batch to results, then ends (availableNow).

    A batch that is run again after a failure finds its finished rows in results and leaves them out,
    so every (model, file) succeeds at most once. process takes and returns rows with model, file and error.
    """

    def batch(df: DataFrame, number: int) -> None:
        spark = df.sparkSession
        try:
            log = spark.read.schema(log_schema).parquet(results)
            log.limit(1).count()
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            log = spark.createDataFrame([], log_schema)
        process(pending(models, df, log)).withColumn("batch", F.lit(number).cast("long")).write.mode("append").parquet(results)

    return records.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def retry(records: DataFrame, models: DataFrame, process: Callable[[DataFrame], DataFrame], results: str, log_schema: str) -> None:
    """Runs what has failed or wasn't run, in one batch, and appends it."""
    spark = records.sparkSession
    process(pending(models, records, spark.read.schema(log_schema).parquet(results))).withColumn("batch", F.lit(-1).cast("long")).write.mode("append").parquet(results)


def current(spark: SparkSession, results: str, log_schema: str) -> DataFrame:
    """The latest success of each (model, file)."""
    return latest_success(spark.read.schema(log_schema).parquet(results), "batch")
