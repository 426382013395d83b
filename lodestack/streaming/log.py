"""Streaming intake of captures: a change log that a repeated micro-batch cannot write twice."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def read_captures(spark: SparkSession, path: str, schema: StructType, files_per_batch: int = 1) -> DataFrame:
    """Parquet captures as they arrive, a bounded number of files at a time."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def append_log(entries: DataFrame, log_path: str, snapshot_col: str, checkpoint: str) -> StreamingQuery:
    """Append entries to a Parquet log partitioned by snapshot.

    Every snapshot owns its partition and a batch overwrites the partitions that
    it holds, so replaying a batch after a failure leaves the log as it was. A
    snapshot must arrive within one batch.
    """

    def write(batch: DataFrame, _: int) -> None:
        (
            batch.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(snapshot_col)
            .parquet(log_path)
        )

    return entries.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
