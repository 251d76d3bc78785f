"""Publishing with offsets: what a batch writes and how far it has read become visible together.

Rows of a batch go to a folder of their own, then one row in a commit folder names the batch, the
group and the offsets it covers. Readers join rows with commits, so a batch that was written but not
committed is not there; run again, it overwrites its rows and commits once. Each group has its own
folder and checkpoint, so groups read the same topic independently and at their own pace.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

COMMITS = "topic STRING, rows LONG, first_offset LONG, last_offset LONG, batch LONG"


def write_rows(batch: DataFrame, path: str, batch_id: int) -> None:
    batch.write.mode("overwrite").parquet(f"{path}/rows/batch={batch_id}")


def commit(batch: DataFrame, path: str, batch_id: int) -> None:
    """One file with the offsets per topic of a batch; its name is moved into place when it is whole."""
    offsets = batch.groupBy("topic").agg(
        F.count(F.lit(1)).alias("rows"), F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset")
    )
    offsets.coalesce(1).write.mode("overwrite").parquet(f"{path}/commits/batch={batch_id}")


def publish_stream(events: DataFrame, path: str, checkpoint: str, work: Callable[[DataFrame], DataFrame] = lambda batch: batch):
    """Reads (topic, offset, ...), writes what ``work`` makes of each batch and commits its offsets."""

    def publish(batch: DataFrame, batch_id: int) -> None:
        write_rows(work(batch), path, batch_id)
        commit(batch, path, batch_id)

    return events.writeStream.foreachBatch(publish).option("checkpointLocation", checkpoint)


def commits(spark: SparkSession, path: str) -> DataFrame:
    """(topic, rows, first_offset, last_offset, batch) of the committed batches."""
    return spark.read.schema(COMMITS).parquet(f"{path}/commits")


def committed(spark: SparkSession, path: str) -> DataFrame:
    """The rows of committed batches; folders of others are not opened (partition pruning at run time)."""
    done = commits(spark, path).select("batch").distinct()
    return spark.read.parquet(f"{path}/rows").join(done, "batch", "left_semi").drop("batch")
