"""Partition controls, skew profiles and stage figures from event logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def grouped_sum(
    df: DataFrame,
    key: str = "group_id",
    value: str | Column = "value",
    partitions: int | None = None,
    mode: str = "repartition",
) -> DataFrame:
    """Sum per group after changing the number of partitions.

    ``coalesce`` only lowers the number; asking for more leaves it as it is.
    """
    if partitions is not None:
        if mode == "repartition":
            df = df.repartition(partitions)
        elif mode == "coalesce":
            df = df.coalesce(partitions)
        else:
            raise ValueError(f"unknown mode {mode!r}")
    return df.groupBy(key).agg(F.sum(value).alias("total"))


def partition_profile(df: DataFrame) -> DataFrame:
    """Rows per partition."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(
        F.count(F.lit(1)).alias("row_count")
    )


def key_skew_profile(df: DataFrame, key: str) -> DataFrame:
    """Number of keys, rows, rows of the largest key and its share of all."""
    return (
        df.groupBy(key)
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(
            F.count(F.lit(1)).alias("key_count"),
            F.sum("n").alias("row_count"),
            F.max("n").alias("largest_key_rows"),
        )
        .withColumn(
            "largest_share",
            F.round(F.try_divide(F.col("largest_key_rows").cast("double"), F.col("row_count")), 6),
        )
    )


# The event-log fields that are read.
TASK_END = """
    Event STRING, `Stage ID` BIGINT,
    `Task Metrics` STRUCT<
        `Executor Run Time`: BIGINT, `Memory Bytes Spilled`: BIGINT, `Disk Bytes Spilled`: BIGINT,
        `Shuffle Read Metrics`: STRUCT<`Remote Bytes Read`: BIGINT, `Local Bytes Read`: BIGINT>,
        `Shuffle Write Metrics`: STRUCT<`Shuffle Bytes Written`: BIGINT>,
        `Input Metrics`: STRUCT<`Bytes Read`: BIGINT>>,
    Properties MAP<STRING, STRING>, `Stage Info` STRUCT<`Stage ID`: BIGINT>
"""


def stage_metrics(spark: SparkSession, event_log: str) -> DataFrame:
    """Task figures summed per job group, from event-log files."""
    events = spark.read.schema(TASK_END).json(event_log)
    groups = events.filter(F.col("Event") == "SparkListenerStageSubmitted").select(
        F.col("`Stage Info`.`Stage ID`").alias("stage_id"),
        F.coalesce(
            F.try_element_at("Properties", F.lit("spark.jobGroup.id")), F.lit("")
        ).alias("job_group"),
    )
    m = "`Task Metrics`"
    tasks = events.filter(F.col("Event") == "SparkListenerTaskEnd").select(
        F.col("`Stage ID`").alias("stage_id"),
        F.col(f"{m}.`Executor Run Time`").alias("executor_run_time"),
        F.col(f"{m}.`Memory Bytes Spilled`").alias("memory_bytes_spilled"),
        F.col(f"{m}.`Disk Bytes Spilled`").alias("disk_bytes_spilled"),
        (
            F.col(f"{m}.`Shuffle Read Metrics`.`Remote Bytes Read`")
            + F.col(f"{m}.`Shuffle Read Metrics`.`Local Bytes Read`")
        ).alias("shuffle_read_bytes"),
        F.col(f"{m}.`Shuffle Write Metrics`.`Shuffle Bytes Written`").alias("shuffle_write_bytes"),
        F.col(f"{m}.`Input Metrics`.`Bytes Read`").alias("input_bytes"),
    )
    sums = [c for c in tasks.columns if c != "stage_id"]
    per_stage = tasks.groupBy("stage_id").agg(
        F.count(F.lit(1)).alias("tasks"), *(F.sum(c).alias(c) for c in sums)
    )
    return (
        per_stage.join(groups.distinct(), "stage_id")
        .groupBy("job_group")
        .agg(F.sum("tasks").alias("tasks"), *(F.sum(c).alias(c) for c in sums))
    )
