"""Structured Streaming jobs of the document flow.

Each job is one query with its own checkpoint. Sinks keyed by the batch number overwrite their
own folder, so a batch that runs again after a failure leaves no second copy. What spans batches
(totals, first and last events, the index) is written per batch as a part, merged with earlier parts
(:mod:`tidemark.streaming.parts`) and put together by a reader: no watermark, and no event is too late.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidemark.operators import documents as D
from tidemark.streaming.parts import add_part, parts


def file_stream(
    spark: SparkSession, path: str, schema: StructType, files_per_batch: int | None = None
) -> DataFrame:
    """A parquet folder (or one file) as a stream; new files become new batches."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path + "*" if path.endswith(".parquet") else path)


def run_available(writer) -> StreamingQuery:
    """Work off what is there now, then stop."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def to_lake(stream: DataFrame, path: str, checkpoint: str, partition_by: list[str]):
    """Append to a partitioned parquet folder, each row exactly once."""
    return (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy(*partition_by)
        .outputMode("append")
    )


def per_batch(
    stream: DataFrame, checkpoint: str, work: Callable[[DataFrame, int], None], mode: str = "append"
):
    return (
        stream.writeStream.foreachBatch(work)
        .option("checkpointLocation", checkpoint)
        .outputMode(mode)
    )


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Write a batch to its own folder; doing it again replaces it."""
    df.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def batches(spark: SparkSession, path: str) -> DataFrame:
    """All batches of a folder, without their numbers."""
    return spark.read.parquet(path).drop("batch")


def split_stream(raw: DataFrame, checked_path: str, checkpoint: str, min_chars: int = 1):
    """Normalize a stream into one sink; :func:`split_batches` reads its two sides."""

    def split(batch: DataFrame, batch_id: int) -> None:
        seen = D.checked(batch, min_chars)
        good = F.col("reason").isNull().cast("int")
        folder = f"{checked_path}/batch={batch_id}"
        seen.withColumn("good", good).write.mode("overwrite").partitionBy("good").parquet(folder)

    return per_batch(raw, checkpoint, split)


def split_batches(spark: SparkSession, checked_path: str) -> tuple[DataFrame, DataFrame]:
    """(valid events, dead letters) of all batches; each side reads its own folders."""
    seen = spark.read.parquet(checked_path)
    good = seen.filter("good = 1").drop("batch", "good")
    dead = seen.filter("good = 0").drop("batch", "good")
    return D.valid_events(good), D.dead_letters(dead)


def dedup_stream(valid: DataFrame, keys: list[str], keep: list[str], path: str, checkpoint: str):
    """The first event per key of each batch; :func:`first_events` reads them."""

    def reduce(batch: DataFrame, batch_id: int) -> None:
        first = D.first_per(batch, keys, "offset", keep)
        add_part(first, path, batch_id, lambda some: D.first_per(some, keys, "offset", keep))

    return per_batch(valid, checkpoint, reduce)


def first_events(spark: SparkSession, path: str, keys: list[str], keep: list[str]) -> DataFrame:
    return D.first_per(parts(spark, path), keys, "offset", keep)


def state_stream(valid: DataFrame, path: str, checkpoint: str):
    """The last event per document of each batch; :func:`latest_state` reads them.

    Events count by offset, so late ones, or a batch that runs again, change nothing.
    """

    def reduce(batch: DataFrame, batch_id: int) -> None:
        add_part(D.compacted(batch), path, batch_id, D.compacted)

    return per_batch(valid, checkpoint, reduce)


def latest_state(spark: SparkSession, path: str) -> DataFrame:
    """The last event per document, tombstones included."""
    return D.compacted(parts(spark, path))


def index_stream(valid: DataFrame, path: str, checkpoint: str):
    """The terms of each batch's documents, and which events there were."""

    def add(batch: DataFrame, batch_id: int) -> None:
        live = batch.filter(~F.col("tombstone"))
        add_part(D.inverted_index(live, "offset", "text"), f"{path}/terms", batch_id, lambda some: some)
        events = batch.select("document_id", F.struct("offset", "tombstone").alias("last"))
        add_part(_last_events(events), f"{path}/events", batch_id, _last_events)

    return per_batch(valid, checkpoint, add)


def _last_events(events: DataFrame) -> DataFrame:
    return events.groupBy("document_id").agg(F.max("last").alias("last"))


def current_index(spark: SparkSession, path: str) -> DataFrame:
    """(term, document_id, tf) of the last version of every document that is not deleted."""
    last = _last_events(parts(spark, f"{path}/events"))
    live = last.filter(~F.col("last.tombstone")).select("document_id", F.col("last.offset").alias("doc_id"))
    return parts(spark, f"{path}/terms").join(live, "doc_id").select("term", "document_id", "tf")


def window_stream(
    events: DataFrame, keys: list[str], moment: str, value: str, width: str, path: str, checkpoint: str
):
    """Count and sum per time window and keys of each batch; :func:`window_totals` adds them up."""

    def reduce(batch: DataFrame, batch_id: int) -> None:
        counted = batch.groupBy(F.window(moment, width)["start"].alias("window_start"), *keys).agg(
            F.count(F.lit(1)).alias("n"), F.sum(value).alias("total")
        )
        add_part(counted, path, batch_id, lambda some: _added(some, keys))

    return per_batch(events, checkpoint, reduce)


def window_totals(spark: SparkSession, path: str, keys: list[str], history: DataFrame) -> DataFrame:
    """Totals per time window next to the figures of ``history`` for the same keys."""
    return _added(parts(spark, path), keys).join(history, keys)


def _added(counted: DataFrame, keys: list[str]) -> DataFrame:
    total = F.sum("total").cast(counted.schema["total"].dataType)
    return counted.groupBy("window_start", *keys).agg(F.sum("n").alias("n"), total.alias("total"))
