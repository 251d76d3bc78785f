"""Readers. Schemas are declared; inference is opt-in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


class ModuleUnavailable(RuntimeError):
    """A format's Spark module is not on the classpath."""


def require_format(spark: SparkSession, name: str) -> None:
    """Fail early, and by name, when a format needs a module the session lacks."""
    try:
        spark.read.format(name).load()
    except Exception as error:  # the lookup error differs by format; only its text tells
        text = str(error)
        if "Failed to find data source" in text or "DATA_SOURCE_NOT_FOUND" in text or (
            "failed to find" in text.lower() or "deploy" in text.lower()
        ):
            raise ModuleUnavailable(f"the Spark module for '{name}' is not on the classpath") from None


ORDERS_SCHEMA = "order_id INT, created_at TIMESTAMP, product STRING, amount DOUBLE"
EVENT_SCHEMA = (
    "date STRING, user_id BIGINT, event_type STRING, url STRING, user_agent STRING, value DOUBLE,"
    " metrics STRUCT<clicks: BIGINT, impressions: BIGINT, revenue: DOUBLE>"
)
SNAPSHOT_SCHEMA = (
    "system STRING, date STRING, machine STRING, load_time DOUBLE, data_size BIGINT,"
    " result ARRAY<ARRAY<DOUBLE>>"
)


def read_session_files(spark: SparkSession, path: str) -> DataFrame:
    """One row (source_file, content) per text file; small files share a task."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("source_file"), F.col("value").alias("content")
    )


def read_session_blocks(spark: SparkSession, path: str, lines: int = 1 << 14) -> DataFrame:
    """(source_file, block, content): text files of any size in blocks of at most ``lines`` lines.

    Files are read by splits, so that a large one is read by many tasks and never is one row. ``lines``
    is a power of two; rows are numbered within their split, and blocks never cross splits.
    """
    bits = lines.bit_length() - 1
    if lines != 1 << bits:
        raise ValueError("the number of lines has to be a power of two")
    rows = spark.read.option("lineSep", "\n").text(path)
    placed = rows.select(
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("id"),
        "value",
    ).withColumn("part", F.shiftright("id", bits))
    grouped = placed.groupBy("source_file", "split", "part").agg(F.sort_array(F.collect_list(F.struct("id", "value"))).alias("rows"))
    content = F.array_join(F.transform("rows", lambda row: row["value"]), "\n")
    return grouped.select("source_file", F.struct("split", "part").alias("block"), content.alias("content"))


def read_csv(
    spark: SparkSession, path: str, schema: str | StructType | None = None, infer: bool = False
) -> DataFrame:
    reader = spark.read.option("header", True)
    if schema is not None:
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", infer).csv(path)


def read_events(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: str | StructType = EVENT_SCHEMA
) -> DataFrame:
    """Click events from parquet, json (plain or gzip), orc or avro."""
    if fmt == "avro":
        require_format(spark, "avro")
    return spark.read.format(fmt).schema(schema).load(path)


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """Benchmark snapshots, one JSON document per file."""
    return spark.read.schema(SNAPSHOT_SCHEMA).option("multiLine", True).json(path)


def read_topic(spark: SparkSession, servers: str, topics: list[str], **options: str) -> DataFrame:
    """A stream (topic, key, value, timestamp, partition, offset) from a broker."""
    require_format(spark, "kafka")
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .options(**options)
        .load()
        .select(
            "topic",
            F.col("key").cast("string").alias("key"),
            F.col("value").cast("string").alias("value"),
            "timestamp",
            "partition",
            "offset",
        )
    )


# The exposition line grammar ``name{label="value",...} number``.
METRIC_LINE = r'^([A-Za-z_:][A-Za-z0-9_:]*)(?:\{(.*)\})?\s+(\S+)(?:\s+(\d+))?\s*$'
LABEL_PAIR = r'([A-Za-z_][A-Za-z0-9_]*)\s*=\s*"((?:[^"\\]|\\.)*)"'


def _unescaped(text: Column) -> Column:
    """Undo the escapes of a label value: backslash, quote and line feed."""
    plain = F.replace(text, F.lit('\\"'), F.lit('"'))
    plain = F.regexp_replace(plain, r"(?<!\\)((?:\\\\)*)\\n", "$1\n")
    return F.when(text.contains("\\"), F.replace(plain, F.lit("\\\\"), F.lit("\\"))).otherwise(text)


def parse_metric_lines(lines: DataFrame, line: str = "value") -> DataFrame:
    """Exposition lines to (metric, labels, value, ts, error); comments and blank lines are skipped.

    ``ts`` is the line's time in milliseconds as a timestamp, or null. A label given twice is named
    in ``error``; the line then has no labels.
    """
    text = F.trim(F.col(line))
    names = F.regexp_extract_all(F.col("_labels"), F.lit(LABEL_PAIR), 1)
    values = F.transform(
        F.regexp_extract_all(F.col("_labels"), F.lit(LABEL_PAIR), 2), _unescaped
    )
    number = F.regexp_extract(text, METRIC_LINE, 3)
    millis = F.regexp_extract(text, METRIC_LINE, 4).try_cast("bigint")
    repeated = F.size(F.array_distinct("_names")) < F.size("_names")
    return (
        lines.filter(text.rlike(METRIC_LINE) & ~text.startswith("#"))
        .withColumn("_labels", F.regexp_extract(text, METRIC_LINE, 2))
        .withColumn("_names", names)
        .select(
            *[c for c in lines.columns if c != line],
            F.regexp_extract(text, METRIC_LINE, 1).alias("metric"),
            F.when(~repeated, F.map_from_arrays("_names", values)).alias("labels"),
            F.when(number == "+Inf", F.lit(float("inf")))
            .when(number == "-Inf", F.lit(float("-inf")))
            .otherwise(number.try_cast("double"))
            .alias("value"),
            F.timestamp_millis(millis).alias("ts"),
            F.when(repeated, F.lit("repeated label")).alias("error"),
        )
    )


def read_metric_files(spark: SparkSession, path: str) -> DataFrame:
    return parse_metric_lines(spark.read.text(path))
