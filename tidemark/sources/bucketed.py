"""Tables dealt into buckets by their keys: a merge moves its source and never the table.

Rows of a key lie in one bucket, by the same hash that Spark shuffles with, so a join on the keys, a
window along them or the next state of the table asks for no exchange of what is already there. The
number of buckets is a property of the table and goes with its keys; readers of the folder in another
session name both again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def _quoted(columns: list[str]) -> str:
    return ", ".join(f"`{c}`" for c in columns)


def write_bucketed(df: DataFrame, path: str, keys: list[str], buckets: int, dealt: bool = False) -> None:
    """Writes ``df`` to ``path``, a file per bucket, sorted by ``keys``.

    ``dealt`` says that ``df`` comes from a join with a table of the same buckets and needs no
    exchange; it would be right without, in more files.
    """
    rows = df if dealt else df.repartition(buckets, *keys)
    name = f"written_{uuid.uuid4().hex}"
    rows.write.bucketBy(buckets, *keys).sortBy(*keys).format("parquet").option("path", path).saveAsTable(name)
    df.sparkSession.sql(f"DROP TABLE {name}")  # the folder stays, only its name goes


def read_bucketed(spark: SparkSession, path: str, schema: StructType, keys: list[str], buckets: int) -> DataFrame:
    """The table in the folder ``path``, known by its buckets."""
    name = f"read_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({_quoted(keys)})"
        f" SORTED BY ({_quoted(keys)}) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return table


def table_size(spark: SparkSession, path: str) -> DataFrame:
    """(files, bytes, mb) of the data files in a folder, from their listing alone."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "part-*").load(path)
    sizes = files.select("path", "length")
    return sizes.agg(
        F.count(F.lit(1)).alias("files"),
        F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"),
        F.round(F.coalesce(F.sum("length"), F.lit(0)) / (1 << 20), 2).alias("mb"),
    )
