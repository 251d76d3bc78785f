"""Writers. Output keeps its partitions; a single file is opt-in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.sources.readers import require_format

# Parquet codecs by name; any other name means uncompressed.
PARQUET_CODECS = {"SNAPPY": "snappy", "GZIP": "gzip", "UNCOMPRESSED": "uncompressed"}
ROW_GROUP_BYTES = 64 * 1024 * 1024
PAGE_BYTES = 8 * 1024


def _shaped(df: DataFrame, single_file: bool) -> DataFrame:
    """One partition is made by a shuffle, so that the work before it keeps its tasks."""
    return df.repartition(1) if single_file else df


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    _shaped(df, single_file).write.mode("overwrite").option("header", True).csv(path)


def write_json(df: DataFrame, path: str, gzip: bool = False, single_file: bool = False) -> None:
    codec = "gzip" if gzip else "none"
    _shaped(df, single_file).write.mode("overwrite").option("compression", codec).json(path)


def write_events(df: DataFrame, path: str, fmt: str = "parquet", codec: str = "SNAPPY") -> None:
    """Write events as parquet, json, orc or avro with the named codec."""
    writer = df.write.mode("overwrite")
    if fmt == "parquet":
        writer = (
            writer.option("compression", PARQUET_CODECS.get(codec.upper(), "uncompressed"))
            .option("parquet.block.size", ROW_GROUP_BYTES)
            .option("parquet.page.size", PAGE_BYTES)
        )
    elif fmt == "avro":
        require_format(df.sparkSession, "avro")
        writer = writer.option("compression", codec.lower())
    elif fmt == "json":
        writer = writer.option("compression", "gzip" if codec.upper() == "GZIP" else "none")
    writer.format(fmt).save(path)


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Create or replace a table."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_sorted(df: DataFrame, path: str, columns: list[str]) -> None:
    """Sort inside each partition before writing, so file statistics allow skipping."""
    df.sortWithinPartitions(*columns).write.mode("overwrite").parquet(path)


def interleaved(df: DataFrame, columns: list[str], bits: int = 6) -> Column:
    """A number whose bits are those of the ranks of ``columns`` in turn, most significant first.

    A rank is the place of a value among ``2**bits - 1`` approximate quantiles, so it follows the data
    whatever its distribution; the quantiles, a bounded number, come from one aggregate. Nulls rank 0.
    """
    shares = [i / 2**bits for i in range(1, 2**bits)]
    cuts = df.agg(*(F.percentile_approx(c, shares).alias(c) for c in columns)).first()

    def rank_of(c: str) -> Column:
        if not cuts[c]:
            return F.lit(0)
        return F.size(F.filter(F.array(*(F.lit(v) for v in cuts[c])), lambda border: border <= F.col(c)))

    number = F.lit(0).cast("bigint")
    for j, c in enumerate(columns):
        rank = rank_of(c)
        for bit in range(bits):
            place = bit * len(columns) + len(columns) - 1 - j
            number = number + F.shiftleft(F.shiftright(rank, bit).bitwiseAND(F.lit(1)).cast("bigint"), place)
    return number


def write_clustered(df: DataFrame, path: str, columns: list[str], files: int, bits: int = 6) -> None:
    """Writes ``files`` files whose minima and maxima are narrow in each of ``columns``.

    A sort favours its first column; here every column gets its share of the cuts, so a range on any
    of them leaves most files and row groups unread.
    """
    order = ["_place", *columns]
    placed = df.withColumn("_place", interleaved(df, columns, bits))
    dealt = placed.repartitionByRange(files, *order).sortWithinPartitions(*order)
    dealt.drop("_place").write.mode("overwrite").parquet(path)
