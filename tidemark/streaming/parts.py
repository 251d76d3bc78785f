"""What spans batches, as parts that are merged like the digits of a number.

Every batch writes a part. As soon as ``BASE`` parts of a level are there, a batch merges them into one
of the next level, so readers of ``n`` batches touch at most ``BASE - 1`` folders for each digit of ``n``.
Which folders make up the whole is a small list, written last: a reader sees all of a batch or none of
it. Names depend on the batch number alone; a batch that runs again writes the same folders anew.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

BASE = 4
_BATCH = re.compile(r"/batch=(\d+)/")


def cover(batches: int) -> list[tuple[int, int]]:
    """(level, first batch) of the parts that make up the first ``batches`` batches, in order."""
    digits = []
    while batches:
        batches, digit = divmod(batches, BASE)
        digits.append(digit)
    found, at = [], 0
    for level in range(len(digits) - 1, -1, -1):
        for _ in range(digits[level]):
            found.append((level, at))
            at += BASE**level
    return found


def _folder(path: str, level: int, first: int) -> str:
    return f"{path}/parts/level={level}/first={first}"


def _published(spark: SparkSession, path: str) -> int:
    """How many batches are in the last list, 0 if there is none; only names are listed."""
    try:
        lists = spark.read.schema("level int, first long").parquet(f"{path}/lists").inputFiles()
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return 0
    return max((int(n) + 1 for name in lists for n in _BATCH.findall(name)), default=0)


def add_part(batch: DataFrame, path: str, batch_id: int, merge: Callable[[DataFrame], DataFrame]) -> None:
    """Writes a batch, merges the levels that it fills, then publishes the list.

    ``merge`` puts rows of several parts together; it may be applied to its own results. A job that
    starts over with batch 0 replaces its parts one by one and never shortens the list.
    """
    spark = batch.sparkSession
    batch.write.mode("overwrite").parquet(_folder(path, 0, batch_id))
    done, level = batch_id + 1, 1
    while done % BASE**level == 0:
        first, width = done - BASE**level, BASE ** (level - 1)
        sources = [_folder(path, level - 1, first + i * width) for i in range(BASE)]
        merge(spark.read.schema(batch.schema).parquet(*sources)).write.mode("overwrite").parquet(_folder(path, level, first))
        level += 1
    if done >= _published(spark, path):
        names = spark.createDataFrame(cover(done), "level int, first long")
        names.coalesce(1).write.mode("overwrite").parquet(f"{path}/lists/batch={batch_id}")


def folders(spark: SparkSession, path: str) -> list[str]:
    """The folders of all published batches."""
    done = _published(spark, path)
    listed = spark.read.parquet(f"{path}/lists/batch={done - 1}").orderBy("first").collect() if done else []
    return [_folder(path, r.level, r.first) for r in listed]


def parts(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all published parts; the caller merges them once more."""
    return spark.read.parquet(*folders(spark, path))
