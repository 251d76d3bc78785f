"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def get_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A UTC session with adaptive execution; the web page stays off."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    Only a local session without the setting gets a temporary folder; on a cluster a missing
    setting is an error, because a machine-local folder would be lost with its executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="tidemark-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, never used before."""
    return f"{shared_dir(spark)}/tidemark/{label}-{uuid.uuid4().hex}"


def text_parts(spark: SparkSession) -> int:
    """A stated number of parts for texts: parts sized by narrow columns or packed bytes are too few, uneven, and sorted on disk."""
    return max(8 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def stored(df: DataFrame, label: str = "stage", compression: str | None = None, path: str | None = None) -> DataFrame:
    """Write ``df`` as parquet to the shared folder and read it back; ``zstd`` takes less disk, more time.

    Cuts the lineage with files that outlive an executor, so work shared by several outputs is
    done once and a lost executor never forces it to be redone. ``path`` is a :func:`new_folder`
    that the caller removes.
    """
    spark = df.sparkSession
    path = path or new_folder(spark, label)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


# Shuffle files else stay until the driver happens to collect its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def brief_shuffles(spark: SparkSession) -> Iterator[None]:
    """Jobs that are run inside leave no shuffle files; for those that store what they make."""
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a :func:`new_folder` that nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)
