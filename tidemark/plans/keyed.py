"""Keyed-table queries: the orders as target, orders at a modulus as source."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from tidemark.operators import keyed as K
from tidemark.operators.benchmarks import side_by_side
from tidemark.plans.catalog import query
from tidemark.session import new_folder
from tidemark.sources.bucketed import read_bucketed, table_size, write_bucketed
from tidemark.sources.tables import Tables
from tidemark.sources.writers import write_clustered, write_sorted, write_table


def target(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_orderkey").alias("id"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("amount"),
        F.to_date("o_orderdate").alias("updated_at"),
        (F.col("o_orderkey") % 10).cast("string").alias("partition_key"),
    )


TARGET = """
    t AS (SELECT o_orderkey AS id, CAST(round(o_totalprice * 100) AS BIGINT) AS amount,
                 CAST(o_orderdate AS DATE) AS updated_at,
                 CAST(o_orderkey % 10 AS VARCHAR) AS partition_key FROM orders)
"""


def source(t: Tables, tenths: int) -> DataFrame:
    """``tenths`` of ten rows, dearer and newer."""
    return K.update_where(
        target(t).filter(F.col("id") % 10 < tenths),
        F.lit(True),
        {"amount": F.col("amount") + 100, "updated_at": F.date_add("updated_at", 1)},
    )


def published(t: Tables, df: DataFrame, label: str, partition_by: list[str] | None = None) -> str:
    """The folder of ``df`` written as a table."""
    path = new_folder(t.spark, label)
    write_table(df, path, partition_by)
    return path


@query(
    "table_overwrite",
    f"WITH {TARGET} SELECT id, amount + 5 AS amount, updated_at, partition_key FROM t",
)
def table_overwrite(t: Tables) -> DataFrame:
    path = new_folder(t.spark, "overwrite")
    write_table(target(t), path)
    write_table(target(t).withColumn("amount", F.col("amount") + 5), path)
    return t.spark.read.parquet(path)


@query(
    "table_scan_sum",
    f"WITH {TARGET} SELECT CAST(sum(amount) AS BIGINT) AS amount_sum FROM t",
)
def table_scan_sum(t: Tables) -> DataFrame:
    table = t.spark.read.parquet(published(t, target(t), "scan"))
    return table.agg({"amount": "sum"}).withColumnRenamed("sum(amount)", "amount_sum")


@query(
    "partitioned_write",
    f"""
    WITH {TARGET} SELECT partition_key, count(*) AS row_count,
    CAST(sum(amount) AS BIGINT) AS amount_sum FROM t GROUP BY 1
    """,
)
def partitioned_write(t: Tables) -> DataFrame:
    schema = target(t).schema
    path = new_folder(t.spark, "partitioned")
    write_table(target(t), path, ["partition_key"])
    return (
        t.spark.read.schema(schema)
        .parquet(path)
        .groupBy("partition_key")
        .agg(F.count(F.lit(1)).alias("row_count"), F.sum("amount").alias("amount_sum"))
    )


@query("sorted_write", f"WITH {TARGET} SELECT * FROM t WHERE amount BETWEEN 10000000 AND 12000000")
def sorted_write(t: Tables) -> DataFrame:
    path = new_folder(t.spark, "sorted")
    write_sorted(target(t), path, ["amount"])
    return t.spark.read.parquet(path).filter(F.col("amount").between(10_000_000, 12_000_000))


@query(
    "clustered_write",
    f"""
    WITH {TARGET} SELECT * FROM t
    WHERE amount BETWEEN 10000000 AND 11000000 OR updated_at BETWEEN DATE '1995-03-01' AND DATE '1995-03-20'
    """,
)
def clustered_write(t: Tables) -> DataFrame:
    """A table that skips files on either of two columns."""
    path = new_folder(t.spark, "clustered")
    write_clustered(target(t), path, ["amount", "updated_at"], files=16)
    table = t.spark.read.parquet(path)
    days = F.col("updated_at").between(F.lit("1995-03-01").cast("date"), F.lit("1995-03-20").cast("date"))
    dear = F.col("amount").between(10_000_000, 11_000_000)
    return table.filter(dear).unionByName(table.filter(days & ~F.coalesce(dear, F.lit(False))))


@query(
    "merge_update",
    f"""
    WITH {TARGET}
    SELECT id, CASE WHEN id % 10 < 1 THEN amount + 100 ELSE amount END AS amount,
           CASE WHEN id % 10 < 1 THEN updated_at + 1 ELSE updated_at END AS updated_at, partition_key
    FROM t
    """,
)
def merge_update(t: Tables) -> DataFrame:
    changes = source(t, 1).unionByName(
        source(t, 1).withColumn("id", -F.col("id") - 1)  # rows without a match
    )
    return K.merge_update(target(t), changes, ["id"], ["amount", "updated_at"])


@query(
    "merge_upsert",
    f"""
    WITH {TARGET}
    SELECT id, CASE WHEN id % 10 < 2 THEN amount + 100 ELSE amount END AS amount,
           CASE WHEN id % 10 < 2 THEN updated_at + 1 ELSE updated_at END AS updated_at, partition_key
    FROM t
    UNION ALL SELECT -id - 1, amount + 100, updated_at + 1, partition_key FROM t WHERE id % 10 < 2
    """,
)
def merge_upsert(t: Tables) -> DataFrame:
    changes = source(t, 2).unionByName(source(t, 2).withColumn("id", -F.col("id") - 1))
    return K.merge_upsert(target(t), changes, ["id"], ["amount", "updated_at"])


@query(
    "upsert_latest",
    f"""
    WITH {TARGET},
    u AS (SELECT *, 0 AS side FROM t
          UNION ALL SELECT id, amount + 100, updated_at + 1, partition_key, 1 FROM t WHERE id % 10 < 5
          UNION ALL SELECT id, amount - 1, updated_at - 9, partition_key, 1 FROM t WHERE id % 10 < 7)
    SELECT id, amount, updated_at, partition_key FROM (
      SELECT *, row_number() OVER (PARTITION BY id ORDER BY updated_at DESC, side DESC) AS rn FROM u)
    WHERE rn = 1
    """,
)
def upsert_latest(t: Tables) -> DataFrame:
    stale = K.update_where(
        target(t).filter(F.col("id") % 10 < 7),
        F.lit(True),
        {"amount": F.col("amount") - 1, "updated_at": F.date_add("updated_at", -9)},
    )
    changes = source(t, 5).unionByName(stale)
    return next_state(t, lambda before, n: K.upsert_latest(before, changes, ["id"], ["updated_at"], n))


def next_state(t: Tables, change: Callable[[DataFrame, int], DataFrame]) -> DataFrame:
    """The target as a table in buckets, changed into its next state, in the same buckets."""
    spark, schema, keys = t.spark, target(t).schema, ["id"]
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    before, after = new_folder(spark, "state"), new_folder(spark, "state")
    write_bucketed(target(t), before, keys, buckets)
    write_bucketed(change(read_bucketed(spark, before, schema, keys, buckets), buckets), after, keys, buckets, dealt=True)
    return read_bucketed(spark, after, schema, keys, buckets)


@query(
    "merge_bucketed",
    f"""
    WITH {TARGET}
    SELECT id, CASE WHEN id % 10 < 3 THEN amount + 100 ELSE amount END AS amount,
           CASE WHEN id % 10 < 3 THEN updated_at + 1 ELSE updated_at END AS updated_at, partition_key
    FROM t
    UNION ALL SELECT -id - 1, amount + 100, updated_at + 1, partition_key FROM t WHERE id % 10 < 3
    """,
)
def merge_bucketed(t: Tables) -> DataFrame:
    """A merge with updates and inserts, written as the table's next state."""
    changes = source(t, 3).unionByName(source(t, 3).withColumn("id", -F.col("id") - 1))
    return next_state(t, lambda before, n: K.merge_upsert(before, changes, ["id"], ["amount", "updated_at"], n))


@query(
    "table_size",
    f"WITH {TARGET} SELECT 4 AS files, true AS has_bytes, true AS mb_agrees, count(*) AS row_count FROM t",
)
def table_size_of(t: Tables) -> DataFrame:
    """Files and megabytes of a table, and its rows; bytes depend on the writer and are only checked."""
    path = published(t, target(t).repartition(4), "size")
    rows = t.spark.read.parquet(path).agg(F.count(F.lit(1)).alias("row_count"))
    found = table_size(t.spark, path).select(
        F.col("files").cast("int").alias("files"),
        (F.col("bytes") > 0).alias("has_bytes"),
        (F.abs(F.col("mb") - F.col("bytes") / (1 << 20)) <= 0.005).alias("mb_agrees"),
    )
    return side_by_side(found, rows)


@query(
    "update_where",
    f"""
    WITH {TARGET}
    SELECT id, CASE WHEN id < 1000 THEN amount + 7 ELSE amount END AS amount, updated_at,
           partition_key FROM t
    """,
)
def update_where(t: Tables) -> DataFrame:
    before = t.spark.read.parquet(published(t, target(t), "update"))
    after = K.update_where(before, F.col("id") < 1000, {"amount": F.col("amount") + 7})
    return t.spark.read.parquet(published(t, after, "update"))


@query(
    "upsert_limit",
    f"""
    WITH {TARGET}, f AS (SELECT id FROM t ORDER BY id LIMIT 1000)
    SELECT id, CASE WHEN id IN (SELECT id FROM f) THEN amount + 3 ELSE amount END AS amount,
           CASE WHEN id IN (SELECT id FROM f) THEN updated_at + 1 ELSE updated_at END AS updated_at,
           partition_key FROM t
    """,
)
def upsert_limit(t: Tables) -> DataFrame:
    first = K.update_where(
        K.first_rows(target(t), ["id"], 1000),
        F.lit(True),
        {"amount": F.col("amount") + 3, "updated_at": F.date_add("updated_at", 1)},
    )
    return K.upsert_latest(target(t), first, ["id"], ["updated_at"])


CHANGES = """
    c AS (SELECT id, amount + 1 AS amount, updated_at, partition_key, 'update' AS op, 1 AS seq
          FROM t WHERE id % 4 = 0
          UNION ALL SELECT id, amount + 2, updated_at, partition_key, 'update', 2 FROM t WHERE id % 8 = 0
          UNION ALL SELECT id, amount, updated_at, partition_key, 'delete', 3 FROM t WHERE id % 16 = 0
          UNION ALL SELECT -id - 1, amount, updated_at, partition_key, 'insert', 4 FROM t WHERE id % 5 = 0)
"""


@query(
    "cdc_apply",
    f"""
    WITH {TARGET}, {CHANGES},
    l AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY id ORDER BY seq DESC) = 1)
    SELECT id, amount, updated_at, partition_key FROM t WHERE id NOT IN (SELECT id FROM l)
    UNION ALL SELECT id, amount, updated_at, partition_key FROM l WHERE op <> 'delete'
    """,
)
def cdc_apply(t: Tables) -> DataFrame:
    rows = target(t)

    def change(every: int, op: str, seq: int, extra: int, fresh: bool = False) -> DataFrame:
        changed = rows.filter(F.col("id") % every == 0).withColumn("amount", F.col("amount") + extra)
        if fresh:
            changed = changed.withColumn("id", -F.col("id") - 1)
        return changed.select("*", F.lit(op).alias("op"), F.lit(seq).alias("seq"))

    changes = (
        change(4, "update", 1, 1)
        .unionByName(change(8, "update", 2, 2))
        .unionByName(change(16, "delete", 3, 0))
        .unionByName(change(5, "insert", 4, 0, fresh=True))
    )
    return K.cdc_apply(rows, changes, ["id"], ["seq"])


@query(
    "scd2",
    """
    SELECT o_custkey AS customer, o_orderkey AS version, CAST(o_orderdate AS DATE) AS valid_from,
           lead(CAST(o_orderdate AS DATE)) OVER w AS valid_to,
           lead(o_orderkey) OVER w IS NULL AS is_current
    FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)
    """,
)
def scd2(t: Tables) -> DataFrame:
    versions = t.orders.select(
        F.col("o_custkey").alias("customer"),
        F.col("o_orderkey").alias("version"),
        F.to_date("o_orderdate").alias("valid_from"),
    )
    return K.scd2(versions, ["customer"], "valid_from", ["valid_from", "version"])


@query(
    "compact_files",
    f"""
    WITH {TARGET}
    SELECT 16 AS files_before, 4 AS files_after, count(*) AS row_count,
           CAST(sum(amount) AS BIGINT) AS amount_sum FROM t
    """,
)
def compact_files(t: Tables) -> DataFrame:
    """Rewrite a table of many small files as one of few, and read both."""
    many = t.spark.read.parquet(published(t, target(t).repartition(16), "compact"))
    rows = many.count()
    few = t.spark.read.parquet(published(t, K.compact(many, max(1, -(-rows // 4)), rows), "compact"))

    def files(table: DataFrame, name: str) -> DataFrame:
        return table.agg(F.count_distinct("_metadata.file_path").cast("int").alias(name))

    sums = few.agg(F.count(F.lit(1)).alias("row_count"), F.sum("amount").alias("amount_sum"))
    counts = side_by_side(files(many, "files_before"), files(few, "files_after"))
    return side_by_side(counts, sums)


def _versions(t: Tables, label: str, *states: DataFrame) -> str:
    """States of a table, each in its own ``version=`` folder; old ones stay as they are."""
    path = new_folder(t.spark, label)
    for number, state in enumerate(states, 1):
        write_table(state, f"{path}/version={number}")
    return path


@query(
    "read_version",
    f"""
    WITH {TARGET}
    SELECT id, amount, NULL::VARCHAR AS note FROM t
    UNION ALL SELECT id, amount * 2, 'second' FROM t
    """,
)
def read_version(t: Tables) -> DataFrame:
    """An old version stays readable; a column added later is null in its rows."""
    rows = target(t).select("id", "amount")
    second = rows.select("id", (F.col("amount") * 2).alias("amount"), F.lit("second").alias("note"))
    path = _versions(t, "versions", rows, second)
    return t.spark.read.option("mergeSchema", True).parquet(path).select("id", "amount", "note")


@query(
    "time_travel",
    f"WITH {TARGET} SELECT CAST(sum(amount) AS BIGINT) AS old_sum FROM t",
)
def time_travel(t: Tables) -> DataFrame:
    rows = target(t).select("id", "amount")
    path = _versions(t, "travel", rows, rows.withColumn("amount", F.col("amount") + 1))
    old = t.spark.read.parquet(path).filter(F.col("version") == 1)
    return old.agg(F.sum("amount").alias("old_sum"))
