"""Quality, benchmark-comparison and partitioning queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.operators import benchmarks as B
from tidemark.operators import partitioning as P
from tidemark.operators import quality as Q
from tidemark.plans.catalog import query
from tidemark.session import new_folder
from tidemark.sources.readers import read_snapshot
from tidemark.sources.tables import Tables

REQUIRED = " 1-URGENT,2-HIGH, 3-MEDIUM ,,5-LOW"


def manifest(t: Tables) -> DataFrame:
    """Customers as projects, order priorities as their paths."""
    return t.orders.select(
        F.concat(F.lit("c"), "o_custkey").alias("project"), F.col("o_orderpriority").alias("path")
    )


VERDICTS = f"""
    v AS (SELECT 'c' || o_custkey AS project,
                 count(*) FILTER (WHERE len(string_split(o_orderpriority, '/')) <= 3) AS listed_paths,
                 concat_ws(',', {', '.join(
                     f"CASE WHEN count(*) FILTER (WHERE o_orderpriority = '{x}') = 0 THEN '{x}' END"
                     for x in ('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW'))}) AS missing
          FROM orders GROUP BY 1),
    w AS (SELECT project, CASE WHEN missing = '' THEN 'OK' ELSE 'FAILED' END AS status,
                 CASE WHEN missing = '' THEN '-' ELSE missing END AS missing_paths, listed_paths FROM v)
"""


@query("required_missing", f"WITH {VERDICTS} SELECT * FROM w")
def required_missing(t: Tables) -> DataFrame:
    return Q.required_missing(manifest(t), REQUIRED)


@query(
    "check_report",
    f"""
    WITH {VERDICTS}
    SELECT project, c_name AS author, status, missing_paths,
           concat_ws(chr(10), '- Project name: ' || project, '- Author: ' || c_name,
                     '- Check status: ' || status, '- Missing paths: ' || missing_paths,
                     CASE WHEN status = 'OK' THEN '{Q.PASSED_TEXT}' ELSE '{Q.FAILED_TEXT}' END) AS summary
    FROM w JOIN customer ON project = 'c' || c_custkey
    """,
)
def check_report(t: Tables) -> DataFrame:
    authors = t.customer.select(
        F.concat(F.lit("c"), "c_custkey").alias("project"), F.col("c_name").alias("author")
    )
    return Q.check_report(Q.required_missing(manifest(t), REQUIRED), authors)


@query(
    "dq_profile",
    """
    SELECT 'price present' AS rule, count(*) AS checked,
           count(*) FILTER (WHERE o_totalprice IS NULL) AS failed FROM orders
    UNION ALL SELECT 'known status', count(*),
           count(*) FILTER (WHERE o_orderstatus NOT IN ('F', 'O')) FROM orders
    UNION ALL SELECT 'price in range', count(*),
           count(*) FILTER (WHERE NOT o_totalprice BETWEEN 10000 AND 400000) FROM orders
    UNION ALL SELECT 'unique l_orderkey, l_linenumber', count(*),
           count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem))
           FROM lineitem
    UNION ALL SELECT 'o_orderkey in l_orderkey', count(*),
           count(*) FILTER (WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)) FROM orders
    """,
)
def dq_profile(t: Tables) -> DataFrame:
    rules = {
        "price present": F.col("o_totalprice").isNotNull(),
        "known status": F.col("o_orderstatus").isin("F", "O"),
        "price in range": F.col("o_totalprice").between(10_000, 400_000),
    }
    parents = t.lineitem.select("l_orderkey").distinct()
    return (
        Q.profile(t.orders, rules)
        .unionByName(Q.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"]))
        .unionByName(Q.broken_references(t.orders, "o_orderkey", parents, "l_orderkey"))
    )


@query(
    "orders_without_items",
    """
    SELECT o_orderkey, o_custkey FROM orders
    WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)
    """,
)
def orders_without_items(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_custkey").join(
        t.lineitem.select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_anti"
    )


@query(
    "job_metrics",
    """
    SELECT 'orders-copy' AS job_name, count(*) AS processed,
           count(*) FILTER (WHERE o_orderstatus = 'P') AS failed, 1::BIGINT AS runs FROM orders
    """,
)
def job_metrics(t: Tables) -> DataFrame:
    """Run a job, note its final figures in a metrics table and read that."""
    watched, seen = Q.observed(
        t.orders,
        "orders-copy",
        processed=F.count(F.lit(1)),
        failed=F.count_if(F.col("o_orderstatus") == "P"),
    )
    watched.write.parquet(new_folder(t.spark, "job"))
    figures = seen.get
    path = new_folder(t.spark, "job-metrics")
    t.spark.createDataFrame(
        [("orders-copy", figures["processed"], figures["failed"])],
        "job_name STRING, processed BIGINT, failed BIGINT",
    ).write.mode("append").parquet(path)
    return (
        t.spark.read.parquet(path)
        .groupBy("job_name")
        .agg(
            F.sum("processed").alias("processed"),
            F.sum("failed").alias("failed"),
            F.count(F.lit(1)).alias("runs"),
        )
    )


# --- benchmark comparison ---------------------------------------------------------------------


def system_runs(t: Tables, flag: str) -> DataFrame:
    """(query, cold, hot) of a system: first run, better of the other two."""
    n, mine = F.col("l_linenumber"), F.col("l_returnflag") == flag
    sums = [
        (F.sum(F.when((n % 3 == i) & mine, F.col("l_quantity")).otherwise(0.0)) + 1).alias(f"r{i}")
        for i in range(3)
    ]
    return (
        t.lineitem.groupBy(F.col("l_partkey").alias("query"))
        .agg(*sums)
        .select("query", F.array("r0", "r1", "r2").alias("runs"))
        .select(
            "query", B.cold_run(F.col("runs")).alias("cold"), B.hot_run(F.col("runs")).alias("hot")
        )
    )


def _side(flag: str) -> str:
    runs = ", ".join(
        f"sum(CASE WHEN l_linenumber % 3 = {i} AND l_returnflag = '{flag}' THEN l_quantity ELSE 0 END)"
        f" + 1 AS r{i}"
        for i in range(3)
    )
    return (
        f"(SELECT query, r0 AS cold, least(r1, r2) AS hot FROM"
        f" (SELECT l_partkey AS query, {runs} FROM lineitem GROUP BY 1))"
    )


RATIOS = f"""
    q AS (SELECT b.cold AS bc, b.hot AS bh, o.cold AS oc, o.hot AS oh
          FROM {_side('A')} b JOIN {_side('R')} o ON b.query = o.query),
    p AS (SELECT count(*) AS queries, exp(avg(ln(oc / bc))) AS cold, exp(avg(ln(oh / bh))) AS hot,
                 count(*) FILTER (WHERE oc < bc) AS cold_wins,
                 count(*) FILTER (WHERE oh < bh) AS hot_wins FROM q)
"""


@query(
    "pairwise_ratio",
    f"""
    WITH {RATIOS}
    SELECT queries, round(cold, 6) AS cold_ratio, round(hot, 6) AS hot_ratio, cold_wins, hot_wins FROM p
    """,
)
def pairwise_ratio(t: Tables) -> DataFrame:
    found = B.pairwise_ratio(system_runs(t, "A"), system_runs(t, "R"))
    return found.withColumns(
        {c: F.round(c, 6) for c in ("cold_ratio", "hot_ratio")}
    )


@query(
    "result_rows",
    f"""
    WITH {RATIOS},
    r AS (SELECT round(cold, 6) AS cold, round(hot, 6) AS hot, cold_wins, hot_wins FROM p)
    SELECT 'pair' AS scenario, 'r_vs_a' AS engine, 'cold_ratio' AS metric, cold AS "value", 'x' AS unit FROM r
    UNION ALL SELECT 'pair', 'r_vs_a', 'hot_ratio', hot, 'x' FROM r
    UNION ALL SELECT 'pair', 'r_vs_a', 'cold_wins', CAST(cold_wins AS DOUBLE), 'count' FROM r
    UNION ALL SELECT 'pair', 'r_vs_a', 'hot_wins', CAST(hot_wins AS DOUBLE), 'count' FROM r
    """,
)
def result_rows(t: Tables) -> DataFrame:
    """A comparison as a result record, one row per metric, written as JSON and read back."""
    rows = B.tidy(pairwise_ratio(t), "pair", "r_vs_a")
    path = new_folder(t.spark, "results")
    rows.write.json(path)
    return t.spark.read.schema(rows.schema).json(path)


@query(
    "snapshot_runs",
    """
    SELECT l_returnflag AS system, CAST(l_linenumber - 1 AS INTEGER) AS query, min(l_quantity) AS cold,
           least(max(l_quantity), round(avg(l_discount), 4)) AS hot FROM lineitem GROUP BY 1, 2
    """,
)
def snapshot_runs(t: Tables) -> DataFrame:
    """Nested JSON snapshots of systems, written and read back; seven queries of three runs each."""
    runs = t.lineitem.groupBy("l_returnflag", "l_linenumber").agg(
        F.array(F.min("l_quantity").cast("double"), F.max("l_quantity").cast("double"), F.round(F.avg("l_discount"), 4).cast("double")).alias("runs")
    )
    listed = F.sort_array(F.collect_list(F.struct("l_linenumber", "runs")))
    snapshots = runs.groupBy(F.col("l_returnflag").alias("system")).agg(F.transform(listed, lambda r: r["runs"]).alias("result"))
    path = new_folder(t.spark, "snapshots")
    snapshots.write.option("maxRecordsPerFile", 1).json(path)  # a snapshot is a file
    return B.query_runs(read_snapshot(t.spark, path))


@query(
    "weighted_score",
    f"""
    WITH {RATIOS},
    s AS (SELECT sum(CASE WHEN l_returnflag = 'R' THEN l_quantity END)
                 / sum(CASE WHEN l_returnflag = 'A' THEN l_quantity END) AS load,
                 CAST(count(*) FILTER (WHERE l_returnflag = 'R') AS DOUBLE)
                 / count(*) FILTER (WHERE l_returnflag = 'A') AS size FROM lineitem)
    SELECT round(load, 6) AS load_ratio, round(size, 6) AS size_ratio,
           round(exp(0.1 * ln(load) + 0.1 * ln(size) + 0.2 * ln(cold) + 0.6 * ln(hot)), 6) AS combined_ratio
    FROM p, s
    """,
)
def weighted_score(t: Tables) -> DataFrame:
    ratios = B.pairwise_ratio(system_runs(t, "A"), system_runs(t, "R"))
    flag, quantity = F.col("l_returnflag"), F.col("l_quantity")
    sizes = t.lineitem.agg(
        (
            F.sum(F.when(flag == "R", quantity)) / F.sum(F.when(flag == "A", quantity))
        ).alias("load"),
        (F.count_if(flag == "R").cast("double") / F.count_if(flag == "A")).alias("size"),
    )
    row = B.side_by_side(ratios, sizes)
    score = B.weighted_score(
        {"load": F.col("load"), "size": F.col("size"), "cold": F.col("cold_ratio"), "hot": F.col("hot_ratio")}
    )
    return row.select(
        F.round("load", 6).alias("load_ratio"),
        F.round("size", 6).alias("size_ratio"),
        F.round(score, 6).alias("combined_ratio"),
    )


@query(
    "run_summary",
    """
    SELECT l_returnflag AS engine, l_suppkey AS query, count(*) AS runs,
           round(avg(l_quantity), 3) AS mean_seconds FROM lineitem GROUP BY 1, 2
    """,
)
def run_summary(t: Tables) -> DataFrame:
    runs = t.lineitem.select(
        F.col("l_returnflag").alias("engine"), F.col("l_suppkey").alias("query"), "l_quantity"
    )
    return B.run_summary(runs, ["engine", "query"], "l_quantity")


# --- partitioning -----------------------------------------------------------------------------

GROUPED = """
    SELECT l_suppkey AS group_id, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM lineitem GROUP BY 1
"""


def _grouped(t: Tables, partitions: int, mode: str) -> DataFrame:
    rows = t.lineitem.select(
        F.col("l_suppkey").alias("group_id"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("value"),
    )
    return P.grouped_sum(rows, partitions=partitions, mode=mode).withColumn(
        "total", F.col("total").cast("double")
    )


@query("repartition_agg", GROUPED)
def repartition_agg(t: Tables) -> DataFrame:
    return _grouped(t, 16, "repartition")


@query("coalesce_agg", GROUPED)
def coalesce_agg(t: Tables) -> DataFrame:
    return _grouped(t, 4, "coalesce")


@query(
    "key_skew_profile",
    """
    SELECT count(*) AS key_count, CAST(sum(n) AS BIGINT) AS row_count, max(n) AS largest_key_rows,
           round(max(n) / CAST(sum(n) AS DOUBLE), 6) AS largest_share
    FROM (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1)
    """,
)
def key_skew_profile(t: Tables) -> DataFrame:
    return P.key_skew_profile(t.lineitem, "l_partkey")


@query(
    "partition_profile",
    "SELECT l_orderkey % 16 AS part, count(*) AS row_count, true AS alone FROM lineitem GROUP BY 1",
)
def partition_profile(t: Tables) -> DataFrame:
    """Rows per partition of a split into folders, each partition reading one folder."""
    path = new_folder(t.spark, "profile")
    part = (F.col("l_orderkey") % 16).alias("part")
    t.lineitem.select("l_orderkey", part).write.partitionBy("part").parquet(path)
    rows = t.spark.read.schema("l_orderkey BIGINT, part BIGINT").parquet(path).repartition(16, "part")
    seen = rows.groupBy(F.spark_partition_id().alias("task"), "part").agg(F.count(F.lit(1)).alias("n"))
    return seen.groupBy("part").agg(F.sum("n").alias("row_count"), (F.count("task") == 1).alias("alone"))
