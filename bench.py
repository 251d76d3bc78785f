"""Time the headline queries and the published workloads; print one JSON line.

Each entry runs once to warm up and three times measured; the median counts. Queries are planned
anew each time and their full result is forced by the ``noop`` sink. ``published_*`` entries use
join, 3M skewed rows, 1M grouped rows, 5M key/value rows and a keyed table of 1M rows; the
``_full`` ones force the whole result.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators import keyed as K
from tidemark.operators import relational as R
from tidemark.operators.partitioning import grouped_sum
from tidemark.plans import QUERIES
from tidemark.session import get_session, new_folder
from tidemark.sources import generators as G
from tidemark.sources.writers import write_table

HEADLINE = [
    "q1_daily_agg",
    "q2_filter_region",
    "q3_join_top10",
    "q4_distinct_segment",
    "broadcast_join",
    "cte_self_join",
    "orders_daily",
    "card_doc_hits",
    "doc_opens_by_day",
    "doc_opens_wide",
    "multi_agg",
    "topn_per_group",
    "nested_explode",
    "salted_count",
    "window_patterns",
    "merge_update",
    "upsert_latest",
    "scd2",
    "panel_cpu",
    "panel_p95_service",
    "prom_error_pct",
    "current_state",
    "inverted_index",
    "sequence_episodes",
    "required_missing",
    "dq_profile",
    "pairwise_ratio",
    "filter_date_count",
]
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def force(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action, name: str) -> float:
    action()
    seconds = []
    for _ in range(RUNS):
        start = time.perf_counter()
        action()
        seconds.append(time.perf_counter() - start)
    median = round(statistics.median(seconds), 3)
    print(f"{name} {median}", file=sys.stderr, flush=True)
    return median


def published(spark: SparkSession) -> dict:
    """The published workloads at their published sizes."""
    orders = G.derived(spark.range(2_000_000), G.ORDER_COLUMNS)
    countries = G.country_names(G.derived(spark.range(200), G.ORDER_COLUMNS))
    skewed = G.derived(spark.range(3_000_000), G.SKEWED_COLUMNS)
    grouped = G.grouped_values(spark.range(1_000_000))
    pairs = G.key_value(spark.range(5_000_000))
    nested = G.nested_values(spark.range(5_000_000))
    big = spark.range(5_000_000).select((F.col("id") % 100_000).alias("key"), F.col("id").alias("value"))
    small = spark.range(1000).select(F.col("id").alias("key"), (F.col("id") % 10).alias("s"))
    total = F.count(F.lit(1)).alias("n")
    return {
        "join_shuffled": lambda: R.join_shuffle(orders, countries, "country_id").agg(total).collect(),
        "join_unhinted": lambda: orders.join(countries, "country_id").agg(total).collect(),
        "join_broadcast": lambda: R.join_broadcast(orders, countries, "country_id").agg(total).collect(),
        "skewed_plain": lambda: R.group_count(skewed, ["key"]).count(),
        "skewed_salted": lambda: R.salted_agg(
            skewed, "key", "row_id", 10, {"n": ("count", "*")}
        ).count(),
        "grouped_sum": lambda: grouped_sum(grouped).count(),
        "grouped_sum_repartition_8": lambda: grouped_sum(grouped, partitions=8).count(),
        "grouped_sum_coalesce_4": lambda: grouped_sum(grouped, partitions=4, mode="coalesce").count(),
        "multi_agg": lambda: R.multi_agg(pairs, ["key"], "value").count(),
        "topn_per_group": lambda: R.top_n_per_group(pairs, ["key"], "value", [], 4).count(),
        "nested_explode": lambda: R.flatten_nested(nested, "values", ["key", "meta.subid"]).count(),
        "hinted_sql_join": lambda: R.group_count(big.join(F.broadcast(small), "key"), ["key"]).count(),
        "multi_agg_full": lambda: force(R.multi_agg(pairs, ["key"], "value")),
        "topn_per_group_full": lambda: force(R.top_n_per_group(pairs, ["key"], "value", [], 4)),
        "nested_explode_full": lambda: force(
            R.flatten_nested(nested, "values", ["key", "meta.subid"])
        ),
    }


def published_table(spark: SparkSession) -> dict[str, float]:
    """Write, scan and merge a keyed table of one million rows."""
    rows = G.keyed_rows(spark.range(1_000_000)).cache()
    rows.count()
    path = new_folder(spark, "bench")
    found = {"table_write": timed(lambda: write_table(rows, path), "table_write")}
    found["table_scan_sum"] = timed(
        lambda: spark.read.parquet(path).agg({"amount": "sum"}).collect(), "table_scan_sum"
    )
    for tenths in (1, 2, 5):

        def merge(tenths: int = tenths) -> None:
            now = spark.read.parquet(path)
            changes = now.filter(F.col("id") % 10 < tenths).select(
                "id", (F.col("amount") + 100).alias("amount"), F.current_timestamp().alias("updated_at")
            )
            write_table(K.merge_update(now, changes, ["id"], ["amount", "updated_at"]), new_folder(spark, "bench"))

        found[f"table_update_{tenths}0"] = timed(merge, f"table_update_{tenths}0")
    rows.unpersist()
    return found


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    only = os.environ.get("BENCH_ONLY", "").split(",") if os.environ.get("BENCH_ONLY") else None
    seconds = {}
    for name in HEADLINE:
        if only is None or name in only:
            seconds[name] = timed(lambda: force(QUERIES[name](spark, folder)), name)
    if only is None or "published" in only:
        for name, action in published(spark).items():
            seconds[f"published_{name}"] = timed(action, name)
        for name, value in published_table(spark).items():
            seconds[f"published_{name}"] = value
    print(
        json.dumps(
            {
                "metric": "sum of median query seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")),
                "cpus": int(cpus),
                "runs": RUNS,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
