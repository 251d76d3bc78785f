"""What the plans have to show: pushed filters, early limits, guarded broadcasts, no Python."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from tidemark.operators import relational as R
from tidemark.operators import sessions as S
from tidemark.plans import QUERIES
from tidemark.session import new_folder
from tidemark.sources.writers import write_sorted

# Queries that run jobs while they are planned (streams, writes) are left to the other tests.
PLANNED = sorted(
    n
    for n in QUERIES
    if not n.startswith("stream_") and "roundtrip" not in n and "write" not in n
)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


#: Aggregates that a user writes in Python: their feature is the Python, on batches.
WRITTEN_IN_PYTHON = {"custom_geo_mean"}


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", PLANNED)
def test_no_python_and_no_cartesian_product(spark, small, name):
    text = plan(entry_module.queries()[name](spark, small))
    allowed = {"MapInArrow"} if name in WRITTEN_IN_PYTHON else set()
    for word in {"EvalPython", "InPandas", "MapInArrow", "CartesianProduct", "BroadcastNestedLoop"} - allowed:
        assert word not in text, f"{word} in\n{text}"


def test_filter_and_columns_reach_the_scan(spark, small):
    text = plan(entry_module.queries()["q4_distinct_segment"](spark, small))
    assert "GreaterThanOrEqual(l_discount,0.05)" in text
    scan = [line for line in text.splitlines() if "lineitem.parquet" in line]
    assert scan and all("l_comment" not in line and "l_tax" not in line for line in scan)


def test_rank_filter_limits_before_the_shuffle(spark, small):
    text = plan(entry_module.queries()["topn_per_group"](spark, small))
    assert text.count("WindowGroupLimit") == 2


def test_top_k_is_not_a_full_sort(spark, small):
    text = plan(entry_module.queries()["q3_join_top10"](spark, small))
    assert "TakeOrderedAndProject" in text


def test_broadcast_only_when_small(spark):
    fact = spark.range(1000).select((F.col("id") % 50).alias("k"))
    dim = spark.range(50).select(F.col("id").alias("k"), F.lit(1).alias("x"))
    assert "BroadcastHashJoin" in plan(R.join_broadcast(fact, dim, "k"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100")
    try:
        assert "SortMergeJoin" in plan(R.join_broadcast(fact, dim, "k"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan(R.join_shuffle(fact, dim, "k"))


def test_hint_names_the_alias(spark, small):
    found = entry_module.queries()["broadcast_join"](spark, small)
    assert "strategy=broadcast" in found._jdf.queryExecution().analyzed().toString()


def test_parsing_needs_no_shuffle(spark):
    files = spark.createDataFrame([("f", "DOC_OPEN 1 A")], "source_file STRING, content STRING")
    for frame in S.parse_sessions(files):
        assert "Exchange" not in plan(frame) and "Window" not in plan(frame)


def test_unused_nested_fields_are_not_read(spark, small):
    text = optimized(entry_module.queries()["nested_explode"](spark, small))
    assert "AS flag" not in text


def test_sorted_files_can_be_skipped(spark):
    path = new_folder(spark, "sorted")
    write_sorted(spark.range(0, 1000, 1, 4).toDF("n"), path, ["n"])
    text = plan(spark.read.parquet(path).filter(F.col("n") < 10))
    assert "PushedFilters: [IsNotNull(n), LessThan(n,10)]" in text


def test_salting_keeps_results(spark):
    rows = spark.range(5000).select(
        F.when(F.col("id") % 10 < 9, "hot").otherwise("cold").alias("k"), "id", (F.col("id") % 7).alias("v")
    )
    aggs = {"n": ("count", "*"), "s": ("sum", "v"), "lo": ("min", "id"), "hi": ("max", "id")}
    plain = rows.groupBy("k").agg(
        F.count(F.lit(1)).alias("n"), F.sum("v").alias("s"), F.min("id").alias("lo"), F.max("id").alias("hi")
    )
    assert sorted(R.salted_agg(rows, "k", "id", 10, aggs).collect()) == sorted(plain.collect())
