"""Segmented windows against plain ones, one key holding most rows."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import Window, functions as F

from tidemark.operators import segments as G
from tidemark.plans import QUERIES


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(5)
    data = [
        (rng.choice(["hot", "hot", "hot", "a", None]), rng.randrange(40), i, rng.randrange(100))
        for i in range(700)
    ]
    return spark.createDataFrame(data, "k STRING, day INT, id INT, v INT").cache()


@pytest.mark.parametrize("size", [40, 150, 1000])
@pytest.mark.parametrize("tail", [1, 3])
@pytest.mark.parametrize("reverse", [False, True])
def test_equal_to_plain_windows(rows, size, tail, reverse):
    order = ["day", "id"]
    columns = [F.col(c).desc() if reverse else F.col(c) for c in order]
    by_day = F.col("day").desc() if reverse else F.col("day")
    plain = Window.partitionBy("k").orderBy(*columns)
    expected = rows.select(
        "id",
        F.sum("v").over(plain).alias("total"),
        F.row_number().over(plain).cast("bigint").alias("place"),
        F.rank().over(Window.partitionBy("k").orderBy(by_day)).cast("bigint").alias("rank"),
        F.dense_rank().over(Window.partitionBy("k").orderBy(by_day)).cast("bigint").alias("dense"),
        *(F.lag("v", i).over(plain).alias(f"lag{i}") for i in range(1, tail + 1)),
    )
    split = G.segmented(
        rows, ["k"], order, ["v"], tail, {"total": F.sum("v"), "days": F.count_distinct("day") if tail == 1 else F.size(F.collect_set("day"))}, reverse, size
    )
    window = G.inside(order, reverse)
    found = split.select(
        "id",
        G.running_total("total", F.col("v"), window).alias("total"),
        G.position(window).alias("place"),
        G.rank_position(["day"], reverse).alias("rank"),
        G.dense_rank_position("days", ["day"], reverse).alias("dense"),
        *(G.earlier_value("v", window, i).alias(f"lag{i}") for i in range(1, tail + 1)),
    )
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, expected.collect()))
    assert found.count() == rows.count()


def final_plan(frame):
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_rows_are_read_shuffled_and_sorted_once(spark, rows, tmp_path):
    rows.write.parquet(f"{tmp_path}/rows")
    read = spark.read.parquet(f"{tmp_path}/rows")
    for tail in (1, 2):
        split = G.segmented(read, ["k"], ["day", "id"], ["v"], tail, {"t": F.sum("v")})
        window = G.inside(["day", "id"])
        found = split.select("k", "id", G.running_total("t", F.col("v"), window), G.earlier_value("v", window), G.position(window))
        text = final_plan(found)
        assert text.count("FileScan") == 1, text
        assert "ReusedExchange" in text and "SortMergeJoin" not in text


def test_one_key_with_most_rows_of_one_day(spark):
    """Segments follow the number of rows, not the calendar: none holds much more than was asked."""
    rng = random.Random(8)
    data = [("hot" if i % 10 else f"k{i % 70}", 86_400 * 365 + rng.randrange(86_400), i) for i in range(20_000)]
    frame = spark.createDataFrame(data, "k STRING, at LONG, id INT").withColumn("at", F.timestamp_seconds("at"))
    split = G.segmented(frame, ["k"], ["at", "id"], ["id"], 1, {}, rows=1000)
    sizes = split.groupBy("_segment").count().collect()
    hot = [r["count"] for r in sizes if r["_segment"].k == "hot"]
    assert len(hot) > 10 and max(hot) < 2000 and sum(hot) == 18_000
    placed = split.select("id", G.position(G.inside(["at", "id"])).alias("n"), "k", "at").where("k = 'hot'").orderBy("n").collect()
    assert [r.n for r in placed] == list(range(1, 18_001))
    assert [(r.at, r.id) for r in placed] == sorted((r.at, r.id) for r in placed)


@pytest.mark.parametrize("name", ["scd2", "window_patterns", "sequence_episodes", "edition_history"])
def test_queries_read_their_table_once(spark, small, name):
    text = final_plan(QUERIES[name](spark, small))
    assert text.count("FileScan") == 1 and "ReusedExchange" in text, text
