"""Keyed tables: merge rules, repeated keys, change data and history."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidemark.operators import keyed as K

SCHEMA = "id INT, amount INT, at INT"


def rows(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def listed(df):
    return sorted(tuple(r) for r in df.collect())


def test_merge_update_ignores_unmatched_and_takes_nulls(spark):
    target = rows(spark, (1, 10, 0), (2, 20, 0))
    source = rows(spark, (2, None, 5), (3, 30, 5))
    assert [tuple(r) for r in K.merge_update(target, source, ["id"], ["amount"]).orderBy("id").collect()] == [
        (1, 10, 0),
        (2, None, 0),
    ]


def test_merge_upsert_inserts(spark):
    target = rows(spark, (1, 10, 0), (2, 20, 0))
    source = rows(spark, (2, 25, 5), (3, 30, 5))
    assert listed(K.merge_upsert(target, source, ["id"], ["amount"])) == [
        (1, 10, 0),
        (2, 25, 0),
        (3, 30, 5),
    ]


def test_upsert_keeps_the_newest(spark):
    target = rows(spark, (1, 10, 5), (2, 20, 5), (3, 30, 5))
    source = rows(spark, (1, 11, 9), (1, 12, 7), (2, 21, 1), (3, 31, 5), (4, 41, 0))
    assert listed(K.upsert_latest(target, source, ["id"], ["at"])) == [
        (1, 11, 9),
        (2, 20, 5),
        (3, 31, 5),
        (4, 41, 0),
    ]


def test_change_data(spark):
    target = rows(spark, (1, 10, 0), (2, 20, 0), (3, 30, 0))
    changes = spark.createDataFrame(
        [(1, 11, 1, "update", 1), (1, None, 1, "update", 2), (2, 0, 1, "delete", 3),
         (4, 40, 1, "insert", 4), (5, 50, 1, "insert", 5), (5, 50, 1, "delete", 6)],
        SCHEMA + ", op STRING, seq INT",
    )
    found = K.cdc_apply(target, changes, ["id"], ["seq"]).orderBy("id").collect()
    assert [tuple(r) for r in found] == [(1, None, 1), (3, 30, 0), (4, 40, 1)]


def test_history(spark):
    versions = rows(spark, (1, 5, 100), (1, 6, 200), (1, 7, 900), (2, 5, 50))
    found = K.scd2(versions, ["id"], "at", ["at"])
    assert sorted((r.id, r.at, r.valid_to, r.is_current) for r in found.collect() if r.valid_to) == [
        (1, 100, 200, False),
        (1, 200, 900, False),
    ]
    assert sorted((r.id, r.at) for r in found.collect() if r.is_current) == [(1, 900), (2, 50)]


@pytest.mark.parametrize("merge", [K.merge_update, K.merge_upsert])
def test_two_matches_are_an_error(spark, merge):
    target, twice = rows(spark, (1, 10, 0)), rows(spark, (1, 11, 1), (1, 12, 2))
    with pytest.raises(Exception, match=K.REPEATED):
        merge(target, twice, ["id"], ["amount"]).collect()
    # repeated keys that match nothing are no conflict
    assert merge(target, rows(spark, (5, 1, 1), (5, 2, 1)), ["id"], ["amount"]).filter("id = 1").count() == 1


def test_upsert_does_not_sort_the_target(spark):
    found = K.upsert_latest(rows(spark, (1, 1, 1)), rows(spark, (1, 2, 2)), ["id"], ["at"])
    assert "SortAggregate" not in found._jdf.queryExecution().executedPlan().toString()


def final_plan(frame):
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def in_buckets(spark, folder, rows, buckets):
    from tidemark.sources.bucketed import read_bucketed, write_bucketed

    write_bucketed(rows, folder, ["id"], buckets)
    return read_bucketed(spark, folder, rows.schema, ["id"], buckets)


@pytest.mark.parametrize("buckets", [3, 16])
def test_merges_leave_a_bucketed_target_where_it_is(spark, tmp_path, buckets):
    from tidemark.sources.bucketed import read_bucketed, write_bucketed

    rows = spark.range(5000).select("id", (F.col("id") * 2).alias("v"), F.lit(1).alias("at"))
    changes = spark.range(4990, 5020).select("id", F.lit(7).cast("long").alias("v"), F.lit(2).alias("at"))
    target = in_buckets(spark, f"{tmp_path}/t", rows, buckets)
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = {
            "upsert": K.merge_upsert(target, changes, ["id"], ["v", "at"], buckets),
            "update": K.merge_update(target, changes, ["id"], ["v", "at"], buckets),
            "latest": K.upsert_latest(target, changes, ["id"], ["at"], buckets),
        }
        for name, frame in merged.items():
            text = final_plan(frame)
            assert text.count("Exchange hashpartitioning") == 1 and f", {buckets})" in text, text
            assert f"SelectedBucketsCount: {buckets} out of {buckets}" in text
            got = {r.id: (r.v, r.at) for r in frame.collect()}
            want = {i: (2 * i, 1) for i in range(5000)} | {i: (7, 2) for i in range(4990, 5000 if name == "update" else 5020)}
            assert got == want
        write_bucketed(merged["latest"], f"{tmp_path}/n", ["id"], buckets, dealt=True)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    after = read_bucketed(spark, f"{tmp_path}/n", rows.schema, ["id"], buckets)
    assert len(after.inputFiles()) == buckets
    assert "Exchange" not in final_plan(after.groupBy("id").agg(F.sum("v")))
