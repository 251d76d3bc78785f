"""Aggregates written in Python against Spark's own."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidemark.operators import aggregates as A
from tidemark.operators import relational as R


def test_geometric_mean_of_hot_null_and_large_keys(spark):
    big = (1 << 60) + 1
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, big).when(F.col("id") % 3 == 1, F.col("id") % 50).alias("k"),
        F.when(F.col("id") % 7 == 0, "x").alias("s"),
        (F.col("id") % 1000 + 1).cast("double").alias("v"),
    )
    kept = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "97")
    try:
        found = {(r.k, r.s): (r.n, r.geo_mean) for r in A.aggregate(rows.repartition(5), ["k", "s"], ["v"], A.geometric_mean("v"), salts=3).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", kept)
    want = rows.groupBy("k", "s").agg(F.count("v").alias("n"), F.exp(F.avg(F.ln("v"))).alias("m")).collect()
    assert len(found) == len(want) and (big, None) in found and (None, "x") in found
    for r in want:
        assert found[r.k, r.s] == (r.n, pytest.approx(r.m))


def test_no_rows(spark):
    empty = spark.createDataFrame([], "k STRING, v DOUBLE")
    assert A.aggregate(empty, ["k"], ["v"], A.geometric_mean("v")).collect() == []


def test_pivot_fills_what_is_missing(spark):
    rows = spark.createDataFrame([(1, "a", 2), (1, "a", 3), (2, "b", 4), (3, "z", 1), (4, None, 1)], "d INT, k STRING, n LONG")
    found = R.pivot_filled(rows, ["d"], "k", ["a", "b"], "n")
    assert sorted(map(tuple, found.collect())) == [(1, 5, 0), (2, 0, 4), (3, 0, 0), (4, 0, 0)]
