"""Every named query against its SQL, and the shape of its plan."""

from __future__ import annotations

import os

import pytest
from oracle import compare, open_tables

import __spark_entry__ as entry_module
from tidemark.operators.relational import sample_by_key

QUERIES = entry_module.queries()
SQL = entry_module.oracle_sql()
# Not expressible in SQL; tests/llm holds these against plain versions of them.
FREE = {name for name in QUERIES if name == "pipeline" or name.startswith("op")}
RATES = ["panel_cpu", "panel_rps", "panel_4xx", "prom_rate", "prom_error_pct", "panel_success_pct"]


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, small, tables, name):
    assert compare(QUERIES[name](spark, small), tables, SQL[name]) is None


def test_only_known_queries_lack_sql():
    assert set(QUERIES) - set(SQL) <= FREE
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", RATES)
def test_rates_on_more_rows(spark, name):
    folder = "/root/testdata/sf0.01"
    if not os.path.isdir(folder):
        pytest.skip(f"{folder} is not there")
    assert compare(QUERIES[name](spark, folder), open_tables(folder), SQL[name]) is None


def test_sample_does_not_depend_on_the_layout(spark, small):
    orders = spark.read.parquet(f"{small}/orders.parquet")
    first = sample_by_key(orders, "o_orderkey", 0.1)
    again = sample_by_key(orders.repartition(7), "o_orderkey", 0.1)
    assert sorted(first.collect()) == sorted(again.collect())
    assert 0 < first.count() < orders.count() * 0.3


def test_entry_has_rows(spark):
    frame = entry_module.entry(spark)
    assert frame.columns == ["date", "document_id", "open_count"]
    assert frame.limit(1).count() == 1
