"""Readers, writers and generators."""

from __future__ import annotations

import io
import json
import tarfile
import zipfile

import pytest
from pyspark.sql import functions as F

from tidemark.functions.dates import parse_date_token
from tidemark.operators import benchmarks as B
from tidemark.operators import quality as Q
from tidemark.operators import relational as R
from tidemark.operators.partitioning import stage_metrics
from tidemark.session import new_folder, stored
from tidemark.sources import generators as G
from tidemark.sources import readers, writers

ORDERS = """order_id,created_at,product,amount
1,2026-05-01T09:00:00Z,coffee,120.50
2,2026-05-01T10:15:00Z,tea,80.00
3,2026-05-01T11:45:00Z,coffee,120.50
4,2026-05-02T08:30:00Z,cake,320.00
5,2026-05-02T12:10:00Z,tea,80.00
6,2026-05-02T13:25:00Z,cake,320.00
"""


@pytest.mark.parametrize("infer", [False, True])
def test_orders_mart_from_csv(spark, tmp_path, infer):
    (tmp_path / "orders.csv").write_text(ORDERS)
    schema = None if infer else readers.ORDERS_SCHEMA
    orders = readers.read_csv(spark, str(tmp_path), schema, infer)
    daily = R.orders_daily(orders).orderBy("order_date", "product")
    assert [(str(r.order_date), *r[1:]) for r in daily.collect()] == [
        ("2026-05-01", "coffee", 2, 241.0),
        ("2026-05-01", "tea", 1, 80.0),
        ("2026-05-02", "cake", 2, 640.0),
        ("2026-05-02", "tea", 1, 80.0),
    ]
    kpi = R.kpi_daily(orders).orderBy("order_date").collect()
    assert [tuple(r)[1:] for r in kpi] == [(321.0, 3, "coffee"), (720.0, 3, "cake")]


def test_session_files_one_row_each(spark, tmp_path):
    (tmp_path / "a").write_text("DOC_OPEN 1 Документ\n\n", encoding="utf-8")
    (tmp_path / "b").write_text("")
    files = readers.read_session_files(spark, str(tmp_path)).collect()
    assert sorted((r.source_file.rsplit("/", 1)[1], r.content) for r in files if r.content) == [
        ("a", "DOC_OPEN 1 Документ\n\n")
    ]


def test_listings_to_verdicts(spark):
    paths = spark.createDataFrame(
        [("bad", "README.md"), ("bad", "go.mod"), *[("good", p) for p in ("README.md", "cmd", "cmd/app", "cmd/app/main.go", "go.mod")]],
        "project STRING, path STRING",
    )
    verdicts = Q.required_missing(paths, "README.md, go.mod,,cmd")
    assert sorted(tuple(r)[:3] for r in verdicts.collect()) == [("bad", "FAILED", "cmd"), ("good", "OK", "-")]
    assert [r.line for r in Q.tree_lines(paths.filter("project = 'good'")).collect()] == [
        "./README.md", "./cmd", "./cmd/app", "./cmd/app/main.go", "./go.mod",
    ]


def test_formats_without_their_module_are_named(spark):
    for call in (
        lambda: readers.read_events(spark, "/nowhere", "avro"),
        lambda: writers.write_events(spark.range(1).toDF("n"), new_folder(spark, "x"), "avro"),
        lambda: readers.read_topic(spark, "nowhere:1", ["a"]),
    ):
        try:
            call()
        except readers.ModuleUnavailable as error:
            assert "classpath" in str(error)
        else:
            pytest.skip("the module is installed")


@pytest.mark.parametrize(
    "fmt, codec, ending",
    [("parquet", "SNAPPY", ".snappy.parquet"), ("parquet", "GZIP", ".gz.parquet"),
     ("parquet", "nonsense", ".parquet"), ("json", "GZIP", ".json.gz"), ("json", "NONE", ".json")],
)
def test_codecs(spark, fmt, codec, ending):
    events = G.click_events(spark.range(500))
    path = new_folder(spark, "codec")
    writers.write_events(events, path, fmt, codec)
    back = readers.read_events(spark, path, fmt)
    assert sorted(back.collect()) == sorted(events.collect())
    names = {r[0].rsplit("/", 1)[1] for r in back.select(F.input_file_name()).distinct().collect()}
    assert all(n.endswith(ending) for n in names)
    if codec == "nonsense":
        assert not any(".snappy" in n or ".gz" in n for n in names)


def test_single_file_is_opt_in(spark):
    rows = spark.range(0, 100, 1, 4).toDF("n")
    many, one = new_folder(spark, "many"), new_folder(spark, "one")
    writers.write_csv(rows, many)
    writers.write_csv(rows, one, single_file=True)

    def files(path):
        return readers.read_csv(spark, path).select(F.input_file_name()).distinct().count()

    assert (files(many), files(one)) == (4, 1)


def test_generators_do_not_depend_on_partitions(spark):
    a = G.click_events(spark.range(300)).collect()
    spark.conf.set("spark.sql.leafNodeDefaultParallelism", "3")
    try:
        assert sorted(G.click_events(spark.range(300)).collect()) == sorted(a)
    finally:
        spark.conf.unset("spark.sql.leafNodeDefaultParallelism")
    assert sorted(G.click_events(spark.range(300), seed=7).collect()) != sorted(a)


def test_star_schema_totals(spark):
    star = G.star_schema(spark.range(1, 100_001))
    facts = star["fact_sales"]
    found = facts.agg(
        F.sum("amount").cast("double"), F.count_distinct("sale_date"),
        F.count_distinct("customer_id"), F.count_distinct("product_id"),
    ).first()
    assert tuple(found) == (8_217_320.0, 84, 10_000, 1_000)
    assert facts.filter("discount >= 0.05").count() == 50_000
    summer = facts.filter("sale_date BETWEEN DATE'2024-06-01' AND DATE'2024-08-31'")
    assert summer.count() == 25_000
    assert R.buyers_by_segment(facts.join(star["dim_customers"], "customer_id")).agg(F.sum("buyers")).first()[0] == 5_000


def test_date_tokens(spark):
    tokens = {
        "23.06.2020_03:55:06": "2020-06-23",
        "Fri,_26_Jun_2020_16:24:28_+0300": "2020-06-26",
        "Fri,_6_Jun_2020_23:59:59_-1100": "2020-06-06",
        "Fri,_26_Foo_2020_16:24:28_+0300": None,
        "99.99.2020_00:00:00": None,
        "23.06.2020": None,
        "": None,
    }
    frame = spark.createDataFrame([(t,) for t in tokens], "t STRING")
    found = frame.select("t", parse_date_token(F.col("t")).cast("string").alias("d")).collect()
    assert {r.t: r.d for r in found} == tokens


def test_snapshot_comparison(spark, tmp_path):
    for name, load, runs in (("a", 100, [[2, 1, 4], [1, 1, 1]]), ("b", 200, [[4, 2, 1], [1, 4, 9]])):
        (tmp_path / f"{name}.json").write_text(
            json.dumps({"system": name, "date": "2026-01-01", "machine": "m", "load_time": load,
                        "data_size": load * 10, "result": runs}, indent=1)
        )
    sides = readers.read_snapshot(spark, str(tmp_path))
    a, b = sides.filter("system = 'a'"), sides.filter("system = 'b'")
    found = B.compare_snapshots(a, b).first().asDict()
    assert found["load_ratio"] == found["size_ratio"] == 2.0
    assert found["cold_ratio"] == pytest.approx(2**0.5, abs=1e-6)
    assert found["hot_ratio"] == pytest.approx(2.0)
    assert found["combined_ratio"] == pytest.approx(2 ** (0.1 + 0.1 + 0.1 + 0.6), abs=1e-6)
    assert (found["queries"], found["cold_wins"], found["hot_wins"]) == (2, 0, 0)
    tidy = B.tidy(B.compare_snapshots(a, b), "pair", "b_vs_a")
    assert {r.metric: r.unit for r in tidy.collect()}["hot_wins"] == "count"
    longer = B.query_runs(a).unionByName(
        spark.createDataFrame([("a", 2, 1.0, 1.0)], "system STRING, query INT, cold DOUBLE, hot DOUBLE")
    )
    with pytest.raises(Exception, match="different queries"):
        B.query_ratios(longer, B.query_runs(b)).collect()


def test_stage_metrics_per_job_group(spark, event_log):
    spark.sparkContext.setJobGroup("tidemark-probe", "two stages")
    try:
        spark.range(0, 10_000, 1, 4).groupBy((F.col("id") % 7).alias("k")).count().collect()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    spark.range(3).count()
    found = {r.job_group: r for r in stage_metrics(spark, str(event_log)).collect()}
    probe = found["tidemark-probe"]
    assert probe.tasks >= 5
    assert probe.shuffle_write_bytes > 0 and probe.shuffle_read_bytes > 0
    assert probe.disk_bytes_spilled == 0


def test_stored_cuts_the_lineage(spark):
    kept = stored(spark.range(10).withColumn("x", F.col("id") * 2))
    assert kept.count() == 10
    assert "Range" not in kept._jdf.queryExecution().optimizedPlan().toString()


def test_observed_counts(spark):
    watched, seen = Q.observed(
        spark.range(10).toDF("n"), "watch", rows=F.count(F.lit(1)), odd=F.count_if(F.col("n") % 2 == 1)
    )
    watched.write.format("noop").mode("overwrite").save()
    assert seen.get == {"rows": 10, "odd": 5}


def test_clustered_files_skip_on_either_column(spark, tmp_path):
    import glob

    import pyarrow.parquet as pq
    from pyspark.sql import functions as F

    from tidemark.sources.writers import write_clustered

    rows = spark.range(40_000).select("id", F.pmod(F.xxhash64("id"), F.lit(100_000)).alias("a"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(5_000)).cast("double").alias("b"))
    rows = rows.unionByName(spark.createDataFrame([(-1, None, None)], rows.schema))
    path = f"{tmp_path}/clustered"
    write_clustered(rows, path, ["a", "b"], files=256)
    groups = []
    for name in glob.glob(f"{path}/part-*"):
        file = pq.ParquetFile(name).metadata
        for i in range(file.num_row_groups):
            groups.append({file.row_group(i).column(j).path_in_schema: file.row_group(i).column(j).statistics for j in range(3)})
    for column, low, high in (("a", 40_000, 40_900), ("b", 1000.0, 1045.0)):
        hit = sum(g[column].has_min_max and g[column].min <= high and g[column].max >= low for g in groups)
        assert 0 < hit < 0.2 * len(groups)
        kept = spark.read.parquet(path).filter(F.col(column).between(low, high))
        assert sorted(kept.collect()) == sorted(rows.filter(F.col(column).between(low, high)).collect())
    assert spark.read.parquet(path).count() == 40_001
