"""Counter, gauge and histogram rules on samples small enough to work out by hand."""

from __future__ import annotations

import math
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import timeseries as M
from tidemark.sources.readers import parse_metric_lines

START = datetime(2024, 1, 1)
AT = START + timedelta(seconds=300)


def samples(spark, *series):
    rows = [
        ("m", labels, START + timedelta(seconds=s), float(v))
        for labels, points in series
        for s, v in points
    ]
    return spark.createDataFrame(
        rows, "metric STRING, labels MAP<STRING, STRING>, ts TIMESTAMP, value DOUBLE"
    )


def values(vector):
    return sorted((tuple(sorted(r.labels.items())), r.value) for r in vector.collect())


def test_increase_counts_on_after_a_reset(spark):
    vector = samples(spark, ({"a": "1"}, [(60, 10), (120, 15), (180, 4), (240, 6)]))
    assert values(M.increase(vector, 300, at=AT)) == [((("a", "1"),), 5 + 4 + 2)]
    assert values(M.rate(vector, 300, at=AT)) == [((("a", "1"),), 11 / 300)]


def test_range_is_open_on_the_left(spark):
    vector = samples(spark, ({}, [(0, 1), (100, 5), (300, 9)]))
    assert values(M.increase(vector, 300, at=AT)) == [((), 4.0)]


def test_one_sample_gives_no_row(spark):
    vector = samples(spark, ({}, [(100, 5)]))
    assert M.increase(vector, 300, at=AT).count() == 0
    assert M.delta(vector, 300, at=AT).count() == 0


def test_extrapolation_reaches_the_range_ends(spark):
    vector = samples(spark, ({}, [(60, 100), (120, 110), (180, 120), (240, 130)]))
    # 180 s are covered, 60 s are missing on each side, no more than 1.1 pauses
    assert values(M.increase(vector, 300, at=AT, extrapolate=True)) == [((), pytest.approx(50.0))]
    far = samples(spark, ({}, [(120, 100), (140, 110)]))
    # both gaps are longer than 1.1 pauses, so half a pause is added on each side
    assert values(M.increase(far, 300, at=AT, extrapolate=True)) == [((), pytest.approx(20.0))]
    low = samples(spark, ({}, [(60, 1), (120, 11), (180, 21), (240, 31)]))
    # a counter starts at zero, 6 s before its first sample
    assert values(M.increase(low, 300, at=AT, extrapolate=True)) == [
        ((), pytest.approx(30 * (180 + 6 + 60) / 180))
    ]
    assert values(M.delta(vector, 300, at=AT, extrapolate=True)) == [((), pytest.approx(50.0))]


def test_step_grid_equals_single_moments(spark):
    vector = samples(
        spark,
        ({"a": "1"}, [(s, s // 7) for s in range(0, 900, 20)]),
        ({"a": "2"}, [(s, s % 130) for s in range(5, 900, 45)]),
    )
    grid = M.increase(vector, 300, step=100)
    for second in range(0, 1300, 100):
        at = START + timedelta(seconds=second)
        one = values(M.increase(vector, 300, at=at))
        assert values(grid.filter(F.col("at") == F.lit(at))) == one


def test_instant_takes_the_latest_in_the_lookback(spark):
    vector = samples(spark, ({"a": "1"}, [(10, 1), (200, 2)]), ({"a": "2"}, [(0, 7)]))
    assert values(M.instant(vector, at=AT)) == [((("a", "1"),), 2.0)]


def test_matchers(spark):
    vector = samples(
        spark, ({"s": "200", "c": ""}, [(1, 1)]), ({"s": "404"}, [(1, 2)]), ({"c": "x"}, [(1, 3)])
    )

    def found(**conditions):
        return sorted(r.value for r in M.matching(vector, "m", **conditions).collect())

    assert found(s="=~4..") == [2.0]
    assert found(s="=~4") == []
    assert found(s="!~[24]..") == [3.0]
    assert found(c="!=") == [3.0]
    assert found(c="=") == [1.0, 2.0]
    assert M.matching(vector, "other").count() == 0


def test_sums_and_shares(spark):
    vector = samples(
        spark,
        ({"s": "a", "c": "500"}, [(1, 2)]),
        ({"s": "a", "c": "200"}, [(1, 6)]),
        ({"s": "b", "c": "200"}, [(1, 5)]),
        ({"s": "z", "c": "500"}, [(1, 0)]),
    ).withColumn("at", F.lit(AT).cast("timestamp"))
    left = {tuple(map(tuple, r.series)): r.value for r in M.sum_without(vector, ["c"]).collect()}
    assert left == {(("s", "a"),): 8.0, (("s", "b"),): 5.0, (("s", "z"),): 0.0}
    failed = M.sum_by(M.matching(vector, c="=~5.."), ["s"])
    for fill, services in ((False, ["a", "z"]), (True, ["a", "b", "z"])):
        for shares in (
            M.ratio(failed, M.sum_by(vector, ["s"]), ["s"], fill),
            M.share(vector, ["s"], fill, c="=~5.."),
        ):
            by_service = {r.s: r.value for r in shares.collect()}
            assert sorted(by_service) == services
            assert by_service["a"] == 25.0 and math.isnan(by_service["z"])
            assert by_service.get("b", 0.0) == 0.0


def quantile(spark, q, buckets):
    rows = [(AT, le, float(v)) for le, v in buckets]
    frame = spark.createDataFrame(rows, "at TIMESTAMP, le STRING, value DOUBLE")
    return M.histogram_quantile(q, frame, []).first().value


def test_quantiles(spark):
    steady = [("1", 10), ("2", 20), ("+Inf", 20)]
    assert quantile(spark, 0.5, steady) == pytest.approx(1.0)
    assert quantile(spark, 0.25, steady) == pytest.approx(0.5)
    assert quantile(spark, 0.75, steady) == pytest.approx(1.5)
    assert quantile(spark, 0.99, [("1", 10), ("2", 20), ("+Inf", 40)]) == 2.0
    assert quantile(spark, 0.5, [("-1", 10), ("2", 10), ("+Inf", 10)]) == -1.0
    # a bucket below its predecessor is lifted
    assert quantile(spark, 0.75, [("1", 10), ("2", 8), ("3", 20), ("+Inf", 20)]) == pytest.approx(2.5)
    assert math.isnan(quantile(spark, 0.5, [("1", 10), ("2", 20)]))
    assert math.isnan(quantile(spark, 0.5, [("1", 0), ("+Inf", 0)]))


def test_alert_needs_every_step(spark):
    def firing(points):
        rows = [(START + timedelta(seconds=s), "x", float(v)) for s, v in points]
        frame = spark.createDataFrame(rows, "at TIMESTAMP, s STRING, value DOUBLE")
        kept = M.held(frame, ["s"], F.col("value") > 5, 60, 120)
        return sorted((r.at - START).total_seconds() for r in kept.collect())

    assert firing([(0, 9), (60, 9), (120, 9), (180, 9)]) == [120, 180]
    assert firing([(0, 9), (60, 1), (120, 9), (180, 9)]) == []
    assert firing([(0, 9), (120, 9), (180, 9)]) == []


def test_metric_lines(spark):
    lines = [
        "# HELP a text", "", 'runs_total{job="x", status="ok"} 3', "up 1", "gauge{} +Inf 1700000000",
        'odd{q="a\\"b\\\\c\\n"} -2.5e3', "not a line at all",
    ]
    found = parse_metric_lines(spark.createDataFrame([(x,) for x in lines], "value STRING"))
    assert [(r.metric, r.labels, r.value) for r in found.collect()] == [
        ("runs_total", {"job": "x", "status": "ok"}, 3.0),
        ("up", {}, 1.0),
        ("gauge", {}, math.inf),
        ("odd", {"q": 'a"b\\c\n'}, -2500.0),
    ]


def test_ranges_from_buckets_equal_single_ranges(spark):
    """Every moment of a stepped evaluation equals the range taken for that moment alone."""
    import random

    rng = random.Random(7)
    points = sorted({rng.randrange(0, 4000) for _ in range(150)} | {600, 900, 1200})
    series = [({"a": "1"}, [(s, rng.randrange(0, 50)) for s in points]), ({"a": "2"}, [(1000, 5), (3700, 2)])]
    vector = samples(spark, *series)
    for seconds, step in ((300, 300), (900, 400), (700, 300), (100, 600)):
        for function in (M.increase, M.delta, M.instant):
            name = "lookback" if function is M.instant else "seconds"
            found = {}
            for r in function(vector, step=step, **{name: seconds}).collect():
                found[tuple(r.labels.items()), int((r.at - START).total_seconds())] = r.value
            want = {}
            for t in range(0, 5400, step):
                for r in function(vector, at=START + timedelta(seconds=t), **{name: seconds}).collect() if t % 1200 == 0 else ():
                    want[tuple(r.labels.items()), t] = r.value
            assert {k: v for k, v in found.items() if k[1] % 1200 == 0} == want


def test_samples_are_not_copied_before_a_shuffle(spark):
    vector = samples(spark, ({"a": "1"}, [(60, 10), (120, 15)]))
    plan = M.increase(vector, 7 * 86_400, step=60)._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    generated = [i for i, line in enumerate(lines) if "Generate" in line]
    exchanged = [i for i, line in enumerate(lines) if "Exchange" in line]
    assert generated and max(generated) < min(exchanged)


def test_long_fractional_counters_are_added_exactly(spark):
    """Ranges from totals equal single ranges and the direct sum to the last digit, however long the series."""
    from decimal import Decimal

    count, low, high = 300_000, 0.1, 1e12 / 3
    rows = spark.range(count).select(
        F.lit("m").alias("metric"),
        F.expr("map('a', '1')").alias("labels"),
        F.timestamp_seconds(F.lit(START.timestamp()) + F.col("id")).alias("ts"),
        F.when(F.col("id") % 2 == 0, low).otherwise(high).alias("value"),
    )
    at = START + timedelta(seconds=count - 1)
    moment = F.lit(at).cast("timestamp")
    stepped = M.increase(rows, 300, step=1).where(F.col("at") == moment).collect()
    single = M.increase(rows, 300, at=at).collect()
    # 300 samples that begin with an even one: 150 rises, and 149 resets that count from zero
    direct = 150 * (Decimal(repr(high)) - Decimal(repr(low))) + 149 * Decimal(repr(low))
    assert [r.value for r in stepped] == [r.value for r in single] == [float(direct)]


def test_no_number_in_a_range_gives_none(spark):
    nan = float("nan")
    vector = samples(spark, ({"a": "1"}, [(10, 1), (60, nan), (120, 5), (400, 6), (500, 8), (560, 9)]), ({"a": "2"}, [(10, 0.1), (20, 0.3)]))
    for found in (M.increase(vector, 300, at=AT), M.increase(vector, 300, step=300).where(F.col("at") == F.lit(AT).cast("timestamp"))):
        got = dict(values(found))
        assert math.isnan(got[(("a", "1"),)]) and got[(("a", "2"),)] == 0.2
    later = M.increase(vector, 300, step=300).where(F.col("at") == F.lit(START + timedelta(seconds=600)).cast("timestamp"))
    assert values(later) == [((("a", "1"),), 3.0)]


def test_distinct_values_of_a_frequent_label_spread_before_they_are_counted(spark):
    """The values of a label are dealt by (label, value); the last step sees counts, not values."""
    rows = spark.range(60_000).select(
        F.expr("map('hot', string(id), 'cold', string(id % 3))").alias("labels"), F.lit("m").alias("metric")
    )
    found = M.label_cardinality(rows)
    assert sorted(map(tuple, found.collect())) == [("cold", 3), ("hot", 60_000)]
    text = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    deals = [line for line in text.splitlines() if "Exchange hashpartitioning(" in line]
    assert len(deals) == 2 and "hashpartitioning(label#" in deals[0] and ", text#" in deals[1]
    halves = M.label_sketches(rows.filter("labels['cold'] = '0'")).unionByName(M.label_sketches(rows.filter("labels['cold'] <> '0'")))
    estimate = {r.label: r["values"] for r in M.estimated_cardinality(halves).collect()}
    assert estimate["cold"] == 3 and abs(estimate["hot"] - 60_000) < 1800
