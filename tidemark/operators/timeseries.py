"""Queries on metric samples ``(metric, labels MAP, ts TIMESTAMP, value DOUBLE)``.

A range query is evaluated at one moment (``at``) or at every multiple of ``step`` seconds. In the
second case samples are summed up once, per series and bucket of the widest span that divides both
the range and the step; ranges are then put together from the buckets of a series, whatever their
number, as differences of running totals.
"""

from __future__ import annotations

import math
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

MICROS = 1_000_000


def _meets(label: str, condition: str) -> Column:
    value = F.coalesce(F.try_element_at("labels", F.lit(label)), F.lit(""))
    if condition.startswith("=~"):
        return value.rlike(f"^(?:{condition[2:]})$")
    if condition.startswith("!~"):
        return ~value.rlike(f"^(?:{condition[2:]})$")
    if condition.startswith("!="):
        return value != condition[2:]
    if condition.startswith("="):
        return value == condition[1:]
    raise ValueError(f"unknown condition {condition!r} for label {label}")


def matching(samples: DataFrame, metric: str | None = None, **conditions: str) -> DataFrame:
    """Select samples by metric name and label conditions.

    A condition is the operator followed by the operand: ``"=a"``, ``"!=a"``, ``"=~re"`` or
    ``"!~re"``. Patterns match the whole value; an absent label counts as the empty string.
    """
    kept = samples if metric is None else samples.filter(F.col("metric") == metric)
    for label, condition in conditions.items():
        kept = kept.filter(_meets(label, condition))
    return kept


def in_range(samples: DataFrame, seconds: int, at: datetime) -> DataFrame:
    """The samples with ``at - seconds < ts <= at``, and ``at``."""
    moment = F.lit(at).cast("timestamp")
    since = moment - F.expr(f"INTERVAL {seconds} SECONDS")
    return samples.filter((F.col("ts") > since) & (F.col("ts") <= moment)).withColumn("at", moment)


def _series() -> Column:
    return F.array_sort(F.map_entries("labels")).alias("series")


#: Growth is added as decimals, so that no sum depends on its order and totals can be taken from each
#: other. A counter beyond 10**23 is an error; digits beyond the 15th decimal place are rounded off.
EXACT = "decimal(38,15)"


def _step(value: Column, before: Column) -> Column:
    """Growth from one sample to the next; a counter that falls was reset and counts from zero."""
    grown = F.when(value < before, value.cast(EXACT)).otherwise((value.cast(EXACT) - before.cast(EXACT)).cast(EXACT))
    return F.when(before.isNull() | ~_finite(value) | ~_finite(before), F.lit(0).cast(EXACT)).otherwise(grown)


def _finite(value: Column) -> Column:
    return F.abs(value) < float("inf")  # NaN is larger than any number


def _summed(samples: DataFrame, keys: list[str]) -> DataFrame:
    """Per keys: number of samples and of those that are no number, first and last one, and the
    growth between them."""
    order = Window.partitionBy(*keys).orderBy("ts")
    return (
        samples.withColumn("grown", _step(F.col("value"), F.lag("value").over(order)))
        .groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(~_finite(F.col("value"))).alias("odd"),
            F.sum("grown").cast(EXACT).alias("grown"),
            F.min("ts").alias("first_ts"),
            F.max("ts").alias("last_ts"),
            F.min_by("value", "ts").alias("first_value"),
            F.max_by("value", "ts").alias("last_value"),
        )
    )


def _range_summary(
    samples: DataFrame, seconds: int, at: datetime | None, step: int | None
) -> DataFrame:
    """Per (metric, series, at) with a sample: their number, the first and last one, the growth."""
    if (at is None) == (step is None):
        raise ValueError("give either at or step")
    names = ["n", "odd", "grown", "first_ts", "last_ts", "first_value", "last_value"]
    if at is not None:
        ranged = in_range(samples, seconds, at).select("metric", _series(), "at", "ts", "value")
        return _summed(ranged, ["metric", "series", "at"])
    width = math.gcd(seconds, step) * MICROS
    micros = F.unix_micros("ts")
    end = (micros + F.pmod(-micros, F.lit(width))).alias("end")
    buckets = _summed(samples.select("metric", _series(), end, "ts", "value"), ["metric", "series", "end"])

    along = Window.partitionBy("metric", "series").orderBy("end")
    so_far = along.rowsBetween(Window.unboundedPreceding, 0)
    jump = _step(F.col("first_value"), F.lag("last_value").over(along))
    chained = (
        buckets.withColumn("_gained", (F.col("grown") + jump).cast(EXACT))
        .withColumn("_total_n", F.sum("n").over(so_far))
        .withColumn("_total_odd", F.sum("odd").over(so_far))
        .withColumn("_total", F.sum("_gained").over(so_far).cast(EXACT))
        .withColumn("_next", F.lead("end").over(along))
    )
    # A moment belongs to the last bucket that ends by then; its range starts after ``end`` below.
    grid, reach = F.lit(step * MICROS), F.lit(seconds * MICROS)
    first = F.col("end") + F.pmod(-F.col("end"), grid)
    ahead = F.least(F.col("end") + reach, F.coalesce("_next", F.col("end") + reach)) - 1
    last = ahead - F.pmod(ahead, grid)
    moments = F.when(first <= last, F.sequence(first, last, grid)).otherwise(F.array().cast("array<bigint>"))
    bucket = F.struct(F.lit(None).cast("bigint").alias("at"), F.col("end").alias("place"))
    asked = F.transform(moments, lambda t: F.struct(t.alias("at"), (t - reach).alias("place")))
    rows = chained.select(
        "metric", "series", *names, "_total_n", "_total_odd", "_total", F.inline(F.concat(F.array(bucket), asked))
    )
    # From the end, the last bucket passed is the first one of a range; one that ends where the
    # range begins lies outside and comes after it.
    back = Window.partitionBy("metric", "series").orderBy(F.desc("place"), F.desc_nulls_last("at"))
    held = F.when(F.col("at").isNull(), F.struct("n", "odd", "grown", "first_ts", "first_value", "_total_n", "_total_odd", "_total"))
    opening = F.last(held, ignorenulls=True).over(back.rowsBetween(Window.unboundedPreceding, 0))
    return (
        rows.withColumn("_first", opening)
        .filter(F.col("at").isNotNull())
        .select(
            "metric",
            "series",
            F.timestamp_micros("at").alias("at"),
            (F.col("_total_n") - F.col("_first._total_n") + F.col("_first.n")).alias("n"),
            (F.col("_total_odd") - F.col("_first._total_odd") + F.col("_first.odd")).alias("odd"),
            (F.col("_total") - F.col("_first._total") + F.col("_first.grown")).cast(EXACT).alias("grown"),
            F.col("_first.first_ts").alias("first_ts"),
            "last_ts",
            F.col("_first.first_value").alias("first_value"),
            "last_value",
        )
    )


def _stretch(seconds: int, amount: Column, counter: bool) -> Column:
    """The factor that carries an amount seen between two samples over to the whole range."""
    end = F.unix_micros("at") / MICROS
    head = F.unix_micros("first_ts") / MICROS - (end - seconds)
    rest = end - F.unix_micros("last_ts") / MICROS
    covered = (F.unix_micros("last_ts") - F.unix_micros("first_ts")) / MICROS
    pause = covered / (F.col("n") - 1)
    limit = pause * 1.1
    if counter:
        from_zero = F.when(
            (amount > 0) & (F.col("first_value") >= 0), covered * F.col("first_value") / amount
        )
        head = F.least(head, from_zero)
    head = F.when(head >= limit, pause / 2).otherwise(head)
    rest = F.when(rest >= limit, pause / 2).otherwise(rest)
    return (covered + head + rest) / covered


def _vector(summary: DataFrame, value: Column) -> DataFrame:
    return summary.select(
        "metric", F.map_from_entries("series").alias("labels"), "at", value.alias("value")
    )


def increase(
    samples: DataFrame,
    seconds: int,
    at: datetime | None = None,
    step: int | None = None,
    extrapolate: bool = False,
) -> DataFrame:
    """Growth of each counter over the range; series with fewer than two samples vanish."""
    grown = F.when(F.col("odd") > 0, F.lit(float("nan"))).otherwise(F.col("grown").cast("double"))
    value = grown * _stretch(seconds, grown, True) if extrapolate else grown
    return _vector(_range_summary(samples, seconds, at, step).filter("n >= 2"), value)


def rate(
    samples: DataFrame,
    seconds: int,
    at: datetime | None = None,
    step: int | None = None,
    extrapolate: bool = False,
) -> DataFrame:
    """Growth per second."""
    return per_second(increase(samples, seconds, at, step, extrapolate), seconds)


def per_second(vector: DataFrame, seconds: int) -> DataFrame:
    """Growth over ``seconds`` as growth per second; sums are best taken before."""
    return vector.withColumn("value", F.col("value") / seconds)


def delta(
    samples: DataFrame,
    seconds: int,
    at: datetime | None = None,
    step: int | None = None,
    extrapolate: bool = False,
) -> DataFrame:
    """Last minus first value of each gauge over the range."""
    summary = _range_summary(samples, seconds, at, step).filter("n >= 2")
    change = F.col("last_value") - F.col("first_value")
    return _vector(summary, change * _stretch(seconds, change, False) if extrapolate else change)


def instant(
    samples: DataFrame, at: datetime | None = None, step: int | None = None, lookback: int = 300
) -> DataFrame:
    """The latest value of each series within the lookback."""
    summary = _range_summary(samples, lookback, at, step)
    return _vector(summary, F.col("last_value"))


def sum_by(vector: DataFrame, labels: list[str]) -> DataFrame:
    """Sum per moment and the given labels, which become columns."""
    keys = [F.coalesce(F.try_element_at("labels", F.lit(x)), F.lit("")).alias(x) for x in labels]
    return vector.groupBy("at", *keys).agg(F.sum("value").alias("value"))


def max_by_labels(vector: DataFrame, labels: list[str]) -> DataFrame:
    keys = [F.coalesce(F.try_element_at("labels", F.lit(x)), F.lit("")).alias(x) for x in labels]
    return vector.groupBy("at", *keys).agg(F.max("value").alias("value"))


def sum_without(vector: DataFrame, labels: list[str]) -> DataFrame:
    """Sum per moment over everything but the given labels; ``series`` lists what is left."""
    kept = F.filter(F.map_entries("labels"), lambda e: ~e["key"].isin(labels))
    return vector.groupBy("at", F.array_sort(kept).alias("series")).agg(
        F.sum("value").alias("value")
    )


def _percent(part: Column, whole: Column) -> Column:
    """Nothing divided by nothing is NaN."""
    return F.when(whole != 0, part * 100 / F.nullif(whole, F.lit(0.0))).otherwise(
        F.when(part == 0, F.lit(float("nan"))).otherwise(F.lit(float("inf")))
    )


def ratio(
    part: DataFrame, whole: DataFrame, labels: list[str], fill_missing: bool = False
) -> DataFrame:
    """``100 * part / whole`` per moment and labels.

    A group without ``part`` vanishes, or counts as zero with ``fill_missing``.
    """
    keys = ["at", *labels]
    joined = whole.select(*keys, F.col("value").alias("_whole")).join(
        part.select(*keys, F.col("value").alias("_part")), keys, "left" if fill_missing else "inner"
    )
    share = _percent(F.coalesce("_part", F.lit(0.0)), F.col("_whole"))
    return joined.select(*keys, share.alias("value"))


def share(
    vector: DataFrame, labels: list[str], fill_missing: bool = False, **conditions: str
) -> DataFrame:
    """:func:`ratio` of the matching part of one vector to all of it, without a join."""
    met = F.lit(True)
    for label, condition in conditions.items():
        met = met & _meets(label, condition)
    keys = [F.coalesce(F.try_element_at("labels", F.lit(x)), F.lit("")).alias(x) for x in labels]
    sums = vector.groupBy("at", *keys).agg(
        F.sum(F.when(met, F.col("value"))).alias("_part"), F.sum("value").alias("_whole")
    )
    if not fill_missing:
        sums = sums.filter(F.col("_part").isNotNull())
    share = _percent(F.coalesce("_part", F.lit(0.0)), F.col("_whole"))
    return sums.select("at", *labels, share.alias("value"))


def age(vector: DataFrame) -> DataFrame:
    """Seconds between the evaluation moment and the moment held as the value."""
    return vector.withColumn("value", F.unix_micros("at") / MICROS - F.col("value"))


def histogram_quantile(q: float, buckets: DataFrame, labels: list[str]) -> DataFrame:
    """The q-quantile per moment and labels from cumulative buckets with a column ``le``.

    Counts that fall from one bucket to the next are lifted to the highest seen so far; values
    are spread evenly inside a bucket; the lowest bucket starts at zero. Above the last finite
    bound the answer is that bound; an empty histogram or one without ``+Inf`` gives NaN.
    """
    keys = ["at", *labels]
    bound = F.when(F.col("le") == "+Inf", F.lit(float("inf"))).otherwise(F.col("le").cast("double"))
    order = Window.partitionBy(*keys).orderBy("_le")
    upward = order.rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*keys)
    lifted = (
        buckets.select(*keys, bound.alias("_le"), "value")
        .withColumn("_count", F.max("value").over(upward))
        .withColumn("_low", F.lag("_le").over(order))
        .withColumn("_below", F.lag("_count").over(order))
        .withColumn("_total", F.max("_count").over(whole))
        .withColumn("_top", F.max("_le").over(whole))
    )
    wanted = F.col("_total") * q
    start = F.when(F.col("_low").isNull(), F.when(F.col("_le") > 0, 0.0)).otherwise(F.col("_low"))
    below = F.coalesce("_below", F.lit(0.0))
    inside = F.when(start.isNull(), F.col("_le")).otherwise(
        start
        + (F.col("_le") - start)
        * F.try_divide(wanted - below, F.col("_count") - below)
    )
    value = F.when(F.col("_le") == float("inf"), F.col("_low")).otherwise(inside)
    usable = (F.col("_top") == float("inf")) & (F.col("_total") > 0)
    # the first bucket that reaches the wanted count answers
    return (
        lifted.filter((F.col("_count") >= wanted) | ~usable)
        .groupBy(*keys)
        .agg(
            F.min_by(
                F.when(usable, F.coalesce(value, F.lit(float("nan")))).otherwise(
                    F.lit(float("nan"))
                ),
                "_le",
            ).alias("value")
        )
    )


def held(vector: DataFrame, labels: list[str], condition: Column, step: int, hold: int) -> DataFrame:
    """Moments at which ``condition`` was true at every step of the last ``hold`` seconds.

    The window of a label group holds one row per evaluation step, not per sample.
    """
    seconds = F.unix_seconds("at")
    past = Window.partitionBy(*labels).orderBy(seconds).rangeBetween(-hold, 0)
    return (
        vector.withColumn("_true", F.min(F.coalesce(condition, F.lit(False))).over(past))
        .withColumn("_seen", F.count(F.lit(1)).over(past))
        .filter(F.col("_true") & (F.col("_seen") == hold // step + 1))
        .drop("_true", "_seen")
    )


def label_cardinality(samples: DataFrame) -> DataFrame:
    """Number of distinct values per label."""
    return (
        samples.select(F.explode("labels").alias("label", "text"))
        .groupBy("label")
        .agg(F.count_distinct("text").alias("values"))
    )


def label_sketches(samples: DataFrame) -> DataFrame:
    """(label, sketch) of the distinct values; sketches of parts can be stored and merged later."""
    texts = samples.select(F.explode("labels").alias("label", "text"))
    return texts.groupBy("label").agg(F.hll_sketch_agg("text", 14).alias("sketch"))


def estimated_cardinality(sketches: DataFrame) -> DataFrame:
    """Distinct values per label to about a percent, from any number of :func:`label_sketches`."""
    merged = sketches.groupBy("label").agg(F.hll_union_agg("sketch").alias("sketch"))
    return merged.select("label", F.hll_sketch_estimate("sketch").alias("values"))


def jobs_without_success(status: DataFrame, successes: DataFrame, key: str) -> DataFrame:
    """Jobs reported as failed that never sent a success."""
    return status.join(successes.select(key), key, "left_anti")
