"""Comparison of benchmark runs as data work."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.numbers import cold_run, geo_mean, hot_run

# Shares of load time, data size, cold and hot runs in the combined score.
SCORE_SHARES = {"load": 0.1, "size": 0.1, "cold": 0.2, "hot": 0.6}


def query_runs(snapshots: DataFrame) -> DataFrame:
    """(system, query, cold, hot) from snapshots with nested run times."""
    return snapshots.select("system", F.posexplode("result").alias("query", "runs")).select(
        "system", "query", cold_run(F.col("runs")).alias("cold"), hot_run(F.col("runs")).alias("hot")
    )


def query_ratios(base: DataFrame, other: DataFrame) -> DataFrame:
    """Query i of ``other`` over query i of ``base``; a query only one side has is an error."""
    mine = base.select("query", F.col("cold").alias("base_cold"), F.col("hot").alias("base_hot"))
    theirs = other.select("query", "cold", "hot")
    both = mine.join(theirs, "query", "full_outer")
    checked = F.when(
        F.col("base_cold").isNull() | F.col("cold").isNull(),
        F.raise_error(F.lit("the two sides hold different queries")).cast("double"),
    ).otherwise(F.col("cold") / F.col("base_cold"))
    return both.select(
        "query",
        checked.alias("cold_ratio"),
        (F.col("hot") / F.col("base_hot")).alias("hot_ratio"),
        (F.col("cold") < F.col("base_cold")).alias("cold_faster"),
        (F.col("hot") < F.col("base_hot")).alias("hot_faster"),
    )


def pairwise_ratio(base: DataFrame, other: DataFrame) -> DataFrame:
    """Geometric means of the ratios and the number of wins of ``other``."""
    return query_ratios(base, other).agg(
        F.count(F.lit(1)).alias("queries"),
        geo_mean(F.col("cold_ratio")).alias("cold_ratio"),
        geo_mean(F.col("hot_ratio")).alias("hot_ratio"),
        F.count_if("cold_faster").alias("cold_wins"),
        F.count_if("hot_faster").alias("hot_wins"),
    )


def weighted_score(ratios: dict[str, Column], shares: dict[str, float] | None = None) -> Column:
    """Weighted geometric mean of the named ratios."""
    shares = shares or SCORE_SHARES
    total = F.lit(0.0)
    for name, share in shares.items():
        total = total + F.ln(ratios[name]) * share
    return F.exp(total)


def side_by_side(left: DataFrame, right: DataFrame) -> DataFrame:
    """The columns of two one-row tables in one row."""
    both = left.select(F.struct("*").alias("_left")).unionByName(
        right.select(F.struct("*").alias("_right")), allowMissingColumns=True
    )
    return both.agg(
        F.first("_left", ignorenulls=True).alias("_left"),
        F.first("_right", ignorenulls=True).alias("_right"),
    ).select("_left.*", "_right.*")


def compare_snapshots(base: DataFrame, other: DataFrame, digits: int = 6) -> DataFrame:
    """All ratios of two snapshots in one row; each side is one row with nested runs."""
    loads = side_by_side(
        base.select(F.col("load_time").alias("bl"), F.col("data_size").alias("bs")),
        other.select("load_time", "data_size"),
    ).select(
        (F.col("load_time") / F.col("bl")).alias("load_ratio"),
        (F.col("data_size") / F.col("bs")).alias("size_ratio"),
    )
    row = side_by_side(loads, pairwise_ratio(query_runs(base), query_runs(other)))
    combined = weighted_score(
        {
            "load": F.col("load_ratio"),
            "size": F.col("size_ratio"),
            "cold": F.col("cold_ratio"),
            "hot": F.col("hot_ratio"),
        }
    )
    rounded = ["load_ratio", "size_ratio", "cold_ratio", "hot_ratio"]
    return row.withColumn("combined_ratio", combined).select(
        *(F.round(c, digits).alias(c) for c in [*rounded, "combined_ratio"]),
        "queries",
        "cold_wins",
        "hot_wins",
    )


def tidy(comparison: DataFrame, scenario: str, engine: str) -> DataFrame:
    """One row per metric: (scenario, engine, metric, value, unit)."""
    metrics = [c for c in comparison.columns if c != "queries"]
    entries = F.array(
        *(
            F.struct(
                F.lit(scenario).alias("scenario"),
                F.lit(engine).alias("engine"),
                F.lit(m).alias("metric"),
                F.col(m).cast("double").alias("value"),
                F.lit("count" if m.endswith("wins") else "x").alias("unit"),
            )
            for m in metrics
        )
    )
    return comparison.select(F.inline(entries))


def run_summary(runs: DataFrame, keys: list[str], seconds: str) -> DataFrame:
    """Mean of the measured runs, to three digits."""
    return runs.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("runs"), F.round(F.avg(seconds), 3).alias("mean_seconds")
    )
