"""Joins, aggregations and per-group selections."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.functions.numbers import exact, hex_number, money


def estimated_bytes(df: DataFrame) -> int:
    """The size of ``df`` by the optimizer's statistics; no job runs."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def fits_broadcast(df: DataFrame) -> bool:
    """Whether ``df`` is estimated below the session's broadcast threshold."""
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return 0 <= estimated_bytes(df) <= limit


def join_broadcast(fact: DataFrame, dim: DataFrame, on: str | list[str]) -> DataFrame:
    """Join with ``dim`` sent to every task if its estimated bytes allow; else Spark chooses."""
    return fact.join(F.broadcast(dim) if fits_broadcast(dim) else dim, on)


def join_shuffle(fact: DataFrame, dim: DataFrame, on: str | list[str]) -> DataFrame:
    """Join by shuffling both sides, however small ``dim`` is."""
    return fact.join(dim.hint("merge"), on)


def multi_agg(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.sum(value).alias("sum"), F.avg(value).alias("avg"), F.min(value).alias("min")
    )


def group_count(df: DataFrame, keys: list[str], name: str = "row_count") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def group_sum(df: DataFrame, keys: list[str], value: str, name: str = "total") -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(value).alias(name))


def group_cardinality(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.select(*keys).distinct().agg(F.count(F.lit(1)).alias("group_count"))


def top_n_per_group(
    df: DataFrame, keys: list[str], order: str, tie: list[str], k: int
) -> DataFrame:
    """The ``k`` rows with the highest ``order`` per group; ``tie`` makes the choice unique.

    The rank filter is pushed below the shuffle, so each task sends at most ``k`` rows per group.
    """
    ranked = Window.partitionBy(*keys).orderBy(F.col(order).desc(), *(F.col(t) for t in tie))
    return df.withColumn("rn", F.row_number().over(ranked)).filter(F.col("rn") <= k)


def top_list_per_group(
    df: DataFrame, keys: list[str], value: str, tie: list[str], k: int, name: str = "top"
) -> DataFrame:
    """One row per group with its ``k`` highest values as a descending list."""
    return (
        top_n_per_group(df, keys, value, tie, k)
        .groupBy(*keys)
        .agg(F.sort_array(F.collect_list(F.struct("rn", F.col(value).alias("v")))).alias("p"))
        .select(*keys, F.transform("p", lambda x: x["v"]).alias(name))
    )


def global_top(df: DataFrame, order: str, tie: list[str], k: int) -> DataFrame:
    return df.orderBy(F.col(order).desc(), *(F.col(t) for t in tie)).limit(k)


def sample_by_key(df: DataFrame, key: str, fraction: float) -> DataFrame:
    """About ``fraction`` of the rows, chosen by a digest of the key: the same rows in any layout."""
    drawn = hex_number(F.substring(F.md5(F.col(key).cast("string")), 1, 8))
    return df.filter(drawn < int(fraction * 2**32))


def latest_per_key(df: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """The row with the highest ``order_by`` per key, chosen partly before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    return (
        df.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), F.struct(*order_by)).alias("_row"))
        .select(*keys, "_row.*")
        .select(*df.columns)
    )


# Aggregates that can be computed in parts: (part, merge of parts).
_MERGE = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}


def salted_agg(
    df: DataFrame, key: str, salt_source: str, salts: int, aggs: dict[str, tuple[str, str]]
) -> DataFrame:
    """Aggregate by ``(key, salt)`` and then by ``key``, so a hot key is worked on by many tasks.

    ``aggs`` maps a result name to ``(count | sum | min | max, column)``.
    """
    salt = F.pmod(F.hash(salt_source), F.lit(salts))
    parts = {
        "count": lambda c: F.count(c),
        "sum": lambda c: F.sum(c),
        "min": lambda c: F.min(c),
        "max": lambda c: F.max(c),
    }
    first = [
        parts[kind](F.lit(1) if column == "*" else F.col(column)).alias(name)
        for name, (kind, column) in aggs.items()
    ]
    second = [_MERGE[kind](name).alias(name) for name, (kind, _) in aggs.items()]
    return df.withColumn("_salt", salt).groupBy(key, "_salt").agg(*first).groupBy(key).agg(*second)


def flatten_nested(
    df: DataFrame, array_col: str, fields: list[str], name: str = "value", outer: bool = False
) -> DataFrame:
    """One row per array element next to plain or nested ``fields``."""
    explode = F.explode_outer if outer else F.explode
    return df.select(*fields, explode(array_col).alias(name))


# --- star schema ------------------------------------------------------------------------------


def daily_revenue(sales: DataFrame) -> DataFrame:
    return sales.groupBy("sale_date").agg(
        money(F.sum("amount")).alias("revenue"), F.count(F.lit(1)).alias("orders_cnt")
    )


def revenue_by_region(sales: DataFrame, first_day: str, last_day: str) -> DataFrame:
    days = F.col("sale_date").between(F.lit(first_day).cast("date"), F.lit(last_day).cast("date"))
    return (
        sales.filter(days)
        .groupBy("region")
        .agg(
            money(F.sum("amount")).alias("revenue"), F.round(F.avg("qty"), 2).alias("avg_qty")
        )
    )


def top_region_category(sales: DataFrame, products: DataFrame, k: int = 10) -> DataFrame:
    totals = (
        sales.join(products, "product_id")
        .groupBy("region", "category")
        .agg(money(F.sum("amount")).alias("revenue"), F.count(F.lit(1)).alias("orders_cnt"))
    )
    return global_top(totals, "revenue", ["region", "category"], k)


def buyers_by_segment(sales: DataFrame, min_discount: float = 0.05) -> DataFrame:
    return (
        sales.filter(F.col("discount") >= min_discount)
        .groupBy("segment")
        .agg(
            F.count_distinct("customer_id").alias("buyers"),
            money(F.sum("amount")).alias("revenue"),
        )
    )


def orders_daily(orders: DataFrame) -> DataFrame:
    """Orders and amount by day and product."""
    return (
        orders.withColumn("order_date", F.to_date("created_at"))
        .groupBy("order_date", "product")
        .agg(
            F.count(F.lit(1)).alias("orders_total"),
            money(F.sum(exact(F.col("amount")))).alias("amount_total"),
        )
    )


def kpi_daily(orders: DataFrame) -> DataFrame:
    """Revenue, number of orders and best-selling product of each day; ties go by name."""
    per_product = orders_daily(orders)
    first = F.min_by("product", F.struct((-F.col("amount_total")).alias("a"), "product"))
    return per_product.groupBy("order_date").agg(
        money(F.sum(exact(F.col("amount_total")))).alias("revenue"),
        F.sum("orders_total").alias("orders_total"),
        first.alias("top_product"),
    )


def pivot_filled(df: DataFrame, keys: list[str], column: str, values: list[str], measure: str) -> DataFrame:
    """One row per ``keys`` and a column per given value, ``measure`` summed; 0 where there is none.

    The values are given, so no job looks for them and the columns are known beforehand.
    """
    wide = df.groupBy(*keys).pivot(column, values).agg(F.sum(measure))
    return wide.fillna(0, subset=values)
