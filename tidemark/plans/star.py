"""Star-schema and group queries over orders and line items."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.functions.numbers import exact
from tidemark.operators import aggregates as A
from tidemark.operators import relational as R
from tidemark.operators import segments as G
from tidemark.plans.catalog import query
from tidemark.sources.tables import Tables

AMOUNT = "CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,4))"


def line_sales(t: Tables) -> DataFrame:
    """Line items as facts that need no customer."""
    return t.lineitem.select(
        "l_orderkey",
        F.col("l_partkey").alias("product_id"),
        F.to_date("l_shipdate").alias("sale_date"),
        F.col("l_quantity").alias("qty"),
        exact(F.col("l_extendedprice") * (1 - F.col("l_discount")), 4).alias("amount"),
        F.col("l_discount").alias("discount"),
    )


def sales_with(t: Tables, buyers: DataFrame) -> DataFrame:
    """Line items with the attributes of their buyer.

    Orders, the smaller side, meet the buyers first, so line items are exchanged once.
    """
    placed = t.orders.select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("customer_id")
    )
    return line_sales(t).join(placed.join(buyers, "customer_id"), "l_orderkey")


def customers(t: Tables) -> DataFrame:
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_nationkey", F.col("r_name").alias("region")
    )
    return t.customer.join(places, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("customer_id"), "region", F.col("c_mktsegment").alias("segment")
    )


def products(t: Tables) -> DataFrame:
    return t.part.select(
        F.col("p_partkey").alias("product_id"), F.col("p_type").alias("category")
    )


def shop_orders(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderdate").alias("created_at"),
        F.col("o_orderpriority").alias("product"),
        F.col("o_totalprice").alias("amount"),
    )


@query(
    "q1_daily_agg",
    f"""
    SELECT CAST(l_shipdate AS DATE) AS sale_date,
           CAST(round(sum({AMOUNT}), 2) AS DOUBLE) AS revenue, count(*) AS orders_cnt
    FROM lineitem GROUP BY 1 ORDER BY 1
    """,
)
def q1_daily_agg(t: Tables) -> DataFrame:
    return R.daily_revenue(line_sales(t)).orderBy("sale_date")


@query(
    "q2_filter_region",
    f"""
    SELECT r_name AS region, CAST(round(sum({AMOUNT}), 2) AS DOUBLE) AS revenue,
           round(avg(l_quantity), 2) AS avg_qty
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    WHERE CAST(l_shipdate AS DATE) BETWEEN DATE '1996-06-01' AND DATE '1996-08-31'
    GROUP BY 1
    """,
)
def q2_filter_region(t: Tables) -> DataFrame:
    return R.revenue_by_region(sales_with(t, customers(t)), "1996-06-01", "1996-08-31").orderBy(
        F.desc("revenue"), "region"
    )


@query(
    "q3_join_top10",
    f"""
    SELECT r_name AS region, p_type AS category,
           CAST(round(sum({AMOUNT}), 2) AS DOUBLE) AS revenue, count(*) AS orders_cnt
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    JOIN part ON l_partkey = p_partkey
    GROUP BY 1, 2 ORDER BY revenue DESC, region, category LIMIT 10
    """,
)
def q3_join_top10(t: Tables) -> DataFrame:
    return R.top_region_category(sales_with(t, customers(t)), products(t), 10)


@query(
    "q4_distinct_segment",
    f"""
    SELECT c_mktsegment AS segment, count(DISTINCT o_custkey) AS buyers,
           CAST(round(sum({AMOUNT}), 2) AS DOUBLE) AS revenue
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey
    WHERE l_discount >= 0.05 GROUP BY 1
    """,
)
def q4_distinct_segment(t: Tables) -> DataFrame:
    segments = t.customer.select(
        F.col("c_custkey").alias("customer_id"), F.col("c_mktsegment").alias("segment")
    )
    return R.buyers_by_segment(sales_with(t, segments), 0.05).orderBy(F.desc("revenue"), "segment")


ORDERS_DAILY_SQL = """
    SELECT CAST(o_orderdate AS DATE) AS order_date, o_orderpriority AS product,
           count(*) AS orders_total,
           CAST(round(sum(CAST(o_totalprice AS DECIMAL(18,2))), 2) AS DOUBLE) AS amount_total
    FROM orders GROUP BY 1, 2
"""


@query("orders_daily", ORDERS_DAILY_SQL)
def orders_daily(t: Tables) -> DataFrame:
    return R.orders_daily(shop_orders(t)).orderBy("order_date", "product")


@query(
    "kpi_daily",
    f"""
    WITH d AS ({ORDERS_DAILY_SQL})
    SELECT order_date, CAST(sum(CAST(amount_total AS DECIMAL(18,2))) AS DOUBLE) AS revenue,
           CAST(sum(orders_total) AS BIGINT) AS orders_total,
           arg_min(product, ROW(-amount_total, product)) AS top_product
    FROM d GROUP BY 1
    """,
)
def kpi_daily(t: Tables) -> DataFrame:
    return R.kpi_daily(shop_orders(t))


@query(
    "broadcast_join",
    "SELECT l_suppkey AS key, count(*) AS row_count FROM lineitem "
    "JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1",
)
def broadcast_join(t: Tables) -> DataFrame:
    """The SQL form of a hinted join; the hint names the alias the query uses."""
    t.lineitem.createOrReplaceTempView("tidemark_big")
    t.supplier.createOrReplaceTempView("tidemark_small")
    hint = "/*+ BROADCAST(s) */" if R.fits_broadcast(t.supplier) else ""
    return t.spark.sql(
        f"SELECT {hint} b.l_suppkey AS key, count(*) AS row_count "
        "FROM tidemark_big b JOIN tidemark_small s ON b.l_suppkey = s.s_suppkey GROUP BY 1"
    )


@query(
    "broadcast_join_hint",
    "SELECT n_name AS nation, count(*) AS order_count FROM orders "
    "JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1",
)
def broadcast_join_hint(t: Tables) -> DataFrame:
    """Orders are counted per customer first, so the joined rows are few."""
    per_customer = R.group_count(t.orders, ["o_custkey"], "n").withColumnRenamed(
        "o_custkey", "c_custkey"
    )
    placed = R.join_broadcast(
        per_customer.join(t.customer, "c_custkey").withColumnRenamed("c_nationkey", "n_nationkey"),
        t.nation.select("n_nationkey", "n_name"),
        "n_nationkey",
    )
    return placed.groupBy(F.col("n_name").alias("nation")).agg(F.sum("n").alias("order_count"))


@query(
    "shuffle_join",
    "SELECT s_nationkey AS nation, count(*) AS row_count FROM lineitem "
    "JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1",
)
def shuffle_join(t: Tables) -> DataFrame:
    small = t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("nation"))
    joined = R.join_shuffle(t.lineitem.select("l_suppkey"), small, "l_suppkey")
    return R.group_count(joined, ["nation"])


@query(
    "cte_self_join",
    """
    WITH sub AS (SELECT o_custkey AS key, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS s
                 FROM orders GROUP BY 1)
    SELECT a.key, CAST(a.s AS DOUBLE) AS a_sum, CAST(b.s AS DOUBLE) AS b_sum
    FROM sub a JOIN sub b ON a.key = b.key WHERE a.s > 1000000
    """,
)
def cte_self_join(t: Tables) -> DataFrame:
    t.orders.createOrReplaceTempView("tidemark_orders")
    return t.spark.sql(
        """
        WITH sub AS (SELECT o_custkey AS key, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS s
                     FROM tidemark_orders GROUP BY o_custkey)
        SELECT a.key, CAST(a.s AS DOUBLE) AS a_sum, CAST(b.s AS DOUBLE) AS b_sum
        FROM sub a JOIN sub b ON a.key = b.key WHERE a.s > 1000000
        """
    )


@query(
    "count_by_type",
    "SELECT event_type, count(*) AS row_count FROM events GROUP BY 1",
)
def count_by_type(t: Tables) -> DataFrame:
    return R.group_count(t.events, ["event_type"]).orderBy("event_type")


@query(
    "sum_by_group",
    "SELECT l_partkey AS part, sum(l_quantity) AS total FROM lineitem GROUP BY 1",
)
def sum_by_group(t: Tables) -> DataFrame:
    return R.group_sum(t.lineitem, ["l_partkey"], "l_quantity").withColumnRenamed(
        "l_partkey", "part"
    )


@query(
    "multi_agg",
    """
    SELECT l_suppkey, sum(l_quantity) AS sum, avg(l_quantity) AS avg, min(l_quantity) AS min
    FROM lineitem GROUP BY 1
    """,
)
def multi_agg(t: Tables) -> DataFrame:
    return R.multi_agg(t.lineitem, ["l_suppkey"], "l_quantity")


@query(
    "group_cardinality",
    "SELECT count(*) AS group_count FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem)",
)
def group_cardinality(t: Tables) -> DataFrame:
    return R.group_cardinality(t.lineitem, ["l_partkey", "l_suppkey"])


@query(
    "salted_count",
    """
    SELECT l_returnflag, count(*) AS cnt, sum(l_quantity) AS total, min(l_quantity) AS low,
           max(l_quantity) AS high FROM lineitem GROUP BY 1
    """,
)
def salted_count(t: Tables) -> DataFrame:
    return R.salted_agg(
        t.lineitem,
        "l_returnflag",
        "l_orderkey",
        10,
        {
            "cnt": ("count", "*"),
            "total": ("sum", "l_quantity"),
            "low": ("min", "l_quantity"),
            "high": ("max", "l_quantity"),
        },
    )


TOP4_SQL = """
    SELECT * FROM (
      SELECT o_custkey, o_orderkey, o_totalprice,
             CAST(row_number() OVER (PARTITION BY o_custkey
                                     ORDER BY o_totalprice DESC, o_orderkey) AS INTEGER) AS rn
      FROM orders) WHERE rn <= {k}
"""


@query("topn_per_group", TOP4_SQL.format(k=4))
def topn_per_group(t: Tables) -> DataFrame:
    return R.top_n_per_group(
        t.orders.select("o_custkey", "o_orderkey", "o_totalprice"),
        ["o_custkey"],
        "o_totalprice",
        ["o_orderkey"],
        4,
    )


@query(
    "topn_sorted_list",
    f"""
    SELECT o_custkey, string_agg(CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS VARCHAR), ','
                                 ORDER BY rn) AS top_cents
    FROM ({TOP4_SQL.format(k=5)}) GROUP BY 1
    """,
)
def topn_sorted_list(t: Tables) -> DataFrame:
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents")
    lists = R.top_list_per_group(
        t.orders.select("o_custkey", "o_orderkey", cents), ["o_custkey"], "cents", ["o_orderkey"], 5
    )
    return lists.select("o_custkey", F.array_join(F.col("top").cast("array<string>"), ",").alias("top_cents"))


@query(
    "window_patterns",
    """
    SELECT o_custkey, o_orderkey,
           CAST(sum(c) OVER w AS DOUBLE) / 100 AS running_total,
           round(CAST(sum(c) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS DOUBLE)
                 / count(*) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) / 100, 4) AS moving_avg,
           CAST(c - lag(c) OVER w AS DOUBLE) / 100 AS change,
           row_number() OVER w AS place,
           rank() OVER (PARTITION BY o_custkey ORDER BY d) AS day_rank,
           dense_rank() OVER (PARTITION BY o_custkey ORDER BY d) AS day_dense_rank
    FROM (SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS d,
                 CAST(round(o_totalprice * 100) AS BIGINT) AS c FROM orders)
    WINDOW w AS (PARTITION BY o_custkey ORDER BY d, o_orderkey)
    """,
)
def window_patterns(t: Tables) -> DataFrame:
    """Running total, moving average of three, difference and ranks along each customer's orders."""
    orders = t.orders.select(
        "o_custkey",
        "o_orderkey",
        F.to_date("o_orderdate").alias("d"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("c"),
    )
    keys, order = ["o_custkey"], ["d", "o_orderkey"]
    rows = G.segmented(
        orders,
        keys,
        order,
        keep=["c"],
        tail=2,
        totals={"total": F.sum("c"), "days": F.size(F.collect_set("d"))},
    )
    w = G.inside(order)
    one, two = G.earlier_value("c", w, 1), G.earlier_value("c", w, 2)
    spread = F.lit(1) + one.isNotNull().cast("int") + two.isNotNull().cast("int")
    moving = (F.col("c") + F.coalesce(one, F.lit(0)) + F.coalesce(two, F.lit(0))).cast("double")
    return rows.select(
        "o_custkey",
        "o_orderkey",
        (G.running_total("total", F.col("c"), w).cast("double") / 100).alias("running_total"),
        F.round(moving / spread / 100, 4).alias("moving_avg"),
        ((F.col("c") - one).cast("double") / 100).alias("change"),
        G.position(w).alias("place"),
        G.rank_position(["d"]).alias("day_rank"),
        G.dense_rank_position("days", ["d"]).alias("day_dense_rank"),
    )


@query(
    "top_documents",
    """
    SELECT 'PART_' || l_partkey AS document_id, count(*) AS total_open_count
    FROM lineitem GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 30
    """,
)
def top_documents(t: Tables) -> DataFrame:
    counted = R.group_count(t.lineitem, ["l_partkey"], "total_open_count").select(
        F.concat(F.lit("PART_"), F.col("l_partkey")).alias("document_id"), "total_open_count"
    )
    return R.global_top(counted, "total_open_count", ["document_id"], 30)


@query(
    "custom_geo_mean",
    """
    SELECT o_orderpriority AS product, count(*) AS n, round(exp(avg(ln(o_totalprice))), 4) AS geo_mean
    FROM orders GROUP BY 1
    """,
)
def custom_geo_mean(t: Tables) -> DataFrame:
    """An aggregate that is written in Python: states per batch, merged by salted keys, then by key."""
    orders = t.orders.select(F.col("o_orderpriority").alias("product"), F.col("o_totalprice").alias("price"))
    found = A.aggregate(orders, ["product"], ["price"], A.geometric_mean("price"))
    return found.withColumn("geo_mean", F.round("geo_mean", 4))


SHOWN = ["AUTOMOBILE", "BUILDING", "FURNITURE", "MACHINERY", "NO SUCH SEGMENT"]


@query(
    "pivot_values",
    f"""
    SELECT CAST(o_orderdate AS DATE) AS day,
           {", ".join(f"""CAST(coalesce(sum(CASE WHEN c_mktsegment = '{s}' THEN 1 END), 0) AS BIGINT) AS "{s}" """ for s in SHOWN)}
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1
    """,
)
def pivot_values(t: Tables) -> DataFrame:
    """Orders per day, a column for each of the given segments; 0 on days and for segments without any."""
    buyers = t.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("segment"))
    days = t.orders.select("o_custkey", F.to_date("o_orderdate").alias("day")).join(buyers, "o_custkey")
    counted = R.group_count(days, ["day", "segment"], "n")
    return R.pivot_filled(counted, ["day"], "segment", SHOWN, "n")
