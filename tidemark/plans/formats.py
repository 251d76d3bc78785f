"""Source, sink, projection and filter queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.operators import relational as R
from tidemark.plans.catalog import query
from tidemark.session import new_folder
from tidemark.sources import generators as G
from tidemark.sources.readers import read_csv, read_events
from tidemark.sources.tables import Tables
from tidemark.sources.writers import write_csv, write_events, write_json

def click_events(t: Tables) -> DataFrame:
    """The events with a date text and a nested ``metrics`` struct."""
    weight = F.from_json("props", "k BIGINT")["k"]
    return t.events.select(
        F.date_format("ts", "yyyy-MM-dd").alias("date"),
        "user_id",
        "event_type",
        F.concat(F.lit("https://example.com/page/"), F.col("event_id") % 100).alias("url"),
        F.concat(F.lit("Agent/"), F.col("event_id") % 3).alias("user_agent"),
        "value",
        F.struct(
            (F.col("event_id") % 10).alias("clicks"),
            (weight + 100).alias("impressions"),
            (F.col("value") / 2).alias("revenue"),
        ).alias("metrics"),
    )


CLICKS = """
    c AS (SELECT strftime(ts, '%Y-%m-%d') AS date, user_id, event_type,
                 'https://example.com/page/' || (event_id % 100) AS url,
                 'Agent/' || (event_id % 3) AS user_agent, value, event_id % 10 AS clicks,
                 CAST(json_extract(props, '$.k') AS BIGINT) + 100 AS impressions, value / 2 AS revenue
          FROM events)
"""
FLAT = "date, user_id, event_type, url, user_agent, value, clicks, impressions, revenue"


def flat(events: DataFrame) -> DataFrame:
    return events.select(
        "date", "user_id", "event_type", "url", "user_agent", "value", "metrics.*"
    )


def stored_events(t: Tables, fmt: str, codec: str) -> DataFrame:
    path = new_folder(t.spark, fmt)
    write_events(click_events(t), path, fmt, codec)
    return read_events(t.spark, path, fmt)


for _codec in ("SNAPPY", "GZIP", "OTHER"):

    def _parquet(t: Tables, codec: str = _codec) -> DataFrame:
        return flat(stored_events(t, "parquet", codec))

    _name = "parquet_roundtrip" if _codec == "SNAPPY" else f"parquet_roundtrip_{_codec.lower()}"
    query(_name, f"WITH {CLICKS} SELECT {FLAT} FROM c")(_parquet)


@query("json_roundtrip", f"WITH {CLICKS} SELECT {FLAT} FROM c")
def json_roundtrip(t: Tables) -> DataFrame:
    return flat(stored_events(t, "json", "GZIP"))


@query("orc_roundtrip", f"WITH {CLICKS} SELECT {FLAT} FROM c")
def orc_roundtrip(t: Tables) -> DataFrame:
    return flat(stored_events(t, "orc", "SNAPPY"))


@query(
    "scan_json",
    f"WITH {CLICKS} SELECT event_type, count(*) AS row_count, CAST(sum(clicks) AS BIGINT) AS clicks "
    "FROM c GROUP BY 1",
)
def scan_json(t: Tables) -> DataFrame:
    """Only the columns in use are parsed from the JSON lines."""
    return (
        stored_events(t, "json", "NONE")
        .groupBy("event_type")
        .agg(F.count(F.lit(1)).alias("row_count"), F.sum("metrics.clicks").alias("clicks"))
    )


@query(
    "csv_roundtrip",
    "SELECT o_orderkey AS order_id, CAST(o_orderdate AS DATE) AS created_on, "
    "o_orderpriority AS product, o_totalprice AS amount FROM orders",
)
def csv_roundtrip(t: Tables) -> DataFrame:
    path = new_folder(t.spark, "csv")
    rows = t.orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.to_date("o_orderdate").alias("created_on"),
        F.col("o_orderpriority").alias("product"),
        F.col("o_totalprice").alias("amount"),
    )
    write_csv(rows, path)
    return read_csv(
        t.spark, path, "order_id BIGINT, created_on DATE, product STRING, amount DOUBLE"
    )


@query(
    "json_report",
    """
    SELECT CAST(o_orderdate AS DATE) AS order_date, count(*) AS orders_total FROM orders GROUP BY 1
    """,
)
def json_report(t: Tables) -> DataFrame:
    """A daily report written as one JSON file and read back."""
    path = new_folder(t.spark, "report")
    daily = t.orders.groupBy(F.to_date("o_orderdate").alias("order_date")).agg(
        F.count(F.lit(1)).alias("orders_total")
    )
    write_json(daily, path, single_file=True)
    return t.spark.read.schema("order_date DATE, orders_total BIGINT").json(path)


@query(
    "scan_parquet",
    """
    SELECT count(*) AS row_count, count(DISTINCT user_id) AS users, min(event_id) AS first_id,
           max(event_id) AS last_id, CAST(sum(length(props)) AS BIGINT) AS prop_chars,
           CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total,
           CAST(sum(length(event_type)) AS BIGINT) AS type_chars, epoch_us(max(ts)) AS last_us
    FROM events
    """,
)
def scan_parquet(t: Tables) -> DataFrame:
    """Every column of every row takes part."""
    return t.events.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct("user_id").alias("users"),
        F.min("event_id").alias("first_id"),
        F.max("event_id").alias("last_id"),
        F.sum(F.length("props")).alias("prop_chars"),
        F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("total"),
        F.sum(F.length("event_type")).alias("type_chars"),
        F.unix_micros(F.max("ts").cast("timestamp")).alias("last_us"),
    )


@query(
    "sql_view",
    "SELECT o_orderstatus, count(*) AS row_count FROM orders WHERE o_totalprice > 100000 GROUP BY 1",
)
def sql_view(t: Tables) -> DataFrame:
    t.orders.createOrReplaceTempView("tidemark_view")
    return t.spark.sql(
        "SELECT o_orderstatus, count(*) AS row_count FROM tidemark_view "
        "WHERE o_totalprice > :least GROUP BY o_orderstatus",
        args={"least": 100_000},
    )


@query(
    "literal_rows",
    """
    SELECT v.label, count(*) AS row_count FROM orders
    JOIN (VALUES ('F', 'finished'), ('O', 'open')) v(status, label) ON o_orderstatus = v.status
    GROUP BY 1
    """,
)
def literal_rows(t: Tables) -> DataFrame:
    labels = t.spark.createDataFrame(
        [("F", "finished"), ("O", "open")], "o_orderstatus STRING, label STRING"
    )
    return R.join_broadcast(t.orders, labels, "o_orderstatus").groupBy("label").agg(
        F.count(F.lit(1)).alias("row_count")
    )


@query(
    "project_rename",
    "SELECT l_orderkey AS order_id, l_partkey AS part, l_quantity AS qty FROM lineitem",
)
def project_rename(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("part"),
        F.col("l_quantity").alias("qty"),
    )


@query(
    "rename_prefix",
    "SELECT r_regionkey AS region_r_regionkey, r_name AS region_r_name, n_name AS region_n_name, "
    "count(*) AS customers FROM region JOIN nation ON n_regionkey = r_regionkey "
    "JOIN customer ON c_nationkey = n_nationkey GROUP BY 1, 2, 3",
)
def rename_prefix(t: Tables) -> DataFrame:
    places = t.region.join(t.nation, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "r_regionkey", "r_name", "n_name", "n_nationkey"
    )
    named = places.withColumnsRenamed(
        {c: f"region_{c}" for c in places.columns if c != "n_nationkey"}
    )
    per_nation = R.group_count(t.customer, ["c_nationkey"], "customers")
    return per_nation.join(named, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "region_r_regionkey", "region_r_name", "region_n_name", "customers"
    )


@query(
    "computed_cols",
    """
    SELECT o_orderkey, o_custkey % 10 AS bucket, o_totalprice * 2 AS doubled,
           CAST(o_orderdate AS DATE) AS order_date,
           CASE WHEN o_totalprice >= 250000 THEN 'large' ELSE 'small' END AS size_class FROM orders
    """,
)
def computed_cols(t: Tables) -> DataFrame:
    return (
        t.orders.withColumns(
            {
                "bucket": F.col("o_custkey") % 10,
                "doubled": F.col("o_totalprice") * 2,
                "order_date": F.to_date("o_orderdate"),
                "size_class": F.when(F.col("o_totalprice") >= 250_000, "large").otherwise("small"),
            }
        )
        .drop("o_custkey", "o_totalprice", "o_orderdate", "o_orderstatus", "o_orderpriority")
    )


@query(
    "filter_date_count",
    f"WITH {CLICKS} SELECT count(*) AS row_count FROM c WHERE date = '2024-01-15'",
)
def filter_date_count(t: Tables) -> DataFrame:
    """Written with a date text, counted with the filter pushed into the scan."""
    events = stored_events(t, "parquet", "SNAPPY")
    return events.filter(F.col("date") == "2024-01-15").agg(F.count(F.lit(1)).alias("row_count"))


@query(
    "sample_rows",
    f"""
    SELECT o_orderkey, o_totalprice FROM orders
    WHERE CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8) AS BIGINT) < {int(0.1 * 2**32)}
    """,
)
def sample_rows(t: Tables) -> DataFrame:
    """A tenth of the orders by a digest of their key."""
    return R.sample_by_key(t.orders, "o_orderkey", 0.1).select("o_orderkey", "o_totalprice")


@query("sample_mod", "SELECT o_orderkey, o_totalprice + 100 AS amount FROM orders WHERE o_orderkey % 10 < 2")
def sample_mod(t: Tables) -> DataFrame:
    """A repeatable share of the rows, the form used for updates."""
    return t.orders.filter(F.col("o_orderkey") % 10 < 2).select(
        "o_orderkey", (F.col("o_totalprice") + 100).alias("amount")
    )


@query("limit_ordered", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 1000")
def limit_ordered(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_totalprice").orderBy("o_orderkey").limit(1000)


@query(
    "nested_explode",
    """
    SELECT l_orderkey AS key, l_partkey % 100 AS subid,
           unnest([l_orderkey % 10, l_orderkey % 10 + 1, l_orderkey % 10 + 2]) AS value FROM lineitem
    """,
)
def nested_explode(t: Tables) -> DataFrame:
    n = F.col("l_orderkey")
    nested = t.lineitem.select(
        n.alias("key"),
        F.struct((F.col("l_partkey") % 100).alias("subid"), (n % 5).alias("flag")).alias("meta"),
        F.array(*(n % 10 + i for i in range(3))).alias("values"),
    )
    return R.flatten_nested(nested, "values", ["key", "meta.subid"])


@query(
    "nested_explode_outer",
    """
    SELECT l_orderkey AS key, unnest(CASE WHEN l_linenumber = 1 THEN [NULL]
           ELSE [l_partkey, l_suppkey] END) AS value FROM lineitem
    """,
)
def nested_explode_outer(t: Tables) -> DataFrame:
    """Rows without elements stay, with a null."""
    values = F.when(F.col("l_linenumber") != 1, F.array("l_partkey", "l_suppkey")).otherwise(
        F.array().cast("array<bigint>")
    )
    rows = t.lineitem.select(F.col("l_orderkey").alias("key"), values.alias("values"))
    return R.flatten_nested(rows, "values", ["key"], outer=True)


# --- data derived from the keys of the tables -------------------------------------------------

# The row number of a line item or an event, in Spark and DuckDB alike.
_ROW_OF = {"lineitem": "l_orderkey * 8 + l_linenumber", "events": "event_id"}


def _ids(t: Tables, table: str) -> DataFrame:
    return getattr(t, table).select(F.expr(_ROW_OF[table]).cast("bigint").alias("id"))


_IDS = {table: f"(SELECT CAST({row} AS BIGINT) AS id FROM {table})" for table, row in _ROW_OF.items()}


@query(
    "range_source",
    f"""
    SELECT id % 1000 AS key, CAST(sum(id % 1000) AS BIGINT) AS sum, avg(id % 1000) AS avg,
           min(id % 1000) AS min FROM {_IDS['lineitem']} GROUP BY 1
    """,
)
def range_source(t: Tables) -> DataFrame:
    return R.multi_agg(G.key_value(_ids(t, "lineitem")), ["key"], "value")


@query(
    "orders_gen",
    f"""
    SELECT 'country_' || (id % 200) AS country_name, count(*) AS row_count,
           CAST(sum(CAST('0x' || substr(sha256(CAST(id AS VARCHAR)), 1, 8) AS BIGINT) % 10000) AS BIGINT)
           AS amount_sum, max(id % 1000000) AS last_ts
    FROM {_IDS['lineitem']} GROUP BY 1
    """,
)
def orders_gen(t: Tables) -> DataFrame:
    orders = G.derived(_ids(t, "lineitem"), G.ORDER_COLUMNS)
    return (
        R.join_broadcast(orders, G.country_names(orders), "country_id")
        .groupBy("country_name")
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.sum("amount").alias("amount_sum"),
            F.max("ts").alias("last_ts"),
        )
    )


@query(
    "skewed_gen",
    f"""
    SELECT CASE WHEN id % 10000 < 9000 THEN 'HOT_KEY' ELSE 'K_' || (id % 10000 % 1000) END AS key,
           count(*) AS cnt, CAST(sum(id % 1000) AS BIGINT) AS total
    FROM {_IDS['lineitem']} GROUP BY 1
    """,
)
def skewed_gen(t: Tables) -> DataFrame:
    rows = G.derived(_ids(t, "lineitem"), G.SKEWED_COLUMNS)
    return R.salted_agg(
        rows, "key", "row_id", 10, {"cnt": ("count", "*"), "total": ("sum", "value")}
    )


def _draw(stream: int, seed: int = 42) -> str:
    m = G.DRAW_MODULUS
    mixed = f"((id % {m}) * 48271 + {seed * 1_000_003 + stream * 69_621})"
    return f"((({mixed} % {m}) * 16807 + {stream}) % {m})"


@query(
    "grouped_gen",
    f"""
    SELECT CAST(id % 100 AS INTEGER) AS group_id, count(*) AS row_count,
           round(sum(CAST({_draw(0)} AS DOUBLE) / {G.DRAW_MODULUS}), 5) AS total
    FROM {_IDS['lineitem']} GROUP BY 1
    """,
)
def grouped_gen(t: Tables) -> DataFrame:
    rows = G.grouped_values(_ids(t, "lineitem"))
    return rows.groupBy("group_id").agg(
        F.count(F.lit(1)).alias("row_count"), F.round(F.sum("value"), 5).alias("total")
    )


@query(
    "star_gen",
    f"""
    WITH f AS (SELECT id AS n FROM {_IDS['lineitem']}),
    s AS (SELECT (n * 17) % 10000 + 1 AS c, (n * 13) % 1000 + 1 AS p, n % 5 + 1 AS q, n % 10 AS d,
                 make_date(2024, (n * 7) % 12 + 1, (n * 11) % 28 + 1) AS day FROM f)
    SELECT {str(G.REGIONS)}[(c - 1) % 5 + 1] AS region, {str(G.CATEGORIES)}[(p - 1) % 5 + 1] AS category,
           CAST(sum(round(CAST(q * (1000 + (p * 13) % 4000) * (100 - d) AS DECIMAL(18,0)) / 10000, 2)::DECIMAL(18,2)) AS DOUBLE)
           AS revenue, count(*) AS orders_cnt, count(DISTINCT day) AS days
    FROM s GROUP BY 1, 2
    """,
)
def star_gen(t: Tables) -> DataFrame:
    star = G.star_schema(_ids(t, "lineitem"))
    return (
        star["fact_sales"]
        .join(star["dim_customers"], "customer_id")
        .join(star["dim_products"], "product_id")
        .groupBy("region", "category")
        .agg(
            F.sum("amount").cast("double").alias("revenue"),
            F.count(F.lit(1)).alias("orders_cnt"),
            F.count_distinct("sale_date").alias("days"),
        )
    )


@query(
    "click_gen",
    f"""
    SELECT {str(G.EVENT_KINDS)}[{_draw(3)} % 6 + 1] AS event_type, count(*) AS row_count,
           strftime(max(DATE '2024-01-01' + CAST({_draw(1)} % 365 AS INTEGER)), '%Y-%m-%d') AS last_date,
           CAST(sum({_draw(8)} % 10) AS BIGINT) AS clicks,
           CAST(sum({_draw(9)} % 1000 + 100) AS BIGINT) AS impressions,
           count(DISTINCT 'https://example.com/page/' || ({_draw(4)} % 10000)) AS urls,
           round(avg(CAST({_draw(7)} AS DOUBLE) / {G.DRAW_MODULUS} * 100.0), 6) AS mean_value
    FROM {_IDS['events']} GROUP BY 1
    """,
)
def click_gen(t: Tables) -> DataFrame:
    return (
        G.click_events(_ids(t, "events"))
        .groupBy("event_type")
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.max("date").alias("last_date"),
            F.sum("metrics.clicks").alias("clicks"),
            F.sum("metrics.impressions").alias("impressions"),
            F.count_distinct("url").alias("urls"),
            F.round(F.avg("value"), 6).alias("mean_value"),
        )
    )
