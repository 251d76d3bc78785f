"""Scalar-function queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions import arrays, dates, numbers, text
from tidemark.plans.catalog import query
from tidemark.sources.tables import Tables


@query(
    "scalar_string",
    """
    SELECT p_partkey, len(string_split(p_name, ' ')) AS word_count,
           string_split(p_name, ' ')[1] AS first_word, starts_with(p_name, 'red') AS is_red,
           sha256(p_name) AS digest, CAST(('0x' || substr(sha256(p_name), 1, 8)) AS BIGINT) AS hex_value,
           p_brand || '/' || p_type AS label, 'item-' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') AS code,
           regexp_full_match(CAST(p_size - 20 AS VARCHAR), '-?[0-9]+') AS whole,
           p_name AS trimmed, len(string_split(p_brand || chr(10) || p_type || chr(10), chr(10))) AS line_count,
           TRY_CAST(p_type AS BIGINT) AS not_a_number
    FROM part
    """,
)
def scalar_string(t: Tables) -> DataFrame:
    padded = F.concat(F.lit(" \t"), F.regexp_replace("p_name", " ", "  "), F.lit("\x01 \r"))
    words = text.words_of(text.trim_blanks(padded))
    digest = F.sha2("p_name", 256)
    return t.part.select(
        "p_partkey",
        F.size(words).cast("bigint").alias("word_count"),
        F.get(words, F.lit(0)).alias("first_word"),
        F.col("p_name").startswith("red").alias("is_red"),
        digest.alias("digest"),
        numbers.hex_number(F.substring(digest, 1, 8)).alias("hex_value"),
        F.concat_ws("/", "p_brand", "p_type").alias("label"),
        F.format_string("item-%09d", "p_partkey").alias("code"),
        text.is_integer((F.col("p_size") - 20).cast("string")).alias("whole"),
        F.array_join(words, " ").alias("trimmed"),
        F.size(text.lines_of(F.concat("p_brand", F.lit("\r\n"), "p_type", F.lit("\n"))))
        .cast("bigint")
        .alias("line_count"),
        F.col("p_type").try_cast("bigint").alias("not_a_number"),
    )


@query(
    "scalar_date",
    """
    SELECT o_orderkey, CAST(o_orderdate AS DATE) AS short_day, CAST(o_orderdate AS DATE) AS long_day,
           CAST(NULL AS DATE) AS bad_day, CAST(NULL AS DATE) AS bad_month,
           make_date(2024, o_orderkey % 12 + 1, o_orderkey % 28 + 1) AS made,
           CAST(o_orderdate AS DATE) + 3 AS later, year(o_orderdate) AS y
    FROM orders
    """,
)
def scalar_date(t: Tables) -> DataFrame:
    short = F.date_format("o_orderdate", "dd.MM.yyyy_HH:mm:ss")
    long = F.concat(F.date_format("o_orderdate", "EEE,_d_MMM_yyyy_HH:mm:ss"), F.lit("_-0500"))
    n = F.col("o_orderkey")
    return t.orders.select(
        "o_orderkey",
        dates.parse_date_token(short).alias("short_day"),
        dates.parse_date_token(long).alias("long_day"),
        dates.parse_date_token(F.concat(F.lit("99.99"), F.substring(short, 6, 99))).alias("bad_day"),
        dates.parse_date_token(F.regexp_replace(long, "_[A-Z][a-z]{2}_", "_Abc_")).alias("bad_month"),
        F.make_date(F.lit(2024), (n % 12 + 1).cast("int"), (n % 28 + 1).cast("int")).alias("made"),
        F.date_add(dates.day_of(F.col("o_orderdate")), 3).alias("later"),
        F.year("o_orderdate").cast("bigint").alias("y"),
    )


@query(
    "scalar_math",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
           (l_orderkey - 500) % 7 + CASE WHEN (l_orderkey - 500) % 7 < 0 THEN 7 ELSE 0 END AS slot,
           round(l_extendedprice, 1) AS price, least(l_quantity, l_linenumber) AS smaller,
           round(ln(l_quantity), 6) AS logged, round(exp(l_discount), 6) AS raised,
           CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS quantity_text,
           CASE WHEN l_linenumber > 1 THEN l_quantity / (l_linenumber - 1) END AS per_line
    FROM lineitem
    """,
)
def scalar_math(t: Tables) -> DataFrame:
    lines = F.col("l_linenumber")
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.pmod(F.col("l_orderkey") - 500, F.lit(7)).alias("slot"),
        F.round("l_extendedprice", 1).alias("price"),
        F.least("l_quantity", lines.cast("double")).alias("smaller"),
        F.round(F.ln("l_quantity"), 6).alias("logged"),
        F.round(F.exp("l_discount"), 6).alias("raised"),
        F.col("l_quantity").cast("int").cast("string").alias("quantity_text"),
        F.try_divide("l_quantity", lines - 1).alias("per_line"),
    )


@query(
    "scalar_array",
    """
    WITH a AS (SELECT c_custkey, [c_custkey % 3, c_custkey % 5, c_custkey % 7] AS v,
                      c_mktsegment || ', ' || c_name || ',, x ' AS csv FROM customer)
    SELECT c_custkey, list_contains(v, 2) AS has_two, v[2] AS second,
           CAST(v[9] AS BIGINT) AS missing, array_to_string(list_sort(v), ',') AS sorted,
           array_to_string(v[2:], ',') AS tail,
           array_to_string([trim(x) FOR x IN string_split(csv, ',') IF trim(x) <> ''], '|') AS items,
           CASE WHEN c_custkey % 2 = 0 THEN '-' ELSE 'a,b' END AS listed,
           CAST(c_custkey % 3 + 1 AS BIGINT) AS depth
    FROM a
    """,
)
def scalar_array(t: Tables) -> DataFrame:
    n = F.col("c_custkey")
    v = F.array(n % 3, n % 5, n % 7)
    csv = F.concat("c_mktsegment", F.lit(", "), "c_name", F.lit(",, x "))
    listed = F.when(n % 2 == 0, F.array().cast("array<string>")).otherwise(
        F.array(F.lit("a"), F.lit("b"))
    )
    path = F.concat(F.lit("p"), F.repeat(F.lit("/p"), (n % 3).cast("int")))
    return t.customer.select(
        "c_custkey",
        F.array_contains(v, 2).alias("has_two"),
        F.get(v, F.lit(1)).alias("second"),
        F.try_element_at(v, F.lit(9)).alias("missing"),
        F.array_join(F.sort_array(v).cast("array<string>"), ",").alias("sorted"),
        F.array_join(F.slice(v, 2, 9).cast("array<string>"), ",").alias("tail"),
        F.array_join(arrays.items_of(csv), "|").alias("items"),
        arrays.joined_or_dash(listed).alias("listed"),
        arrays.path_depth(path).cast("bigint").alias("depth"),
    )


@query(
    "scalar_json",
    """
    SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
           '{"id":' || event_id || ',"meta":{"kind":"' || event_type || '"},"values":['
           || (event_id % 3) || ',' || (event_id % 4) || ']}' AS encoded,
           event_type AS kind, event_id % 4 AS last_value, CAST(NULL AS BIGINT) AS broken
    FROM events
    """,
)
def scalar_json(t: Tables) -> DataFrame:
    n = F.col("event_id")
    encoded = F.to_json(
        F.struct(
            n.alias("id"),
            F.struct(F.col("event_type").alias("kind")).alias("meta"),
            F.array(n % 3, n % 4).alias("values"),
        )
    )
    schema = "id BIGINT, meta STRUCT<kind: STRING>, values ARRAY<BIGINT>"
    return t.events.withColumn("encoded", encoded).select(
        "event_id",
        F.from_json("props", "k BIGINT")["k"].alias("k"),
        "encoded",
        F.from_json("encoded", schema)["meta"]["kind"].alias("kind"),
        F.element_at(F.from_json("encoded", schema)["values"], -1).alias("last_value"),
        F.from_json(F.lit("{broken"), "k BIGINT")["k"].alias("broken"),
    )
