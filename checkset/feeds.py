"""Scans and sinks."""

from pyspark.sql import functions as F

from gleanspark.sources import feeds
from gleanspark.sources.pages import read_table
from gleanspark.workspace import fresh_path


def csv_roundtrip(spark, sf):
    df = read_table(spark, sf, "customer")
    path = fresh_path(spark, "feed")
    feeds.write_feed(df, path)
    return feeds.read_feed(spark, path, df.schema)


def csv_roundtrip_text(spark, sf):
    df = read_table(spark, sf, "documents").select("doc_id", "text")
    path = fresh_path(spark, "feed")
    feeds.write_feed(df, path)
    return feeds.read_feed(spark, path, df.schema)


def csv_roundtrip_strings(spark, sf):
    df = read_table(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_size")
    path = fresh_path(spark, "feed")
    feeds.write_feed(df, path)
    return feeds.read_feed(spark, path, all_string=True)


def csv_inferred(spark, sf):
    key = F.col("o_orderkey")
    df = read_table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(key % 7 == 0, F.lit("NA")).otherwise(F.col("o_custkey").cast("string")).alias("cust"),
        F.when(key % 5 == 0, F.lit("n/a"))
        .otherwise((key / 4).cast("string"))
        .alias("quarter"),
        F.when(key % 3 == 0, F.lit("")).otherwise((key % 2 == 0).cast("string")).alias("even"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"),
        F.lit("None").alias("nothing"),
        # The last two differ in what a double cannot tell apart.
        (key + 1234567890123456780).cast("string").alias("id19"),
        F.concat(F.lit("1234567890123456"), F.lpad((key % 10000).cast("string"), 4, "0")).alias("id20"),
    )
    path = fresh_path(spark, "feed")
    feeds.write_feed(df, path)
    return feeds.read_feed(spark, path)


def rewrite_feed(spark, sf):
    part = read_table(spark, sf, "part").select(F.col("p_partkey").cast("string"), "p_name")
    headers = part.where("p_partkey % 10 = 0").select(
        F.lit("p_partkey").alias("p_partkey"), F.lit("p_name").alias("p_name")
    )
    path = fresh_path(spark, "feed")
    feeds.write_feed(part.unionByName(headers), path)
    feeds.rewrite_without_headers(spark, path)
    return feeds.read_feed(spark, path, all_string=True)


def null_tokens(spark, sf):
    kind = F.col("event_type")
    marked = (
        F.when(kind == "error", F.lit("NA"))
        .when(kind == "view", F.lit(""))
        .when(kind == "signup", F.lit("None"))
        .otherwise(kind)
    )
    df = read_table(spark, sf, "events").select("event_id", marked.alias("event_type"))
    return feeds.null_tokens(df)


def overwrite_feed(spark, sf):
    df = read_table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    path = fresh_path(spark, "feed")
    feeds.write_feed(df.where("s_suppkey % 2 = 0"), path)
    feeds.write_feed(df, path, mode="overwrite")
    return feeds.read_feed(spark, path, df.schema)


def drop_header_rows(spark, sf):
    part = read_table(spark, sf, "part")
    rows = part.select(F.col("p_partkey").cast("string"), "p_name")
    headers = part.where("p_partkey % 10 = 0").select(
        F.lit("p_partkey").alias("p_partkey"), F.lit("p_name").alias("p_name")
    )
    nulls = part.where("p_partkey % 15 = 0").select(
        F.lit(None).cast("string").alias("p_partkey"), "p_name"
    )
    return feeds.drop_header_rows(rows.unionByName(headers).unionByName(nulls))


def fill_blank(spark, sf):
    customer = read_table(spark, sf, "customer").select("c_custkey", "c_name")
    orders = read_table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    joined = customer.join(orders, F.col("c_custkey") == F.col("o_custkey"), "left")
    return feeds.fill_blank(joined)


def redelivered_tab(spark, sf):
    """A batch sent again without rows is gone; one sent again with others is replaced."""
    df = read_table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    dest = fresh_path(spark, "tabs")
    feeds.append_tab(df, dest, "Data", "first")
    feeds.append_tab(df, dest, "Data", "a/b=%1")
    feeds.append_tab(df.where("c_custkey % 3 = 0"), dest, "Data", "a/b=%1")
    feeds.append_tab(df.where("c_custkey < 0"), dest, "Data", "first")
    return feeds.read_tab(spark, dest, "Data", df.columns)


def compacted_tab(spark, sf):
    """Deliveries are packed twice; between, one is sent again and one is emptied."""
    df = read_table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    dest = fresh_path(spark, "tabs")
    for i in range(3):
        feeds.append_tab(df.where(F.col("c_custkey") % 3 == i), dest, "Data", f"a/b={i}")
    feeds.compact_tab(spark, dest, "Data", df.columns)
    feeds.append_tab(df.where("c_custkey % 5 = 0"), dest, "Data", "a/b=1")
    feeds.append_tab(df.where("c_custkey < 0"), dest, "Data", "a/b=2")
    feeds.compact_tab(spark, dest, "Data", df.columns)
    return feeds.read_tab(spark, dest, "Data", df.columns)


def append_tab(spark, sf):
    df = read_table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    some = F.when(F.col("c_custkey") % 4 != 0, F.col("c_mktsegment"))
    df = df.withColumn("c_mktsegment", some)
    dest = fresh_path(spark, "tabs")
    feeds.append_tab(df, dest, "Data", "first")
    feeds.append_tab(df, dest, "Other", "first")
    feeds.append_tab(df, dest, "Data", "second")
    feeds.append_tab(df, dest, "Data", "second")
    tab = feeds.read_tab(spark, dest, "Data", df.columns)
    return tab.groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("c_custkey").alias("n_customers")
    )


QUERIES = {
    "csv_roundtrip": csv_roundtrip,
    "csv_roundtrip_text": csv_roundtrip_text,
    "csv_roundtrip_strings": csv_roundtrip_strings,
    "csv_inferred": csv_inferred,
    "rewrite_feed": rewrite_feed,
    "redelivered_tab": redelivered_tab,
    "compacted_tab": compacted_tab,
    "null_tokens": null_tokens,
    "overwrite_feed": overwrite_feed,
    "drop_header_rows": drop_header_rows,
    "fill_blank": fill_blank,
    "append_tab": append_tab,
}

ORACLE = {
    "csv_roundtrip": "SELECT * FROM customer",
    "csv_roundtrip_text": "SELECT doc_id, text FROM documents",
    "csv_roundtrip_strings": """
        SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, p_brand,
               CAST(p_size AS VARCHAR) AS p_size
        FROM part
    """,
    "csv_inferred": """
        SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey,
               CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_custkey AS INTEGER) END AS cust,
               CASE WHEN o_orderkey % 5 <> 0 THEN o_orderkey / 4 END AS quarter,
               CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey % 2 = 0 END AS even,
               strftime(o_orderdate, '%Y-%m-%d') AS day, CAST(NULL AS VARCHAR) AS nothing,
               o_orderkey + 1234567890123456780 AS id19,
               '1234567890123456' || lpad(CAST(o_orderkey % 10000 AS VARCHAR), 4, '0') AS id20
        FROM orders
    """,
    "rewrite_feed": "SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name FROM part",
    "compacted_tab": """
        SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_mktsegment FROM customer
        WHERE c_custkey % 3 = 0
        UNION ALL SELECT CAST(c_custkey AS VARCHAR), c_mktsegment FROM customer
        WHERE c_custkey % 5 = 0
    """,
    "redelivered_tab": """
        SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_mktsegment FROM customer
        WHERE c_custkey % 3 = 0
    """,
    "null_tokens": """
        WITH marked AS (
            SELECT event_id,
                   CASE event_type WHEN 'error' THEN 'NA' WHEN 'view' THEN ''
                        WHEN 'signup' THEN 'None' ELSE event_type END AS event_type
            FROM events
        )
        SELECT event_id,
               CASE WHEN event_type NOT IN ('', 'NA', 'N/A', 'NULL', 'None', 'nan', 'null')
                    THEN event_type END AS event_type
        FROM marked
    """,
    "overwrite_feed": "SELECT s_suppkey, s_name, s_nationkey FROM supplier",
    "drop_header_rows": """
        WITH feed AS (
            SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name FROM part
            UNION ALL SELECT 'p_partkey', 'p_name' FROM part WHERE p_partkey % 10 = 0
            UNION ALL SELECT NULL, p_name FROM part WHERE p_partkey % 15 = 0
        )
        SELECT p_partkey, p_name FROM feed WHERE p_partkey IS DISTINCT FROM 'p_partkey'
    """,
    "fill_blank": """
        SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, coalesce(c_name, '') AS c_name,
               coalesce(CAST(o_orderkey AS VARCHAR), '') AS o_orderkey,
               coalesce(CAST(o_custkey AS VARCHAR), '') AS o_custkey,
               coalesce(o_orderstatus, '') AS o_orderstatus
        FROM customer LEFT JOIN orders ON o_custkey = c_custkey
    """,
    "append_tab": """
        WITH delivered AS (
            SELECT c_custkey, CASE WHEN c_custkey % 4 <> 0 THEN c_mktsegment ELSE '' END
                              AS c_mktsegment
            FROM customer
        ), tab AS (SELECT * FROM delivered UNION ALL SELECT * FROM delivered)
        SELECT c_mktsegment, count(*) AS n_rows, count(DISTINCT c_custkey) AS n_customers
        FROM tab GROUP BY c_mktsegment
    """,
}
