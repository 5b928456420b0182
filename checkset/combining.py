"""Joins, unions, look-ups and resuming."""

from pyspark.sql import functions as F

from gleanspark.operators import combine, paging
from gleanspark.schema import POSTING_COLUMNS, SOURCE_A, SOURCE_B
from gleanspark.sources.pages import read_table

DAY = "2024-01-31"


def enrich_company(spark, sf):
    lines = read_table(spark, sf, "lineitem").select(
        "l_orderkey",
        F.col("l_linenumber").cast("bigint"),
        F.when(
            F.col("l_orderkey") % 11 != 0,
            F.concat(F.lit("https://jobs.example.com/cmp/"), F.col("l_suppkey").cast("string")),
        )
        .otherwise(F.lit(""))
        .alias("profile_url"),
    )
    # Only suppliers with some means have a profile.
    supplier = read_table(spark, sf, "supplier").where("s_acctbal > 5000")
    profile = F.concat(F.lit("https://jobs.example.com/cmp/"), F.col("s_suppkey").cast("string"))
    site = F.concat(F.lit("https://"), F.lower(F.replace("s_name", F.lit("#"), F.lit("-"))))
    first = supplier.select(
        profile.alias("profile_url"), F.lit(0).alias("rank"), site.alias("website")
    )
    second = first.select(
        "profile_url", F.lit(1).alias("rank"), F.concat("website", F.lit("/about")).alias("website")
    )
    joined = combine.enrich_company(lines, second.unionByName(first), "rank")
    return joined.select("l_orderkey", "l_linenumber", "website")


def zip_by_position(spark, sf):
    customer = read_table(spark, sf, "customer").select(
        F.col("c_nationkey").alias("nationkey"), "c_custkey", "c_name"
    )
    supplier = read_table(spark, sf, "supplier").select(
        F.col("s_nationkey").alias("nationkey"), "s_suppkey", "s_name"
    )
    return combine.zip_by_position(customer, supplier, "nationkey", "c_custkey", "s_suppkey")


def line_batches(spark, sf):
    lines = read_table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_returnflag"
    )
    # Line numbers repeat, so they cannot order the lines by themselves.
    order = ["l_partkey", "l_linenumber", "l_returnflag"]
    batches = paging.assign_batches(lines, "l_orderkey", order, 3)
    return combine.to_column_lists(
        batches, "l_orderkey", "batch", "slot", ["l_partkey", "l_returnflag"]
    )


def to_column_lists(spark, sf):
    return line_batches(spark, sf).select(
        "l_orderkey",
        "batch",
        F.array_join(F.col("slot").cast("array<string>"), ",").alias("slots"),
        F.array_join(F.col("l_partkey").cast("array<string>"), ",").alias("parts"),
        F.array_join("l_returnflag", ",").alias("flags"),
    )


def from_column_lists(spark, sf):
    return combine.from_column_lists(
        line_batches(spark, sf), ["l_orderkey", "batch"], "slot", ["l_partkey", "l_returnflag"]
    )


def unify_sources(spark, sf):
    customer = read_table(spark, sf, "customer").select(
        F.col("c_mktsegment").alias("job_title"),
        F.concat(F.lit("https://jobs.example.com/c/"), F.col("c_custkey").cast("string")).alias(
            "job_opening_link"
        ),
        F.col("c_name").alias("company_name"),
        F.concat(F.lit("nation "), F.col("c_nationkey").cast("string")).alias("job_location"),
    )
    supplier = read_table(spark, sf, "supplier").select(
        F.concat(F.lit("https://jobs.example.com/s/"), F.col("s_suppkey").cast("string")).alias(
            "job_opening_link"
        ),
        F.col("s_name").alias("company_name"),
        F.concat(F.lit("$"), F.col("s_acctbal").cast("decimal(12,2)").cast("string")).alias(
            "salary"
        ),
    )
    rest_a = [c for c in POSTING_COLUMNS if c not in customer.columns][:-4]
    rest_b = [c for c in POSTING_COLUMNS if c not in supplier.columns][:-4]
    return combine.unify(
        [
            combine.with_lineage(customer, SOURCE_A, DAY, '"Data Scientist"', "New York", rest_a),
            combine.with_lineage(supplier, SOURCE_B, DAY, "python", "", rest_b),
        ]
    )


def lookup_first(spark, sf):
    events = read_table(spark, sf, "events")
    return combine.lookup_first(events, "user_id", ["ts", "event_id"], ["event_id", "event_type"])


def todo_and_done(spark, sf):
    orders = read_table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return orders, orders.where("o_orderstatus = 'F'")


def resume_skip(spark, sf):
    todo, done = todo_and_done(spark, sf)
    return combine.resume_skip(combine.work_list(todo, "o_orderkey"), done, "o_orderkey")


def resume_anti(spark, sf):
    todo, done = todo_and_done(spark, sf)
    return combine.resume_anti(todo, done, "o_orderkey")


QUERIES = {
    "enrich_company": enrich_company,
    "zip_by_position": zip_by_position,
    "to_column_lists": to_column_lists,
    "from_column_lists": from_column_lists,
    "unify_sources": unify_sources,
    "lookup_first": lookup_first,
    "resume_skip": resume_skip,
    "resume_anti": resume_anti,
}

PLACED_LINES = """
    placed AS (
        SELECT l_orderkey, l_partkey, l_returnflag,
               row_number() OVER (PARTITION BY l_orderkey
                                  ORDER BY l_partkey, l_linenumber, l_returnflag) - 1 AS pos
        FROM lineitem
    )
"""

ORACLE = {
    "enrich_company": """
        SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
               CASE WHEN s_suppkey IS NULL THEN ''
                    ELSE 'https://' || lower(replace(s_name, '#', '-')) END AS website
        FROM lineitem LEFT JOIN supplier
             ON l_suppkey = s_suppkey AND s_acctbal > 5000 AND l_orderkey % 11 <> 0
    """,
    "zip_by_position": """
        WITH c AS (
            SELECT c_nationkey AS nationkey, c_custkey, c_name,
                   row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS pos
            FROM customer
        ), s AS (
            SELECT s_nationkey AS nationkey, s_suppkey, s_name,
                   row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) - 1 AS pos
            FROM supplier
        )
        SELECT nationkey, pos, c_custkey, c_name, s_suppkey, s_name
        FROM c JOIN s USING (nationkey, pos)
    """,
    "to_column_lists": f"""
        WITH {PLACED_LINES}
        SELECT l_orderkey, pos // 3 AS batch,
               string_agg(CAST(pos % 3 AS VARCHAR), ',' ORDER BY pos) AS slots,
               string_agg(CAST(l_partkey AS VARCHAR), ',' ORDER BY pos) AS parts,
               string_agg(l_returnflag, ',' ORDER BY pos) AS flags
        FROM placed GROUP BY 1, 2
    """,
    "from_column_lists": f"""
        WITH {PLACED_LINES}
        SELECT l_orderkey, pos // 3 AS batch, pos % 3 AS slot, l_partkey, l_returnflag FROM placed
    """,
    "unify_sources": """
        SELECT c_mktsegment AS job_title, 'https://jobs.example.com/c/' || c_custkey
               AS job_opening_link, '' AS salary, 'nation ' || c_nationkey AS job_location,
               '' AS publication_date, '' AS remote, '' AS job_type, '' AS job_description,
               c_name AS company_name, '' AS company_website, '' AS company_profile_url,
               '"Data Scientist"' AS input_keyword, 'New York' AS input_location,
               '2024-01-31' AS search_date, 'Linkedin' AS source
        FROM customer
        UNION ALL
        SELECT '', 'https://jobs.example.com/s/' || s_suppkey,
               '$' || CAST(CAST(s_acctbal AS DECIMAL(12,2)) AS VARCHAR), '', '', '', '', '',
               s_name, '', '', 'python', '', '2024-01-31', 'Indeed'
        FROM supplier
    """,
    "lookup_first": """
        SELECT user_id, event_id, event_type FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1
    """,
    "resume_skip": """
        SELECT o_orderkey FROM orders
        QUALIFY row_number() OVER (ORDER BY o_orderkey)
                > (SELECT count(*) FROM orders WHERE o_orderstatus = 'F')
    """,
    "resume_anti": """
        SELECT o_orderkey, o_custkey, o_orderstatus FROM orders
        WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')
    """,
}
