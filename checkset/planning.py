"""Work lists: keywords, URLs, pages, batches."""

from pyspark.sql import functions as F

from gleanspark.functions import planning
from gleanspark.operators import paging
from gleanspark.sources.pages import read_pages, read_table

BASE = "https://jobs.example.com"


def keyword_parts(spark, sf):
    """Parts with a search keyword of every quoting style."""
    key, name, brand = F.col("p_partkey"), F.col("p_name"), F.col("p_brand")
    keyword = (
        F.when(key % 23 == 0, F.concat(F.lit('"'), name))
        .when(key % 17 == 0, F.lit(" "))
        .when(key % 4 == 0, F.concat(F.lit('"'), name, F.lit('" '), brand))
        .when(key % 4 == 1, name)
        .when(key % 4 == 2, F.concat(brand, F.lit('"'), name, F.lit('"')))
        .otherwise(F.concat(F.lit("'"), name, F.lit("'"), F.col("p_type")))
    )
    return read_table(spark, sf, "part").select("p_partkey", keyword.alias("keyword"))


KEYWORD_PARTS = """
    keywords AS (
        SELECT p_partkey, CASE
            WHEN p_partkey % 23 = 0 THEN '"' || p_name
            WHEN p_partkey % 17 = 0 THEN ' '
            WHEN p_partkey % 4 = 0 THEN '"' || p_name || '" ' || p_brand
            WHEN p_partkey % 4 = 1 THEN p_name
            WHEN p_partkey % 4 = 2 THEN p_brand || '"' || p_name || '"'
            ELSE '''' || p_name || '''' || p_type END AS keyword
        FROM part
    ), tokens AS (
        SELECT p_partkey, CASE
            WHEN NOT regexp_matches(regexp_replace(keyword,
                '"[^"]*"|''[^'']*''|[^ \\t\\r\\n"''][^ \\t\\r\\n]*', '', 'g'), '["'']')
            THEN regexp_extract_all(keyword,
                '"[^"]*"|''[^'']*''|[^ \\t\\r\\n"''][^ \\t\\r\\n]*') END AS tokens
        FROM keywords
    )
"""


def searches(spark, sf):
    """One search for each part, placed in a nation."""
    nation = read_table(spark, sf, "nation").join(
        read_table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    place = F.concat_ws(" ", "n_name", "r_name")
    return (
        keyword_parts(spark, sf)
        .join(nation, F.col("p_partkey") % 25 == F.col("n_nationkey"))
        .select(F.col("p_partkey").alias("search_id"), "keyword", place.alias("location"))
    )


SEARCHES = f"""
    {KEYWORD_PARTS}, searches AS (
        SELECT p_partkey AS search_id,
               'https://jobs.example.com'
               || CASE WHEN len(tokens) = 0 THEN '/jobs?q'
                       ELSE '/jobs?q=' || array_to_string(tokens, '+') END
               || '&l=' || replace(n_name || ' ' || r_name, ' ', '+') AS search_url
        FROM tokens JOIN nation ON p_partkey % 25 = n_nationkey
                    JOIN region ON n_regionkey = r_regionkey
    )
"""


def split_keywords(spark, sf):
    tokens = planning.split_keywords(F.col("keyword"))
    return (
        keyword_parts(spark, sf)
        .select("p_partkey", F.posexplode_outer(tokens).alias("pos", "token"))
        .withColumn("pos", F.col("pos").cast("bigint"))
    )


def search_url(spark, sf):
    url = planning.search_url(F.lit(BASE), F.col("keyword"), F.col("location"))
    return searches(spark, sf).select("search_id", url.alias("search_url"))


def order_counts(spark, sf, scale):
    counts = read_table(spark, sf, "orders").groupBy("o_custkey").agg(
        (F.count(F.lit(1)) * scale).alias("n_results")
    )
    url = F.concat(F.lit(BASE + "/jobs?q=c"), F.col("o_custkey").cast("string"))
    return counts.withColumn("url", url)


def page_plan_25(spark, sf):
    plan = paging.page_plan_25(order_counts(spark, sf, 50), "n_results", "url")
    return plan.select(
        "o_custkey", F.col("page").cast("bigint"), F.col("start").cast("bigint"), "page_url"
    )


def page_plan_10(spark, sf):
    plan = paging.page_plan_10(order_counts(spark, sf, 1), "n_results", "url")
    return plan.select("o_custkey", F.col("page").cast("bigint"), "start", "page_url")


def count_text(spark, sf):
    key = F.col("o_orderkey")
    digits = key.cast("string")
    commas = F.concat(
        F.floor(key / 1000).cast("string"), F.lit(","), F.lpad((key % 1000).cast("string"), 3, "0")
    )
    label = (
        F.when(key % 5 == 0, F.concat(commas, F.lit(" results")))
        .when(key % 5 == 1, F.concat(digits, F.lit(" jobs")))
        .when(key % 5 == 2, F.concat(F.lit("About "), commas, F.lit(" jobs")))
        .when(key % 5 == 3, F.concat(commas, F.lit("+ results")))
        .otherwise(F.concat(F.lit("1,"), commas, F.lit(" results")))
    )
    labels = read_table(spark, sf, "orders").select(
        F.lit("orders").alias("origin"), key.alias("id"), label.alias("label")
    )
    texts = read_table(spark, sf, "documents").select(
        F.lit("documents").alias("origin"),
        F.col("doc_id").alias("id"),
        F.col("text").alias("label"),
    )
    # As text, since nullable whole numbers differ between data frame readers.
    return labels.unionByName(texts).select(
        "origin",
        "id",
        planning.leading_count(F.col("label")).cast("string").alias("leading_count"),
        planning.first_count(F.col("label")).cast("string").alias("first_count"),
    )


def until_marker(spark, sf):
    events = read_table(spark, sf, "events").select("event_id", "user_id", "ts", "event_type")
    error = F.col("event_type") == "error"
    pages = paging.until_marker(events, "user_id", ["ts", "event_id"], error)
    return pages.select("event_id", "user_id", "event_type")


def while_next(spark, sf):
    turns = read_table(spark, sf, "conversations")
    pages = paging.while_next(turns, "conv_id", "turn", F.length("text") % 3 != 0)
    return pages.select("conv_id", "turn", "role")


def allowed_domains(spark, sf):
    pages = read_pages(spark, f"{sf}/pages.parquet").select("page_id", "url")
    return paging.allowed_domains(pages, "url", ["example.org", "blog.tionsh.example.net"])


def in_domain_table(spark, sf):
    """Pages below the domains of pages without a secure address."""
    pages = read_pages(spark, f"{sf}/pages.parquet").select("page_id", "url")
    domain = F.regexp_extract("url", r"^http://[^/?#]*?([^./]+\.[^./]+\.[^./?#]+)(?:[/?#]|$)", 1)
    domains = pages.select(domain.alias("domain")).where("domain <> ''")
    return paging.in_domain_table(pages, "url", domains)


def assign_batches(spark, sf):
    orders = read_table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return paging.assign_batches(orders, "o_custkey", "o_orderkey", 3)


def assign_batches_overall(spark, sf):
    orders = read_table(spark, sf, "orders").select("o_orderkey")
    return paging.assign_batches(orders, [], "o_orderkey", 10)


def cap_per_search(spark, sf):
    orders = read_table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return paging.cap_per_search(orders, "o_custkey", "o_orderkey", 5)


QUERIES = {
    "split_keywords": split_keywords,
    "search_url": search_url,
    "page_plan_25": page_plan_25,
    "page_plan_10": page_plan_10,
    "count_text": count_text,
    "until_marker": until_marker,
    "while_next": while_next,
    "allowed_domains": allowed_domains,
    "in_domain_table": in_domain_table,
    "assign_batches": assign_batches,
    "assign_batches_overall": assign_batches_overall,
    "cap_per_search": cap_per_search,
}

ORACLE = {
    "split_keywords": f"""
        WITH {KEYWORD_PARTS}
        SELECT p_partkey, unnest(range(len(tokens))) AS pos, unnest(tokens) AS token FROM tokens
        UNION ALL SELECT p_partkey, NULL, NULL FROM tokens WHERE coalesce(len(tokens), 0) = 0
    """,
    "search_url": f"WITH {SEARCHES} SELECT search_id, search_url FROM searches",
    "page_plan_25": """
        WITH counts AS (
            SELECT o_custkey, 50 * count(*) AS n FROM orders GROUP BY o_custkey
        ), planned AS (
            SELECT o_custkey,
                   unnest(range(CAST(CASE WHEN n >= 1000 THEN 40 ELSE ceil(n / 25) END AS BIGINT)))
                   AS page
            FROM counts
        )
        SELECT o_custkey, page, page * 25 AS start,
               'https://jobs.example.com/jobs?q=c' || o_custkey || '&start=' || (page * 25)
               AS page_url
        FROM planned
    """,
    "page_plan_10": """
        WITH counts AS (
            SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey
        ), planned AS (
            SELECT o_custkey, unnest(range(CASE WHEN n <= 15 THEN 1 ELSE 67 END)) AS page
            FROM counts
        )
        SELECT o_custkey, page, page || '0' AS start,
               'https://jobs.example.com/jobs?q=c' || o_custkey || '&start=' || page || '0'
               AS page_url
        FROM planned
    """,
    "count_text": r"""
        WITH commas AS (
            SELECT o_orderkey,
                   (o_orderkey // 1000) || ',' || lpad(CAST(o_orderkey % 1000 AS VARCHAR), 3, '0')
                   AS c
            FROM orders
        ), labels AS (
            SELECT 'orders' AS origin, o_orderkey AS id, CASE o_orderkey % 5
                WHEN 0 THEN c || ' results'
                WHEN 1 THEN o_orderkey || ' jobs'
                WHEN 2 THEN 'About ' || c || ' jobs'
                WHEN 3 THEN c || '+ results'
                ELSE '1,' || c || ' results' END AS label
            FROM commas
            UNION ALL SELECT 'documents', doc_id, text FROM documents
        ), found AS (
            SELECT origin, id, split_part(replace(label, ',', ''), ' ', 1) AS lead,
                   replace(regexp_extract(label, '\d*,?\d+'), ',', '') AS first
            FROM labels
        )
        SELECT origin, id,
               CASE WHEN regexp_matches(lead, '^\s*[+-]?[0-9]+\s*$')
                    THEN CAST(TRY_CAST(trim(lead) AS BIGINT) AS VARCHAR) END AS leading_count,
               CAST(TRY_CAST(first AS BIGINT) AS VARCHAR) AS first_count
        FROM found
    """,
    "until_marker": """
        SELECT event_id, user_id, event_type FROM events
        QUALIFY coalesce(bool_or(event_type = 'error') OVER (
            PARTITION BY user_id ORDER BY ts, event_id
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), FALSE) = FALSE
    """,
    "while_next": """
        SELECT conv_id, turn, role FROM conversations
        QUALIFY coalesce(bool_or(length(text) % 3 = 0) OVER (
            PARTITION BY conv_id ORDER BY turn
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), FALSE) = FALSE
    """,
    "allowed_domains": """
        WITH hosts AS (
            SELECT page_id, url, lower(regexp_extract(url, '^[a-z]+://([^/?#:]*)', 1)) AS host
            FROM pages
        )
        SELECT page_id, url FROM hosts
        WHERE host IN ('example.org', 'blog.tionsh.example.net')
           OR host LIKE '%.example.org' OR host LIKE '%.blog.tionsh.example.net'
    """,
    "in_domain_table": """
        WITH hosts AS (
            SELECT page_id, url, string_split(regexp_extract(url, '^[a-z]+://([^/?#:]*)', 1), '.')
                   AS labels
            FROM pages
        ), known AS (
            SELECT DISTINCT array_to_string(labels[-3:], '.') AS domain FROM hosts
            WHERE url LIKE 'http://%'
        )
        SELECT page_id, url FROM hosts
        WHERE array_to_string(labels[-3:], '.') IN (SELECT domain FROM known)
    """,
    "assign_batches": """
        WITH placed AS (
            SELECT o_orderkey, o_custkey,
                   row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS pos
            FROM orders
        )
        SELECT o_orderkey, o_custkey, pos // 3 AS batch, pos % 3 AS slot FROM placed
    """,
    "assign_batches_overall": """
        WITH placed AS (
            SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS pos FROM orders
        )
        SELECT o_orderkey, pos // 10 AS batch, pos % 10 AS slot FROM placed
    """,
    "cap_per_search": """
        SELECT o_orderkey, o_custkey FROM orders
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) <= 5
    """,
}
