"""Salary, work mode, type and place; facets."""

from pyspark.sql import functions as F

from checkset import sql
from gleanspark.functions import classify
from gleanspark.operators import facets, paging
from gleanspark.sources.pages import read_table


def price(sign, col):
    return F.concat(F.lit(sign), F.col(col).cast("decimal(12,2)").cast("string"))


def classify_preferences(spark, sf):
    key = F.col("o_orderkey")
    mode = F.element_at(
        F.array(*map(F.lit, ["On-site", "Hybrid", "Remote", "Remote "])), (key % 4 + 1).cast("int")
    )
    items = F.concat(
        F.when(key % 5 != 0, F.array(price("$", "o_totalprice"), F.lit(" "))).otherwise(
            F.array().cast("array<string>")
        ),
        F.array(mode, F.lit("\n")),
        F.when(key % 7 != 0, F.array(F.col("o_orderpriority"))).otherwise(
            F.array(F.lit("€5 bonus"))
        ),
    )
    kinds = classify.classify_preferences(items)
    return read_table(spark, sf, "orders").select("o_orderkey", kinds.alias("k")).select(
        "o_orderkey", "k.*"
    )


def split_salary_type(spark, sf):
    key = F.col("l_orderkey") + F.col("l_linenumber")
    flag, sum_of_money = F.col("l_returnflag"), price("£", "l_extendedprice")
    items = (
        F.when(key % 6 == 0, F.array().cast("array<string>"))
        .when(key % 6 == 1, F.array(sum_of_money, F.concat(F.lit("- "), flag)))
        .when(key % 6 == 2, F.array(F.lit("Competitive"), F.concat(F.lit("- "), flag)))
        .when(key % 6 == 3, F.array(flag))
        .when(key % 6 == 4, F.array(F.concat(sum_of_money, F.lit(" a year"))))
        .otherwise(F.array(flag, sum_of_money, F.col("l_linestatus")))
    )
    pay = classify.split_salary_type(items)
    return read_table(spark, sf, "lineitem").select(
        "l_orderkey", F.col("l_linenumber").cast("bigint"), pay.alias("p")
    ).select("l_orderkey", "l_linenumber", "p.*")


def normalise_salary(spark, sf):
    key, amount = F.col("o_orderkey"), price("", "o_totalprice")
    label = (
        F.when(key % 5 == 0, F.concat(F.lit("$"), amount, F.lit(" - $"), amount, F.lit(" a year")))
        .when(key % 5 == 1, F.concat(F.lit("€"), amount, F.lit(" an hour")))
        .when(key % 5 == 2, F.concat(F.lit("£1,"), amount, F.lit(" £2 £3")))
        .when(key % 5 == 3, F.concat(F.lit("Up to "), amount))
    )
    labels = read_table(spark, sf, "orders").select(
        F.lit("orders").alias("origin"), key.alias("id"), label.alias("label")
    )
    texts = read_table(spark, sf, "documents").select(
        F.lit("documents").alias("origin"),
        F.col("doc_id").alias("id"),
        F.col("text").alias("label"),
    )
    return labels.unionByName(texts).select(
        "origin", "id", classify.normalise_salary(F.col("label")).alias("salary")
    )


def has_currency(spark, sf):
    return read_table(spark, sf, "documents").select(
        "doc_id", classify.has_currency(F.col("text")).alias("has_currency")
    )


def resolve_location(spark, sf):
    key = F.col("c_custkey")
    place = (
        read_table(spark, sf, "nation")
        .join(read_table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("n_nationkey", "n_name", "r_name")
    )
    customers = read_table(spark, sf, "customer").join(
        place, F.col("c_nationkey") == F.col("n_nationkey")
    )
    office = F.concat(F.col("c_name"), F.lit(" Office"))
    header = (
        F.when(key % 7 == 0, F.array().cast("array<string>"))
        .when(key % 7 == 1, F.array(office, F.lit("Remote"), F.col("n_name")))
        .when(key % 7 == 2, F.array(F.lit("Hybrid work"), F.lit("Remote")))
        .when(key % 7 == 3, F.array(F.col("r_name"), F.lit("Hybrid work"), office, F.col("n_name")))
        .when(key % 7 == 4, F.array(F.lit("Remote")))
        .when(key % 7 == 5, F.array(office, office))
        .otherwise(F.array(F.lit("Remote"), F.lit("Remote"), F.col("n_name")))
    )
    company = F.when(key % 3 != 0, F.col("c_name")).otherwise(F.lit(""))
    found = classify.resolve_location(header, company)
    return customers.select("c_custkey", found.alias("f")).select("c_custkey", "f.*")


def facet_filter(spark, sf):
    columns = ["o_orderkey", "o_orderstatus", "o_orderpriority"]
    orders = read_table(spark, sf, "orders").select(*columns)
    return facets.facet_filter(
        orders,
        {
            "o_orderstatus": ["f", "x"],
            "o_orderpriority": ["1-urgent", "2-high", "0-now"],
        },
    )


def facet_filter_not_offered(spark, sf):
    part = read_table(spark, sf, "part").select("p_partkey", "p_brand", "p_type")
    return facets.facet_filter(
        part, {"p_brand": ["brand#1", "brand#2", "brand#3"], "p_type": ["remote"]}
    )


def most_recent(spark, sf):
    columns = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate"]
    orders = read_table(spark, sf, "orders").select(*columns)
    return paging.most_recent(orders, "o_orderdate", "o_orderkey", 20).select(
        "o_orderkey", "o_custkey", "o_orderstatus"
    )


QUERIES = {
    "classify_preferences": classify_preferences,
    "split_salary_type": split_salary_type,
    "normalise_salary": normalise_salary,
    "has_currency": has_currency,
    "resolve_location": resolve_location,
    "facet_filter": facet_filter,
    "facet_filter_not_offered": facet_filter_not_offered,
    "most_recent": most_recent,
}

MONEY = "regexp_matches(x, '[$€£]')"
MODES = "x IN ('On-site', 'Hybrid', 'Remote')"


def preferences(items: str) -> str:
    """Select list over a column of items."""
    kept = f"list_filter({items}, lambda x: {sql.norm_ws('x')} <> '')"
    return f"""
        {sql.last(f"list_filter({kept}, lambda x: {MONEY})")} AS salary,
        {sql.last(f"list_filter({kept}, lambda x: {MODES})")} AS remote,
        {sql.last(f"list_filter({kept}, lambda x: NOT {MONEY} AND NOT {MODES})")} AS job_type
    """


def salary_type(items: str) -> str:
    money = f"regexp_matches({items}[1], '[$€£]')"
    return f"""
        CASE WHEN len({items}) = 2 OR {money} THEN {items}[1] END AS salary_text,
        CASE WHEN len({items}) = 2 THEN {items}[2][3:]
             WHEN NOT {money} THEN {items}[1] END AS job_type
    """


def salary(text: str) -> str:
    found = rf"regexp_extract_all({text}, '[$€£]\d*,?\.?\d*')"
    return f"CASE WHEN len({found}) = 2 THEN array_to_string({found}, ' - ') ELSE ({found})[1] END"


def location_steps(source: str, keep: str) -> str:
    """CTEs from ``source(keep, header, company)`` to ``placed(keep, location, remote)``."""
    return f"""
        named AS (
            SELECT *, coalesce(list_position(
                list_transform(header, lambda x: contains(x, company)), TRUE), 0) AS hit
            FROM {source}
        ), moded AS (
            SELECT *, list_filter(header, lambda x, i: i <> hit) AS entries FROM named
        ), marked AS (
            SELECT *, CASE WHEN list_contains(entries, 'Remote') THEN 'Remote'
                           WHEN list_contains(entries, 'Hybrid work') THEN 'Hybrid work'
                           ELSE '' END AS remote
            FROM moded
        ), cut AS (
            SELECT *, CASE WHEN remote = '' THEN 0 ELSE list_position(entries, remote) END AS spot
            FROM marked
        ), placed AS (
            SELECT {keep}, remote,
                   {sql.last("list_filter(entries, lambda x, i: i <> spot)")} AS location
            FROM cut
        )
    """


ORACLE = {
    "classify_preferences": f"""
        WITH given AS (
            SELECT o_orderkey,
                   list_concat(list_concat(
                       CASE WHEN o_orderkey % 5 <> 0
                            THEN ['$' || CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR), ' ']
                            ELSE [] END,
                       [['On-site', 'Hybrid', 'Remote', 'Remote '][o_orderkey % 4 + 1], chr(10)]),
                       CASE WHEN o_orderkey % 7 <> 0 THEN [o_orderpriority]
                            ELSE ['€5 bonus'] END) AS items
            FROM orders
        )
        SELECT o_orderkey, {preferences("items")} FROM given
    """,
    "split_salary_type": f"""
        WITH given AS (
            SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
                   '£' || CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) AS m,
                   l_returnflag AS f, l_linestatus AS s
            FROM lineitem
        ), listed AS (
            SELECT l_orderkey, l_linenumber, CASE (l_orderkey + l_linenumber) % 6
                WHEN 0 THEN CAST([] AS VARCHAR[])
                WHEN 1 THEN [m, '- ' || f]
                WHEN 2 THEN ['Competitive', '- ' || f]
                WHEN 3 THEN [f]
                WHEN 4 THEN [m || ' a year']
                ELSE [f, m, s] END AS items
            FROM given
        )
        SELECT l_orderkey, l_linenumber, {salary_type("items")} FROM listed
    """,
    "normalise_salary": f"""
        WITH given AS (
            SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) AS a
            FROM orders
        ), labels AS (
            SELECT 'orders' AS origin, o_orderkey AS id, CASE o_orderkey % 5
                WHEN 0 THEN '$' || a || ' - $' || a || ' a year'
                WHEN 1 THEN '€' || a || ' an hour'
                WHEN 2 THEN '£1,' || a || ' £2 £3'
                WHEN 3 THEN 'Up to ' || a END AS label
            FROM given
            UNION ALL SELECT 'documents', doc_id, text FROM documents
        )
        SELECT origin, id, {salary("label")} AS salary FROM labels
    """,
    "has_currency": """
        SELECT doc_id, regexp_matches(text, '[$€£]') AS has_currency FROM documents
    """,
    "resolve_location": f"""
        WITH given AS (
            SELECT c_custkey, c_name || ' Office' AS office, n_name, r_name,
                   CASE WHEN c_custkey % 3 <> 0 THEN c_name ELSE '' END AS company
            FROM customer JOIN nation ON c_nationkey = n_nationkey
                          JOIN region ON n_regionkey = r_regionkey
        ), headed AS (
            SELECT c_custkey, company, CASE c_custkey % 7
                WHEN 0 THEN CAST([] AS VARCHAR[])
                WHEN 1 THEN [office, 'Remote', n_name]
                WHEN 2 THEN ['Hybrid work', 'Remote']
                WHEN 3 THEN [r_name, 'Hybrid work', office, n_name]
                WHEN 4 THEN ['Remote']
                WHEN 5 THEN [office, office]
                ELSE ['Remote', 'Remote', n_name] END AS header
            FROM given
        ), {location_steps("headed", "c_custkey")}
        SELECT c_custkey, location, remote FROM placed
    """,
    "facet_filter": """
        SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders
        WHERE (NOT EXISTS (SELECT 1 FROM orders WHERE lower(o_orderstatus) IN ('f', 'x'))
               OR lower(o_orderstatus) IN ('f', 'x'))
          AND (NOT EXISTS (SELECT 1 FROM orders
                           WHERE lower(o_orderpriority) IN ('1-urgent', '2-high', '0-now'))
               OR lower(o_orderpriority) IN ('1-urgent', '2-high', '0-now'))
    """,
    "facet_filter_not_offered": """
        SELECT p_partkey, p_brand, p_type FROM part
        WHERE (NOT EXISTS (SELECT 1 FROM part
                           WHERE lower(p_brand) IN ('brand#1', 'brand#2', 'brand#3'))
               OR lower(p_brand) IN ('brand#1', 'brand#2', 'brand#3'))
          AND (NOT EXISTS (SELECT 1 FROM part WHERE lower(p_type) = 'remote')
               OR lower(p_type) = 'remote')
    """,
    "most_recent": """
        SELECT o_orderkey, o_custkey, o_orderstatus FROM orders
        ORDER BY o_orderdate DESC, o_orderkey LIMIT 20
    """,
}
