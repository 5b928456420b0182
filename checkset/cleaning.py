"""Text cleaning over whole pages and documents."""

from pyspark.sql import functions as F

from checkset import sql
from gleanspark.functions import text
from gleanspark.functions.extract import extract_all
from gleanspark.operators import containment
from gleanspark.sources.pages import read_pages, read_table

PARAGRAPH = "(?s)<p>(.*?)<(?:/p|br)>"


def clean_html(spark, sf):
    return read_pages(spark, f"{sf}/pages.parquet").select(
        "page_id", text.clean_html(F.col("html")).alias("text")
    )


def norm_ws(spark, sf):
    return read_table(spark, sf, "documents").select(
        "doc_id", text.norm_ws(F.col("text")).alias("text")
    )


def lines(spark, sf):
    return read_table(spark, sf, "documents").select(
        "doc_id", F.split("text", "\n").alias("lines")
    )


def drop_blank(spark, sf):
    kept = text.drop_blank(F.col("lines"))
    filled = text.drop_empty(F.col("lines"))
    return lines(spark, sf).select(
        "doc_id",
        F.array_join(kept, "\n").alias("text"),
        F.size(kept).cast("bigint").alias("n_kept"),
        F.size(filled).cast("bigint").alias("n_filled"),
    )


def remove_contained(spark, sf):
    return lines(spark, sf).select(
        "doc_id", F.array_join(text.remove_contained(F.col("lines")), "\n").alias("text")
    )


def document_lines(spark, sf):
    exploded = lines(spark, sf).select("doc_id", F.posexplode("lines").alias("pos", "line"))
    return exploded.withColumn("pos", F.col("pos").cast("bigint"))


def remove_contained_rows(spark, sf):
    return containment.remove_contained_rows(document_lines(spark, sf), "doc_id", "line")


def posting_links(spark, sf):
    link = F.concat(F.lit("https://jobs.example.com/view/"), F.col("o_orderkey").cast("string"))
    return read_table(spark, sf, "orders").select("o_orderstatus", link.alias("link"))


def remove_contained_links(spark, sf):
    return containment.remove_contained_rows(posting_links(spark, sf), "o_orderstatus", "link")


def remove_contained_items(spark, sf):
    found = containment.remove_contained_items(lines(spark, sf), "doc_id", "lines", 50)
    return found.select("doc_id", F.array_join("lines", "\n").alias("text"))


def clean_description(spark, sf):
    fragments = extract_all(F.col("html"), PARAGRAPH)
    return read_pages(spark, f"{sf}/pages.parquet").select(
        "page_id", text.clean_description(fragments).alias("description")
    )


def clean_description_rows(spark, sf):
    fragments = extract_all(F.col("html"), PARAGRAPH)
    parts = read_pages(spark, f"{sf}/pages.parquet").select(
        "page_id", text.description_parts(fragments).alias("parts")
    )
    found = containment.remove_contained_items(parts, "page_id", "parts", row_items=10)
    return found.select("page_id", F.array_join("parts", "\n").alias("description"))


def dedup_lines(spark, sf):
    return read_table(spark, sf, "documents").select(
        "doc_id", text.dedup_lines(F.col("text")).alias("text")
    )


QUERIES = {
    "clean_html": clean_html,
    "norm_ws": norm_ws,
    "drop_blank": drop_blank,
    "remove_contained": remove_contained,
    "remove_contained_rows": remove_contained_rows,
    "remove_contained_links": remove_contained_links,
    "remove_contained_items": remove_contained_items,
    "clean_description": clean_description,
    "clean_description_rows": clean_description_rows,
    "dedup_lines": dedup_lines,
}

LINES = "lines AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)"
NOT_PART = "len(list_filter({0}, lambda y: x <> y AND contains(y, x))) = 0"

ITEMS_WITHOUT_CONTAINED = f"""
    WITH {LINES}
    SELECT doc_id, array_to_string(list_filter(l, lambda x: {NOT_PART.format("l")}), chr(10)) AS text
    FROM lines
"""

DESCRIPTION = f"""
    WITH found AS (
        SELECT page_id, {sql.elements("html", PARAGRAPH)} AS f FROM pages
    ), filled AS (
        SELECT page_id, list_filter(f, lambda x: x <> '') AS n FROM found
    ), once AS (
        SELECT page_id, {sql.distinct("n")} AS d FROM filled
    )
    SELECT page_id, array_to_string(list_filter(d, lambda x: {NOT_PART.format("d")}), chr(10))
           AS description
    FROM once
"""

ORACLE = {
    "clean_html": f"SELECT page_id, {sql.clean_html('html')} AS text FROM pages",
    "norm_ws": f"SELECT doc_id, {sql.norm_ws('text')} AS text FROM documents",
    "drop_blank": f"""
        WITH {LINES}, kept AS (
            SELECT doc_id, list_filter(l, lambda x: {sql.norm_ws("x")} <> '') AS k,
                   list_filter(l, lambda x: x <> '') AS f
            FROM lines
        )
        SELECT doc_id, array_to_string(k, chr(10)) AS text, len(k) AS n_kept, len(f) AS n_filled
        FROM kept
    """,
    "remove_contained": ITEMS_WITHOUT_CONTAINED,
    "remove_contained_items": ITEMS_WITHOUT_CONTAINED,
    "remove_contained_rows": f"""
        WITH {LINES}, rows AS (
            SELECT doc_id, unnest(range(len(l))) AS pos, unnest(l) AS line FROM lines
        )
        SELECT doc_id, pos, line FROM rows r
        WHERE NOT EXISTS (SELECT 1 FROM rows o WHERE o.doc_id = r.doc_id AND o.line <> r.line
                          AND contains(o.line, r.line))
    """,
    "remove_contained_links": """
        WITH links AS (
            SELECT o_orderstatus, 'https://jobs.example.com/view/' || o_orderkey AS link FROM orders
        )
        SELECT o_orderstatus, link FROM links r
        WHERE NOT EXISTS (SELECT 1 FROM links o WHERE o.o_orderstatus = r.o_orderstatus
                          AND o.link <> r.link AND contains(o.link, r.link))
    """,
    "clean_description": DESCRIPTION,
    "clean_description_rows": DESCRIPTION,
    "dedup_lines": f"""
        WITH {LINES}
        SELECT doc_id, array_to_string({sql.distinct("l")}, chr(10)) AS text FROM lines
    """,
}
