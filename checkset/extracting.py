"""Fields from captured pages."""

from pyspark.sql import functions as F

from checkset import sql
from gleanspark.functions import extract, text
from gleanspark.sources.pages import read_pages

TITLE = "(?s)<title>(.*?)</title>"
H1 = "(?s)<h1>(.*?)</h1>"
H2 = "(?s)<h2>(.*?)</h2>"
BOLD = "<b>([^<]*)"
AD = '(?s)<div class="ad">(.*?)</div>'
ASIDE = "(?s)<aside>(.*?)</aside>"
ITEM = "(?s)<li>(.*?)</li>"
LINK = '<a href="[^"]*">[^<]*</a>'


def pages(spark, sf):
    return read_pages(spark, f"{sf}/pages.parquet")


def extract_title(spark, sf):
    html = F.col("html")
    return pages(spark, sf).select(
        "page_id",
        extract.extract_text(html, TITLE).alias("title"),
        extract.extract_text(html, H1).alias("heading"),
        extract.extract_text(html, H2).alias("subheading"),
    )


def extract_first_link(spark, sf):
    html = F.col("html")
    return pages(spark, sf).select(
        "page_id",
        extract.extract_attr(html, "a", "href").alias("link"),
        extract.extract_attr(html, "html", "lang").alias("lang"),
        extract.extract_attr(html, "img", "src").alias("image"),
    )


def first_non_empty(spark, sf):
    texts = [extract.extract_text(F.col("html"), p) for p in (H2, H1, TITLE)]
    return pages(spark, sf).select(
        "page_id", extract.first_non_empty(*texts).alias("heading")
    )


def first_present(spark, sf):
    html = F.col("html")
    found = [extract.if_present(html, p) for p in (H2, BOLD, "<i>([^<]*)")]
    return pages(spark, sf).select(
        "page_id",
        extract.first_present(*found).alias("published"),
        extract.first_present(extract.if_present(html, H2), default="").alias("website"),
    )


def first_non_empty_list(spark, sf):
    html = F.col("html")
    items = extract.first_non_empty_list(
        extract.extract_texts(html, ASIDE), extract.extract_texts(html, ITEM)
    )
    ads = extract.first_non_empty_list(
        extract.extract_texts(html, AD), extract.extract_texts(html, ITEM)
    )
    return pages(spark, sf).select(
        "page_id",
        F.array_join(items, "|").alias("items"),
        F.array_join(ads, "|").alias("ads"),
    )


def page_links(spark, sf):
    links = extract.explode_elements(pages(spark, sf), "html", LINK, ["page_id", "url"])
    href = extract.extract_attr(F.col("element"), "a", "href")
    return links.select(
        "page_id",
        F.col("pos").cast("bigint"),
        href.alias("href"),
        extract.absolute_url(F.col("url"), href).alias("target"),
        extract.extract_text(F.col("element"), ">([^<]*)<").alias("label"),
    )


def nested_pages(spark, sf):
    """The pages with paragraphs as blocks in blocks, of which some are never closed."""
    html = F.replace(F.col("html"), F.lit("<p>"), F.lit("<div class=part data-x='>'><div>"))
    html = F.replace(html, F.lit("</p>"), F.lit("</div><hr></div>"))
    html = F.replace(html, F.lit("<article>"), F.lit('<article><DIV class="desc">'))
    html = F.replace(html, F.lit("</article>"), F.lit("</DIV></article>"))
    return pages(spark, sf).withColumn("html", html)


DESC = extract.Element("div", 'class="desc"')
PART = extract.Element("div", "class=part")


def nested_elements(spark, sf):
    rows = extract.explode_elements(nested_pages(spark, sf), "html", PART, ["page_id"])
    return rows.select(
        "page_id", F.col("pos").cast("bigint"), text.clean_html(F.col("element")).alias("text")
    )


def nested_text(spark, sf):
    html = F.col("html")
    return nested_pages(spark, sf).select(
        "page_id",
        extract.extract_text(html, DESC).alias("description"),
        extract.if_present(html, extract.Element("div", "class=none")).alias("absent"),
        F.size(extract.extract_all(html, extract.Element("div"))).cast("bigint").alias("blocks"),
    )


QUERIES = {
    "nested_elements": nested_elements,
    "nested_text": nested_text,
    "extract_title": extract_title,
    "extract_first_link": extract_first_link,
    "first_non_empty": first_non_empty,
    "first_present": first_present,
    "first_non_empty_list": first_non_empty_list,
    "page_links": page_links,
}

def nested(opening: str) -> str:
    """Tables ``steps``, with the depth of each piece of a page, and ``blocks``, their texts."""
    hidden = sql.MARKUP.rpartition("|")[0]
    # What is not closed goes on to the end of the page; quotes may hold a bracket.
    body = sql.clean_html("replace(body, ' data-x=''>''', '')")
    return f"""
        changed AS (
            SELECT page_id, url, replace(replace(replace(replace(html,
                '<p>', '<div class=part data-x=''>''><div>'), '</p>', '</div><hr></div>'),
                '<article>', '<article><DIV class="desc">'), '</article>', '</DIV></article>') AS html
            FROM pages
        ), divided AS (
            SELECT page_id, string_split(regexp_replace(regexp_replace(html, '{hidden}', '', 'g'),
                '(<[a-zA-Z/!](?:=''>''|[^>])*>)', chr(65534) || '\\1', 'g'), chr(65534)) AS pieces
            FROM changed
        ), pieces AS (
            SELECT page_id, unnest(range(len(pieces))) AS i, unnest(pieces) AS piece FROM divided
        ), steps AS (
            SELECT *, sum(kind) OVER (PARTITION BY page_id ORDER BY i) AS depth
            FROM (SELECT *, CASE WHEN piece ILIKE '<div%' THEN 1 WHEN piece ILIKE '</div%' THEN -1
                         ELSE 0 END AS kind FROM pieces)
        ), ends AS (
            SELECT o.page_id, o.i, coalesce(min(c.i), 1000000) AS stop
            FROM steps o LEFT JOIN steps c
                ON c.page_id = o.page_id AND c.i > o.i AND c.depth < o.depth
            WHERE o.kind = 1 AND contains(o.piece, '{opening}') GROUP BY ALL
        ), bodies AS (
            SELECT page_id, e.i, string_agg(piece, '' ORDER BY s.i) AS body
            FROM ends e JOIN steps s USING (page_id) WHERE s.i >= e.i AND s.i < stop GROUP BY ALL
        ), blocks AS (
            SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY i) - 1 AS pos,
                {body} AS text
            FROM bodies
        )
    """


ORACLE = {
    "nested_elements": f"WITH {nested('class=part')} SELECT page_id, pos, text FROM blocks",
    "nested_text": f"""
        WITH {nested('class="desc"')}
        SELECT page_id, text AS description, NULL::VARCHAR AS absent,
            (SELECT count(*) FROM steps s WHERE s.page_id = b.page_id AND kind = 1) AS blocks
        FROM blocks b WHERE pos = 0
    """,
    "extract_title": f"""
        SELECT page_id, {sql.element("html", TITLE)} AS title,
               {sql.element("html", H1)} AS heading, {sql.element("html", H2)} AS subheading
        FROM pages
    """,
    "extract_first_link": f"""
        SELECT page_id,
               {sql.entities("regexp_extract(html, '<a href=" + '"([^"]*)"' + "', 1)")} AS link,
               {sql.entities("regexp_extract(html, '<html lang=" + '"([^"]*)"' + "', 1)")} AS lang,
               {sql.entities("regexp_extract(html, '<img src=" + '"([^"]*)"' + "', 1)")} AS image
        FROM pages
    """,
    "first_non_empty": f"""
        SELECT page_id, coalesce(nullif({sql.element("html", H2)}, ''),
                                 nullif({sql.element("html", H1)}, ''),
                                 nullif({sql.element("html", TITLE)}, ''), '') AS heading
        FROM pages
    """,
    "first_present": f"""
        SELECT page_id,
               CASE WHEN regexp_matches(html, '{H2}') THEN {sql.element("html", H2)}
                    WHEN regexp_matches(html, '{BOLD}') THEN {sql.element("html", BOLD)}
                    WHEN regexp_matches(html, '<i>([^<]*)')
                    THEN {sql.element("html", "<i>([^<]*)")} END AS published,
               CASE WHEN regexp_matches(html, '{H2}') THEN {sql.element("html", H2)}
                    ELSE '' END AS website
        FROM pages
    """,
    "first_non_empty_list": f"""
        SELECT page_id,
               array_to_string(CASE WHEN regexp_matches(html, '{ASIDE}')
                                    THEN {sql.elements("html", ASIDE)}
                                    ELSE {sql.elements("html", ITEM)} END, '|') AS items,
               array_to_string(CASE WHEN regexp_matches(html, '{AD}')
                                    THEN {sql.elements("html", AD)}
                                    ELSE {sql.elements("html", ITEM)} END, '|') AS ads
        FROM pages
    """,
    "page_links": f"""
        WITH found AS (
            SELECT page_id, regexp_extract(url, '^[a-z]+://[^/?#]*') AS origin,
                   regexp_extract_all(html, '{LINK}') AS links
            FROM pages
        ), one AS (
            SELECT page_id, origin, unnest(range(len(links))) AS pos, unnest(links) AS link
            FROM found
        )
        SELECT page_id, pos,
               {sql.entities("regexp_extract(link, 'href=" + '"([^"]*)"' + "', 1)")} AS href,
               origin || {sql.entities("regexp_extract(link, 'href=" + '"([^"]*)"' + "', 1)")}
               AS target,
               {sql.element("link", ">([^<]*)<")} AS label
        FROM one
    """,
}
