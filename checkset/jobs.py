"""Whole jobs: feeds, listing, search plan, stream.

The tables hold no postings, so pages stand in: headings are titles, the footer
names the company, the host is its profile, list items are the header and the
preference items, paragraphs are the description. Prices and work modes are
added by page number so that every rule meets all its cases.
"""

from dataclasses import replace

from pyspark.sql import functions as F

from checkset import planning, sql
from checkset.classifying import location_steps, preferences, salary, salary_type
from checkset.extracting import BOLD, DESC, H1, H2, ITEM, nested, nested_pages
from gleanspark.functions import extract
from gleanspark.functions.text import clean_html
from gleanspark.plans import listing, postings
from gleanspark.plans.cursor import run_listing
from gleanspark.plans.search import rejected_searches
from gleanspark.plans.search import search_plan as plan_pages
from gleanspark.schema import POSTING_COLUMNS, PROVIDER_FEED
from gleanspark.sources.feeds import append_tab, read_feed, read_tab, write_feed
from gleanspark.sources.pages import read_pages
from gleanspark.streaming.ingest import ingest_to_tab, page_stream
from gleanspark.workspace import fresh_path

FOOTER = "(?s)<footer>&copy; (.*?) &middot;"
PROFILE = "^[a-z]+://[^/?#]+"
LINK = '<a href="([^"]*)"'
PARAGRAPH = "(?s)<p>(.*?)<(?:/p|br)>"
KEYWORD, PLACE, DAY = '"Data Scientist" python', "New York", "2024-01-31"

SEARCH = postings.Search(KEYWORD, PLACE, DAY)
SELECTORS_A = postings.SelectorsA(
    title=H1,
    company=FOOTER,
    company_url=LINK,
    location=ITEM,
    description=PARAGRAPH,
    preferences=ITEM,
    dates=(H2, BOLD, "<i>([^<]*)"),
)
SELECTORS_B = postings.SelectorsB(
    titles=(H2, H1),
    companies=(H2, FOOTER),
    company_urls=("<a class=([^>]*)>", LINK),
    headers=("(?s)<h3>(.*?)</h3>", ITEM),
    salary_type="(?s)<h4>(.*?)</h4>",
    description=PARAGRAPH,
)


def some(condition, *items):
    return F.when(condition, F.array(*items)).otherwise(F.array().cast("array<string>"))


def feed_a(spark, sf):
    key = F.col("page_id")
    details = postings.read_details_a(read_pages(spark, f"{sf}/pages.parquet"), SELECTORS_A)
    pay = F.concat(F.lit("$"), (key % 90 + 40).cast("string"), F.lit("K/yr"))
    items = F.concat(
        some(key % 3 == 0, F.lit(" "), pay),
        some(key % 4 == 1, F.lit("Hybrid")),
        some(key % 5 != 0, F.get("items", F.lit(0))),
        some(key % 6 == 1, F.lit("Remote")),
    )
    return postings.postings_a(details.withColumn("items", items), SEARCH)


def details_b(spark, sf):
    key = F.col("page_id")
    details = postings.read_details_b(read_pages(spark, f"{sf}/pages.parquet"), SELECTORS_B)
    pay = F.concat(F.lit("$"), (key % 90 + 40).cast("string"), F.lit(",000"))
    header = F.concat(
        some(key % 4 == 0, F.concat("company", F.lit(" Office"))),
        some(key % 5 == 0, F.lit("Hybrid work")),
        some(key % 6 == 0, F.lit("Remote")),
        F.col("header"),
    )
    items = (
        F.when(key % 5 == 0, F.array(F.concat(pay, F.lit(" - "), pay), F.lit("- Full-time")))
        .when(key % 5 == 1, F.array(F.lit("Competitive"), F.lit("- Contract")))
        .when(key % 5 == 2, F.array(F.concat(F.lit("From "), pay)))
        .when(key % 5 == 3, F.array(F.lit("Part-time"), pay, pay))
        .otherwise(F.col("items"))
    )
    profile = F.regexp_extract("url", PROFILE, 0)
    return details.withColumns({"header": header, "items": items, "company_url": profile})


def companies(spark, sf):
    """One company for each page, its host; those without a secure address are unknown."""
    profile = F.regexp_extract("url", PROFILE, 0)
    return (
        read_pages(spark, f"{sf}/pages.parquet")
        .select(profile.alias("profile_url"))
        .where(F.col("profile_url").startswith("https:"))
        .withColumn("website", F.concat("profile_url", F.lit("/about")))
    )


def feed_b(spark, sf):
    return postings.postings_b(details_b(spark, sf), companies(spark, sf), SEARCH)


def feed_a_nested(spark, sf):
    """The library's own feed, with a description that holds elements of its name."""
    selectors = replace(SELECTORS_A, description=DESC)
    return postings.feed_a(nested_pages(spark, sf), selectors, SEARCH)


def feed_b_nested(spark, sf):
    """The library's own feed; each page's first link is the company's profile."""
    pages = nested_pages(spark, sf)
    profile = extract.absolute_url(F.col("url"), extract.extract_attr(F.col("html"), "a", "href"))
    website = F.concat(F.regexp_extract("url", PROFILE, 0), F.lit("/about"))
    sites = pages.where(F.col("url").startswith("https:")).select(
        profile.alias("profile_url"), website.alias("website")
    )
    selectors = replace(SELECTORS_B, description=DESC)
    return postings.feed_b(pages, selectors, sites, SEARCH)


def unified_feed(spark, sf):
    dest = fresh_path(spark, "tabs")
    feeds = [feed_a(spark, sf), feed_b(spark, sf)]
    postings.publish(spark, feeds, fresh_path(spark, "feed"), dest, "Data", "first")
    return read_tab(spark, dest, "Data", list(POSTING_COLUMNS.values()))


CARD_NAME = '<a href="[^"]*">([a-z][^<]*)</a>'
CARD_LINK = 'href="(/[^"]{3,})"'


def provider_listing(spark, sf):
    host = F.regexp_extract("url", PROFILE, 0)
    pages = read_pages(spark, f"{sf}/pages.parquet").withColumn("host", host)
    has_next = F.contains(F.col("html"), F.lit("<b>"))
    cards = listing.provider_listing(
        pages, "host", "page_id", has_next, ITEM, CARD_NAME, CARD_LINK
    )
    return cards.withColumn("pos", F.col("pos").cast("bigint")).drop("host")


def listing_in_runs(spark, sf):
    """The provider listing in three runs, each over the pages captured until then."""
    host = F.regexp_extract("url", PROFILE, 0)
    pages = read_pages(spark, f"{sf}/pages.parquet").withColumn("host", host)
    has_next = F.contains(F.col("html"), F.lit("<b>"))
    most = pages.agg(F.max("page_id")).scalar()
    dest, cursor = fresh_path(spark, "tabs"), fresh_path(spark, "cursor")
    columns = ["page_id", "pos", "provider_name", "provider_profile"]
    for run in range(3):

        def deliver(todo, run=run):
            cards = listing.provider_listing(
                todo, "host", "page_id", has_next, ITEM, CARD_NAME, CARD_LINK
            )
            append_tab(cards.select(*columns), dest, "Providers", f"run-{run}")

        captured = pages.where(F.col("page_id") <= most * (run + 1) / 3)
        run_listing(captured, "host", "page_id", ~has_next, cursor, deliver)
    tab = read_tab(spark, dest, "Providers", columns)
    return tab.withColumns({n: F.col(n).cast("bigint") for n in ("page_id", "pos")})


def remaining_profiles(spark, sf):
    """What is left of the providers once the pages of one domain ending are done."""
    path = fresh_path(spark, "providers")
    write_feed(listing.provider_feed(provider_listing(spark, sf)), path)
    providers = read_feed(spark, path, PROVIDER_FEED)
    done = providers.where(F.col("Provider profile").contains(".example.com/"))
    left = listing.remaining_profiles(providers, done)
    return left.withColumnRenamed("Provider profile", "provider_profile")


def listing_links(spark, sf):
    """The last page of a host is the first whose title holds a percent sign."""
    host = F.regexp_extract("url", PROFILE, 0)
    pages = read_pages(spark, f"{sf}/pages.parquet").withColumn("host", host)
    marker = F.col("html").rlike("<title>[^<]*%")
    links = listing.listing_links(pages, "host", "page_id", "<a [^>]*>", marker)
    return links.select("page_id", F.col("pos").cast("bigint"), "link")


def company_sites(spark, sf):
    sites = ["<a class=([^>]*)>", '<li><a href="(/[A-Z][^"]*)"', LINK]
    return postings.company_sites(read_pages(spark, f"{sf}/pages.parquet"), sites)


def search_plan(spark, sf):
    searches = planning.searches(spark, sf).withColumn("n_results", F.col("search_id") % 20)
    pages = plan_pages(searches, planning.BASE, "n_results", windows=4)
    return pages.select("search_id", F.col("page").cast("bigint"), "page_url", "batch", "slot")


def search_plan_fixed(spark, sf):
    searches = planning.searches(spark, sf).withColumn("n_results", F.col("search_id") % 300)
    pages = plan_pages(searches, planning.BASE, "n_results", windows=3, paging="fixed")
    return pages.select("search_id", F.col("page").cast("bigint"), "page_url", "batch", "slot")


def stream_ingest(spark, sf):
    def job(pages):
        return pages.select("page_id", clean_html(F.col("html")).alias("text"))

    dest = fresh_path(spark, "tabs")
    # A pattern, because the table may be one file as well as a folder.
    stream = page_stream(spark, f"{sf}/page[s].parquet")
    ingest_to_tab(stream, job, dest, "Pages", fresh_path(spark, "progress")).awaitTermination()
    tab = read_tab(spark, dest, "Pages", ["page_id", "text"])
    return tab.withColumn("page_id", F.col("page_id").cast("bigint"))


def stream_two_feeds(spark, sf):
    """Two streams with checkpoints of their own into one tab, one of them run twice."""

    def job(pages):
        return pages.select("page_id", "url")

    dest = fresh_path(spark, "tabs")
    for progress in (fresh_path(spark, "progress"), fresh_path(spark, "progress")):
        for _ in range(2):
            stream = page_stream(spark, f"{sf}/page[s].parquet")
            ingest_to_tab(stream, job, dest, "Pages", progress).awaitTermination()
    tab = read_tab(spark, dest, "Pages", ["page_id", "url"])
    return tab.withColumn("page_id", F.col("page_id").cast("bigint"))


def stream_once(spark, sf):
    """Two streams into one tab whose ledger lets each capture through once; then packed."""

    def job(pages):
        return pages.select("page_id", "url")

    dest = fresh_path(spark, "tabs")
    for progress in (fresh_path(spark, "progress"), fresh_path(spark, "progress")):
        stream = page_stream(spark, f"{sf}/page[s].parquet")
        query = ingest_to_tab(stream, job, dest, "Pages", progress, ["page_id"], compact_every=1)
        query.awaitTermination()
    tab = read_tab(spark, dest, "Pages", ["page_id", "url"])
    return tab.withColumn("page_id", F.col("page_id").cast("bigint"))


def search_outcomes(spark, sf):
    searches = planning.searches(spark, sf).withColumn("n_results", F.lit(1))
    planned = plan_pages(searches, planning.BASE, "n_results", windows=4)
    rejected = rejected_searches(searches, planning.BASE)
    planned = planned.select("search_id", F.lit("planned").alias("outcome"))
    return planned.unionByName(rejected.select("search_id", F.col("reason").alias("outcome")))


QUERIES = {
    "feed_a": feed_a,
    "feed_b": feed_b,
    "feed_a_nested": feed_a_nested,
    "feed_b_nested": feed_b_nested,
    "unified_feed": unified_feed,
    "company_sites": company_sites,
    "listing_links": listing_links,
    "provider_listing": provider_listing,
    "listing_in_runs": listing_in_runs,
    "remaining_profiles": remaining_profiles,
    "search_plan": search_plan,
    "search_plan_fixed": search_plan_fixed,
    "stream_ingest": stream_ingest,
    "stream_two_feeds": stream_two_feeds,
    "stream_once": stream_once,
    "search_outcomes": search_outcomes,
}

# The texts that a feed's reader takes as missing.
TOKENS = """
    '', '#N/A', '#N/A N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN', '-nan', '1.#IND', '1.#QNAN',
    '<NA>', 'N/A', 'NA', 'NULL', 'NaN', 'None', 'n/a', 'nan', 'null'
"""
EMPTY = "CAST([] AS VARCHAR[])"

FEED_A = f"""
    given_a AS (
        SELECT *, {sql.elements("html", ITEM)} AS li FROM pages
    ), listed_a AS (
        SELECT *, list_concat(list_concat(list_concat(
            CASE WHEN page_id % 3 = 0 THEN [' ', '$' || (page_id % 90 + 40) || 'K/yr']
                 ELSE {EMPTY} END,
            CASE WHEN page_id % 4 = 1 THEN ['Hybrid'] ELSE {EMPTY} END),
            CASE WHEN page_id % 5 <> 0 THEN [li[1]] ELSE {EMPTY} END),
            CASE WHEN page_id % 6 = 1 THEN ['Remote'] ELSE {EMPTY} END) AS items
        FROM given_a
    ), classed_a AS (SELECT *, {preferences("items")} FROM listed_a),
    feed_a AS (
        SELECT {sql.element("html", H1)} AS job_title, url AS job_opening_link, salary,
               {sql.element("html", ITEM)} AS job_location,
               CASE WHEN regexp_matches(html, '{H2}') THEN {sql.element("html", H2)}
                    WHEN regexp_matches(html, '{BOLD}') THEN {sql.element("html", BOLD)}
                    WHEN regexp_matches(html, '<i>([^<]*)')
                    THEN {sql.element("html", "<i>([^<]*)")} END AS publication_date,
               remote, job_type, {sql.element("html", PARAGRAPH)} AS job_description,
               {sql.element("html", FOOTER)} AS company_name, '' AS company_website,
               regexp_extract(url, '{PROFILE}')
               || {sql.entities(f"regexp_extract(html, '{LINK}', 1)")} AS company_profile_url,
               '{KEYWORD}' AS input_keyword, '{PLACE}' AS input_location,
               '{DAY}' AS search_date, 'Linkedin' AS source
        FROM classed_a
    )
"""

FEED_B = f"""
    given_b AS (
        SELECT page_id, url, regexp_extract(url, '{PROFILE}') AS profile,
               coalesce(nullif({sql.element("html", H2)}, ''), {sql.element("html", H1)}) AS title,
               coalesce(nullif({sql.element("html", H2)}, ''), {sql.element("html", FOOTER)})
               AS company,
               {sql.elements("html", ITEM)} AS li, {sql.elements("html", PARAGRAPH)} AS p,
               '$' || (page_id % 90 + 40) || ',000' AS pay
        FROM pages
    ), headed AS (
        SELECT page_id, url, profile, title, company,
               string_split(array_to_string(p, chr(10)), chr(10)) AS l,
               list_concat(list_concat(list_concat(
                   CASE WHEN page_id % 4 = 0 THEN [company || ' Office'] ELSE {EMPTY} END,
                   CASE WHEN page_id % 5 = 0 THEN ['Hybrid work'] ELSE {EMPTY} END),
                   CASE WHEN page_id % 6 = 0 THEN ['Remote'] ELSE {EMPTY} END), li) AS header,
               CASE page_id % 5 WHEN 0 THEN [pay || ' - ' || pay, '- Full-time']
                                WHEN 1 THEN ['Competitive', '- Contract']
                                WHEN 2 THEN ['From ' || pay]
                                WHEN 3 THEN ['Part-time', pay, pay]
                                ELSE {EMPTY} END AS items
        FROM given_b
    ), {location_steps("headed", "url, profile, title, company, l, items")},
    paid AS (SELECT *, {salary_type("items")} FROM placed),
    feed_b AS (
        SELECT title AS job_title, url AS job_opening_link, {salary("salary_text")} AS salary,
               location AS job_location, '' AS publication_date, remote, job_type,
               array_to_string({sql.distinct("l")}, chr(10)) AS job_description,
               company AS company_name,
               CASE WHEN starts_with(profile, 'https:') THEN profile || '/about' ELSE '' END
               AS company_website, '' AS company_profile_url,
               '{KEYWORD}' AS input_keyword, '{PLACE}' AS input_location,
               '{DAY}' AS search_date, 'Indeed' AS source
        FROM paid
    )
"""

POSTING_SQL = ", ".join(POSTING_COLUMNS)
DELIVERED = ", ".join(
    f"""coalesce(CASE WHEN {name} NOT IN ({TOKENS}) THEN {name} END, '') AS "{header}" """
    for name, header in POSTING_COLUMNS.items()
)

ORACLE = {
    "feed_a": f"WITH {FEED_A} SELECT {POSTING_SQL} FROM feed_a",
    "feed_b": f"WITH {FEED_B} SELECT {POSTING_SQL} FROM feed_b",
    "feed_a_nested": f"""
        WITH {nested('class="desc"')}, items AS (
            SELECT changed.*, {sql.elements("html", ITEM)} AS items, text AS description
            FROM changed JOIN blocks USING (page_id) WHERE pos = 0
        ), classed AS (SELECT *, {preferences("items")} FROM items), found AS (
            SELECT {sql.element("html", H1)} AS job_title, url AS job_opening_link, salary,
               {sql.element("html", ITEM)} AS job_location,
               CASE WHEN regexp_matches(html, '{BOLD}') THEN {sql.element("html", BOLD)} END
               AS publication_date, remote, job_type, description AS job_description,
               {sql.element("html", FOOTER)} AS company_name, '' AS company_website,
               regexp_extract(url, '{PROFILE}')
               || {sql.entities(f"regexp_extract(html, '{LINK}', 1)")} AS company_profile_url,
               '{KEYWORD}' AS input_keyword, '{PLACE}' AS input_location,
               '{DAY}' AS search_date, 'Linkedin' AS source
            FROM classed
        )
        SELECT {POSTING_SQL} FROM found
    """,
    "feed_b_nested": f"""
        WITH {nested('class="desc"')}, headed AS (
            SELECT url, {sql.element("html", H1)} AS title, {sql.element("html", FOOTER)} AS company,
                regexp_extract(url, '{PROFILE}') AS profile, text AS description,
                {sql.elements("html", ITEM)} AS header
            FROM changed JOIN blocks USING (page_id) WHERE pos = 0
        ), {location_steps("headed", "url, profile, title, company, description")}, found AS (
            SELECT title AS job_title, url AS job_opening_link, NULL::VARCHAR AS salary,
               location AS job_location, '' AS publication_date, remote, NULL::VARCHAR AS job_type,
               description AS job_description, company AS company_name,
               CASE WHEN starts_with(profile, 'https:') THEN profile || '/about' ELSE '' END
               AS company_website, '' AS company_profile_url,
               '{KEYWORD}' AS input_keyword, '{PLACE}' AS input_location,
               '{DAY}' AS search_date, 'Indeed' AS source
            FROM placed
        )
        SELECT {POSTING_SQL} FROM found
    """,
    "unified_feed": f"""
        WITH {FEED_A}, {FEED_B}, both_feeds AS (
            SELECT {POSTING_SQL} FROM feed_a UNION ALL SELECT {POSTING_SQL} FROM feed_b
        )
        SELECT {DELIVERED} FROM both_feeds
    """,
    "provider_listing": f"""
        WITH hosts AS (
            SELECT page_id, html, regexp_extract(url, '{PROFILE}') AS host FROM pages
        ), visited AS (
            SELECT page_id, host, regexp_extract_all(html, '{ITEM}') AS cards FROM hosts
            QUALIFY coalesce(bool_or(NOT contains(html, '<b>')) OVER (
                PARTITION BY host ORDER BY page_id
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), FALSE) = FALSE
        ), one AS (
            SELECT page_id, host, unnest(range(len(cards))) AS pos, unnest(cards) AS card
            FROM visited
        )
        SELECT page_id, pos,
               CASE WHEN regexp_matches(card, '{CARD_NAME}')
                    THEN {sql.element("card", CARD_NAME)} ELSE 'NA' END AS provider_name,
               CASE WHEN regexp_matches(card, '{CARD_LINK}')
                    THEN host || {sql.element("card", CARD_LINK)} ELSE 'NA' END
               AS provider_profile
        FROM one
    """,
    "company_sites": f"""
        SELECT url AS profile_url, regexp_extract(url, '{PROFILE}') || {sql.entities(
            f"""CASE WHEN regexp_matches(html, '<li><a href="(/[A-Z][^"]*)"')
                     THEN regexp_extract(html, '<li><a href="(/[A-Z][^"]*)"', 1)
                     ELSE regexp_extract(html, '{LINK}', 1) END"""
        )} AS website
        FROM pages
    """,
    "listing_links": f"""
        WITH hosts AS (
            SELECT page_id, html, regexp_extract(url, '{PROFILE}') AS host FROM pages
        ), visited AS (
            SELECT page_id, host, regexp_extract_all(html, '{LINK}', 1) AS links FROM hosts
            QUALIFY coalesce(bool_or(regexp_matches(html, '<title>[^<]*%')) OVER (
                PARTITION BY host ORDER BY page_id
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), FALSE) = FALSE
        ), one AS (
            SELECT page_id, host, unnest(range(len(links))) AS pos, unnest(links) AS link
            FROM visited
        )
        SELECT page_id, pos, host || {sql.entities("link")} AS link FROM one
    """,
    "search_plan": f"""
        WITH {planning.SEARCHES}, planned AS (
            SELECT search_id, search_url,
                   unnest(range(CASE WHEN search_id % 20 <= 15 THEN 1 ELSE 67 END)) AS page
            FROM searches WHERE search_url IS NOT NULL
        )
        SELECT search_id, page, search_url || '&start=' || page || '0' AS page_url,
               page // 4 AS batch, page % 4 AS slot
        FROM planned
    """,
    "search_plan_fixed": f"""
        WITH {planning.SEARCHES}, planned AS (
            SELECT search_id, search_url,
                   unnest(range(CAST(ceil(search_id % 300 / 25) AS BIGINT))) AS page
            FROM searches WHERE search_url IS NOT NULL
        )
        SELECT search_id, page, search_url || '&start=' || (page * 25) AS page_url,
               page // 3 AS batch, page % 3 AS slot
        FROM planned
    """,
    "stream_ingest": f"SELECT page_id, {sql.clean_html('html')} AS text FROM pages",
    "stream_once": "SELECT page_id, url FROM pages",
    "stream_two_feeds": """
        SELECT page_id, url FROM pages UNION ALL SELECT page_id, url FROM pages
    """,
    "search_outcomes": f"""
        WITH {planning.SEARCHES}
        SELECT search_id, CASE WHEN search_url IS NOT NULL THEN 'planned'
                               ELSE 'unclosed quote' END AS outcome
        FROM searches
    """,
}

# Runs one after the other find what one run finds.
ORACLE["listing_in_runs"] = ORACLE["provider_listing"]
ORACLE["remaining_profiles"] = f"""
    WITH providers AS ({ORACLE["provider_listing"]}), feed AS (
        SELECT CASE WHEN provider_profile NOT IN ({TOKENS}) THEN provider_profile END
               AS provider_profile
        FROM providers
    )
    SELECT provider_profile FROM feed
    WHERE provider_profile IS NULL OR provider_profile NOT LIKE '%.example.com/%'
"""
