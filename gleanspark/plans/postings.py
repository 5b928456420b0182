"""From captured posting pages to one feed of both sources."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanspark.functions import classify, extract, text
from gleanspark.operators.combine import enrich_company, unify, with_lineage
from gleanspark.schema import (
    POSTING_FEED,
    SOURCE_A,
    SOURCE_B,
    to_postings,
    with_feed_headers,
)
from gleanspark.sources.feeds import append_tab, drop_header_rows, read_feed, write_feed
from gleanspark.workspace import settle


# A regular expression, or an element with all it contains.
Pattern = str | extract.Element


@dataclass(frozen=True)
class SelectorsA:
    """Patterns for a posting page of the first source."""

    title: Pattern
    company: Pattern
    company_url: str
    location: Pattern
    description: Pattern
    preferences: Pattern
    dates: tuple[Pattern, ...] = ()


@dataclass(frozen=True)
class SelectorsB:
    """Patterns for a posting page of the second source, in order of preference."""

    titles: tuple[Pattern, ...]
    companies: tuple[Pattern, ...]
    company_urls: tuple[str, ...]
    headers: tuple[Pattern, ...]
    salary_type: Pattern
    description: Pattern


@dataclass(frozen=True)
class Search:
    """What was searched and when: texts, or columns of the page table."""

    keyword: str | Column
    location: str | Column
    day: str | Column


def _link(pattern: str) -> Column:
    """Full address of the first link that matches, ``""`` if none does."""
    return text.let(
        text.decode_entities(F.regexp_extract("html", pattern, 1)),
        lambda href: F.when(href != "", extract.absolute_url(F.col("url"), href)).otherwise(href),
    )


def read_details_a(pages: DataFrame, selectors: SelectorsA) -> DataFrame:
    """Raw fields of first-source postings, next to the columns of ``pages``."""
    html = F.col("html")
    dates = [extract.if_present(html, pattern) for pattern in selectors.dates]
    return pages.withColumns(
        {
            "title": extract.extract_text(html, selectors.title),
            "company": extract.extract_text(html, selectors.company),
            "company_url": _link(selectors.company_url),
            "place": extract.extract_text(html, selectors.location),
            "published": extract.first_present(*dates),
            "items": extract.extract_texts(html, selectors.preferences),
            "description": extract.extract_text(html, selectors.description),
        }
    )


def postings_a(details: DataFrame, search: Search) -> DataFrame:
    """First source: preference items give salary, work mode and type, as written."""
    classed = details.withColumn("_kinds", classify.classify_preferences(F.col("items")))
    rows = classed.select(
        F.col("title").alias("job_title"),
        F.col("url").alias("job_opening_link"),
        F.col("_kinds.salary").alias("salary"),
        F.col("place").alias("job_location"),
        F.col("published").alias("publication_date"),
        F.col("_kinds.remote").alias("remote"),
        F.col("_kinds.job_type").alias("job_type"),
        F.col("description").alias("job_description"),
        F.col("company").alias("company_name"),
        F.col("company_url").alias("company_profile_url"),
        *_search_columns(search),
    )
    return to_postings(_lineage(rows, SOURCE_A, search, ["company_website"]))


def read_details_b(pages: DataFrame, selectors: SelectorsB) -> DataFrame:
    """Raw fields of second-source postings, next to the columns of ``pages``."""
    html = F.col("html")

    def first_text(patterns):
        return extract.first_non_empty(*[extract.extract_text(html, p) for p in patterns])

    urls = [_link(pattern) for pattern in selectors.company_urls]
    return pages.withColumns(
        {
            "title": first_text(selectors.titles),
            "company": first_text(selectors.companies),
            "company_url": extract.first_non_empty(*urls),
            "header": extract.first_non_empty_list(
                *[extract.extract_texts(html, p) for p in selectors.headers]
            ),
            "items": extract.extract_texts(html, selectors.salary_type),
            "description": F.array_join(
                extract.extract_texts(html, selectors.description), "\n"
            ),
        }
    )


def company_sites(pages: DataFrame, websites: list[str]) -> DataFrame:
    """``profile_url, website`` from captured company pages.

    The first link that is there counts, even if it is empty; none gives ``""``.
    """
    found = [F.when(F.col("html").rlike(pattern), _link(pattern)) for pattern in websites]
    return pages.select(
        F.col("url").alias("profile_url"),
        extract.first_present(*found, default="").alias("website"),
    )


def postings_b(details: DataFrame, companies: DataFrame, search: Search) -> DataFrame:
    """Second source: header, salary line and company table resolved.

    ``companies`` is ``profile_url, website``. Only fields are shuffled for the
    join, but ``details`` is read twice, the second time for ``company_url``.
    """
    found = details.select(
        "url",
        "title",
        "company",
        F.col("company_url").alias("profile_url"),
        classify.resolve_location(F.col("header"), F.col("company")).alias("_place"),
        classify.split_salary_type(F.col("items")).alias("_pay"),
        text.dedup_lines(F.col("description")).alias("description"),
        *_search_columns(search),
    )
    enriched = enrich_company(found, companies, order="website")
    rows = enriched.select(
        F.col("title").alias("job_title"),
        F.col("url").alias("job_opening_link"),
        classify.normalise_salary(F.col("_pay.salary_text")).alias("salary"),
        F.col("_place.location").alias("job_location"),
        F.col("_place.remote").alias("remote"),
        F.col("_pay.job_type").alias("job_type"),
        F.col("description").alias("job_description"),
        F.col("company").alias("company_name"),
        F.col("website").alias("company_website"),
        "_keyword",
        "_location",
        "_day",
    )
    return to_postings(
        _lineage(rows, SOURCE_B, search, ["publication_date", "company_profile_url"])
    )


def _column(value: str | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def _search_columns(search: Search) -> list[Column]:
    return [
        _column(search.keyword).alias("_keyword"),
        _column(search.location).alias("_location"),
        _column(search.day).alias("_day"),
    ]


def _lineage(rows: DataFrame, source: str, search: Search, blanks: list[str]) -> DataFrame:
    day = F.col("_day").cast("date")
    return with_lineage(rows, source, day, F.col("_keyword"), F.col("_location"), blanks)


def feed_a(pages: DataFrame, selectors: SelectorsA, search: Search) -> DataFrame:
    return postings_a(read_details_a(pages, selectors), search)


def feed_b(
    pages: DataFrame, selectors: SelectorsB, companies: DataFrame, search: Search
) -> DataFrame:
    """The fields are written before the join, so that pages are read once."""
    details = read_details_b(pages, selectors).drop("html")
    return postings_b(settle(details, "details"), companies, search)


def publish(
    spark: SparkSession, feeds: list[DataFrame], feed_path: str, dest: str, tab: str, batch: str
) -> DataFrame:
    """Replace the feed, read it back without repeated headers, append it to a tab.

    Returns what was appended, under the feed headers.
    """
    write_feed(with_feed_headers(unify(feeds)), feed_path, mode="overwrite")
    delivered = drop_header_rows(read_feed(spark, feed_path, POSTING_FEED))
    append_tab(delivered, dest, tab, batch)
    return delivered
