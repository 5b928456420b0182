"""From captured listing pages to links and provider cards, in page order."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanspark.functions import extract
from gleanspark.operators.combine import resume_anti, work_list
from gleanspark.operators.paging import until_marker
from gleanspark.operators.skew import as_list
from gleanspark.schema import NOT_AVAILABLE, PROVIDER_COLUMNS, with_feed_headers
from gleanspark.sources.feeds import drop_header_rows
from gleanspark.workspace import settle


def visited_elements(
    pages: DataFrame,
    keys,
    order,
    pattern: str,
    last: Column | None = None,
) -> DataFrame:
    """``keys, order, url, pos, element``: each match on each page that is visited.

    Pages of a group are visited in order up to the first where ``last`` holds,
    or all of them. What is needed of a page is then taken out and written
    first: finding the last page reads the input more than once, and pages are
    far larger than their elements.
    """
    keys, order = as_list(keys), as_list(order)
    found = pages.select(
        *keys,
        *order,
        "url",
        (F.lit(None).cast("boolean") if last is None else last).alias("_last"),
        extract.extract_all(F.col("html"), pattern, 0).alias("_elements"),
    )
    if last is not None:
        found = until_marker(settle(found, "elements"), keys, order, F.col("_last"))
    return found.select(*keys, *order, "url", F.posexplode("_elements").alias("pos", "element"))


def listing_links(
    pages: DataFrame,
    keys,
    order,
    link: str,
    marker: Column | None = None,
) -> DataFrame:
    """``keys, order, pos, link``: the links of each search, repeats and all.

    ``link`` matches one link element; ``marker`` tells the page that says the
    rest was left out, which is the last one read.
    """
    elements = visited_elements(pages, keys, order, link, marker)
    href = extract.extract_attr(F.col("element"), "a", "href")
    return elements.select(
        *as_list(keys),
        *as_list(order),
        "pos",
        extract.absolute_url(F.col("url"), href).alias("link"),
    )


def provider_listing(
    pages: DataFrame,
    keys,
    order,
    has_next: Column,
    card: str,
    name: str,
    link: str,
) -> DataFrame:
    """One row per card of the pages visited while each has a next one.

    A missing field says ``NA``.
    """
    last = ~F.coalesce(has_next, F.lit(False))
    cards = visited_elements(pages, keys, order, card, last)
    profile = extract.if_present(F.col("element"), link)
    return cards.select(
        *as_list(keys),
        *as_list(order),
        "pos",
        extract.or_sentinel(extract.if_present(F.col("element"), name), NOT_AVAILABLE).alias(
            "provider_name"
        ),
        extract.or_sentinel(extract.absolute_url(F.col("url"), profile), NOT_AVAILABLE).alias(
            "provider_profile"
        ),
    )


def provider_feed(listing: DataFrame) -> DataFrame:
    return with_feed_headers(listing.select(*PROVIDER_COLUMNS), PROVIDER_COLUMNS)


def remaining_profiles(providers: DataFrame, done: DataFrame) -> DataFrame:
    """Profiles of a provider feed still to visit: those not in the ``done`` feed."""
    profile = PROVIDER_COLUMNS["provider_profile"]
    return resume_anti(work_list(drop_header_rows(providers), profile), done, profile)
