"""From searches to the list of listing pages, in batches."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanspark.functions.planning import search_url
from gleanspark.operators.paging import page_plan_10, page_plan_25, with_slots

PLANS = {"fixed": page_plan_25, "offset": page_plan_10}


def search_plan(
    searches: DataFrame, base: str, results: str, windows: int, paging: str = "offset"
) -> DataFrame:
    """One row per listing page to visit, with its batch and slot per search.

    ``searches`` is ``search_id, keyword, location`` and the result count. The
    pages of a search are numbered without gaps, so nothing is shuffled to place
    them. A keyword with an unclosed quote has no address and plans no page;
    ``rejected_searches`` has these.
    """
    urls = _with_url(searches, base).where(F.col("search_url").isNotNull())
    return with_slots(PLANS[paging](urls, results, "search_url"), "page", windows)


def rejected_searches(searches: DataFrame, base: str) -> DataFrame:
    """The searches that ``search_plan`` cannot plan, with the ``reason``."""
    reason = F.when(F.col("keyword").isNull(), F.lit("no keyword"))
    reason = reason.when(F.col("location").isNull(), F.lit("no location"))
    return (
        _with_url(searches, base)
        .where(F.col("search_url").isNull())
        .withColumn("reason", reason.otherwise(F.lit("unclosed quote")))
        .drop("search_url")
    )


def _with_url(searches: DataFrame, base: str) -> DataFrame:
    url = search_url(F.lit(base), F.col("keyword"), F.col("location"))
    return searches.withColumn("search_url", url)
