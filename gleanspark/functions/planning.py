"""Expressions that turn search input into URLs and counts."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Quoted phrases keep their quotes; a quote inside a word is part of the word.
TOKEN = r""""[^"]*"|'[^']*'|[^ \t\r\n"'][^ \t\r\n]*"""

# The parts of a search address and the pattern of a result count.
QUERY, NO_QUERY, LOCATION = "/jobs?q=", "/jobs?q", "&l="
RESULT_COUNT = r"\d*,?\d+"


def split_keywords(col: Column) -> Column:
    """Split at white space, but not inside quoted phrases.

    A phrase that is never closed has no reading: the list is null.
    """
    leftover = F.regexp_replace(col, TOKEN, "")
    return F.when(
        ~leftover.rlike("[\"']"), F.regexp_extract_all(col, F.lit(TOKEN), F.lit(0))
    )


def search_url(base: Column, keyword: Column, location: Column) -> Column:
    """Search address; blanks become ``+``, nothing is percent-encoded."""
    tokens = split_keywords(keyword)
    query = F.when(F.size(tokens) == 0, F.lit(NO_QUERY)).otherwise(
        F.concat(F.lit(QUERY), F.array_join(tokens, "+"))
    )
    return F.concat(base, query, F.lit(LOCATION), F.replace(location, F.lit(" "), F.lit("+")))


def leading_count(col: Column) -> Column:
    """Number before the first blank, commas ignored; no number gives null."""
    first = F.substring_index(col, " ", 1)
    return F.replace(first, F.lit(","), F.lit("")).try_cast("bigint")


def first_count(col: Column) -> Column:
    """First number with at most one comma: ``1,234,567`` reads as 1234."""
    found = F.regexp_extract(col, RESULT_COUNT, 0)
    return F.replace(found, F.lit(","), F.lit("")).try_cast("bigint")
