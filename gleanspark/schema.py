"""Schemas and the constants every feed shares."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Posting columns in feed order, internal name and feed header.
POSTING_COLUMNS = {
    "job_title": "Job title",
    "job_opening_link": "Job opening link",
    "salary": "Salary",
    "job_location": "Job location",
    "publication_date": "Publication date",
    "remote": "Remote",
    "job_type": "Job type",
    "job_description": "Job description",
    "company_name": "Company name",
    "company_website": "Company website",
    "company_profile_url": "Company linkedin url",
    "input_keyword": "Input_Keyword",
    "input_location": "Input_Location",
    "search_date": "Search date",
    "source": "Source",
}

# Provider columns, internal name and feed header.
PROVIDER_COLUMNS = {
    "provider_name": "Provider name",
    "provider_profile": "Provider profile",
}

# The labels the two posting sources carry in the feed.
SOURCE_A = "Linkedin"
SOURCE_B = "Indeed"

# Fixed value: what a provider field says when the page lacks it.
NOT_AVAILABLE = "NA"


def text_schema(names) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType(), True) for name in names])


# Feeds are read as text, under their headers.
POSTING_FEED = text_schema(POSTING_COLUMNS.values())
PROVIDER_FEED = text_schema(PROVIDER_COLUMNS.values())

SEARCH = T.StructType(
    [
        T.StructField("search_id", T.LongType()),
        T.StructField("source", T.StringType()),
        T.StructField("keyword", T.StringType()),
        T.StructField("location", T.StringType()),
    ]
)
PAGE = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("html", T.StringType()),
    ]
)


def to_postings(df: DataFrame) -> DataFrame:
    """The posting columns in feed order, as text."""
    return df.select(*[F.col(name).cast("string").alias(name) for name in POSTING_COLUMNS])


def with_feed_headers(df: DataFrame, columns: dict[str, str] = POSTING_COLUMNS) -> DataFrame:
    """Rename internal names to the headers written to a feed."""
    return df.withColumnsRenamed(columns)
