"""Which pages to visit, where to stop, and who takes which."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanspark.operators.skew import as_list, look_up
from gleanspark.operators.slices import first_rows, ordinal, until_first, whole_parts

# Page sizes and limits of the two listing sources, offset parameter.
START = "&start="
FIXED_STEP = 25
FIXED_PAGES = 40
OFFSET_PAGES = 67
ONE_PAGE_RESULTS = 15


def _pages(limit: int, count: Column) -> Column:
    numbers = F.sequence(F.lit(0), F.lit(limit - 1))
    planned = F.least(F.lit(limit), F.greatest(F.lit(0), count))
    return F.slice(numbers, F.lit(1), planned.cast("int"))


def page_plan_25(df: DataFrame, results: str, url: str) -> DataFrame:
    """One row per listing page of 25, at most 40: ``page``, ``start``, ``page_url``.

    An unknown number of results plans no page.
    """
    needed = F.ceil(F.coalesce(F.col(results), F.lit(0)) / FIXED_STEP)
    start = F.col("page") * FIXED_STEP
    return (
        df.withColumn("page", F.explode(_pages(FIXED_PAGES, needed)))
        .withColumn("start", start)
        .withColumn("page_url", F.concat(F.col(url), F.lit(START), start.cast("string")))
    )


def page_plan_10(df: DataFrame, results: str, url: str) -> DataFrame:
    """One page up to 15 results, else 67; the offset is the page with a 0 behind it.

    Page 0 starts at ``00``. An unknown number of results plans no page.
    """
    needed = (
        F.when(F.col(results) <= ONE_PAGE_RESULTS, F.lit(1))
        .when(F.col(results).isNotNull(), F.lit(OFFSET_PAGES))
        .otherwise(F.lit(0))
    )
    start = F.concat(F.col("page").cast("string"), F.lit("0"))
    return (
        df.withColumn("page", F.explode(_pages(OFFSET_PAGES, needed)))
        .withColumn("start", start)
        .withColumn("page_url", F.concat(F.col(url), F.lit(START), start))
    )


def until_marker(
    df: DataFrame, keys, order, marker: Column
) -> DataFrame:
    """Listing pages up to and including the first that shows the marker."""
    return until_first(df, keys, order, marker)


def while_next(
    df: DataFrame, keys, order, has_next: Column
) -> DataFrame:
    """Pages from the first on while each says there is a next one.

    A page that does not say so (null) ends the run as well.
    """
    return until_first(df, keys, order, ~F.coalesce(has_next, F.lit(False)))


def allowed_domains(df: DataFrame, url: str, domains: list[str]) -> DataFrame:
    """Rows whose host is a listed domain or lies below one."""
    host = _host(url)
    allowed = F.lit(False)
    for domain in domains:
        allowed = allowed | (host == domain.lower()) | host.endswith("." + domain.lower())
    return df.where(allowed)


def _host(url: str) -> Column:
    return F.lower(F.try_parse_url(F.col(url), F.lit("HOST")))


def with_slots(df: DataFrame, pos: str, size: int) -> DataFrame:
    """Add the batch of ``size`` a position falls in, and its slot there."""
    return df.withColumn("batch", whole_parts(F.col(pos), size)).withColumn(
        "slot", F.col(pos).cast("bigint") % size
    )


def in_domain_table(df: DataFrame, url: str, domains: DataFrame) -> DataFrame:
    """The same for a table of any size with a column ``domain``.

    Each host is looked up once, by itself and every domain it lies below, so
    the join is by equality.
    """
    rows = df.withColumn("_host", _host(url))
    labels = F.split("_host", r"\.")
    above = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda at: F.array_join(F.slice(labels, at, F.size(labels)), "."),
    )
    hosts = rows.where(F.col("_host").isNotNull()).select("_host").distinct()
    listed = domains.select(F.lower("domain").alias("_domain")).where("_domain IS NOT NULL")
    listed = listed.distinct().withColumn("_listed", F.lit(True))
    # Most hosts lie below a few domains, so these keys are divided.
    parents = hosts.select("_host", F.explode(above).alias("_domain"))
    allowed = (
        look_up(parents, listed, "_domain", spread="_host")
        .where("_listed")
        .select("_host")
        .distinct()
        .withColumn("_allowed", F.lit(True))
    )
    marked = look_up(rows, allowed, "_host")
    return marked.where(F.col("_allowed")).select(*df.columns)


def assign_batches(
    df: DataFrame, keys, order, size: int
) -> DataFrame:
    """Cut the ordered list of each group in batches; ``slot`` is the place in one."""
    return with_slots(ordinal(df, keys, order, "_pos"), "_pos", size).drop("_pos")


def cap_per_search(
    df: DataFrame, keys, order, limit: int
) -> DataFrame:
    """The first ``limit`` rows of each group."""
    return first_rows(df, keys, order, limit)


def most_recent(df: DataFrame, date: str, tie: str, limit: int | None = None) -> DataFrame:
    """Latest first, ties by ``tie``; with a limit each task keeps its top only."""
    ordered = df.orderBy(F.col(date).desc(), *as_list(tie))
    return ordered if limit is None else ordered.limit(limit)
