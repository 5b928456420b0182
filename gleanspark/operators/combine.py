"""Joining, uniting and resuming feeds."""

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanspark.operators.skew import as_list, look_up, with_group
from gleanspark.operators.slices import after_first, ordinal
from gleanspark.schema import POSTING_COLUMNS


def lookup_first(df: DataFrame, keys, order, cols) -> DataFrame:
    """The ``cols`` of the first row of each key, by ``order``.

    A minimum, so each task sends on one row per key; it finds them by sorting
    its rows, as Spark does for minima of rows. Ties in ``order`` go to the smaller values.
    """
    keys, order, cols = as_list(keys), as_list(order), as_list(cols)
    row = F.struct(
        *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)],
        *[F.col(c).alias(f"_c{i}") for i, c in enumerate(cols)],
    )
    first = df.groupBy(*keys).agg(F.min(row).alias("_first"))
    return first.select(*keys, *[F.col(f"_first._c{i}").alias(c) for i, c in enumerate(cols)])


def enrich_company(
    postings: DataFrame, companies: DataFrame, order, key: str = "profile_url", spread=None
) -> DataFrame:
    """Add ``website``; a posting without a profile or a match gets ``""``.

    Of several rows for one profile the first by ``order`` counts, so postings
    never multiply. Those of a company with very many postings are divided,
    by the ``spread`` columns if given.
    """
    sites = lookup_first(companies.where(F.col(key) != ""), key, order, ["website"])
    joined = look_up(postings, sites, key, spread)
    return joined.withColumn("website", F.coalesce("website", F.lit("")))


def zip_by_position(
    left: DataFrame, right: DataFrame, keys, left_order, right_order
) -> DataFrame:
    """Pair the n-th row of a group on the left with the n-th on the right.

    Ends with the shorter side. Group and position are unique on both sides,
    so no partition of the join grows with a group.
    """
    keys = as_list(keys)
    a, group = with_group(ordinal(left, keys, left_order, "pos"), keys)
    b, _ = with_group(ordinal(right, keys, right_order, "pos"), keys)
    return a.join(b.drop(*keys), [*group, "pos"]).drop(*group)


def to_column_lists(df: DataFrame, keys, batch: str, slot: str, cols) -> DataFrame:
    """One row per batch, each column a list in slot order.

    ``batch`` is the batch number of ``assign_batches`` within ``keys``: its size
    bounds the lists.
    """
    if batch in as_list(keys):
        raise ValueError("name the batch column apart from the keys")
    keys, cols = [*as_list(keys), batch], as_list(cols)
    rows = F.array_sort(F.collect_list(F.struct(slot, *cols)))
    batches = df.groupBy(*keys).agg(rows.alias("_rows"))
    return batches.select(*keys, *[F.col(f"_rows.{c}").alias(c) for c in [slot, *cols]])


def from_column_lists(df: DataFrame, keys, slot: str, cols) -> DataFrame:
    """Back to one row per entry."""
    return df.select(*as_list(keys), F.inline(F.arrays_zip(slot, *as_list(cols))))


def unify(feeds: list[DataFrame]) -> DataFrame:
    """All postings of all sources in the posting columns; nothing is merged."""
    parts = [feed.select(*POSTING_COLUMNS) for feed in feeds]
    united = parts[0]
    for part in parts[1:]:
        united = united.unionByName(part)
    return united


def with_lineage(
    df: DataFrame,
    source: str,
    search_date: dt.date | str | Column,
    keyword: str | Column,
    location: str | Column,
    blanks: list[str] = (),
) -> DataFrame:
    """Add what was searched, when and where, and ``""`` for columns a source lacks."""
    day = search_date if isinstance(search_date, Column) else F.lit(str(search_date)).cast("date")
    constants = {
        "input_keyword": keyword if isinstance(keyword, Column) else F.lit(keyword),
        "input_location": location if isinstance(location, Column) else F.lit(location),
        "search_date": F.date_format(day, "yyyy-MM-dd"),
        "source": F.lit(source),
    }
    return df.withColumns({**constants, **{name: F.lit("") for name in blanks}})


def work_list(df: DataFrame, col: str) -> DataFrame:
    """One column of an earlier result, repeats and all."""
    return df.select(col)


def resume_skip(
    todo: DataFrame, done: DataFrame, order
) -> DataFrame:
    """Leave out as many leading rows as ``done`` has; none left gives none.

    Right only if ``done`` was made in the same order; ``resume_anti`` does
    not depend on that.
    """
    finished = done.agg(F.count(F.lit(1))).scalar()
    return after_first(todo, finished, order)


def resume_anti(todo: DataFrame, done: DataFrame, keys) -> DataFrame:
    """Rows of ``todo`` whose key is not in ``done``; a null key is never done."""
    keys = as_list(keys)
    finished = done.select(*keys).distinct().withColumn("_done", F.lit(True))
    return look_up(todo, finished, keys).where(F.col("_done").isNull()).drop("_done")
