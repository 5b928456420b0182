"""Listings that go on where an earlier run ended: a cursor for each group of pages."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanspark.operators.skew import as_list, look_up, with_group
from gleanspark.operators.slices import until_first
from gleanspark.sources import versions
from gleanspark.workspace import scratch, settle

AT, STOPPED = "_visited_to", "_stopped"


def read_cursor(spark: SparkSession, path: str, pages: DataFrame, keys, order) -> DataFrame:
    """``keys, _visited_to, _stopped``: the place of each group's last visited page, and whether
    its listing ended there. Empty before the first run."""
    place = T.StructType([pages.schema[c] for c in as_list(order)])
    schema = T.StructType(
        [
            *(pages.schema[c] for c in as_list(keys)),
            T.StructField(AT, place),
            T.StructField(STOPPED, T.BooleanType()),
        ]
    )
    folder = versions.current(spark, path)
    if folder == path:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(folder)


def unvisited(pages: DataFrame, cursor: DataFrame, keys, order) -> DataFrame:
    """Pages after the cursor of their group, if its listing has not ended; columns unchanged.

    Pages that come late, before the cursor, are not visited any more. Null keys are a
    group of their own.
    """
    keys, order = as_list(keys), as_list(order)
    rows, group = with_group(pages, keys)
    known, _ = with_group(cursor, keys)
    marked = look_up(rows, known.select(*group, AT, STOPPED), group)
    ahead = F.col(AT).isNull() | (F.struct(*order) > F.col(AT))
    return marked.where(~F.coalesce(F.col(STOPPED), F.lit(False)) & ahead).select(*pages.columns)


def advanced(cursor: DataFrame, todo: DataFrame, keys, order, last: Column) -> DataFrame:
    """The cursor after the pages ``todo`` are visited, each group up to where ``last`` holds.

    Only keys, order and the mark are shuffled. Groups without new pages stay as they are.
    """
    keys, order = as_list(keys), as_list(order)
    ends = F.coalesce(last, F.lit(False))
    places = todo.select(*keys, *order, ends.alias(STOPPED))
    seen = until_first(settle(places, "places"), keys, order, F.col(STOPPED))
    seen = seen.select(*keys, F.struct(*order).alias(AT), STOPPED)
    both, group = with_group(cursor.unionByName(seen), keys)
    newest = F.max(F.struct(AT, STOPPED)).alias("_newest")
    merged = both.groupBy(*group).agg(*[F.first(k).alias(k) for k in keys], newest)
    return merged.select(*keys, f"_newest.{AT}", f"_newest.{STOPPED}")


def run_listing(
    pages: DataFrame, keys, order, last: Column, path: str, deliver: Callable[[DataFrame], None]
) -> None:
    """Hand the pages not visited yet to ``deliver``, then move the cursor at ``path`` on.

    ``deliver`` visits each group's pages in order up to the first where ``last`` holds, as
    ``listing_links`` and ``provider_listing`` do. ``order`` is unique in a group. The cursor is replaced in one step
    after the delivery: a run that fails before is run again over the same pages, so
    deliver under a name that replaces a first try. Runs at different times
    together visit what one run over all pages would, if pages arrive in order.
    """
    spark = pages.sparkSession
    with scratch(spark):
        cursor = read_cursor(spark, path, pages, keys, order)
        todo = unvisited(pages, cursor, keys, order)
        deliver(todo)
        moved = advanced(cursor, todo, keys, order, last)
        versions.replace(spark, path, lambda folder: moved.write.parquet(folder))
