"""Groups that hold more rows than a task should get, and look-ups into tables."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanspark.workspace import settle

# A look-up table is broadcast if its values take no more than this.
BROADCAST_BYTES = 32 * 1024 * 1024


def as_list(names) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def shuffle_parts(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def with_group(df: DataFrame, keys: list[str]) -> tuple[DataFrame, list[str]]:
    """Add group columns that equal the keys but are never null.

    Plain equality on them keeps null keys together, as a window does.
    """
    columns = {f"_group{i}": _stand_in(df, key) for i, key in enumerate(keys)}
    nulls = F.lit(0)
    for i, key in enumerate(keys):
        nulls = nulls + F.when(F.col(key).isNull(), F.lit(1 << i)).otherwise(F.lit(0))
    columns["_group_nulls"] = nulls
    return df.withColumns(columns), list(columns)


def _stand_in(df: DataFrame, key: str) -> Column:
    dtype = df.schema[key].dataType
    if isinstance(dtype, T.StringType):
        value = F.lit("")
    elif isinstance(dtype, T.NumericType):
        value = F.lit(0)
    elif isinstance(dtype, T.BooleanType):
        value = F.lit(False)
    else:
        value = F.lit("1970-01-01")
    return F.coalesce(F.col(key), value.cast(dtype))


def hot_groups(counts: DataFrame, total: Column, parts: int) -> DataFrame:
    """The groups with more rows than an average shuffle partition.

    There are fewer than ``parts`` of them at any size of table, so they may be
    broadcast. ``_share`` says how many average partitions a group would fill;
    the shares add up to ``parts`` at most. ``counts`` has ``_rows``, and
    ``total`` is their sum as a scalar.
    """
    share = F.coalesce(F.col("_rows") * F.lit(parts) / total, F.lit(0.0))
    return F.broadcast(counts.withColumn("_share", share).where(F.col("_share") > 1))


def row_count(df: DataFrame) -> Column:
    """The number of rows as a scalar; a scan of no columns."""
    return df.agg(F.count(F.lit(1))).scalar()


def is_small(df: DataFrame) -> bool:
    """Whether the table may be broadcast: its values are measured, not estimated."""
    size = F.lit(0)
    for name in df.columns:
        size = size + F.coalesce(F.octet_length(F.col(name).cast("string")), F.lit(0)) + 16
    return (df.agg(F.sum(size)).first()[0] or 0) <= BROADCAST_BYTES


def look_up(df: DataFrame, lookup: DataFrame, keys, spread=None) -> DataFrame:
    """``df`` left join ``lookup`` on ``keys``, ``lookup`` having each key once.

    The look-up table is written and measured. A small one is broadcast, and
    ``df`` is not shuffled at all; any other goes through ``left_join_unique``.
    """
    lookup = settle(lookup, "lookup")
    if is_small(lookup):
        return df.join(F.broadcast(lookup), as_list(keys), "left")
    return left_join_unique(df, lookup, keys, spread)


def left_join_unique(
    df: DataFrame,
    lookup: DataFrame,
    keys,
    spread=None,
    counts: DataFrame | None = None,
    keep_part: bool = False,
) -> DataFrame:
    """``df`` left join ``lookup`` on ``keys``, ``lookup`` having each key once, or seldom twice.

    A key that would fill more than a partition is divided, in proportion, and
    its look-up row repeated for each part; together that adds at most as many
    rows as there are partitions. The part comes from a hash of the ``spread``
    columns or, without any, from the input partition, which also divides rows
    that are copies. Null keys match nothing and are divided in the same way.
    ``counts`` (keys and ``_rows``) are the keys that may be divided, if not all
    of ``df``. ``keep_part`` leaves the ``_part`` column, 0 in undivided keys:
    the result is partitioned by keys and part.
    """
    keys = as_list(keys)
    parts = shuffle_parts(df)
    if counts is None:
        counts, total = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")), row_count(df)
    else:
        total = counts.agg(F.sum("_rows")).scalar()
    hot = hot_groups(counts, total, parts).select(*keys, F.ceil("_share").alias("_parts"))

    no_key = F.lit(False)
    for key in keys:
        no_key = no_key | F.col(key).isNull()
    place = F.spark_partition_id() if spread is None else F.xxhash64(*as_list(spread))
    divided = F.when(no_key, F.lit(parts)).otherwise(F.coalesce("_parts", F.lit(1)))
    salted = (
        df.join(hot, keys, "left")
        .withColumn("_part", F.pmod(place.cast("bigint"), divided.cast("bigint")))
        .drop("_parts")
    )
    numbers = F.sequence(F.lit(0).cast("bigint"), F.coalesce("_parts", F.lit(1)) - 1)
    repeated = (
        lookup.join(hot, keys, "left").withColumn("_part", F.explode(numbers)).drop("_parts")
    )
    joined = salted.join(repeated, [*keys, "_part"], "left")
    return joined if keep_part else joined.drop("_part")
