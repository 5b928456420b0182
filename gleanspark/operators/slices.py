"""Ordered work inside groups of any size.

A window over a whole group is one task, however many rows the group has.
Here a group that would fill more than an average shuffle partition is cut into
slices along its order. Where to cut comes from a sample of the group's rows, sorted by
all order columns: slices have about the same number of rows wherever the rows
crowd, and rows that share the first order column are cut by the next one. What one slice
must know of the earlier ones is a sum or a flag; it is aggregated per slice, and
as there are only a few slices per partition it is joined by broadcast, before
the shuffle. The rows are shuffled once, on group and slice, and windowed there.

Which groups to cut is found when an operator is called: that counts the keys,
and samples if a group is large. With no large group a plain window only gets an
empty table joined to it.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanspark.operators.skew import as_list, hot_groups, shuffle_parts, with_group
from gleanspark.workspace import settle

# Slices for each average partition a group would fill, so that slices of
# uneven size still mix well.
SLICES_PER_PART = 4

# Sampled rows for each slice. The sample has a fixed size for a number of
# partitions; more of it makes slices more even.
SAMPLE_PER_SLICE = 64

SLICE = "_slice"


def whole_parts(col: Column, size: int) -> Column:
    """Integer division, exact for any bigint."""
    return F.call_function("div", col, F.lit(size))


@dataclass
class Cut:
    """Rows with their group and slice columns; ``hot`` has those of cut groups only."""

    rows: DataFrame
    hot: DataFrame
    group: list[str]

    @property
    def cells(self) -> list[str]:
        return [*self.group, SLICE]

    def earlier(self):
        """The slices of a group before a slice."""
        window = Window.partitionBy(*self.group).orderBy(SLICE)
        return window.rowsBetween(Window.unboundedPreceding, -1)

    def starts(self) -> DataFrame:
        """How many rows of its group lie before each slice; ``_size`` lie in it."""
        sizes = self.hot.groupBy(*self.cells).agg(F.count(F.lit(1)).alias("_size"))
        before = F.coalesce(F.sum("_size").over(self.earlier()), F.lit(0))
        return sizes.withColumn("_start", before)


def _splitters(rows: DataFrame, group: list[str], order: list[str]) -> DataFrame | None:
    """Where each large group is cut: ``_cuts``, sorted; None if there are no rows.

    The sample is drawn by a hash of the order columns, so that it is the same
    whenever it is taken.
    """
    parts, total = shuffle_parts(rows), rows.count()
    if not total:
        return None
    if group:
        counts = rows.groupBy(*group).agg(F.count(F.lit(1)).alias("_rows"))
        hot = settle(hot_groups(counts, F.lit(total), parts), "large-groups")
        if hot.isEmpty():
            nothing = [F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in order]
            none = hot.select(*group, F.array(F.struct(*nothing)).alias("_cuts"))
            return settle(none, "splitters")
        large = rows.join(F.broadcast(hot), group)
    else:
        share = F.lit(float(parts)).alias("_share")
        large = rows.select("*", F.lit(total).alias("_rows"), share)
    slices = F.ceil(F.col("_share") * SLICES_PER_PART)
    draw = F.pmod(F.xxhash64(*order, F.lit(11)), F.lit(1 << 30)) / float(1 << 30)
    sample = large.where(draw < slices * SAMPLE_PER_SLICE / F.col("_rows"))
    number = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    step = F.greatest(F.lit(1), F.least(F.lit(SAMPLE_PER_SLICE), F.floor(F.col("_rows") / slices)))
    chosen = sample.withColumn("_number", number).where(F.col("_number") % step == 0)
    found = chosen.groupBy(*group).agg(
        F.sort_array(F.collect_list(F.struct(*order))).alias("_cuts")
    )
    return settle(found, "splitters")


def _rank(splitters: Column, key: Column) -> Column:
    """How many of the sorted splitters are not above the key, by bisection."""
    steps = F.sequence(F.lit(1), F.ceil(F.log2(F.size(splitters) + 1)) + 1)
    span = F.struct(F.lit(0).alias("low"), F.size(splitters).alias("high"))

    def halve(state: Column, _: Column) -> Column:
        middle = F.floor((state["low"] + state["high"]) / 2).cast("int")
        going = state["low"] < state["high"]
        up = going & (F.get(splitters, middle) <= key)
        return F.struct(
            F.when(up, middle + 1).otherwise(state["low"]).alias("low"),
            F.when(going & ~up, middle).otherwise(state["high"]).alias("high"),
        )

    return F.aggregate(steps, span, halve, lambda state: state["low"])


def cut(df: DataFrame, keys: list[str], order: list[str]) -> Cut:
    """Give each row its group and slice.

    Slices rise with the order, nulls first, as in a window. Without keys the
    whole table is one group.
    """
    rows, group = with_group(df, keys) if keys else (df, [])
    found = _splitters(rows, group, order)
    if found is None:
        rows = rows.withColumn(SLICE, F.lit(0))
        return Cut(rows, rows.where(F.lit(False)), group)
    if group:
        found = found.where(F.col("_cuts").isNotNull())
        rows = rows.join(F.broadcast(found), group, "left")
    else:
        rows = rows.withColumn("_cuts", found.select("_cuts").scalar())
    is_cut = F.col("_cuts").isNotNull()
    place = F.when(is_cut, _rank(F.col("_cuts"), F.struct(*order))).otherwise(F.lit(0))
    rows = rows.withColumns({SLICE: place, "_hot": is_cut}).drop("_cuts")
    return Cut(rows.drop("_hot"), rows.where("_hot").drop("_hot"), group)


# A row's number in the order is that of its range, shifted so far, and its place in there.
_INSIDE = 33


def _ranged(df: DataFrame, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """A written copy in ranges of the order, with ``_range_id``, and where each range starts.

    One exchange by range sorts the whole table: ranges and places in them
    rise with the order, so counts by range are all that is needed to number rows.
    """
    ascending = [F.asc_nulls_first(c) for c in order]
    ranges = df.repartitionByRange(shuffle_parts(df), *ascending).sortWithinPartitions(*ascending)
    rows = settle(ranges.withColumn("_range_id", F.monotonically_increasing_id()), "ranges")
    inside = F.col("_range_id").bitwiseAND(F.lit((1 << _INSIDE) - 1))
    sizes = rows.groupBy(F.shiftright("_range_id", _INSIDE).alias("_range")).agg(
        (F.max(inside) + 1).alias("_size")
    )
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("_start", F.coalesce(F.sum("_size").over(before), F.lit(0)))
    return rows, settle(starts, "starts")


def _overall(df: DataFrame, order: list[str], name: str) -> DataFrame:
    rows, starts = _ranged(df, order)
    # One row for each shuffle partition at most.
    starts = F.broadcast(starts.select(F.col("_range").alias("_of"), "_start"))
    place = F.col("_start") + F.col("_range_id").bitwiseAND(F.lit((1 << _INSIDE) - 1))
    joined = rows.join(starts, F.shiftright("_range_id", _INSIDE) == F.col("_of"))
    return joined.withColumn(name, place).drop("_range_id", "_of", "_start")


def ordinal(df: DataFrame, keys, order, name: str = "pos") -> DataFrame:
    """Position of each row in its group, from 0, as bigint; without keys, in the whole table.

    ``order`` must be unique within a group, and may be of any types that sort.
    """
    keys, order = as_list(keys), as_list(order)
    if not keys:
        return _overall(df, order, name)
    part = cut(df, keys, order)
    starts = F.broadcast(part.starts().drop("_size"))
    inside = F.row_number().over(Window.partitionBy(*part.cells).orderBy(*order))
    return (
        part.rows.join(starts, part.cells, "left")
        .withColumn(name, F.coalesce("_start", F.lit(0)) + inside - 1)
        .drop(*part.cells, "_start")
    )


def first_rows(df: DataFrame, keys, order, limit: int) -> DataFrame:
    """The first ``limit`` rows of each group.

    Slices past the limit end before the shuffle, and each task sends on at
    most ``limit`` rows of a slice.
    """
    keys, order = as_list(keys), as_list(order)
    part = cut(df, keys, order)
    starts = F.broadcast(part.starts().drop("_size"))
    start = F.coalesce("_start", F.lit(0))
    inside = F.row_number().over(Window.partitionBy(*part.cells).orderBy(*order))
    return (
        part.rows.join(starts, part.cells, "left")
        .where(start < limit)
        .withColumn("_inside", inside)
        .where(F.col("_inside") <= limit)
        .where(start + F.col("_inside") <= limit)
        .drop(*part.cells, "_start", "_inside")
    )


def until_first(df: DataFrame, keys, order, stop: Column) -> DataFrame:
    """Rows of each group up to and including the first where ``stop`` holds.

    Slices after that one end before the shuffle. ``df`` is read more than
    once, though only its key, order and stop columns; settle it first if these
    are costly.
    """
    keys, order = as_list(keys), as_list(order)
    part = cut(df.withColumn("_stop", stop), keys, order)
    stops = part.hot.groupBy(*part.cells).agg(
        F.coalesce(F.max("_stop"), F.lit(False)).alias("_stops")
    )
    reached = F.broadcast(
        stops.select(*part.cells, F.max("_stops").over(part.earlier()).alias("_reached"))
    )
    inside = Window.partitionBy(*part.cells).orderBy(*order)
    seen = F.max("_stop").over(inside.rowsBetween(Window.unboundedPreceding, -1))
    return (
        part.rows.join(reached, part.cells, "left")
        .where(~F.coalesce("_reached", F.lit(False)))
        .withColumn("_seen", seen)
        .where(~F.coalesce("_seen", F.lit(False)))
        .drop(*part.cells, "_stop", "_reached", "_seen")
    )


def after_first(df: DataFrame, n: Column, order) -> DataFrame:
    """Skip the first ``n`` rows of the whole table; ``n`` is a scalar.

    Only the order columns are sorted, by range; the row where the table goes on is found
    among the ranges' counts. The table itself is scanned and filtered, never
    shuffled. ``order`` must be unique.
    """
    order = as_list(order)
    rows, starts = _ranged(df.select(*order), order)
    edge = starts.where((F.col("_start") <= n) & (F.col("_start") + F.col("_size") > n))
    number = F.call_function("shiftleft", F.col("_range"), F.lit(_INSIDE)) + n - F.col("_start")
    first_kept = rows.where(F.col("_range_id") == edge.select(number).scalar())
    return df.where(F.struct(*order) >= first_kept.select(F.struct(*order)).scalar())
