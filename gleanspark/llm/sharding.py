"""Even shards of a table by sampled splitters.

Records are ordered by a hash of their text, then by id, so that equal texts lie
together and a third of all rows being one text is no obstacle. Keys are drawn
with a chance in proportion to the record's size, and the quantiles of the sample
bound the ranges of about equal bytes in which the records are sorted. Ranges
that come out overfull are measured and cut again by a sample of their own.
Running sums inside the ranges then give each record its exact byte place, and
with it the shard. Only DataFrame functions are used; texts are never shuffled.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanspark.operators.skew import shuffle_parts
from gleanspark.workspace import settle

# Sampled keys for each range; fewer would leave ranges of very uneven size.
SAMPLE_PER_RANGE = 64
# A range with this many times its share is cut again.
OVERFULL = 2
# Rounds of cutting; a range of rows all equal in every key is cut by row number.
ROUNDS = 2
ORDER = ["_hash", "_id", "_row"]


def _rank(splitters: Column, key: Column, most: int) -> Column:
    """How many of the sorted splitters are not above the key, by bisection."""
    steps = F.sequence(F.lit(1), F.lit(max(1, most.bit_length())))
    span = F.struct(F.lit(0).alias("low"), F.size(splitters).alias("high"))

    def halve(state: Column, _: Column) -> Column:
        low, high = state["low"], state["high"]
        middle = F.floor((low + high) / 2).cast("int")
        up = (low < high) & (F.get(splitters, middle) <= key)
        return F.struct(
            F.when(up, middle + 1).otherwise(low).alias("low"),
            F.when((low < high) & ~up, middle).otherwise(high).alias("high"),
        )

    return F.aggregate(steps, span, halve, lambda state: state["low"])


def _splitters(rows: DataFrame, per_range: Column, seed: int, most: int) -> DataFrame:
    """``_cell`` and its sorted splitters, from a sample weighted by size.

    ``rows`` has the expected bytes of a range, ``per_range``. The sample has
    about ``SAMPLE_PER_RANGE`` keys for each range to be made, at any size of
    the table; a record as heavy as a whole range is drawn several times over.
    """
    draw = F.pmod(F.xxhash64("_row", F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    hits = F.floor(F.col("_size") * SAMPLE_PER_RANGE / per_range + draw)
    sample = rows.withColumn("_hits", hits).where(F.col("_hits") >= 1)
    by_key = Window.partitionBy("_cell").orderBy(*ORDER)
    before = F.sum("_hits").over(by_key) - F.col("_hits")
    crossed = F.floor((before + F.col("_hits")) / SAMPLE_PER_RANGE) > F.floor(
        before / SAMPLE_PER_RANGE
    )
    chosen = sample.withColumn("_crossed", crossed).where("_crossed")
    return chosen.groupBy("_cell").agg(
        F.slice(F.sort_array(F.collect_list(F.struct(*ORDER))), 1, most).alias("_splitters")
    )


def _placed(rows: DataFrame, ranges: int) -> DataFrame:
    """Add ``_cell``, which rises with the order; cells are ranges of bounded size."""
    total = rows.agg(F.coalesce(F.sum("_size"), F.lit(0)).alias("t")).first()["t"]
    share = F.lit(max(total / ranges, 1.0))
    rows = rows.withColumn("_cell", F.array(F.lit(0)))
    for round_no in range(ROUNDS):
        full = rows
        if round_no:
            sizes = rows.groupBy("_cell").agg(
                F.sum("_size").alias("_bytes"), F.count(F.lit(1)).alias("_n")
            )
            heavy = sizes.where((F.col("_bytes") > OVERFULL * share) & (F.col("_n") > 1))
            full = rows.join(F.broadcast(heavy.select("_cell")), "_cell", "left_semi")
        found = settle(_splitters(full, share, round_no, 4 * ranges), "splitters")
        if round_no:
            rows = rows.join(F.broadcast(found), "_cell", "left")
        else:
            rows = rows.withColumn("_splitters", found.select("_splitters").scalar())
        inner = F.when(
            F.col("_splitters").isNotNull(),
            _rank(F.col("_splitters"), F.struct(*ORDER), 4 * ranges),
        ).otherwise(F.lit(0))
        rows = rows.withColumn("_cell", F.concat("_cell", F.array(inner))).drop("_splitters")
    return rows


def byte_shards(
    df: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Id, ``size``, ``text_crc32``, ``shard`` and ``slot`` of each row.

    Size is the UTF-8 bytes of the text plus one, so null and empty texts weigh
    one. A record is in shard ``k`` if its first byte is in the ``k``-th of equal
    parts of all bytes, so shards differ by one record at most, whatever the
    keys. Slots count from zero inside a shard. Null ids come first; repeated
    rows have places of their own, in no particular order. An empty table
    gives an empty result.
    """
    rows = settle(
        df.select(
            F.col(id_col).alias("_id"),
            (F.coalesce(F.octet_length(text_col), F.lit(0)) + F.lit(1).cast("bigint")).alias("_size"),
            F.crc32(F.coalesce(F.col(text_col), F.lit(""))).alias("_crc"),
            F.xxhash64(F.col(text_col)).alias("_hash"),
            F.monotonically_increasing_id().alias("_row"),
        ),
        "records",
    )
    ranges = max(shards, shuffle_parts(df))
    placed = settle(_placed(rows, ranges), "placed")
    cells = placed.groupBy("_cell").agg(
        F.sum("_size").alias("_bytes"), F.count(F.lit(1)).alias("_n")
    )
    earlier = Window.orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = cells.select(
        "_cell",
        F.coalesce(F.sum("_bytes").over(earlier), F.lit(0)).alias("_byte0"),
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_row0"),
    )
    total = rows.agg(F.coalesce(F.sum("_size"), F.lit(0)).alias("t")).first()["t"]
    inside = Window.partitionBy("_cell").orderBy(*ORDER)
    byte = F.col("_byte0") + F.sum("_size").over(inside) - F.col("_size")
    spots = settle(
        placed.join(F.broadcast(starts), "_cell").select(
            "_id",
            "_size",
            "_crc",
            F.call_function("div", byte * shards, F.lit(max(total, 1))).cast("int").alias("shard"),
            (F.col("_row0") + F.row_number().over(inside) - 1).alias("_place"),
        ),
        "spots",
    )
    firsts = spots.groupBy("shard").agg(F.min("_place").alias("_first"))
    return spots.join(F.broadcast(firsts), "shard").select(
        F.col("_id").alias(id_col),
        F.col("_size").alias("size"),
        F.col("_crc").alias("text_crc32"),
        "shard",
        (F.col("_place") - F.col("_first")).alias("slot"),
    )
