"""Containment between rows of a group, without pairing rows through a shuffle.

Items of a group that is known to be small meet in one array. In any other
group an item is found through one of its grams: 1, 2, 4, 8 or 16 characters,
whichever is the most it has. Of its grams it takes one that is rare in a sample of
the group, so what many items begin or end with finds nobody. Every item is
searched for grams of the sizes its group has, and where one occurs the piece of the
right length around it is cut out. Pieces that equal an item of the group mark it as
contained. Both ways are exact: any of an item's grams finds it, and the
sample only decides which. Places whose gram no item is looked for by are left out
before anything is shuffled, and so are the choices of an item with a gram that the
sample has nowhere, which is nearly every item.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanspark.functions import text as texts
from gleanspark.operators.skew import as_list, left_join_unique, shuffle_parts, with_group
from gleanspark.workspace import settle

GRAMS = [1, 2, 4, 8, 16]

# Grams that an item chooses from, at even distances.
CHOICES = 16
# Of these it looks at so many first, from its end on. The first that the sample has
# nowhere is taken at once, and only an item without any counts its choices.
QUICK_CHOICES = 4
# One in so many items is in the sample that tells which grams are rare.
SAMPLED = 16
# Characters in which an item is searched at a time, as finding a place in a text
# takes longer the further in it lies; first large blocks, then small ones in these.
LARGE_BLOCK = 8192
BLOCK = 128

# A list of needles' grams that is sent to all tasks has so many bits at most, 32 MB.
MOST_BITS = 28

# Fragments of one row that are compared in its array.
ROW_ITEMS = 500

# What a group may hold to be compared in one array; up to there that is the
# quicker way as well.
ARRAY_ITEMS = 2_000
ARRAY_CHARS = 4_000_000


def remove_contained_rows(
    df: DataFrame, keys, item: str, array_items: int = ARRAY_ITEMS
) -> DataFrame:
    """Drop the rows whose item is part of a different item of their group.

    Equal items stay, as do rows without an item. Small groups are shuffled
    once, to join their size, and compared where they are then. The rows of large
    groups are written first, as they are read several times; the sizes alone,
    which are counted when this is called, tell if there are any.
    """
    grouped, group = with_group(df, as_list(keys))
    length = F.length(item)
    sizes = grouped.groupBy(*group).agg(
        F.count(F.lit(1)).alias("_rows"),
        F.coalesce(F.sum(length), F.lit(0)).alias("_chars"),
        # The sizes are powers of two, so together they are a set of bits.
        F.bit_or(_gram_size(length)).alias("_grams"),
    )
    fits = (F.col("_rows") <= array_items) & (F.col("_chars") <= ARRAY_CHARS)
    sizes = settle(sizes.withColumn("_fits", fits), "sizes")
    sized = left_join_unique(
        grouped,
        sizes.select(*group, "_fits", "_grams"),
        group,
        counts=sizes.where("NOT _fits").select(*group, "_rows"),
        keep_part=True,
    )
    small = _keep_in_arrays(sized.where("_fits"), [*group, "_part"], df.columns, item)
    if sizes.where("NOT _fits").isEmpty():
        return small
    large = settle(sized.where("NOT _fits").drop("_part"), "large")
    return small.unionByName(_keep_by_grams(large, group, item).select(*df.columns))


def remove_contained_items(
    df: DataFrame, keys, items: str, row_items: int = ROW_ITEMS
) -> DataFrame:
    """``functions.text.remove_contained`` for lists of any length; ``keys`` is unique.

    Up to ``row_items`` entries are compared where they are. Longer lists are dealt out
    as rows, reduced there and put together again, in the same order; they
    are written first, so ``df`` is read once for these and once for all others.
    A null list stays null, a null entry stays where it is.
    """
    keys, size = as_list(keys), F.coalesce(F.size(items), F.lit(0))
    short = df.where(size <= row_items)
    short = short.withColumn(items, texts.remove_contained(F.col(items)))
    long = settle(df.where(size > row_items), "long-lists")
    if long.isEmpty():
        return short
    entries = long.select(*keys, F.posexplode(items).alias("_pos", "_item"))
    kept, group = with_group(remove_contained_rows(entries, keys, "_item", 0), keys)
    rows, _ = with_group(long, keys)
    entry = F.sort_array(F.collect_list(F.struct("_pos", "_item")))
    lists = kept.groupBy(*group).agg(entry.alias("_kept"))
    left = rows.join(lists, group, "left").withColumn(items, F.col("_kept._item"))
    return short.unionByName(left.select(*df.columns))


def _gram_size(length: Column) -> Column:
    size = F.lit(0)
    for larger in GRAMS:
        size = F.when(length >= larger, F.lit(larger)).otherwise(size)
    return size


def _keep_in_arrays(
    rows: DataFrame, group: list[str], columns: list[str], item: str
) -> DataFrame:
    def contained(row: Column) -> Column:
        inside = F.exists(
            "_rows", lambda other: (other[item] != row[item]) & F.contains(other[item], row[item])
        )
        # Rows without an item leave it open whether one holds this.
        return F.coalesce(inside, F.lit(False))

    lists = rows.groupBy(*group).agg(F.collect_list(F.struct(*columns)).alias("_rows"))
    kept = F.filter("_rows", lambda row: ~contained(row))
    return lists.select(F.inline(kept))


def _keep_by_grams(rows: DataFrame, group: list[str], item: str) -> DataFrame:
    copies = rows.groupBy(*group, item).agg(
        F.count(F.lit(1)).alias("_rows"), F.first("_grams").alias("_grams")
    )
    items = copies.where(F.col(item).isNotNull()).drop("_rows")
    contained = _contained(items, group, item).withColumn("_contained", F.lit(True))
    counts = copies.drop("_grams")
    marked = left_join_unique(rows, contained, [*group, item], counts=counts)
    return marked.where(F.col("_contained").isNull())


def _contained(items: DataFrame, group: list[str], item: str) -> DataFrame:
    """Contained items; the work grows with the text, not with pairs of items.

    Grams and items travel as hashes. A false match only cuts out another
    true piece of an item, shorter than it, so it changes nothing.
    """
    ids = items.withColumns(
        {
            "_id": F.xxhash64(item),
            "_id2": F.xxhash64(F.lit("id"), item),
            "_length": F.length(item),
        }
    )
    # Read several times, and finding the items among their copies takes a shuffle.
    filled = settle(ids.where(F.col("_length") > 0), "items")
    hits = _hits(filled, group, item)

    def pieces(some: DataFrame, text: str) -> DataFrame:
        return some.select(*group, F.substring(text, F.col("_from"), F.col("_cut")).alias(item))

    # A short item comes with its places, a longer one is fetched. The test on the
    # length goes down to the scan, so each item is searched for one of them only.
    short = pieces(hits.where(F.col("_length") <= BLOCK), "_whole")
    texts = filled.select(*group, "_id", "_id2", item)
    long = hits.where(F.col("_length") > BLOCK).join(texts, [*group, "_id", "_id2"])

    # An empty item is part of any other, whatever its place.
    beside_empty = filled.select(*group, F.lit("").alias(item))
    return short.unionByName(pieces(long, item)).unionByName(beside_empty).distinct()


def _hits(filled: DataFrame, group: list[str], item: str) -> DataFrame:
    """Where an item may hold another: ``_id, _id2, _length, _whole, _from, _cut``.

    ``filled`` has each item of a group once, none of them empty.
    """
    sample = filled.where(F.pmod("_id2", F.lit(SAMPLED)) == 0)
    counts = settle(
        _grams(sample, group, item)
        .groupBy(*group, "_gram")
        .agg(F.count(F.lit(1)).alias("_rows")),
        "gram-counts",
    )
    needles = settle(_needles(filled, group, item, counts), "needles")
    probes = _grams(filled, group, item, _Among(needles, [*group, "_gram"]))
    # A gram is divided if the sample says that it is in very many places.
    spread = ["_id", "_at"]
    found = left_join_unique(probes, needles, [*group, "_gram"], spread, counts=counts)
    start = F.col("_at") - F.col("_shift")
    inside = (start >= 1) & (start + F.col("_cut") - 1 <= F.col("_length"))
    return found.where((F.col("_cut") < F.col("_length")) & inside).select(
        *group, "_id", "_id2", "_length", "_whole", start.alias("_from"), "_cut"
    )


class _Among:
    """A test in the scan whether a key may be one of ``keys``; it says no only if it is not.

    Bits of a list of whole numbers, three to a key, some twenty for each key up to
    ``MOST_BITS``. Beyond, more keys pass that need not; none is lost.
    """

    def __init__(self, keys: DataFrame, names: list[str]):
        self.names, n = names, keys.count()
        self.bits = min(MOST_BITS, max(12, (20 * n).bit_length()))
        spots = keys.select(F.explode(F.array(*self._spots())).alias("spot"))
        here = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.expr("int(spot & 63)"))
        # Every word of the list is there, most of them empty.
        words = spots.select(F.shiftright("spot", 6).alias("word"), here.alias("set"))
        empty = keys.sparkSession.range(1 << (self.bits - 6)).select(
            F.col("id").alias("word"), F.lit(0).cast("bigint").alias("set")
        )
        words = words.unionByName(empty).groupBy("word").agg(F.bit_or("set").alias("set"))
        listed = F.sort_array(F.collect_list(F.struct("word", "set")))
        self.words = settle(words.agg(listed["set"].alias("words")), "gram-filter").scalar()

    def _spots(self, names: list[str] | None = None) -> list[Column]:
        mixed = F.xxhash64(*(names or self.names))
        # Three runs of bits of the hash; with more than 21 they overlap.
        step = min(self.bits, (64 - self.bits) // 2)
        mask = F.lit((1 << self.bits) - 1).cast("bigint")
        return [F.shiftrightunsigned(mixed, i * step).bitwiseAND(mask) for i in range(3)]

    def may_be(self, names: list[str] | None = None) -> Column:
        """Whether the columns ``names``, by default those of the keys, may be a key."""
        tests = [
            F.getbit(F.get(self.words, F.shiftright(spot, 6).cast("int")), spot.bitwiseAND(F.lit(63)))
            == 1
            for spot in self._spots(names)
        ]
        return tests[0] & tests[1] & tests[2]


def _grams(
    filled: DataFrame, group: list[str], item: str, among: _Among | None = None
) -> DataFrame:
    """One row for each size of gram in the group and each place ``_at`` where it fits.

    Only those ``among`` the wanted ones become rows that go on: the others end in
    the stage that makes them, which is compiled as a whole. ``_whole`` is an item of
    one block.
    """
    own = [*group, "_id", "_id2", "_length", "_grams"]
    length, text = F.col("_length"), F.col(item)

    def blocks(text: Column, length: Column, size: int, rest: int) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.floor((length - 1) / size).cast("int")),
            lambda number: F.struct(
                (number * size).alias("_start"),
                F.substring(text, number * size + 1, F.lit(size + rest)).alias("_text"),
            ),
        )

    rest = max(GRAMS) - 1
    # The texts are small next to the rows they become: keep them in many parts.
    parts = shuffle_parts(filled)
    spread = filled.select(*own, F.inline(blocks(text, length, LARGE_BLOCK, rest)))
    spread = spread.repartition(parts, "_id", "_start").withColumnRenamed("_start", "_large")
    here = F.least(F.lit(LARGE_BLOCK), length - F.col("_large"))
    spread = spread.select(*own, "_large", F.inline(blocks(F.col("_text"), here, BLOCK, rest)))
    spread = spread.select(
        *own, (F.col("_large") + F.col("_start")).alias("_before"), F.col("_text").alias("_block")
    )
    sizes = F.filter(
        F.array(*map(F.lit, GRAMS)),
        lambda size: (F.col("_grams").bitwiseAND(size) != 0) & (F.col("_before") + size <= length),
    )
    sized = spread.select(*own, "_before", "_block", F.explode(sizes).alias("_size"))
    last = F.least(F.lit(BLOCK), length - F.col("_before") - F.col("_size") + 1)
    placed = sized.select("*", F.explode(F.sequence(F.lit(1), last)).alias("_in"))
    found = placed.select(
        *own,
        (F.col("_before") + F.col("_in")).alias("_at"),
        F.xxhash64(F.substring("_block", F.col("_in"), F.col("_size"))).alias("_gram"),
        F.when(length <= BLOCK, F.col("_block")).alias("_whole"),
    ).drop("_grams")
    return found.where(among.may_be()) if among else found


def _needles(filled: DataFrame, group: list[str], item: str, counts: DataFrame) -> DataFrame:
    """``_gram, _shift, _cut``: items by length and the place of the gram that finds them."""
    length, text = F.col("_length"), F.col(item)
    size = _gram_size(length)

    def gram(shift: Column) -> Column:
        return F.xxhash64(F.substring(text, shift + 1, size))

    own = [*group, "_id", "_id2", "_length"]
    quick, number = {}, range(QUICK_CHOICES)
    for i in number:
        shift = length - size - F.floor((length - size) * i / (QUICK_CHOICES - 1)).cast("int")
        quick |= {f"_shift{i}": shift, f"_gram{i}": gram(shift)}
    sampled = _Among(counts, [*group, "_gram"])
    unseen = [
        F.when(
            ~sampled.may_be([*group, f"_gram{i}"]),
            F.struct(F.col(f"_gram{i}").alias("_gram"), F.col(f"_shift{i}").alias("_shift")),
        )
        for i in number
    ]
    tried = filled.select(*own, item, *(c.alias(n) for n, c in quick.items()))
    tried = settle(tried.select(*own, item, F.coalesce(*unseen).alias("_best")), "choices")

    step = F.greatest(F.lit(1), F.ceil((length - size) / (CHOICES - 1)).cast("int"))
    shifts = F.array_union(F.sequence(F.lit(0), length - size, step), F.array(length - size))
    choices = F.transform(
        shifts, lambda shift: F.struct(shift.alias("_shift"), gram(shift).alias("_gram"))
    )
    choices = tried.where(F.col("_best").isNull()).select(*own, F.inline(choices))
    known = left_join_unique(choices, counts, [*group, "_gram"], "_id", counts=counts)
    rarity = F.struct(F.coalesce("_rows", F.lit(0)).alias("_rows"), "_gram", "_shift")
    best = known.groupBy(*own).agg(F.min(rarity).alias("_best"))
    found = [
        some.select(*group, "_best._gram", "_best._shift", length.alias("_cut"))
        for some in (tried.where(F.col("_best").isNotNull()), best)
    ]
    return found[0].unionByName(found[1]).distinct()
