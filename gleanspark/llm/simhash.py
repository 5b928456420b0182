"""SimHash fingerprints, and near duplicates by exact comparison in tiles.

Fingerprints within the radius agree in at least one of ``radius + 1`` bands, so
only those that share a band's value are compared: in tiles, by exclusive-or
and bit counts, where tiles whose population counts differ by more than the
radius are skipped. A band value with more fingerprints than a tile holds is cut in
tiles by population count and hash, and each pair of tiles is a job of its own.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanspark.llm.batches import BATCH_ROWS, as_bytes, groups, texts
from gleanspark.llm.components import stars
from gleanspark.llm.rows import KEYS, free_names, key, matching
from gleanspark.workspace import settle

SEED = 42
# Fingerprints in a tile.
TILE = 2048
# Rows compared with a tile at once.
STRIP = 256


def fingerprint(text: bytes, size: int) -> int:
    """64 bits, each set if set in over half the shingles of ``size`` words."""
    words = text.lower().split()
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    if n <= size:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1)
    starts = np.concatenate(([0], ends[: n - size])).tolist()
    stops = (ends[size - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    count = n - size + 1
    hashes = np.fromiter(
        (digest(joined[a:b], SEED) for a, b in zip(starts, stops, strict=True)), np.uint64, count
    )
    votes = np.zeros(64, np.int64)
    for at in range(0, count, 65_536):
        part = hashes[at : at + 65_536].view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(votes * 2 > count, bitorder="little")
    return int(bits.view(np.uint64)[0])


def fingerprints(df: DataFrame, id_col: str, text_col: str, size: int = 4) -> DataFrame:
    """The key of each row, and its fingerprint ``fp`` as a signed bigint.

    Letters A to Z are lowered. A text of fewer words is one shingle; without
    words, or null, its fingerprint is zero.
    """
    wanted = df.select(*key(id_col, text_col), as_bytes(text_col).alias("text"))

    def work(batches):
        for batch in batches:
            marks = np.fromiter(
                (fingerprint(t, size) for t in texts(batch, "text")), np.uint64, batch.num_rows
            )
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in KEYS), pa.array(marks.view(np.int64))],
                names=[*KEYS, "fp"],
            )

    return wanted.mapInArrow(
        work, f"{KEYS[0]} {dict(df.dtypes)[id_col]}, {KEYS[1]} bigint, fp bigint"
    )


def _jobs(marks: DataFrame, radius: int, tile: int) -> DataFrame:
    """Rows ``job, side, pop, fp``: side 0 meets itself, side 1 meets side 2."""
    bands, shift, spans = radius + 1, 0, []
    for i in range(bands):
        width = 64 // bands + (i < 64 % bands)
        value = F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit((1 << width) - 1))
        spans.append(F.struct(F.lit(i).alias("band"), value.alias("value")))
        shift += width
    rows = marks.select("fp", F.bit_count("fp").alias("pop"), F.explode(F.array(*spans)).alias("at"))
    rows = rows.select("at.band", "at.value", "pop", "fp")
    cell = ["band", "value"]

    sizes = rows.groupBy(*cell, "pop").agg(F.count(F.lit(1)).alias("n"))
    large = sizes.groupBy(*cell).agg(F.sum("n").alias("all")).where(F.col("all") > tile)
    tiles = settle(
        sizes.join(large, cell)
        .withColumn("cuts", F.ceil(F.col("n") / tile))
        .withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("cuts") - 1)))
        .select(*cell, "pop", "cuts", "salt"),
        "tiles",
    )
    left = tiles.select(*cell, F.struct("pop", "salt").alias("a"))
    right = tiles.select(*cell, F.struct("pop", "salt").alias("b"))
    near = F.col("b.pop") - F.col("a.pop") <= radius
    pairs = left.join(right, cell).where((F.col("a") <= F.col("b")) & near)
    pairs = pairs.withColumn("job", F.xxhash64(*cell, "a", "b"))
    self_side = F.when(F.col("a") == F.col("b"), F.lit(0))
    sides = pairs.select(
        *cell, "job", F.explode(
            F.array_distinct(F.array(
                F.struct(F.col("a").alias("tile"), F.coalesce(self_side, F.lit(1)).alias("side")),
                F.struct(F.col("b").alias("tile"), F.coalesce(self_side, F.lit(2)).alias("side")),
            ))
        ).alias("of"),
    ).select(*cell, "job", F.col("of.tile.pop").alias("pop"), F.col("of.tile.salt").alias("salt"), "of.side")

    cut = tiles.select(*cell, "pop", "cuts").distinct()
    placed = rows.join(cut, [*cell, "pop"], "left")
    small = placed.where(F.col("cuts").isNull()).select(
        F.xxhash64(*cell).alias("job"), F.lit(0).alias("side"), "pop", "fp"
    )
    big = (
        placed.where(F.col("cuts").isNotNull())
        .withColumn("salt", F.pmod(F.xxhash64("fp", F.lit(7)), F.col("cuts")))
        .join(sides, [*cell, "pop", "salt"])
        .select("job", "side", "pop", "fp")
    )
    return small.unionByName(big)


class _Labels:
    """Components of the fingerprints of one job, so that a job emits few links."""

    def __init__(self, n: int):
        self.of = np.arange(n)

    def link(self, i: np.ndarray, j: np.ndarray) -> None:
        while True:
            a, b = self.of[i], self.of[j]
            apart = a != b
            if not apart.any():
                return
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(self.of, np.maximum(a, b), np.minimum(a, b))
            while (roots := self.of[self.of]).tolist() != self.of.tolist():
                self.of = roots


def _compare(labels, x, xpop, at_x, y, ypop, at_y, radius, same):
    """Link what lies within the radius; both sides are sorted by population count."""
    for begin in range(0, len(x), STRIP):
        end = min(begin + STRIP, len(x))
        low = np.searchsorted(ypop, xpop[begin] - radius, "left")
        high = np.searchsorted(ypop, xpop[end - 1] + radius, "right")
        if same:
            low = max(low, begin)
        if low >= high:
            continue
        apart = np.bitwise_count(x[begin:end, None] ^ y[None, low:high])
        i, j = np.nonzero(apart <= radius)
        i, j = at_x[begin + i], at_y[low + j]
        labels.link(i[i != j], j[i != j])


def links(marks: DataFrame, radius: int, tile: int = TILE) -> DataFrame:
    """Links ``u, v`` that join just the fingerprints ``fp`` that chains within the radius join."""

    def work(batches):
        left, right, n = [], [], 0
        for _, job in groups(batches, "job"):
            fp, pop, side = job["fp"].view(np.uint64), job["pop"], job["side"]
            if len(fp) < 2:
                continue
            labels, at = _Labels(len(fp)), np.arange(len(fp))
            alone, a, b = side == 0, side == 1, side == 2
            if alone.any():
                own = fp[alone], pop[alone], at[alone]
                _compare(labels, *own, *own, radius, True)
            if a.any() and b.any():
                sides = (fp[a], pop[a], at[a]), (fp[b], pop[b], at[b])
                _compare(labels, *sides[0], *sides[1], radius, False)
            moved = labels.of != at
            left.append(job["fp"][moved])
            right.append(job["fp"][labels.of[moved]])
            n += int(moved.sum())
            if n >= BATCH_ROWS:
                yield _pairs(left, right)
                left, right, n = [], [], 0
        if n:
            yield _pairs(left, right)

    rows = _jobs(marks, radius, tile)
    dealt = rows.repartition("job").sortWithinPartitions("job", "side", "pop")
    return dealt.mapInArrow(work, "u bigint, v bigint")


def _pairs(left, right) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate(left)), pa.array(np.concatenate(right))], names=["u", "v"]
    )


def near_groups(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = 4,
    radius: int = 4,
    tile: int = TILE,
) -> DataFrame:
    """Key, ``fp`` and ``component_id`` of each row: the least id that links reach.

    Equal fingerprints count once, so copies cost no comparison. Null or empty
    texts have the fingerprint zero and link like any other. Null ids are no
    least id; a component of null ids has a null ``component_id``. Repeated rows
    are returned as often as they come.
    """
    marked = settle(fingerprints(df, id_col, text_col, size), "fingerprints")
    firsts = settle(marked.groupBy("fp").agg(F.min(KEYS[0]).alias("first")), "firsts")
    roots = stars(links(firsts.select("fp"), radius, tile))
    rooted = firsts.join(roots.withColumnsRenamed({"u": "fp", "v": "root"}), "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(least, "root").select("fp", "component_id")
    return marked.join(named, "fp").select(*KEYS, "fp", "component_id")


def keep_one(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = 4,
    radius: int = 4,
) -> DataFrame:
    """One row of each group of near duplicates: that with the least id. Columns may have any names.

    Rows without an id are all kept. Rows that share the least id stay once if
    their texts are equal too, otherwise all of them do.
    """
    grouped = settle(near_groups(df, id_col, text_col, size, radius), "groups")
    first = F.col(KEYS[0]).isNull() | (F.col(KEYS[0]) == F.col("component_id"))
    kept = grouped.where(first).groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n"))
    rows = matching(df, kept, id_col, text_col)
    repeated = kept.where((F.col("n") > 1) & F.col(KEYS[0]).isNotNull())
    if repeated.isEmpty():
        return rows
    names = free_names(df.columns, *KEYS)
    once = rows.select("*", *key(id_col, text_col, names))
    some = F.col(names[0]).isNull()
    return once.where(some).unionByName(once.where(~some).dropDuplicates(names)).drop(*names)
