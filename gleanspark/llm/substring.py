"""Removal of word runs that an earlier document holds too.

Two passes over the texts. In the first, each partition counts in a count-min
sketch, and the sketches are merged: an estimate is never below the count. In the
second, only windows estimated in two documents or more are grouped exactly.

The sketch does not count every window, but its anchor: the least hash among the
shorter windows inside. Equal windows have equal anchors, so the count of a
window's anchor is never below that of the window, and nothing is lost; one
anchor stands for some twenty windows in a row, so the sketch stays small.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanspark.llm.batches import (
    BATCH_ROWS,
    WordHashes,
    as_bytes,
    groups,
    second_lane,
    texts,
    windows,
)
from gleanspark.llm.rows import KEYS, key, same_key, with_key
from gleanspark.operators.skew import is_small, shuffle_parts
from gleanspark.workspace import settle

# Words of an anchor.
ANCHOR = 8
DEPTH = 2
# Cells of a sketch row: about four for each anchor, between these bounds. With
# more anchors than the upper bound has cells, estimates rise and the second
# pass groups more windows; none is lost at any size.
LEAST_BITS, MOST_BITS = 16, 30
BLOCK_BITS = 16
RESULT = ["n_words", "n_removed", "kept_sha256"]
EMPTY_SHA = hashlib.sha256(b"").hexdigest()
_LANES = [np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)]


def _anchors(values: np.ndarray, size: int) -> np.ndarray:
    """Of each window of ``size`` words the least hash of the windows of ``ANCHOR`` words in it."""
    least = windows(values, min(ANCHOR, size))
    span = size - min(ANCHOR, size) + 1
    width = 1
    while 2 * width <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if span > width:
        rest = span - width
        least = np.minimum(least[:-rest], least[rest:])
    return least


def _cells(anchors: np.ndarray, bits: int) -> list[np.ndarray]:
    return [(anchors * lane) >> np.uint64(64 - bits) for lane in _LANES]


def sketch_bits(df: DataFrame, text_col: str) -> int:
    """From the size of all texts: some 130 bytes an anchor, four cells each."""
    total = df.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    return min(MOST_BITS, max(LEAST_BITS, (total // 32).bit_length()))


def sketch(df: DataFrame, text_col: str, size: int, bits: int) -> DataFrame:
    """Blocks of the merged sketch: ``block``, and a bit for each cell counted twice or more."""
    per_block = 1 << min(BLOCK_BITS, bits)
    blocks = (1 << bits) // per_block

    def count(batches):
        hashes, seen = WordHashes(), []
        for batch in batches:
            for text in texts(batch, "text"):
                found = _anchors(hashes.of(text.split()), size)
                if len(found):
                    seen.append(np.unique(found))
        if not seen:
            return
        found = np.concatenate(seen)
        for row, cells in enumerate(_cells(found, bits)):
            cells, counts = np.unique(cells, return_counts=True)
            starts = np.searchsorted(cells, np.arange(blocks + 1, dtype=np.uint64) * per_block)
            for block in np.flatnonzero(np.diff(starts)):
                part = slice(starts[block], starts[block + 1])
                inside = (cells[part] % np.uint64(per_block)).astype("<u4")
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row * blocks + int(block)], pa.int32()),
                        pa.array([inside.tobytes()]),
                        pa.array([np.minimum(counts[part], 2).astype(np.uint8).tobytes()]),
                    ],
                    names=["block", "cells", "counts"],
                )

    def merge(batches):
        for block, rows in groups(batches, "block"):
            total = np.zeros(per_block, np.uint8)
            for cells, counts in zip(rows["cells"], rows["counts"], strict=True):
                at = np.frombuffer(cells, "<u4")
                total[at] = np.minimum(total[at] + np.frombuffer(counts, np.uint8), 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int32()), pa.array([np.packbits(total == 2).tobytes()])],
                names=["block", "twice"],
            )

    parts = df.select(as_bytes(text_col).alias("text")).mapInArrow(
        count, "block int, cells binary, counts binary"
    )
    dealt = parts.repartition("block").sortWithinPartitions("block")
    return dealt.mapInArrow(merge, "block int, twice binary")


def _gather(blocks: DataFrame, bits: int) -> bytes:
    """The merged sketch in one piece; its size is fixed by ``bits``."""
    per_block = (1 << min(BLOCK_BITS, bits)) // 8
    whole = bytearray(DEPTH * (1 << bits) // 8)
    for row in blocks.toLocalIterator():
        whole[row["block"] * per_block : (row["block"] + 1) * per_block] = row["twice"]
    return bytes(whole)


def suspects(df: DataFrame, text_col: str, size: int, bits: int, marks) -> DataFrame:
    """Windows estimated in two documents or more: key, two hashes, ``start``.

    ``df`` has the key columns; ``marks`` is the broadcast sketch.
    """
    id_type = dict(df.dtypes)[KEYS[0]]

    def work(batches):
        hashes = WordHashes()
        bitmap = np.frombuffer(marks.value, np.uint8).reshape(DEPTH, -1)
        for batch in batches:
            rows, one, two, starts, n = [], [], [], [], 0
            for i, text in enumerate(texts(batch, "text")):
                values = hashes.of(text.split())
                anchors = _anchors(values, size)
                if not len(anchors):
                    continue
                likely = np.ones(len(anchors), bool)
                for row, cells in zip(bitmap, _cells(anchors, bits), strict=True):
                    bit = np.uint64(7) - (cells & np.uint64(7))
                    likely &= (row[(cells >> np.uint64(3)).astype(np.int64)] >> bit) & 1 == 1
                at = np.flatnonzero(likely)
                if not len(at):
                    continue
                one.append(windows(values, size)[at])
                two.append(windows(second_lane(values), size)[at])
                rows.append(np.full(len(at), i))
                starts.append(at)
                n += len(at)
                if n >= BATCH_ROWS:
                    yield _window_rows(batch, rows, one, two, starts)
                    rows, one, two, starts, n = [], [], [], [], 0
            if n:
                yield _window_rows(batch, rows, one, two, starts)

    wanted = df.select(*KEYS, as_bytes(text_col).alias("text"))
    return wanted.mapInArrow(
        work, f"{KEYS[0]} {id_type}, {KEYS[1]} bigint, one bigint, two bigint, start bigint"
    )


def _window_rows(batch, rows, one, two, starts) -> pa.RecordBatch:
    at = pa.array(np.concatenate(rows))
    return pa.RecordBatch.from_arrays(
        [
            *(batch.column(n).take(at) for n in KEYS),
            pa.array(np.concatenate(one).view(np.int64)),
            pa.array(np.concatenate(two).view(np.int64)),
            pa.array(np.concatenate(starts)),
        ],
        names=[*KEYS, "one", "two", "start"],
    )


def repeated(found: DataFrame) -> DataFrame:
    """Of the windows those that also start in a document with a smaller id.

    A window with more rows than an average partition is hot: there are fewer of
    these than partitions, so they are broadcast and their rows stay where they are.
    """
    by = ["one", "two"]
    share = found.count() / shuffle_parts(found)
    firsts = (
        found.groupBy(*by)
        .agg(
            F.min(KEYS[0]).alias("first"),
            F.max(KEYS[0]).alias("last"),
            F.max(F.col(KEYS[0]).isNull()).alias("nulls"),
            F.count(F.lit(1)).alias("n"),
        )
        .select(*by, "first", "last", "nulls", (F.col("n") > share).alias("hot"))
    )
    later = F.col(KEYS[0]).isNull() | (F.col(KEYS[0]) > F.col("first"))
    several = (F.col("first") < F.col("last")) | (F.col("first").isNotNull() & F.col("nulls"))
    hot = settle(firsts.where("hot"), "hot-windows")
    cold = firsts.where(~F.col("hot") & several).select(*by, "first")
    common = found.join(F.broadcast(hot.where(several).select(*by, "first")), by)
    others = found.join(F.broadcast(hot.select(*by)), by, "left_anti").join(cold, by)
    return common.unionByName(others).where(later).select(*KEYS, "start")


def _kept(words: list[bytes], starts, size: int) -> list[bytes]:
    if starts is None or not len(starts):
        return words
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, np.asarray(starts) + size, -1)
    gone = np.cumsum(edges[:-1]) > 0
    return [w for w, g in zip(words, gone.tolist(), strict=True) if not g]


def remove_repeats(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = 50,
    with_text: bool = True,
) -> DataFrame:
    """Key, ``n_words``, ``n_removed``, ``kept_sha256`` and (if asked) ``kept`` of each row.

    Words are runs of anything but ASCII white space. A word goes if a window of
    ``size`` words over it also starts in a document with a smaller id; windows
    are judged on the input. A null id comes after all others. Null text has no
    words. Rows with one id are one document: they take nothing from each other.

    Exact copies need no windows: with ``size`` words or more all of theirs
    start in the first copy too, so only first copies are searched.
    """
    spark = df.sparkSession
    digest = F.xxhash64(F.lit("copy"), F.col(text_col))
    narrow = df.select(*key(id_col, text_col), digest.alias("digest"))
    narrow = settle(narrow, "texts")
    firsts = (
        narrow.groupBy(KEYS[1], "digest")
        .agg(F.min(KEYS[0]).alias("first"), F.count(F.lit(1)).alias("n"))
        .where((F.col("n") > 1) & F.col("first").isNotNull())
        .drop("n")
    )
    # Written, so that Spark may split the rows of a text with very many copies.
    firsts = settle(firsts, "first-copies")
    later = F.col(KEYS[0]).isNull() | (F.col(KEYS[0]) > F.col("first"))
    copies = settle(
        narrow.join(firsts, [KEYS[1], "digest"]).where(later).select(*KEYS, "first"), "copies"
    )
    keyed = with_key(df.select(id_col, text_col), id_col, text_col)
    known = copies.select(*KEYS).distinct()
    if is_small(known):
        known = F.broadcast(known)
    own = keyed.join(known, same_key(keyed, known), "left_anti")

    bits = sketch_bits(df, text_col)
    marks = spark.sparkContext.broadcast(
        _gather(settle(sketch(own, text_col, size, bits), "sketch"), bits)
    )
    found = settle(suspects(own, text_col, size, bits, marks), "suspects")
    starts = (
        repeated(found)
        .groupBy(*KEYS)
        .agg(F.collect_set("start").alias("starts"))
        .withColumnsRenamed({KEYS[0]: "of_id", KEYS[1]: "of_text"})
    )
    same = own[KEYS[0]].eqNullSafe(starts["of_id"]) & (own[KEYS[1]] == starts["of_text"])
    searched = own.join(starts, same, "left").select(
        *KEYS, as_bytes(text_col).alias("text"), "starts"
    )

    def finish(batches):
        for batch in batches:
            out = []
            lists = batch.column("starts").to_pylist()
            for text, at in zip(texts(batch, "text"), lists, strict=True):
                words = text.split()
                rest = _kept(words, at, size)
                kept = b" ".join(rest)
                digest = hashlib.sha256(kept).hexdigest()
                out.append((len(words), len(words) - len(rest), digest, kept if with_text else b""))
            columns = list(zip(*out, strict=True)) or [()] * 4
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(n) for n in KEYS),
                    *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True)),
                ],
                names=[*KEYS, *RESULT, "kept"],
            )

    schema = (
        f"{KEYS[0]} {dict(keyed.dtypes)[KEYS[0]]}, {KEYS[1]} bigint, "
        "n_words bigint, n_removed bigint, kept_sha256 string, kept binary"
    )
    done = searched.mapInArrow(finish, schema).withColumn("kept", F.col("kept").cast("string"))
    done = settle(done if with_text else done.drop("kept"), "kept")
    of_first = done.dropDuplicates(KEYS).withColumnRenamed(KEYS[0], "first")
    whole = F.col("n_words") >= size
    later = copies.join(of_first, ["first", KEYS[1]]).drop("first")
    later = later.withColumns(
        {
            "n_removed": F.when(whole, F.col("n_words")).otherwise(F.col("n_removed")),
            "kept_sha256": F.when(whole, F.lit(EMPTY_SHA)).otherwise(F.col("kept_sha256")),
        }
    )
    if with_text:
        later = later.withColumn("kept", F.when(whole, F.lit("")).otherwise(F.col("kept")))
    return done.unionByName(later)
