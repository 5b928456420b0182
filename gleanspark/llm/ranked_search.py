"""Ranked lexical search: postings read in order of impact until every interval is closed."""

import math
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gleanspark.llm.batches import as_bytes
from gleanspark.llm.pieces import cut_at_space
from gleanspark.operators.skew import is_small
from gleanspark.workspace import settle

# A byte of a term stays, A to Z in lower case; all else divides terms.
TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)
)


@dataclass(frozen=True)
class Search:
    k: int = 20
    # A shard is cut when it holds so many postings or documents.
    shard_postings: int = 2_000_000
    shard_docs: int = 100_000
    # Bytes of items asked at once.
    block_bytes: int = 4 << 20
    # Each round reads all lists down to this share of the level before.
    step: float = 0.75


def terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in order, in lists of bounded size."""
    for piece in cut_at_space(text.translate(TERM_BYTES)):
        yield piece.split()


class _Shard:
    """Postings of consecutive documents, with term numbers of its own."""

    def __init__(self, number: int):
        self.number, self.ids, self.n = number, [], array("q")
        self.names: dict[bytes, int] = {}
        self.term, self.doc, self.tf = array("I"), array("I"), array("I")

    def add(self, name, n: int, counts: Counter):
        at = len(self.ids)
        self.ids.append(name)
        self.n.append(n)
        for term, tf in counts.items():
            self.term.append(self.names.setdefault(term, len(self.names)))
            self.doc.append(at)
            self.tf.append(tf)

    def batch(self, schema: pa.Schema) -> pa.RecordBatch:
        term = np.asarray(self.term, np.uint32)
        order = np.argsort(term, kind="stable")
        df = np.bincount(term, minlength=len(self.names))
        row = {
            "shard": self.number,
            "ids": self.ids,
            "n": np.asarray(self.n, np.int64).tobytes(),
            "terms": list(self.names),
            "df": df.tolist(),
            "docs": np.asarray(self.doc, np.uint32)[order].tobytes(),
            "tf": np.asarray(self.tf, np.uint32)[order].tobytes(),
        }
        return pa.RecordBatch.from_pylist([row], schema)


def postings(
    df: DataFrame, id_col: str, text_col: str, wanted: frozenset | None, how: Search = Search()
) -> DataFrame:
    """A written table with one row per shard of consecutive documents.

    ``ids`` and ``n`` (all terms, 64-bit) are by document, ``terms`` and ``df`` by term;
    ``docs`` and ``tf`` (32-bit) lie term by term. Postings are of the ``wanted``
    terms, or of all if that is None.
    """
    id_type = dict(df.dtypes)[id_col]
    rows = df.select(
        F.col(id_col).alias("id"),
        F.monotonically_increasing_id().alias("row"),
        as_bytes(text_col).alias("text"),
    )
    schema = (
        f"shard bigint, ids array<{id_type}>, n binary, "
        "terms array<binary>, df array<bigint>, docs binary, tf binary"
    )

    def work(batches):
        shard, out = None, None
        for batch in batches:
            if out is None:
                out = pa.schema(
                    [
                        ("shard", pa.int64()),
                        ("ids", pa.list_(batch.schema.field("id").type)),
                        ("n", pa.binary()),
                        ("terms", pa.list_(pa.binary())),
                        ("df", pa.list_(pa.int64())),
                        ("docs", pa.binary()),
                        ("tf", pa.binary()),
                    ]
                )
            names, numbers = batch.column("id").to_pylist(), batch.column("row").to_pylist()
            for name, number, text in zip(names, numbers, batch.column("text"), strict=True):
                n, counts = 0, Counter()
                for found in terms(text.as_py() or b""):
                    n += len(found)
                    counts.update(found if wanted is None else filter(wanted.__contains__, found))
                shard = shard or _Shard(number)
                shard.add(name, n, counts)
                if len(shard.doc) >= how.shard_postings or len(shard.ids) >= how.shard_docs:
                    yield shard.batch(out)
                    shard = None
        if shard:
            yield shard.batch(out)

    return settle(rows.mapInArrow(work, schema), "postings")


def impact(weight, tf, m):
    """What ``tf`` occurrences in a document of length measure ``m`` add; integers."""
    return weight * ((1_000_000_000 * tf) // (1000 * tf + 12 * m))


def closed(
    lists: list[tuple[np.ndarray, np.ndarray, int]], unit: np.ndarray, k: int, step: float
) -> tuple[np.ndarray, np.ndarray, int]:
    """Documents that may be among the best ``k``, their final scores and the postings read.

    ``lists`` hold documents, impacts (highest first) and the term's weight. A document's
    score lies between what was read of it and that plus the next impact of each list that
    may still hold it. One occurrence in document ``d`` has at least the impact
    weight times ``unit[d]``, so a list that is below that does not hold it. Reading
    goes on until no interval that reaches the k-th best is open, so ties are final too.
    """
    size = len(unit)
    score = np.zeros(size, np.int64)
    at = [0] * len(lists)
    falling = [-impacts for _, impacts, _ in lists]
    ahead = np.array([impacts[0] for _, impacts, _ in lists], np.int64)
    while True:
        level = max(1, int(ahead.max(initial=0) * step))
        for i, (docs, impacts, _) in enumerate(lists):
            if ahead[i] < level:
                continue
            end = int(np.searchsorted(falling[i], -level, "right"))
            score[docs[at[i] : end]] += impacts[at[i] : end]
            at[i] = end
            ahead[i] = impacts[end] if end < len(impacts) else 0
        kth = int(np.partition(score, size - k)[size - k]) if size > k else 0
        beyond = int(ahead.sum())
        if beyond and beyond >= kth:
            continue
        near = np.flatnonzero(score + beyond >= max(kth, 1))
        upper = score[near]
        place = np.full(size, -1)
        place[near] = np.arange(len(near))
        for i in np.flatnonzero(ahead).tolist():
            docs, _, weight = lists[i]
            may = ahead[i] >= weight * unit[near]
            seen = place[docs[: at[i]]]
            may[seen[seen >= 0]] = False
            upper = upper + ahead[i] * may
        reach = upper >= max(kth, 1)
        if (upper[reach] == score[near][reach]).all():
            return near[reach], score[near][reach], sum(at)


def _answers(row: dict, items: list, weights: dict, n_all: int, length: int, how: Search):
    """The best of one shard for each item: item, id, score, postings read and there."""
    n = np.frombuffer(row["n"], np.int64)
    m = 75 + np.array([25 * x * n_all // length for x in n.tolist()], np.int64)
    unit = 1_000_000_000 // (1000 + 12 * m)
    ends = np.cumsum(row["df"])
    docs, tf = np.frombuffer(row["docs"], np.uint32), np.frombuffer(row["tf"], np.uint32)
    place = {t: i for i, t in enumerate(row["terms"]) if t in weights}
    shares = {}
    for term, i in place.items():
        begin, end = ends[i] - row["df"][i], ends[i]
        here = docs[begin:end].astype(np.int64)
        share = impact(1, tf[begin:end].astype(np.int64), m[here])
        order = np.argsort(-share, kind="stable")
        shares[term] = here[order], share[order]
    for number, counts in items:
        asked = [(t, c * weights[t]) for t, c in counts.items() if t in shares and weights[t]]
        if not asked:
            continue
        lists = [(shares[t][0], w * shares[t][1], w) for t, w in asked]
        found, scores, reads = closed(lists, unit, how.k, how.step)
        names = [row["ids"][d] for d in found.tolist()]
        best = sorted(
            zip(scores.tolist(), names, strict=True),
            key=lambda x: (-x[0], x[1] is None, x[1] if x[1] is not None else 0),
        )
        for score, name in best[: how.k]:
            yield number, name, score, reads, sum(len(d) for d, _, _ in lists)


def search(
    df: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    how: Search = Search(),
) -> DataFrame:
    """The ``k`` highest scoring documents of each item, over all of ``df``.

    Returns ``item_id, rank, doc_id, score`` (named as the given id columns), ``reads`` and
    ``postings``: what was read of the lists of the document's shard, and all there is.

    Documents are indexed shard by shard where they lie; only the counts of terms and the
    best of each shard are shuffled. Items are asked in blocks of bounded size,
    each over the index. Where the items' terms are too many to send to the tasks, all
    terms are indexed. Every row is a document and every row of ``items`` an item, repeated ones too;
    equal scores go by id, null last. Null or empty texts have no terms: such
    documents are never found, such items find nothing. Other columns are not read.
    """
    spark = df.sparkSession
    asked = items.select(
        F.col(item_id).alias("item"),
        F.monotonically_increasing_id().alias("number"),
        as_bytes(item_text).alias("text"),
    )
    asked = settle(asked, "items")
    wanted = None
    if is_small(asked):
        wanted = frozenset(
            t for r in asked.toLocalIterator() for part in terms(bytes(r["text"] or b"")) for t in part
        )
    index = postings(df, id_col, text_col, wanted, how)
    sizes = index.select(F.expr("aggregate(df, 0L, (a, x) -> a + x)").alias("p"), "n")
    id_type = dict(df.dtypes)[id_col]

    def measured(batches):
        for batch in batches:
            n = [np.frombuffer(x, np.int64) for x in batch.column("n").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([int((x > 0).sum()) for x in n], pa.int64()),
                    pa.array([int(x.sum()) for x in n], pa.int64()),
                ],
                names=["docs", "length"],
            )

    total = sizes.select("n").mapInArrow(measured, "docs bigint, length bigint")
    n_all, length = total.agg(F.sum("docs"), F.sum("length")).first()
    schema = f"number bigint, id {id_type}, score bigint, reads bigint, postings bigint"
    if not length:
        found = spark.createDataFrame([], schema)
    else:
        listed = index.select(F.explode(F.arrays_zip("terms", "df")).alias("t"))
        df_of = listed.groupBy(F.col("t.terms").alias("term")).agg(F.sum("t.df").alias("df"))
        if wanted is None:
            df_of = settle(df_of, "document-frequencies")
        found = None
        for block in _blocks(asked, how.block_bytes):
            names = spark.createDataFrame(
                [(t,) for t in {t for _, c in block for t in c}], "term binary"
            )
            weights = {
                bytes(r["term"]): math.floor(1000 * math.log((2 * n_all + 2) / (2 * r["df"] + 1)))
                for r in df_of.join(F.broadcast(names), "term", "left_semi").toLocalIterator()
            }

            def work(batches, block=block, weights=weights):
                for batch in batches:
                    for row in batch.to_pylist():
                        got = list(_answers(row, block, weights, n_all, length, how))
                        if got:
                            columns = [list(c) for c in zip(*got, strict=True)]
                            yield pa.RecordBatch.from_arrays(
                                [
                                    pa.array(columns[0], pa.int64()),
                                    pa.array(columns[1], batch.schema.field("ids").type.value_type),
                                    *(pa.array(c, pa.int64()) for c in columns[2:]),
                                ],
                                names=["number", "id", "score", "reads", "postings"],
                            )

            here = index.mapInArrow(work, schema)
            found = here if found is None else found.unionByName(here)
        if found is None:
            found = spark.createDataFrame([], schema)
    best = Window.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= how.k)
    named = asked.select("number", F.col("item").alias("_item"))
    return ranked.join(F.broadcast(named) if wanted is not None else named, "number").select(
        F.col("_item").alias(item_id),
        "rank",
        F.col("id").alias(id_col),
        "score",
        "reads",
        "postings",
    )


def _blocks(asked: DataFrame, most: int) -> Iterator[list[tuple[int, Counter]]]:
    """Numbers and term counts of items, a bounded number of bytes at a time."""
    block, size = [], 0
    for row in asked.toLocalIterator():
        counts = Counter()
        for found in terms(bytes(row["text"] or b"")):
            counts.update(found)
        if counts:
            block.append((row["number"], counts))
            size += len(row["text"])
        if size >= most:
            yield block
            block, size = [], 0
    if block:
        yield block
