"""Training sequences filled with lexically near documents.

Documents are ordered by a lexical key, a weighted MinHash of their terms, and the order
is cut into shards of about ``shard_tokens`` ids, so neighbours share a shard however
many there are. Each shard has an
inverted index of its own, whose terms are token ids, with document
frequencies over the whole corpus. A seed's window is filled with the unused
documents that BM25 ranks nearest; the last one is cut where the window ends, and its
rest seeds the next window. So all windows of a shard but the last are full.
A long document first fills windows by itself; only its rest is a seed or a
neighbour.
"""

import bisect
import math
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanspark.llm.batches import runs
from gleanspark.llm.tokens import VOCABULARY, tokenized


@dataclass(frozen=True)
class Packing:
    """All terms of a seed ask the index, but those in half of the corpus or more.

    Shards are cut by a sample of ``samples`` documents for each, ``most_samples`` in all.
    """

    length: int = 1024
    shard_tokens: int = 1 << 20
    samples: int = 100
    most_samples: int = 1 << 20
    k1: float = 1.2
    b: float = 0.75


def term_counts(ids: np.ndarray, keep: np.ndarray | None = None):
    """The different ids, those that ``keep`` marks if given, and how often each is found."""
    found = np.sort(ids if keep is None else ids[keep[ids]])
    if not len(found):
        return found, np.zeros(0, np.int64)
    edges = np.concatenate(([0], np.flatnonzero(found[1:] != found[:-1]) + 1, [len(found)]))
    return found[edges[:-1]], edges[1:] - edges[:-1]


# Ids that are counted at once; a longer document is counted by itself.
COUNTED_IDS = 1 << 22


def counted_terms(blobs: list[bytes], keep: np.ndarray | None = None):
    """``term_counts`` of many documents: for each lot of them its size, place, term and count.

    Sorted by place and term. The end of a document does not count.
    """
    sizes = np.array([len(x) // 2 for x in blobs], np.int64)
    begin = 0
    while begin < len(blobs):
        stop = begin + max(1, int(np.searchsorted(np.cumsum(sizes[begin:]), COUNTED_IDS, "right")))
        ids = np.frombuffer(b"".join(x[:-2] for x in blobs[begin:stop]), "<u2")
        place = np.repeat(np.arange(stop - begin, dtype=np.uint64), sizes[begin:stop] - 1)
        if keep is not None:
            place, ids = place[keep[ids]], ids[keep[ids]]
        both = np.sort(place << np.uint64(16) | ids)
        first = np.concatenate(([True], both[1:] != both[:-1]))[: len(both)]
        at = np.flatnonzero(first)
        found = both[at]
        terms = (found & np.uint64(0xFFFF)).astype(np.int64)
        yield (
            stop - begin,
            (found >> np.uint64(16)).astype(np.int64),
            terms,
            np.diff(at, append=len(both)),
        )
        begin = stop


def document_frequencies(tokens: DataFrame) -> dict[int, int]:
    """In how many documents each token id occurs; no larger than the vocabulary."""

    def count(batches):
        total = np.zeros(1 << 16, np.int64)
        for batch in batches:
            for _, _, terms, _ in counted_terms(batch.column("ids").to_pylist()):
                total += np.bincount(terms, minlength=1 << 16)
        terms = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(terms.astype(np.int32)), pa.array(total[terms])], names=["term", "docs"]
        )

    counted = tokens.select("ids").mapInArrow(count, "term int, docs bigint")
    return {r["term"]: r["docs"] for r in counted.groupBy("term").agg(F.sum("docs").alias("docs")).collect()}


KEY_TERMS = 4
#: A draw for each term, the same in all tasks.
DRAWS = -np.log1p(-np.random.default_rng(6).random(1 << 16))


def lexical_keys(
    blobs: list[bytes], weights: np.ndarray, how: Packing
) -> np.ndarray:
    """For each document its first ``KEY_TERMS`` terms by weighted MinHash, the first one leading.

    Two documents agree in a term the likelier, the more weight they share. Terms
    without a weight are left out; of equal draws the least term wins. Keys are signed.
    """
    out = []
    for size, place, terms, counts in counted_terms(blobs, weights > 0):
        keys = np.zeros(size, np.uint64)
        strength = weights[terms] * counts / (counts + how.k1) / DRAWS[terms]
        begin = np.flatnonzero(np.diff(place, prepend=-1))
        own = place[begin]
        run = np.repeat(np.arange(len(begin)), np.diff(begin, append=len(place)))
        for left in range(KEY_TERMS - 1, -1, -1):
            if not len(begin):
                break
            most = np.maximum.reduceat(strength, begin)
            at = np.flatnonzero((strength == most[run]) & (strength > 0))
            at = at[np.flatnonzero(np.diff(run[at], prepend=-1))]
            keys[own[run[at]]] |= terms[at].astype(np.uint64) << np.uint64(16 * left)
            strength[at] = 0
        out.append(keys)
    found = np.concatenate(out) if out else np.zeros(0, np.uint64)
    return (found ^ np.uint64(1 << 63)).view(np.int64)


def _keys(batch: pa.RecordBatch, weights: np.ndarray, how: Packing) -> np.ndarray:
    return lexical_keys(batch.column("ids").to_pylist(), weights, how)


def key_weights(idf: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Rare terms lead, but not those in fewer than five documents, which gather few."""
    return np.where(docs >= 5, idf**4, 0.0)


def splitters(sample: pa.Table, shards: int) -> list[tuple[int, int]]:
    """The ``(key, row)`` at which the shards after the first begin; sizes are ``n``."""
    key, row, n = (sample.column(c).to_numpy() for c in ("key", "row", "n"))
    order = np.lexsort((row, key))
    begin = np.cumsum(n[order]) - n[order]
    cuts = np.searchsorted(begin, n.sum() * np.arange(1, shards) / shards)
    return [(int(key[i]), int(row[i])) for i in order[np.unique(cuts[cuts < len(order)])]]


def deal(tokens: DataFrame, shards: int, weights, how: Packing, docs: int) -> DataFrame:
    """``tokens`` with a column ``shard``; ``weights()`` gives those of ``lexical_key``."""
    if shards == 1:
        return tokens.withColumn("shard", F.lit(0).cast("bigint"))

    def keyed(batches):
        own = weights()
        for batch in batches:
            keys = pa.array(_keys(batch, own, how), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [keys, batch.column("row"), batch.column("n")], names=["key", "row", "n"]
            )

    parts = 1_000_000
    rate = min(1.0, min(how.samples * shards, how.most_samples) / docs)
    chosen = F.pmod(F.xxhash64(F.lit("sample"), "row"), F.lit(parts)) < math.ceil(rate * parts)
    sample = tokens.where(chosen).select("row", "n", "ids")
    sample = sample.mapInArrow(keyed, "key bigint, row bigint, n bigint").toArrow()
    cuts = tokens.sparkSession.sparkContext.broadcast(splitters(sample, shards))

    def dealt(batches):
        own = weights()
        for batch in batches:
            keys = _keys(batch, own, how).tolist()
            at = zip(keys, batch.column("row").to_pylist(), strict=True)
            shard = pa.array([bisect.bisect_right(cuts.value, x) for x in at], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, shard], names=[*batch.schema.names, "shard"]
            )

    columns = ", ".join(f"{n} {t}" for n, t in tokens.dtypes)
    return tokens.mapInArrow(dealt, f"{columns}, shard bigint")


class Index:
    """BM25 weights of the units of one shard, by term."""

    def __init__(self, units: list[np.ndarray], idf: np.ndarray, how: Packing):
        keep = idf > 0
        found = [term_counts(u, keep) for u in units]
        owner = np.repeat(np.arange(len(units)), [len(t) for t, _ in found])
        terms = np.concatenate([t for t, _ in found]).astype(np.int64)
        tf = np.concatenate([c for _, c in found]).astype(np.float64)
        lengths = np.array([len(u) for u in units], np.float64)
        norm = how.k1 * (1 - how.b + how.b * lengths / lengths.mean())
        weight = idf[terms] * tf * (how.k1 + 1) / (tf + norm[owner])
        order = np.argsort(terms, kind="stable")
        self.owner, self.weight = owner[order], weight[order]
        bounds = np.searchsorted(terms[order], np.arange(len(idf) + 1))
        self.begin, self.end = bounds[:-1], bounds[1:]
        self.query = [t for t, _ in found]
        self.size = len(units)

    def scores(self, unit: int) -> np.ndarray:
        begin, end = self.begin[self.query[unit]], self.end[self.query[unit]]
        count = end - begin
        first = np.repeat(begin - np.concatenate(([0], np.cumsum(count)[:-1])), count)
        at = np.arange(count.sum()) + first
        return np.bincount(self.owner[at], self.weight[at], self.size)


def ranked(scores: np.ndarray, first: int = 64):
    """Places by falling score, ties by place; only as much is sorted as is asked for."""
    done = 0
    while done < len(scores):
        asked = done + first
        if asked < len(scores):
            least = np.partition(scores, len(scores) - asked)[len(scores) - asked]
            head = np.flatnonzero(scores >= least)
        else:
            head = np.arange(len(scores))
        yield from head[np.argsort(-scores[head], kind="stable")][done:].tolist()
        done, first = len(head), 4 * first


def pack_units(units: list[np.ndarray], idf: np.ndarray, how: Packing):
    """Windows of ``(unit, start, length)``; every id of every unit lies in exactly one."""
    if not units:
        return
    index = Index(units, idf, how)
    unused = np.ones(len(units), bool)
    rest, at = None, 0
    while True:
        if rest is None:
            while at < len(units) and not unused[at]:
                at += 1
            if at == len(units):
                return
            rest = at, 0
            unused[at] = False
        seed, start = rest
        window = [(seed, start, len(units[seed]) - start)]
        room, rest = how.length - window[0][2], None
        if room and unused.any():
            free = np.flatnonzero(unused)
            for unit in map(free.__getitem__, ranked(index.scores(seed)[free])):
                took = min(room, len(units[unit]))
                window.append((unit, 0, took))
                unused[unit] = False
                room -= took
                if took < len(units[unit]):
                    rest = unit, took
                if not room:
                    break
        yield window


def _shard(rows: pa.Table, idf: np.ndarray, how: Packing):
    """Pieces ``(row's place, start, length, sequence, offset, ids)`` of one shard."""
    docs = [np.frombuffer(x, "<u2") for x in rows.column("ids").to_pylist()]
    sequence, units, source = 0, [], []
    for place, ids in enumerate(docs):
        whole = len(ids) // how.length
        for i in range(whole):
            yield place, i * how.length, how.length, sequence, 0, ids[i * how.length :][: how.length]
            sequence += 1
        if len(ids) % how.length:
            units.append(ids[whole * how.length :])
            source.append((place, whole * how.length))
    for window in pack_units(units, idf, how):
        offset = 0
        for unit, start, length in window:
            place, base = source[unit]
            yield place, base + start, length, sequence, offset, units[unit][start : start + length]
            offset += length
        sequence += 1


def pack(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    how: Packing = Packing(),
    path: str = VOCABULARY,
    with_ids: bool = True,
) -> DataFrame:
    """Pieces of documents in sequences of at most ``how.length`` ids.

    ``doc_id``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``,
    ``sequence_id``, ``offset``, and ``ids`` (little-endian 16-bit) if asked. An empty
    or null text is one id. Repeated rows are documents of their own; a null
    id stays null. Ties in the ranking go by the order of rows. A document longer than a
    shard makes its shard longer. An empty table gives an empty result.
    """
    spark = df.sparkSession
    tokens = tokenized(df, id_col, text_col, path)
    total = tokens.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("docs")).first()
    shards = max(1, -(-(total["n"] or 0) // how.shard_tokens))
    frequencies = spark.sparkContext.broadcast(document_frequencies(tokens))
    corpus = total["docs"]

    def inverse():
        idf, found = np.zeros(1 << 16), np.zeros(1 << 16, np.int64)
        for term, docs in frequencies.value.items():
            idf[term] = max(0.0, math.log((corpus - docs + 0.5) / (docs + 0.5)))
            found[term] = docs
        return idf, found

    def work(batches):
        idf, _ = inverse()
        for rows in runs(batches, "shard"):
            number = rows.column("shard")[0].as_py()
            pieces = list(_shard(rows, idf, how))
            places = pa.array([p[0] for p in pieces], pa.int64())
            crcs = [zlib.crc32(p[5].astype("<u4").tobytes()) for p in pieces]
            columns = {
                "doc_id": rows.column("id").take(places),
                "start": pa.array([p[1] for p in pieces], pa.int64()),
                "length": pa.array([p[2] for p in pieces], pa.int64()),
                "ids_crc32": pa.array(crcs, pa.int64()),
                "doc_tokens": rows.column("n").take(places),
                "sequence_id": pa.array([(number << 32) + p[3] for p in pieces], pa.int64()),
                "offset": pa.array([p[4] for p in pieces], pa.int64()),
            }
            if with_ids:
                columns["ids"] = pa.array([p[5].tobytes() for p in pieces], pa.binary())
            yield from pa.table(columns).combine_chunks().to_batches(max_chunksize=20_000)

    schema = (
        f"doc_id {dict(df.dtypes)[id_col]}, start bigint, length bigint, ids_crc32 bigint, "
        "doc_tokens bigint, sequence_id bigint, offset bigint" + ", ids binary" * with_ids
    )
    weights = lambda: key_weights(*inverse())
    wanted = tokens.select("id", "row", "n", "ids")
    dealt = deal(wanted, shards, weights, how, corpus)
    dealt = dealt.repartition("shard").sortWithinPartitions("shard", "row")
    return dealt.mapInArrow(work, schema)
