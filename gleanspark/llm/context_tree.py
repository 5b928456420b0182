"""Context-tree weighting: code lengths of texts under a mix of byte contexts of all depths."""

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import ceil
from zlib import crc32

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from gleanspark.llm.batches import as_bytes
from gleanspark.llm.pieces import (
    Lookup,
    cut_at_space,
    dealt,
    packed,
    packed_rising,
    streams,
    unpacked,
    unpacked_rising,
)
from gleanspark.workspace import settle

# A byte is nine binary decisions: whether the text ends, then its bits from the highest.
BITS = 9
END = 256
# The end of a text as a token; no word holds white space.
END_WORD = b"\n"
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
# Levels of the tree that every task needs: the root and the contexts of one byte.
_TOP = 2


@dataclass(frozen=True)
class Tree:
    # Bytes of context, 2 to 6.
    depth: int = 5
    # Bytes of text whose distinct contexts are counted before anything is shuffled.
    chunk_bytes: int = 32 << 20
    # Bytes of text for each part of the model.
    part_bytes: int = 64 << 20
    # Bytes that are worked on at once.
    slice_bytes: int = 4 << 20


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series, eight steps up."""
    shift = np.ones_like(x)
    for i in range(8):
        shift = shift * (x + i)
    y = x + 8
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - np.log(shift)


def estimate(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log probability that Krichevsky and Trofimov's estimate gives so many bits."""
    a, b = zeros.astype(float), ones.astype(float)
    return _log_gamma(a + 0.5) + _log_gamma(b + 0.5) - _log_gamma(a + b + 1) - np.log(np.pi)


def weigh(own: np.ndarray, below: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log probability of a node's bits, half by itself and half by its children, and the
    share that its own estimate has of it."""
    half = np.log(0.5)
    both = np.logaddexp(half + own, half + below)
    return both, np.exp(half + own - both)


def grams(texts: list[bytes], how: Tree) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Texts, where each begins, and the keys of their symbols, some megabytes at once.

    A key is the context, latest byte first, and the symbol in nine bits. Before its first
    byte a text has zeros. A long text comes in several lots.
    """
    depth, gap = how.depth, bytes(how.depth)
    lot, size = [], 0
    for i, text in enumerate(texts):
        for begin in range(0, max(len(text), 1), how.slice_bytes):
            part = text[begin : begin + how.slice_bytes]
            last = begin + how.slice_bytes >= len(text)
            before = (gap + text[max(0, begin - depth) : begin])[-depth:]
            lot.append((i, before + part, last))
            size += len(part) + 1
            if size >= how.slice_bytes:
                yield _keys(lot, depth)
                lot, size = [], 0
    if lot:
        yield _keys(lot, depth)


def _keys(lot: list[tuple[int, bytes, bool]], depth: int):
    raw = b"".join(part + b"\0" * last for _, part, last in lot) + bytes(8)
    coded = np.array([len(part) + last - depth for _, part, last in lot])
    begins = np.cumsum(coded + depth) - coded
    window = np.ndarray(len(raw) - 8 - depth, "<u8", raw, strides=(1,))
    context = window & np.uint64((1 << 8 * depth) - 1)
    keys = (context << np.uint64(BITS)) | ((window >> np.uint64(8 * depth)) & np.uint64(255))
    keys = keys.view(np.int64)
    ends = (begins + coded - 1)[[last for _, _, last in lot]] - depth
    keys[ends] = (keys[ends] & ~np.int64(511)) | END
    keep = np.ones(len(keys), bool)
    for i in range(depth):
        # The bytes before the first symbol of a later text are context only.
        keep[(begins[1:] - depth - depth + i)] = False
    starts = np.cumsum(coded) - coded
    some = coded > 0
    owners = np.array([i for i, _, _ in lot])
    return owners[some], starts[some], keys[keep]


def merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sums of their counts."""
    if not keys:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    all_keys, all_counts = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(all_keys, kind="stable")
    all_keys, all_counts = all_keys[order], all_counts[order]
    starts = np.flatnonzero(np.diff(all_keys, prepend=-1))
    return all_keys[starts], np.add.reduceat(all_counts, starts) if len(starts) else all_counts


def climb(keys: np.ndarray, counts: np.ndarray, depth: int, low: int = _TOP):
    """Work up the tree of sorted keys from ``depth`` to the contexts of ``low`` bytes.

    Yields for each decision its number, the distinct nodes of the level ``low``, the log
    probability of their bits, and for each key the probability of its own bit by the levels from
    ``low`` down and whether its node there was seen. A context without counts predicts
    as its parent does.
    """
    # Distinct keys of a level, their counts, and the place of each of ``keys`` among them.
    levels = [(keys, counts, np.arange(len(keys)))]
    ups = []
    for _ in range(depth - low):
        below, n, place = levels[-1]
        short = ((below >> (BITS + 8)) << BITS) | (below & 511)
        distinct, up = np.unique(short, return_inverse=True)
        sums = np.bincount(up, weights=n, minlength=len(distinct)).astype(np.int64)
        levels.append((distinct, sums, up[place]))
        ups.append(up)
    for j in range(BITS):
        key_bit = (keys >> (BITS - 1 - j)) & 1
        logs = chance = known = last_starts = None
        for height, (own, n, place) in enumerate(levels):
            node = own >> (BITS - j)
            change = np.diff(node, prepend=-1) != 0
            run, starts = np.cumsum(change) - 1, np.flatnonzero(change)
            total = np.add.reduceat(n, starts)
            ones = np.add.reduceat(n * ((own >> (BITS - 1 - j)) & 1), starts)
            own_log = estimate(total - ones, ones)
            at = run[place]
            hits = np.where(key_bit == 1, ones[at], (total - ones)[at])
            mine = (hits + 0.5) / (total[at] + 1)
            if height == 0:
                logs, chance = own_log, mine
            else:
                parent = run[ups[height - 1][last_starts]]
                below_log = np.bincount(parent, weights=logs, minlength=len(starts))
                logs, share = weigh(own_log, below_log)
                share = np.where(known, share[at], 1.0)
                chance = share * mine + (1 - share) * chance
            known, last_starts = total[at] > 0, starts
        yield j, node[starts], logs, chance, known


@dataclass
class Top:
    """Root and contexts of one byte: for each node its estimate, share and whether it was seen.

    ``[context, node]``; a node is the decision's leading one and the symbol's bits before it.
    """

    one: list[np.ndarray] = field(default_factory=list)
    share: list[np.ndarray] = field(default_factory=list)
    seen: list[np.ndarray] = field(default_factory=list)

    @classmethod
    def of(cls, symbols: np.ndarray, below: np.ndarray) -> "Top":
        """From the counts ``[context, symbol]`` and the sums of logs ``[context, node]``."""
        top = cls()
        for table in (symbols, symbols.sum(0, keepdims=True)):
            total, ones = _by_node(table)
            both, share = weigh(estimate(total - ones, ones), below)
            # The root comes first.
            top.one.insert(0, (ones + 0.5) / (total + 1))
            top.share.insert(0, share)
            top.seen.insert(0, total > 0)
            below = both.sum(0, keepdims=True)
        return top

    def chance(self, keys, depth: int, j: int, below: np.ndarray, known: np.ndarray) -> np.ndarray:
        node = (1 << j) | ((keys & 511) >> (BITS - j))
        bit = (keys >> (BITS - 1 - j)) & 1
        first = keys >> (BITS + 8 * (depth - 1))
        for level in (1, 0):
            at = (first if level else np.zeros_like(first), node)
            one = self.one[level][at]
            mine = np.where(bit == 1, one, 1 - one)
            share = np.where(known, self.share[level][at], 1.0)
            below = share * mine + (1 - share) * below
            known = self.seen[level][at]
        return below


def _by_node(table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How often each node was reached and how often a one followed, from counts of symbols."""
    total = np.zeros((len(table), 1 << BITS), np.int64)
    ones = np.zeros_like(total)
    symbols = np.arange(table.shape[1])
    for j in range(BITS):
        node = (1 << j) | (symbols >> (BITS - j))
        bit = (symbols >> (BITS - 1 - j)) & 1
        for row in range(len(table)):
            total[row] += np.bincount(node, weights=table[row], minlength=1 << BITS).astype(np.int64)
            ones[row] += np.bincount(node, weights=table[row] * bit, minlength=1 << BITS).astype(
                np.int64
            )
    return total, ones


def log10_chances(keys: np.ndarray, counts: np.ndarray, depth: int, top: Top) -> np.ndarray:
    """The log10 probability of each key's symbol after its context."""
    out = np.zeros(len(keys))
    if not len(keys):
        return out
    ends = (keys & 511) == END
    for j, _, _, chance, known in climb(keys, counts, depth):
        bits = np.log10(top.chance(keys, depth, j, chance, known))
        # A text that ends has no bits of a byte.
        out += bits if j == 0 else np.where(ends, 0.0, bits)
    return out


_CHUNK = (
    "chunk bigint, part int, words binary, word_counts binary, keys binary, key_counts binary, "
    "sizes binary, text binary"
)


def _part_of_context(keys: np.ndarray, depth: int, parts: int) -> np.ndarray:
    """Contexts that share their last two bytes are in one part."""
    last = (keys >> (BITS + 8 * (depth - _TOP))).astype(np.uint64)
    return ((last * np.uint64(40503) >> np.uint64(4)) % np.uint64(parts)).astype(np.int64)


def _chunk_rows(chunk: int, texts, learned, parts: int, how: Tree, schema: pa.Schema, ids: list):
    """A row with the texts, then a row for each part of the model with what they ask of it."""
    words: Counter = Counter()
    others: set[bytes] = set()
    for text, learn in zip(texts, learned, strict=True):
        for piece in cut_at_space(text):
            (words if learn else others).update(piece.split())
        (words if learn else others).update([END_WORD])
    by_part: list[list[bytes]] = [[] for _ in range(parts)]
    for word in words.keys() | others:
        by_part[crc32(word) % parts].append(word)

    found, counts = [], []
    for learn in (True, False):
        for _, _, keys in grams([t for t, x in zip(texts, learned, strict=True) if x is learn], how):
            distinct, n = np.unique(keys, return_counts=True)
            found.append(distinct)
            counts.append(n if learn else np.zeros(len(distinct), np.int64))
            if len(found) > 8:
                found, counts = ([x] for x in merged(found, counts))
    keys, n = merged(found, counts)
    part = _part_of_context(keys, how.depth, parts)
    order = np.argsort(part, kind="stable")
    cuts = np.searchsorted(part[order], np.arange(parts + 1))
    row = {
        "chunk": chunk,
        "part": -1,
        "sizes": np.array([len(t) for t in texts], np.int64).tobytes(),
        "text": zstandard.compress(b"".join(texts), 1),
        "ids": ids,
        "learned": learned,
    }
    yield pa.RecordBatch.from_pylist([row], schema)
    rows = []
    for i, own in enumerate(by_part):
        mine = order[cuts[i] : cuts[i + 1]]
        if not own and not len(mine):
            continue
        own.sort()
        rows.append(
            {
                "chunk": chunk,
                "part": i,
                "words": zstandard.compress(b" ".join(own), 1),
                "word_counts": packed(np.array([words.get(w, 0) for w in own], np.int64)),
                "keys": packed_rising(keys[mine]),
                "key_counts": packed(n[mine].astype(np.int64)),
            }
        )
    if rows:
        yield pa.RecordBatch.from_pylist(rows, schema)


def _words(blob: bytes) -> list[bytes]:
    # A text has no words only if the list of its words is empty.
    raw = zstandard.decompress(blob)
    return raw.split(b" ") if raw else []


def _chunks(df: DataFrame, id_col: str, text_col: str, parts: int, how: Tree) -> DataFrame:
    """A written table: texts chunk by chunk with their ids, and the distinct words and keys."""
    id_type = dict(df.dtypes)[id_col]
    held_out = F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(10)) == 0
    rows = df.select(
        F.col(id_col).alias("id"),
        F.monotonically_increasing_id().alias("row"),
        (~F.coalesce(held_out, F.lit(False))).alias("learned"),
        as_bytes(text_col).alias("text"),
    )
    binary = [f.split()[0] for f in _CHUNK.split(", ") if f.endswith("binary")]

    def work(batches):
        schema, texts, ids, learned, size, chunk = None, [], [], [], 0, None
        for batch in batches:
            if schema is None:
                schema = pa.schema(
                    [
                        ("chunk", pa.int64()),
                        ("part", pa.int32()),
                        *((n, pa.binary()) for n in binary),
                        ("ids", pa.list_(batch.schema.field("id").type)),
                        ("learned", pa.list_(pa.bool_())),
                    ]
                )
            names, numbers = batch.column("id").to_pylist(), batch.column("row").to_pylist()
            marks = batch.column("learned").to_pylist()
            for i, text in enumerate(batch.column("text")):
                chunk = numbers[i] if chunk is None else chunk
                texts.append((text.as_py() or b"").translate(LOWER))
                ids.append(names[i])
                learned.append(marks[i])
                size += len(texts[-1])
                if size >= how.chunk_bytes:
                    yield from _chunk_rows(chunk, texts, learned, parts, how, schema, ids)
                    texts, ids, learned, size, chunk = [], [], [], 0, None
        if texts:
            yield from _chunk_rows(chunk, texts, learned, parts, how, schema, ids)

    schema = f"{_CHUNK}, ids array<{id_type}>, learned array<boolean>"
    return settle(rows.mapInArrow(work, schema), "text-chunks")


def _model(chunks: DataFrame, depth: int) -> DataFrame:
    """A written table with one row per part: its words, its keys, and their counts.

    ``tokens`` and ``known`` count training tokens and their distinct ones; ``top_keys``,
    ``top_counts``, ``top_nodes`` and ``top_logs`` are what the top of the tree needs of it.
    """

    def work(batches):
        for (part,), rows in streams(batches, "part"):
            words: Counter = Counter()
            keys, counts = [], []
            for row in rows:
                names = _words(row["words"])
                n = unpacked(row["word_counts"], np.int64).tolist()
                words.update(dict(zip(names, n, strict=True)))
                keys.append(unpacked_rising(row["keys"]))
                counts.append(unpacked(row["key_counts"], np.int64))
                if len(keys) > 16:
                    keys, counts = ([x] for x in merged(keys, counts))
            key, n = merged(keys, counts)
            nodes, logs = [], []
            if len(key):
                for j, node, log, _, _ in climb(key, n, depth):
                    # ``node`` is two bytes of context and j bits; the latest byte stays.
                    nodes.append(((node >> (j + 8)) << BITS) | (1 << j) | (node & ((1 << j) - 1)))
                    logs.append(log)
            symbols = ((key >> (BITS + 8 * (depth - 1))) << BITS) | (key & 511)
            top_keys, top_counts = merged([symbols], [n])
            node, at = np.unique(np.concatenate([np.zeros(0, np.int64), *nodes]), return_inverse=True)
            sums = np.bincount(at, weights=np.concatenate([np.zeros(0), *logs]), minlength=len(node))
            own = sorted(words)
            yield pa.RecordBatch.from_pylist(
                [
                    {
                        "part": part,
                        "words": zstandard.compress(b" ".join(own), 1),
                        "word_counts": packed(np.array([words[w] for w in own], np.int64)),
                        "keys": packed_rising(key),
                        "key_counts": packed(n),
                        "tokens": sum(words.values()),
                        "known": sum(c > 0 for c in words.values()),
                        "top_keys": top_keys.tolist(),
                        "top_counts": top_counts.tolist(),
                        "top_nodes": node.tolist(),
                        "top_logs": sums.tolist(),
                    }
                ]
            )

    schema = (
        "part bigint, words binary, word_counts binary, keys binary, key_counts binary, "
        "tokens bigint, known bigint, top_keys array<bigint>, top_counts array<bigint>, "
        "top_nodes array<bigint>, top_logs array<double>"
    )
    wanted = chunks.where("part >= 0").select(
        F.col("part").cast("bigint"), "chunk", "words", "word_counts", "keys", "key_counts"
    )
    return settle(dealt(wanted, "part", then="chunk").mapInArrow(work, schema), "context-tree")


def _top(model: DataFrame) -> Top:
    """At most 256 contexts with 512 nodes and symbols, whatever the corpus."""

    def summed(key: str, value: str):
        both = model.select(F.explode(F.arrays_zip(key, value)).alias("x"))
        return both.groupBy(F.col(f"x.{key}").alias("k")).agg(F.sum(f"x.{value}").alias("v"))

    symbols = np.zeros((256, END + 1), np.int64)
    for r in summed("top_keys", "top_counts").collect():
        symbols[r["k"] >> BITS, r["k"] & 511] = r["v"]
    logs = np.zeros((256, 1 << BITS))
    for r in summed("top_nodes", "top_logs").collect():
        logs[r["k"] >> BITS, r["k"] & 511] = r["v"]
    return Top.of(symbols, logs)


def _answers(chunks: DataFrame, model: DataFrame, top: Top, depth: int) -> DataFrame:
    """For each chunk and part the words' training counts and the keys' log10 chances."""

    def work(batches):
        for _, rows in streams(batches, "part"):
            words = key = chances = None
            for row in rows:
                names, own = _words(row["words"]), unpacked_rising(row["keys"])
                if row["chunk"] is None:
                    n = unpacked(row["word_counts"], np.int64).tolist()
                    words, key = dict(zip(names, n, strict=True)), own
                    chances = log10_chances(key, unpacked(row["key_counts"], np.int64), depth, top)
                    continue
                counts = np.array([words[w] for w in names], np.int64)
                yield pa.RecordBatch.from_pylist(
                    [
                        {
                            "chunk": row["chunk"],
                            "words": row["words"],
                            "word_counts": packed(counts),
                            "keys": row["keys"],
                            "chances": packed(chances[np.searchsorted(key, own)].astype(np.float32)),
                        }
                    ]
                )

    names = ["words", "word_counts", "keys", "key_counts"]
    asked = chunks.where("part >= 0").select(F.col("part").cast("bigint"), "chunk", *names)
    asked = asked.withColumn("word_counts", F.lit(None).cast("binary"))
    asked = asked.withColumn("key_counts", F.lit(None).cast("binary"))
    both = model.select("part", F.lit(None).cast("bigint").alias("chunk"), *names).unionByName(asked)
    schema = "chunk bigint, words binary, word_counts binary, keys binary, chances binary"
    return dealt(both, "part", then="chunk").mapInArrow(work, schema)


def score(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", how: Tree = Tree()
) -> DataFrame:
    """The log10 probability of every whole text, under what the texts not held out teach.

    Texts are lower-cased (A to Z) UTF-8 bytes and an end. Every byte is a row of binary decisions; each
    decision has a tree of the contexts of 0 to ``depth`` bytes before. A node mixes its own
    Krichevsky-Trofimov estimate with its children's, by how well each foretold the training
    texts; what is mixed is then held fixed. Held out are the rows whose id as text has a CRC-32 divisible by 10.

    Returns ``id_col``, ``held_out``, ``n_tokens`` (words and one end), ``n_known`` (of these, found
    in training), ``train_tokens``, ``base_score`` (the same by single words, smoothed
    by 0.1), ``score`` and ``bits_per_byte`` (null for texts without a byte).

    Texts are read in chunks. A chunk's distinct words and contexts are counted before they
    are shuffled, to parts of the model by word and by the last two bytes of
    context; the answers go back to the chunk. Neither words nor contexts are limited in
    number: the model grows with the corpus and is never in one place. Only its top, at most 256
    by 512 nodes, is sent to all tasks.

    Null text is empty: its end alone is scored. A null id is not held out. Every row is a text,
    repeated ones too. Long texts are worked on in slices. Other columns are not read.
    An empty table gives no rows.
    """
    depth = how.depth
    bytes_all = df.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    parts = max(1, ceil(bytes_all / how.part_bytes))
    chunks = _chunks(df, id_col, text_col, parts, how)
    model = _model(chunks, depth)
    tokens, known = model.agg(F.sum("tokens"), F.sum("known")).first()
    answers = _answers(chunks, model, _top(model), depth)
    tokens = tokens or 0
    room = tokens + 0.1 * ((known or 0) + 1)

    texts = chunks.where("part = -1").select("chunk", "sizes", "text", "ids", "learned")
    both = answers.unionByName(texts, allowMissingColumns=True)
    both = both.withColumn("last", F.col("text").isNotNull())
    id_type = dict(df.dtypes)[id_col]
    id_arrow = to_arrow_type(df.schema[id_col].dataType)
    schema = (
        f"id {id_type}, held_out boolean, n_tokens bigint, n_known bigint, "
        "base_score double, score double, bits_per_byte double"
    )

    def work(batches):
        for _, rows in streams(batches, "chunk"):
            words, keys, chances = {}, [], []
            for row in rows:
                if row["text"] is None:
                    n = unpacked(row["word_counts"], np.int64).tolist()
                    words.update(zip(_words(row["words"]), n, strict=True))
                    keys.append(unpacked_rising(row["keys"]))
                    chances.append(unpacked(row["chances"], np.float32).astype(float))
                    continue
                table = Lookup(np.concatenate(keys), np.concatenate(chances))
                yield from _scored(row, words, table)

    def _scored(row, words, table):
        sizes, raw = np.frombuffer(row["sizes"], np.int64), zstandard.decompress(row["text"])
        ends = np.cumsum(sizes)
        texts = [raw[e - n : e] for e, n in zip(ends.tolist(), sizes.tolist(), strict=True)]
        found = np.zeros(len(texts))
        for owners, starts, keys in grams(texts, how):
            np.add.at(found, owners, np.add.reduceat(table.of(keys), starts))
        n_tokens, n_known = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        base = np.zeros(len(texts))
        for i, text in enumerate(texts):
            for names in (*map(bytes.split, cut_at_space(text)), [END_WORD]):
                counts = np.fromiter(map(words.__getitem__, names), np.int64, len(names))
                n_tokens[i] += len(names)
                n_known[i] += np.count_nonzero(counts)
                base[i] += np.log10((counts + 0.1) / room).sum()
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(row["ids"], id_arrow),
                pa.array([not x for x in row["learned"]]),
                pa.array(n_tokens),
                pa.array(n_known),
                pa.array(base),
                pa.array(found),
                pa.array(-found / np.log10(2) / np.maximum(sizes, 1), mask=sizes == 0),
            ],
            names=["id", "held_out", "n_tokens", "n_known", "base_score", "score", "bits_per_byte"],
        )

    found = dealt(both, "chunk", then="last").mapInArrow(work, schema)
    return found.select(
        F.col("id").alias(id_col),
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(tokens).cast("bigint").alias("train_tokens"),
        "base_score",
        "score",
        "bits_per_byte",
    )
