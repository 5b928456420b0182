"""Alignment of two tokenizers' tokens, weighed by counts of id pairs over the corpus."""

import hashlib
import json
import re
from dataclasses import dataclass
from itertools import chain
from math import ceil

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanspark.llm.batches import as_bytes
from gleanspark.llm.files import opened
from gleanspark.llm.perfect_hash import PerfectHash, part_of
from gleanspark.llm.pieces import (
    dealt,
    packed,
    packed_rising,
    streams,
    unpacked,
    unpacked_rising,
)
from gleanspark.llm.tokens import VOCABULARY, Encoder
from gleanspark.workspace import fresh_path, settle

PIECES = public_tokenizers.path("piece_bpe_32k.model")
# A pair is one number: the first vocabulary's id in the upper bits.
_SHIFT = 15
# Words that are encoded as one text.
_RUN = 500
# Characters of text that are worked on at once.
_LOT = 4 << 20
# A space before white space may be no place to cut.
_UNSAFE = re.compile(r" \s")
_CUT = re.compile(r"(?<=\S) (?=\S)")


@dataclass(frozen=True)
class Alignment:
    a_path: str = VOCABULARY
    b_path: str = PIECES
    # Distinct words between spaces that a task remembers.
    remembered: int = 500_000
    # Pairs in a part of the hash.
    part_pairs: int = 1 << 18
    # Count vectors that are summed at once.
    fan_in: int = 32
    # Bytes of the hash that a task keeps in memory; more is read again when needed.
    kept_bytes: int = 256 << 20


def token_bytes(how: Alignment) -> tuple[list[bytes], list[bytes]]:
    """The bytes of each id of both vocabularies."""
    with open(how.a_path, encoding="utf-8") as file:
        names = json.load(file)["model"]["vocab"]
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in printable}
    byte |= {chr(256 + i): b for i, b in enumerate(sorted({*range(256)} - {*printable}))}
    first = [b""] * (max(names.values()) + 1)
    for name, i in names.items():
        if all(c in byte for c in name):
            first[i] = bytes(map(byte.__getitem__, name))
    model = sentencepiece.SentencePieceProcessor(model_file=how.b_path)
    second = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            second.append(bytes([int(piece[3:5], 16)]))
        else:
            second.append(piece.replace("▁", " ").encode())
    return first, second


class Words:
    """The alignments of a space and a word, found once and remembered under a number.

    Neither tokenizer has a token with a space inside a word, so a text is cut before each
    space between two other characters and its alignment is that of the pieces in order.
    """

    def __init__(self, how: Alignment, with_text: bool):
        self.how, self.with_text = how, with_text
        self.bytes_a, self.bytes_b = token_bytes(how)
        if len(self.bytes_b) > 1 << _SHIFT or len(self.bytes_a) > 1 << (32 - _SHIFT):
            raise ValueError("a pair of ids does not fit 32 bits")
        self.sizes_a, self.sizes_b = (np.array(list(map(len, x))) for x in (self.bytes_a, self.bytes_b))
        self.encode_a = Encoder(how.a_path).ids
        self.encode_b = sentencepiece.SentencePieceProcessor(model_file=how.b_path).encode
        # An id with what follows it when groups are written out.
        most = max(len(self.bytes_a), len(self.bytes_b))
        self.written = np.array([b"%d%c" % (i, c) for c in b",|;" for i in range(most)], object)
        self.written_sizes = np.array(list(map(len, self.written)))
        self.clear()

    def clear(self):
        self.numbers: dict[str, int] = {}
        self.size = 0
        self.text: list[bytes] = []
        # By word: tokens of both and links; the pairs word after word.
        self.n = np.zeros((0, 3), np.int64)
        self.sound = np.zeros(0, bool)
        self.pairs = np.zeros(0, np.int64)
        # What the second pass adds by word.
        self.table = np.zeros((0, 5), np.int64)

    def learn(self, words: list[str]):
        """Remember the alignments of words that are new."""
        easy = [w for w in words if w and not w[0].isspace() and not w[-1].isspace()]
        hard = [w for w in words if not w or w[0].isspace() or w[-1].isspace()]
        runs = [easy[i : i + _RUN] for i in range(0, len(easy), _RUN)]
        done, ids_a, ids_b, unsound = [], [], [], []
        # Runs of words are encoded as one text; where that is not spelled, word by word.
        for _ in range(2):
            texts = [" ".join(run) for run in runs]
            again = []
            for run, text, b in zip(runs, texts, self.encode_b(texts, num_threads=1), strict=True):
                a, raw = self.encode_a(" " + text), (" " + text).encode()
                if all(
                    b"".join(map(names.__getitem__, ids)) == raw
                    for names, ids in ((self.bytes_a, a), (self.bytes_b, b))
                ):
                    done += run
                    ids_a.append(a)
                    ids_b.append(b)
                else:
                    again += run
            runs = [[w] for w in again + hard]
            unsound, hard = again, []
        self._add(done, *(np.fromiter(chain.from_iterable(x), np.int64) for x in (ids_a, ids_b)))
        self.numbers.update((w, len(self.sound) + i) for i, w in enumerate(unsound))
        self.sound = np.concatenate([self.sound, np.zeros(len(unsound), bool)])
        self.n = np.concatenate([self.n, np.zeros((len(unsound), 3), np.int64)])
        self.text += [b""] * len(unsound)

    def _add(self, words: list[str], a: np.ndarray, b: np.ndarray):
        """Words whose tokens spell them, one after the other."""
        sizes = np.fromiter((len(w.encode()) + 1 for w in words), np.int64, len(words))
        stops = np.cumsum(sizes)
        ends_a, ends_b = np.cumsum(self.sizes_a[a]), np.cumsum(self.sizes_b[b])
        # Where both end: the last token of each side of a group.
        last_a, last_b = np.isin(ends_a, ends_b), np.isin(ends_b, ends_a)
        ends = [np.searchsorted(x, stops, "right") for x in (ends_a, ends_b, ends_a[last_a])]
        if self.with_text:
            self._write(a, last_a, b, last_b, ends[2])
        self.numbers.update(zip(words, range(len(self.sound), len(self.sound) + len(words)), strict=True))
        self.n = np.concatenate([self.n, np.diff(np.array(ends), axis=1, prepend=0).T])
        self.sound = np.concatenate([self.sound, np.ones(len(words), bool)])
        self.pairs = np.concatenate([self.pairs, a[last_a] << _SHIFT | b[last_b]])
        self.size += int(sizes.sum())

    def _write(self, flat_a, last_a, flat_b, last_b, links):
        """Each word's groups written out: ids of a group in order, the first vocabulary's first."""
        ids = np.concatenate([flat_a, flat_b])
        last = np.concatenate([last_a, last_b])
        side = np.repeat([0, 1], [len(flat_a), len(flat_b)])
        group = np.concatenate([np.cumsum(x) - x for x in (last_a, last_b)])
        order = np.argsort(2 * group + side, kind="stable")
        at = (ids + np.where(last, 1 + side, 0) * (len(self.written) // 3))[order]
        whole = b"".join(self.written[at].tolist())
        # Where each group ends in ``whole``, and so each word.
        ends = np.cumsum(self.written_sizes[at])[(last & (side == 1))[order]]
        stops = np.concatenate([[0], ends])[links].tolist()
        self.text += [whole[b : max(b, e - 1)] for b, e in zip([0, *stops], stops, strict=False)]

    def lots(self, texts: list[str]):
        """Lists of texts' places, the numbers of a piece's words, and whether tokens spell it.

        What is remembered may change from one list to the next. Empty texts are left out.
        """
        lot, size = [], 0
        for i, text in enumerate(texts):
            for piece in _pieces(text) if text else ():
                lot.append((i, piece))
                size += len(piece)
                if size >= _LOT:
                    yield self._numbered(lot)
                    lot, size = [], 0
        if lot:
            yield self._numbered(lot)

    def _numbered(self, lot: list[tuple[int, str]]):
        if len(self.numbers) >= self.how.remembered or self.size >= _LOT * 8:
            self.clear()
        # Lists of words; plain texts are split by Arrow.
        plain = [not (p[0].isspace() or p[-1].isspace() or _UNSAFE.search(p)) for _, p in lot]
        split = pc.split_pattern(pa.array([p if x else None for (_, p), x in zip(lot, plain, strict=True)], pa.large_string()), " ")
        split = pc.fill_null(pc.list_value_length(split), 0).to_pylist(), split.flatten()
        other = [None if x else _CUT.split(p) for (_, p), x in zip(lot, plain, strict=True)]
        sizes = [n if x else len(o) for n, x, o in zip(split[0], plain, other, strict=True)]
        words = pa.concat_arrays([split[1], pa.array([w for o in other for w in o or ()], pa.large_string())])
        coded = words.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        fresh = [w for w in distinct if w not in self.numbers]
        if fresh:
            self.learn(fresh)
        number = np.fromiter(map(self.numbers.__getitem__, distinct), np.int64, len(distinct))
        found = number[coded.indices.to_numpy()]
        # Plain texts come first in ``found``.
        at, rest, out = 0, sum(split[0]), []
        for (i, _), n, x in zip(lot, sizes, plain, strict=True):
            begin = at if x else rest
            own = found[begin : begin + n]
            at, rest = (at + n, rest) if x else (at, rest + n)
            out.append((i, own, bool(self.sound[own].all())))
        return out


def _pieces(text: str, size: int = _LOT):
    """A long text in pieces, cut where words are; the space of a cut belongs to the next."""
    begin = 0
    while len(text) - begin > size:
        cut = _CUT.search(text, begin + size)
        if cut is None:
            break
        yield text[begin : cut.start()]
        begin = cut.end()
    yield text[begin:]


def _texts(batch: pa.RecordBatch) -> list[str]:
    return [(x or b"").decode("utf-8", "replace") for x in batch.column("text").to_pylist()]


def _summed(*links: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct pairs of all ``links`` and their counts."""
    pairs, counts = (np.concatenate(x) for x in zip(*links, strict=True))
    distinct, at = np.unique(pairs, return_inverse=True)
    return distinct, np.bincount(at, weights=counts, minlength=len(distinct)).astype(np.int64)


def _linked(rows: DataFrame, how: Alignment) -> DataFrame:
    """A written table of the pairs that a task links, and how often."""

    def row_of(piece, pairs, counts):
        return pa.RecordBatch.from_pylist(
            [{"piece": piece, "n": len(pairs), "pairs": packed_rising(pairs), "counts": packed(counts)}]
        )

    def of_lot(words, lot, sound):
        """Links in the pieces of texts that are spelled to the end, as far as is known."""
        numbers = np.concatenate([np.zeros(0, np.int64), *(n for i, n, _ in lot if sound[i])])
        uses = np.bincount(numbers, minlength=len(words.sound))
        times = np.repeat(uses, words.n[:, 2])
        return words.pairs[times > 0], times[times > 0]

    def work(batches):
        words, piece = Words(how, with_text=False), None
        total = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            texts = _texts(batch)
            sound = np.ones(len(texts), bool)
            # A text in several lots counts when its last lot is known to be sound.
            long, own = {i for i, t in enumerate(texts) if len(t) > _LOT}, {}
            for lot in words.lots(texts):
                for i, _, spelled in lot:
                    sound[i] &= spelled
                for i in long & {i for i, _, _ in lot}:
                    mine = of_lot(words, [x for x in lot if x[0] == i], sound)
                    own[i] = _summed(mine, own[i]) if i in own else _summed(mine)
                short = [x for x in lot if x[0] not in long]
                total = _summed(total, of_lot(words, short, sound))
            total = _summed(total, *(own[i] for i in own if sound[i]))
            if batch.num_rows and piece is None:
                piece = batch.column("row")[0].as_py()
            if len(total[0]) >= how.part_pairs * 16:
                yield row_of(piece, *total)
                total, piece = (total[0][:0], total[1][:0]), None
        if len(total[0]):
            yield row_of(piece, *total)

    schema = "piece bigint, n bigint, pairs binary, counts binary"
    return settle(rows.mapInArrow(work, schema), "linked-pairs")


def _by_part(linked: DataFrame, parts: int, with_counts: bool) -> DataFrame:
    """The rows of ``linked`` divided by the part of the hash that has the pair."""

    def work(batches):
        for batch in batches:
            for row in batch.to_pylist():
                pairs = unpacked_rising(row["pairs"])
                part = part_of(pairs, parts)
                order = np.argsort(part, kind="stable")
                cuts = np.searchsorted(part[order], np.arange(parts + 1))
                counts = unpacked(row["counts"], np.int64) if with_counts else None
                for i in np.flatnonzero(np.diff(cuts)).tolist():
                    own = order[cuts[i] : cuts[i + 1]]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([i], pa.int64()),
                            pa.array([row["piece"]], pa.int64()),
                            pa.array([packed_rising(pairs[own])], pa.binary()),
                            pa.array([packed(counts[own]) if with_counts else None], pa.binary()),
                        ],
                        names=["part", "piece", "pairs", "counts"],
                    )

    return linked.mapInArrow(work, "part bigint, piece bigint, pairs binary, counts binary")


def _hashed(linked: DataFrame, parts: int) -> DataFrame:
    """A written table with one row per part: its levels, and its pairs by place."""

    def work(batches):
        for (part,), rows in streams(batches, "part"):
            keys = np.zeros(0, np.int64)
            for row in rows:
                keys = np.union1d(keys, unpacked_rising(row["pairs"]))
            levels = PerfectHash.build(keys)
            places = np.empty(len(keys), np.uint32)
            places[PerfectHash(levels).of(keys)] = keys
            yield pa.RecordBatch.from_pylist(
                [
                    {
                        "part": part,
                        "levels": [x.tobytes() for x in levels],
                        "keys": places.tobytes(),
                    }
                ]
            )

    rows = dealt(_by_part(linked.select("piece", "pairs"), parts, False), "part", then="piece")
    return settle(rows.mapInArrow(work, "part bigint, levels array<binary>, keys binary"), "pair-hash")


def _vectors(linked: DataFrame, hashed: DataFrame, parts: int, fan_in: int) -> DataFrame:
    """The count of each pair at its place, by part: dense vectors, summed as a tree."""
    nodes = max(1, ceil(linked.count() / fan_in))
    rows = _by_part(linked, parts, True).withColumn("node", F.pmod(F.xxhash64("piece"), F.lit(nodes)))
    # Every node gets the hash first, as its piece is null.
    hashes = hashed.withColumn("node", F.explode(F.sequence(F.lit(0), F.lit(nodes - 1))))
    both = rows.unionByName(hashes, allowMissingColumns=True)

    def first(batches):
        for (part, node), own in streams(batches, "part", "node"):
            head = next(own)
            place = PerfectHash([np.frombuffer(x, np.uint8) for x in head["levels"]])
            vector = np.zeros(len(head["keys"]) // 4, np.int64)
            for row in own:
                vector[place.of(unpacked_rising(row["pairs"]))] += unpacked(row["counts"], np.int64)
            yield _vector_row(part, node, vector)

    def further(batches):
        for (part, node), own in streams(batches, "part", "node"):
            vector = 0
            for row in own:
                vector = vector + unpacked(row["vector"], np.int64)
            yield _vector_row(part, node, vector)

    schema = "part bigint, node bigint, vector binary"
    vectors = dealt(both, "part", "node", then="piece").mapInArrow(first, schema)
    while nodes > 1:
        nodes = ceil(nodes / fan_in)
        vectors = vectors.withColumns({"child": F.col("node"), "node": F.pmod("node", F.lit(nodes))})
        vectors = dealt(vectors, "part", "node", then="child").mapInArrow(further, schema)
    return vectors.select("part", "vector")


def _vector_row(part: int, node: int, vector: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([{"part": part, "node": node, "vector": packed(vector)}])


def _best(counted: DataFrame) -> dict[int, int]:
    """The highest count of each id of the second vocabulary, which bounds its size."""

    def work(batches):
        for batch in batches:
            for row in batch.to_pylist():
                b = np.frombuffer(row["keys"], np.uint32) & ((1 << _SHIFT) - 1)
                most = np.zeros(1 << _SHIFT, np.int64)
                np.maximum.at(most, b, unpacked(row["vector"], np.int64))
                ids = np.flatnonzero(most)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids), pa.array(most[ids])], names=["b", "most"]
                )

    found = counted.select("keys", "vector").mapInArrow(work, "b bigint, most bigint")
    return {r["b"]: r["most"] for r in found.groupBy("b").agg(F.max("most").alias("most")).collect()}


class Counts:
    """Counts of pairs, read part by part from the written hash; keys are verified."""

    def __init__(self, path: str, parts: int, best: np.ndarray, kept_bytes: int):
        self.path, self.parts, self.best, self.kept_bytes = path, parts, best, kept_bytes
        self.kept: list | None = []

    def _read(self):
        system, path = opened(self.path)
        table = pyarrow.dataset.dataset(path, filesystem=system, format="parquet")
        for batch in table.to_batches(batch_size=4):
            for row in batch.to_pylist():
                levels = PerfectHash([np.frombuffer(x, np.uint8) for x in row["levels"]])
                keys = np.frombuffer(row["keys"], np.uint32)
                yield row["part"], levels, keys, unpacked(row["vector"], np.int64)

    def _all(self):
        if self.kept:
            yield from self.kept
            return
        held, size = [], 0
        for row in self._read():
            size += 60 * len(row[2])
            if self.kept is not None and size <= self.kept_bytes:
                held.append(row)
            else:
                self.kept, held = None, []
            yield row
        if self.kept is not None:
            self.kept = held

    def of(self, pairs: np.ndarray) -> np.ndarray:
        out = np.zeros(len(pairs), np.int64)
        part = part_of(pairs, self.parts)
        order = np.argsort(part, kind="stable")
        cuts = np.searchsorted(part[order], np.arange(self.parts + 1))
        for number, levels, keys, vector in self._all():
            own = order[cuts[number] : cuts[number + 1]]
            place = levels.of(pairs[own])
            true = place >= 0
            true[true] = keys[place[true]] == pairs[own][true]
            out[own[true]] = vector[place[true]]
        return out


def align(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    how: Alignment = Alignment(),
    with_groups: bool = True,
) -> DataFrame:
    """Each text's tokens under two vocabularies, aligned and weighed by the corpus.

    A text is encoded as a space and the text. Byte offsets where tokens of both end cut them
    into groups; the two tokens that end there are linked. Returns ``id_col``, ``n_a``, ``n_b``,
    ``n_groups``, ``n_links``, ``n_best`` (links whose pair is as frequent as any of its second
    id), ``count_sum`` (corpus-wide links of each link's pair, summed), ``groups_sha256`` and, if
    ``with_groups``, ``groups``: ``a1,a2|b1;a3|b2,b3``.

    The first pass collects distinct pairs with their counts. The pairs are divided by hash into
    parts, each with a minimal perfect hash; counts become dense vectors by place,
    summed as a tree. The second pass aligns again and looks pairs up, part by part
    from the written table, verified by key; nothing is broadcast but the highest
    count for each id, which the vocabulary bounds.

    Null or empty texts, and texts that the tokens do not spell, have no tokens: zeros and
    empty strings. Every row is a text, repeated ones too; other columns are not read.
    """
    id_type = dict(df.dtypes)[id_col]
    rows = df.select(
        F.col(id_col).alias("id"),
        F.monotonically_increasing_id().alias("row"),
        as_bytes(text_col).alias("text"),
    )
    linked = _linked(rows, how)
    parts = max(1, ceil((linked.agg(F.sum("n")).first()[0] or 0) / how.part_pairs))
    hashed = _hashed(linked, parts)
    counted = hashed.join(_vectors(linked, hashed, parts, how.fan_in), "part")
    path = fresh_path(df.sparkSession, "pair-counts")
    counted.write.parquet(path)
    counted = df.sparkSession.read.schema(counted.schema).parquet(path)
    best = np.zeros(1 << _SHIFT, np.int64)
    for b, most in _best(counted).items():
        best[b] = most

    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]

    def work(batches):
        words, counts = Words(how, with_text=True), Counts(path, parts, best, how.kept_bytes)
        for batch in batches:
            texts = _texts(batch)
            sums = np.zeros((len(texts), 5), np.int64)
            sound = np.ones(len(texts), bool)
            digests, groups = [hashlib.sha256() for _ in texts], [[] for _ in texts]
            for lot in words.lots(texts):
                table = _weighed(words, counts, best)
                for i, numbers, spelled in lot:
                    sound[i] &= spelled
                    written = b";".join([words.text[n] for n in numbers.tolist()])
                    digests[i].update(b";" * bool(sums[i, 2]) + written)
                    sums[i] += table[numbers].sum(0)
                    if with_groups:
                        groups[i].append(written.decode())
            sums[~sound] = 0
            some = sums[:, 2] > 0
            n_a, n_b, n, most, total = sums.T
            columns = [*map(pa.array, (n_a, n_b, n, n, most, total))]
            columns.append(pa.array([d.hexdigest() if s else "" for d, s in zip(digests, some, strict=True)], pa.string()))
            if with_groups:
                columns.append(pa.array([";".join(g) if s else "" for g, s in zip(groups, some, strict=True)], pa.string()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *columns],
                names=["id", *names, "groups_sha256", *["groups"] * with_groups],
            )

    schema = f"id {id_type}, " + ", ".join(f"{n} bigint" for n in names) + ", groups_sha256 string"
    found = rows.mapInArrow(work, schema + ", groups string" * with_groups)
    return found.withColumnRenamed("id", id_col)


def _weighed(words: Words, counts: Counts, best: np.ndarray) -> np.ndarray:
    """For each word: tokens of both, links, best links and the sum of counts."""
    known = len(words.table)
    links = words.n[known:, 2]
    own = words.pairs[int(words.n[:known, 2].sum()) :]
    pairs, at = np.unique(own, return_inverse=True)
    n = counts.of(pairs)
    top = n == best[pairs & ((1 << _SHIFT) - 1)]
    owner = np.repeat(np.arange(len(links)), links)

    def by_word(values):
        return np.bincount(owner, weights=values[at], minlength=len(links)).astype(np.int64)

    fresh = np.column_stack([words.n[known:], by_word(top), by_word(n)])
    words.table = np.concatenate([words.table, fresh])
    return words.table
