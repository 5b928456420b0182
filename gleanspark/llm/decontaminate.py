"""Test items inside documents, by MinHash containment search in parts of one size.

Items are put in classes by size. For each class a document is cut in windows a
little wider than the class, every ``BLOCK`` shingles, so that wherever a passage
lies some window holds it and little else; a long document then has small sets
like a short one. A window that shares one of the ``HASHES`` MinHash values of
an item makes the document a candidate, and exact containment of the item's
shingles in the whole document decides.

A passage that just reaches the threshold has a similarity of 0.23 or more to
its window in the worst class, so it is missed with a chance below
``(1 - 0.23) ** 48``, less than four in a million. Items of up to four shingles
need all of them and are looked up by each.
"""

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanspark.llm.batches import WordHashes, as_bytes, texts, windows
from gleanspark.llm.rows import KEYS, with_key

SHINGLE = 5
THRESHOLD = 0.8
HASHES = 48
# Shingles between the starts of windows.
BLOCK = 8
# Items of up to this many shingles are looked up directly.
TINY = 4
# Bytes of items that a task holds at once; more are searched in further passes.
ITEM_BYTES = 4 * 1024 * 1024
# Bytes of documents that are split into words at once.
TEXT_BYTES = 1024 * 1024
# Shingles that are hashed together.
AT_ONCE = 1 << 16

# ASCII letters are lowered and ASCII punctuation divides words.
_PLAIN = bytes(
    b + 32 if 65 <= b <= 90 else 32 if 33 <= b < 127 and not chr(b).isalnum() else b
    for b in range(256)
)
_MULTIPLIERS = (
    np.random.default_rng(7).integers(1, 1 << 32, HASHES, dtype=np.uint64).astype(np.uint32) | 1
)
_EMPTY = np.uint32(0xFFFFFFFF)


def plain_words(text: bytes) -> list[bytes]:
    return text.translate(_PLAIN).split()


def shingle_set(words: list[bytes], size: int) -> set[bytes]:
    """The distinct shingles; a shorter text is one shingle, one without words has none."""
    if not words:
        return set()
    return {b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))}


def _marks(words: list[bytes], size: int, hashes: WordHashes) -> np.ndarray:
    """A 32-bit hash of each shingle."""
    values = hashes.of(words)
    found = windows(values, min(size, len(values))) if len(values) else values
    # A shingle of fewer words must not meet one of five.
    return ((found + np.uint64(min(size, len(words)))) >> np.uint64(16)).astype(np.uint32)


def _size_class(n: int) -> int:
    """Windows of a class hold ``BLOCK << class`` shingles and a block more."""
    return max(0, (n - 1).bit_length() - (BLOCK - 1).bit_length())


class ItemIndex:
    """The items of one pass: MinHash values by size class, and their shingles."""

    def __init__(self, items: list[tuple[int, bytes]], size: int, threshold: float):
        self.size, self.threshold = size, threshold
        hashes = WordHashes()
        self.shingles, self.names = [], []
        self.tiny: dict[int, list[int]] = defaultdict(list)
        self.values: dict[int, dict[tuple[int, int], list[int]]] = {}
        for name, text in items:
            words = plain_words(text)
            shingles = shingle_set(words, size)
            if not shingles:
                continue
            at = len(self.names)
            self.names.append(name)
            self.shingles.append(shingles)
            marks = np.unique(_marks(words, size, hashes))
            if len(shingles) <= TINY:
                for mark in marks.tolist():
                    self.tiny[mark].append(at)
                continue
            own = self.values.setdefault(_size_class(len(shingles)), defaultdict(list))
            for i, multiplier in enumerate(_MULTIPLIERS):
                own[i, int((marks * multiplier).min())].append(at)
        self.bits = max(16, len(self.names).bit_length() + 6)
        self.filters = {c: self._filter(v) for c, v in self.values.items()}
        self.tiny_marks = np.array(sorted(self.tiny), np.uint32)
        self.longest = max(self.values, default=0)

    def _filter(self, values) -> np.ndarray:
        """For the leading bits of a value a bit per MinHash function that may have it."""
        out = np.zeros(1 << self.bits, np.uint64)
        for i, value in values:
            out[value >> (32 - self.bits)] |= np.uint64(1 << i)
        return out

    def candidates(self, marks: list[np.ndarray]) -> set[tuple[int, int]]:
        """Pairs of a document's place in ``marks`` and an item's number."""
        found: set[tuple[int, int]] = set()
        if len(self.tiny_marks):
            for doc, own in enumerate(marks):
                for mark in own[np.isin(own, self.tiny_marks)].tolist():
                    found.update((doc, item) for item in self.tiny[mark])
        if self.values:
            begin, n = 0, 0
            for doc, own in enumerate(marks):
                n += len(own)
                if n >= AT_ONCE or doc + 1 == len(marks):
                    self._search(marks[begin : doc + 1], begin, found)
                    begin, n = doc + 1, 0
        return found

    def _search(self, marks: list[np.ndarray], first: int, found: set) -> None:
        blocks = np.array([-(-len(m) // BLOCK) for m in marks])
        begins = np.concatenate(([0], np.cumsum(blocks)))
        grid = np.full(begins[-1] * BLOCK, _EMPTY)
        owner = np.repeat(np.arange(len(marks)), blocks)
        for own, begin, count in zip(marks, begins.tolist(), blocks.tolist(), strict=False):
            if count:
                grid[begin * BLOCK : begin * BLOCK + len(own)] = own
                # The rest of the last block repeats a shingle, which changes no least value.
                grid[begin * BLOCK + len(own) : (begin + count) * BLOCK] = own[-1]
        if not len(grid):
            return
        grid = np.ascontiguousarray(grid.reshape(-1, BLOCK).T)
        # Blocks from each to its document's end: windows end there, whatever the items' sizes.
        left = begins[1:][owner] - np.arange(begins[-1])
        widest = int(blocks.max())

        def reached(values, width):
            """The value ``width`` blocks on in the same document."""
            out = np.full(len(values), _EMPTY)
            if width < widest:
                np.copyto(out[:-width], values[width:], where=left[:-width] > width)
            return out

        for i, multiplier in enumerate(_MULTIPLIERS):
            least = (grid * multiplier).min(axis=0)
            wide, width = least, 1
            for size_class in range(self.longest + 1):
                # ``wide`` covers ``1 << size_class`` blocks from each; one more holds any passage.
                if size_class in self.values:
                    one_more = np.minimum(wide, reached(least, width))
                    self._probe(i, size_class, one_more, owner, first, found)
                if size_class < self.longest and width < widest:
                    wide = np.minimum(wide, reached(wide, width))
                width *= 2

    def _probe(self, i, size_class, least, owner, first, found) -> None:
        hit = self.filters[size_class][least >> np.uint32(32 - self.bits)] >> np.uint64(i)
        values = self.values[size_class]
        for at in np.flatnonzero(hit & np.uint64(1)).tolist():
            for item in values.get((i, int(least[at])), ()):
                found.add((first + int(owner[at]), item))

    def search(self, docs: list[bytes], hashes: WordHashes) -> list[tuple[int, int, int, int]]:
        """``(document, item's name, its shingles, those found)`` where containment suffices.

        Words take many times the room of their text, so a few documents are split at once.
        """
        out, begin, held = [], 0, 0
        for end, text in enumerate(docs, 1):
            held += len(text)
            if held >= TEXT_BYTES or end == len(docs):
                out += [(begin + h[0], *h[1:]) for h in self._found(docs[begin:end], hashes)]
                begin, held = end, 0
        return out

    def _found(self, docs: list[bytes], hashes: WordHashes) -> list[tuple[int, int, int, int]]:
        words = [plain_words(t) for t in docs]
        marks = [_marks(w, self.size, hashes) for w in words]
        out, own, last = [], set(), None
        for doc, item in sorted(self.candidates(marks)):
            if doc != last:
                own, last = shingle_set(words[doc], self.size), doc
            wanted = self.shingles[item]
            shared = len(wanted & own)
            if shared >= self.threshold * len(wanted):
                out.append((doc, self.names[item], len(wanted), shared))
        return out


def _passes(benchmark: DataFrame, text_col: str):
    """The distinct item texts in broadcast lists of a bounded size; tasks make the index."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.col(text_col).alias("text")).where(F.col("text").isNotNull())
    items = items.distinct().withColumn("name", F.xxhash64("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    passes = -(-total // ITEM_BYTES)
    part = F.pmod(F.xxhash64("text", F.lit("pass")), F.lit(max(passes, 1)))
    for number in range(passes):
        rows = items.where(part == number).select("name", as_bytes("text").alias("text"))
        held = [(r["name"], bytes(r["text"])) for r in rows.toLocalIterator()]
        yield spark.sparkContext.broadcast(sorted(held))


def contaminated(
    df: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    size: int = SHINGLE,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``doc_id, item_id, item_shingles, shared, containment`` of each item in a document.

    Words are runs between ASCII white space and punctuation, ASCII letters
    lowered; shingles count once. A text of fewer words than a shingle is one
    shingle. Texts without words, null or not, contain nothing and are in
    nothing. Items of equal text are each reported; repeated rows of either
    table are reported once, rows that share an id but not the text once each.
    """
    wanted = df.select(F.col(id_col).alias("doc_id"), as_bytes(text_col).alias("text"))
    found = None
    for items in _passes(benchmark, item_text_col):

        def work(batches, items=items):
            index, hashes = ItemIndex(items.value, size, threshold), WordHashes()
            for batch in batches:
                hits = index.search(texts(batch, "text"), hashes)
                docs = batch.column("doc_id").take(pa.array([h[0] for h in hits], pa.int64()))
                rest = list(zip(*(h[1:] for h in hits), strict=True)) or [(), (), ()]
                yield pa.RecordBatch.from_arrays(
                    [docs, *(pa.array(c, pa.int64()) for c in rest)],
                    names=["doc_id", "name", "item_shingles", "shared"],
                )

        part = wanted.mapInArrow(
            work,
            f"doc_id {dict(wanted.dtypes)['doc_id']}, name bigint, "
            "item_shingles bigint, shared bigint",
        )
        found = part if found is None else found.unionByName(part)
    named = benchmark.select(
        F.col(item_col).alias("item_id"), F.xxhash64(F.col(item_text_col)).alias("name")
    ).distinct()
    if found is None:
        found = wanted.sparkSession.createDataFrame(
            [],
            f"doc_id {dict(wanted.dtypes)['doc_id']}, name bigint, "
            "item_shingles bigint, shared bigint",
        )
    return (
        found.distinct()
        .join(named, "name")
        .withColumn("containment", F.col("shared") / F.col("item_shingles"))
        .select("doc_id", "item_id", "item_shingles", "shared", "containment")
    )


def keep_clean(
    df: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_text_col: str = "text",
    size: int = SHINGLE,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """The rows whose text holds no item, all columns unchanged; nothing is shuffled."""
    for items in _passes(benchmark, item_text_col):

        def work(batches, items=items, column=df.columns.index(text_col)):
            index, hashes = ItemIndex(items.value, size, threshold), WordHashes()
            for batch in batches:
                held = batch.column(column).cast(pa.large_binary()).to_pylist()
                hits = index.search([b"" if t is None else t for t in held], hashes)
                clean = np.ones(batch.num_rows, bool)
                clean[[h[0] for h in hits]] = False
                yield batch.filter(pa.array(clean))

        df = df.mapInArrow(work, df.schema)
    return df
