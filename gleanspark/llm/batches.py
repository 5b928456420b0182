"""Arrow batches in tasks: words, hashes of word windows, groups of sorted rows."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column
from pyspark.sql import functions as F

# Distinct words whose hash a task remembers.
REMEMBERED_WORDS = 200_000
# Rows of an emitted batch.
BATCH_ROWS = 50_000

_LEFT = np.uint64(0x9E3779B97F4A7C15)
_NEXT = np.uint64(0xC2B2AE3D27D4EB4F)
_SHIFT = np.uint64(29)


class WordHashes(dict):
    """64-bit hash of each word, remembered for the common ones."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def _joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    out = left * _LEFT + right
    out ^= out >> _SHIFT
    out *= _NEXT
    return out


def windows(values: np.ndarray, size: int) -> np.ndarray:
    """A hash of every ``size`` consecutive values; each step doubles the width."""
    if len(values) < size:
        return values[:0]
    out, done, wide, width = None, 0, values, 1
    while True:
        if size & width:
            here = wide[done:]
            out = here if out is None else _joined(out[: len(here)], here)
            done += width
        if done == size:
            return out[: len(values) - size + 1]
        wide = _joined(wide[:-width], wide[width:])
        width *= 2


def second_lane(values: np.ndarray) -> np.ndarray:
    """Another hash of hashed values, to make windows of 128 bits."""
    out = (values ^ _NEXT) * _LEFT
    return out ^ (out >> np.uint64(32))


def texts(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """The texts as UTF-8; null counts as empty."""
    return [b"" if x is None else x for x in batch.column(name).to_pylist()]


def lots(batch: pa.RecordBatch, name: str, size: int) -> Iterator[pa.RecordBatch]:
    """The batch in slices with about ``size`` bytes of a column; a larger value is alone."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(name)), 0).to_numpy(), dtype=np.int64)
    begin = 0
    while begin < len(ends):
        done = ends[begin - 1] if begin else 0
        stop = max(begin + 1, int(np.searchsorted(ends, done + size, "right")))
        yield batch.slice(begin, stop - begin)
        begin = stop


def as_bytes(name: str) -> Column:
    return F.col(name).cast("binary")


def runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Each run of equal ``key`` (numbers, not null) in rows sorted by it.

    Only the run that a batch ends in waits for the next batch.
    """
    kept: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy()
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for begin, end in zip(cuts, cuts[1:], strict=False):
            if last is not None and keys[begin] != last:
                yield pa.Table.from_batches(kept)
                kept = []
            last = keys[begin]
            kept.append(batch.slice(begin, end - begin))
    if kept:
        yield pa.Table.from_batches(kept)


def groups(
    batches: Iterator[pa.RecordBatch], key: str
) -> Iterator[tuple[int, dict[str, np.ndarray]]]:
    """The same as numpy columns, with the key; no column may have nulls."""
    for run in runs(batches, key):
        columns = {n: run.column(n).to_numpy() for n in run.schema.names}
        yield columns[key][0], columns
