"""Long texts in bounded pieces, numbers as small blobs, and sorted rows one by one."""

import re
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

_SPACE = re.compile(rb"[\x09-\x0D\x20]")


def cut_at_space(text: bytes, size: int = 4 << 20) -> Iterator[bytes]:
    """Pieces of about ``size`` bytes, cut at white space so that no word is divided."""
    begin = 0
    while len(text) - begin > size:
        found = _SPACE.search(text, begin + size)
        if found is None:
            break
        yield text[begin : found.start()]
        begin = found.start()
    yield text[begin:] if begin else text


def packed(values: np.ndarray) -> bytes:
    """Numbers byte plane by byte plane, compressed."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1)
    return zstandard.compress(planes.T.tobytes(), 1)


def unpacked(blob: bytes, dtype) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    planes = np.frombuffer(zstandard.decompress(blob), np.uint8).reshape(width, -1)
    return np.ascontiguousarray(planes.T).view(dtype).reshape(-1)


def packed_rising(values: np.ndarray) -> bytes:
    """The same of sorted 64-bit numbers, by their differences."""
    return packed(np.diff(values, prepend=values.dtype.type(0)))


def unpacked_rising(blob: bytes, dtype=np.int64) -> np.ndarray:
    return np.cumsum(unpacked(blob, dtype), dtype=dtype)


def dealt(df: DataFrame, *keys: str, then: str) -> DataFrame:
    """Rows with equal ``keys`` in one task, one after the other by ``then``, null first."""
    return df.repartition(*keys).sortWithinPartitions(*keys, then)


def streams(
    batches: Iterator[pa.RecordBatch], *keys: str
) -> Iterator[tuple[tuple, Iterator[dict]]]:
    """Each run of equal ``keys`` in sorted rows, with its rows one by one."""
    rows = (
        row for batch in batches for i in range(batch.num_rows) for row in batch.slice(i, 1).to_pylist()
    )
    yield from groupby(rows, key=lambda row: tuple(row[k] for k in keys))


class Lookup:
    """Values of distinct 64-bit keys; only keys that are there may be asked.

    Each level is a table of hashed places; keys that share one go to the next level.
    """

    _MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.levels = []
        keys = keys.astype(np.uint64)
        for mix in self._MIX:
            if not len(keys):
                break
            bits = max(4, int(len(keys)).bit_length() + 2)
            spot = self._spot(keys, mix, bits)
            alone = np.bincount(spot, minlength=1 << bits)[spot] == 1
            table = np.full(1 << bits, np.nan)
            table[spot[alone]] = values[alone]
            self.levels.append((mix, bits, table))
            keys, values = keys[~alone], values[~alone]
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[order]

    @staticmethod
    def _spot(keys: np.ndarray, mix: int, bits: int) -> np.ndarray:
        return ((keys * np.uint64(mix)) >> np.uint64(64 - bits)).astype(np.int64)

    def of(self, keys: np.ndarray) -> np.ndarray:
        out, keys, rest = None, keys.astype(np.uint64), None
        for mix, bits, table in self.levels:
            found = table[self._spot(keys, mix, bits)]
            if out is None:
                out = found
            else:
                out[rest] = found
            missing = np.flatnonzero(np.isnan(found))
            rest = missing if rest is None else rest[missing]
            keys = keys[missing]
            if not len(keys):
                return out
        if out is None:
            return self.values[:0]
        out[rest] = self.values[np.searchsorted(self.keys, keys)]
        return out
