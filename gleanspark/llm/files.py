"""Files that tasks write and read by byte range, in any file system Arrow knows."""

import re

import pyarrow.fs


def opened(folder: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a folder named as Spark names it, and the path in it."""
    return pyarrow.fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", folder))


def coalesced(ranges: list[tuple[int, int]], gap: int, most: int) -> list[tuple[int, int, int, int]]:
    """Reads that cover sorted ``(offset, length)`` ranges: ``(offset, length, first, last + 1)``.

    Neighbours join if the gap between them is small, and up to ``most`` bytes;
    a longer range is a read of its own.
    """
    reads = []
    for i, (offset, length) in enumerate(ranges):
        if reads:
            at, size, first, _ = reads[-1]
            end = max(at + size, offset + length)
            if offset - (at + size) <= gap and end - at <= most:
                reads[-1] = at, end - at, first, i + 1
                continue
        reads.append((offset, length, i, i + 1))
    return reads
