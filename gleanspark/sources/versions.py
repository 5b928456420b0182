"""Folders that are replaced whole: versions beside each other, and a pointer to the last.

A replacement is written to a folder of its own. Only then a pointer file is created, an
empty file whose name holds its number and the version. Creating a file is one step in
any store, so a reader finds the old version or the new one, and a writer that
fails at any step leaves the old one in place. The version before the last stays for
readers that have begun with it; older ones are deleted. A folder without a pointer is
its own version.
"""

import re
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

_POINTER = re.compile(r"^_current-([0-9]{12})-(v-[0-9a-f]{32})$")


def system_of(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path as it knows it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def _names(spark: SparkSession, path: str) -> list[str]:
    system, folder = system_of(spark, path)
    if not system.exists(folder):
        return []
    return [status.getPath().getName() for status in system.listStatus(folder)]


def _pointers(names: list[str]) -> list[tuple[int, str]]:
    """Number and version of each pointer, the last one last."""
    found = (_POINTER.match(name) for name in names)
    return sorted((int(m[1]), m[2]) for m in found if m)


def current(spark: SparkSession, path: str) -> str:
    """The folder that holds what ``path`` stands for now."""
    pointers = _pointers(_names(spark, path))
    return f"{path}/{pointers[-1][1]}" if pointers else path


def replace(spark: SparkSession, path: str, write: Callable[[str], None]) -> str:
    """Let ``write`` fill a new version, then point to it; returns its folder.

    If two writers replace at once, both versions are whole and one of them is current.
    """
    version = f"v-{uuid.uuid4().hex}"
    folder = f"{path}/{version}"
    try:
        write(folder)
    except BaseException:
        delete(spark, folder)
        raise
    before = _pointers(_names(spark, path))
    number = before[-1][0] + 1 if before else 1
    system, pointer = system_of(spark, f"{path}/_current-{number:012d}-{version}")
    system.create(pointer, False).close()
    _clean(spark, path)
    return folder


def _clean(spark: SparkSession, path: str) -> None:
    """Delete all but the last two versions; a plain folder's own files count as the first."""
    names = _names(spark, path)
    pointers = _pointers(names)
    if len(pointers) < 2:
        return
    for name in names:
        if not (name.startswith(("_", ".", "v-"))):
            delete(spark, f"{path}/{name}")
    for number, version in pointers[:-2]:
        delete(spark, f"{path}/{version}")
        # The pointer goes last: a version without one would stay for ever.
        delete(spark, f"{path}/_current-{number:012d}-{version}")


def exists(spark: SparkSession, path: str) -> bool:
    system, folder = system_of(spark, path)
    return system.exists(folder)


def size_of(spark: SparkSession, path: str) -> int:
    system, folder = system_of(spark, path)
    return system.getContentSummary(folder).getLength()


def delete(spark: SparkSession, path: str) -> None:
    system, folder = system_of(spark, path)
    system.delete(folder, True)
