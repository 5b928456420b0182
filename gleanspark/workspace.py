"""Where jobs put tables that must outlive an executor."""

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_written: ContextVar[list[str] | None] = ContextVar("_written", default=None)


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session may do without the setting; it gets a scratch folder
    of its own, which is then set as the session's checkpoint folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="gleanspark-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir()


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no earlier run has written."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    written = _written.get()
    if written is not None:
        written.append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete at the end of the block what ``fresh_path`` named and ``settle`` wrote in it.

    Deliver the result inside the block, to a path of its own: a DataFrame made
    there reads tables that are gone afterwards. Blocks may be nested; each
    cleans up after itself, also if it fails.
    """
    written: list[str] = []
    token = _written.set(written)
    try:
        yield
    finally:
        _written.reset(token)
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for name in written:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(conf).delete(path, True)


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and go on from there.

    For a costly input that is read more than once: it is computed once, and a
    lost executor brings back only a read. The table stays, unless this is
    called in a ``scratch`` block.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
