"""New page captures only: the batch rules as a stream with a checkpoint."""

import json
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from gleanspark.operators.combine import resume_anti
from gleanspark.schema import PAGE
from gleanspark.sources.feeds import append_tab, compact_tab, tab_folder
from gleanspark.sources.versions import exists
from gleanspark.workspace import scratch, settle


def page_stream(
    spark: SparkSession, path: str, schema: StructType = PAGE, files_per_batch: int = 1000
) -> DataFrame:
    """Captured pages as they arrive in a folder or under a path pattern."""
    return (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)
    )


def ingest_to_tab(
    stream: DataFrame,
    job: Callable[[DataFrame], DataFrame],
    dest: str,
    tab: str,
    checkpoint: str,
    capture: list[str] | None = None,
    compact_every: int | None = None,
) -> StreamingQuery:
    """Run ``job`` on every capture not seen before and append it to a tab.

    The checkpoint remembers what is done, so a later call goes on from there.
    Deliveries are named by the id that the checkpoint keeps and the number of the
    micro-batch: one that is run again after a failure replaces its first try,
    and streams with checkpoints of their own never replace each other's. Tables that
    ``job`` writes on the way are deleted once its batch is delivered.

    A new checkpoint is a new stream, which reads all captures again. With ``capture``, the
    columns that tell captures apart, a ledger of the tab keeps the keys of what was delivered,
    and only captures that no other delivery has go on, each key once; a null key is
    never known. A delivery's keys follow it: a batch that failed between the two is sent again
    or taken over by another stream, and either way its captures are there once.
    Streams that run at the same time may both deliver a capture.

    With ``compact_every``, the tab's deliveries are put together after each so many batches.
    """
    spark = stream.sparkSession
    ledger = f"{dest}/_ledger/{tab_folder(tab)}"

    def new_captures(batch: DataFrame, name: str) -> DataFrame:
        """What no other delivery has; what this one has is sent again as a whole."""
        known = [F.col(c).isNotNull() for c in capture]
        every = reduce(lambda a, b: a & b, known)
        once = batch.where(every).dropDuplicates(capture).unionByName(batch.where(~every))
        if not exists(spark, ledger):
            return once
        fields = [StructField("_delivery", StringType()), *(batch.schema[c] for c in capture)]
        done = spark.read.schema(StructType(fields)).option("recursiveFileLookup", True)
        done = done.parquet(ledger).where(F.col("_delivery") != name)
        return resume_anti(once, done, capture)

    def deliver(batch: DataFrame, batch_id: int) -> None:
        kept = spark.read.text(f"{checkpoint}/metadata").first()
        name = f"{json.loads(kept[0])['id']}-{batch_id:012d}"
        with scratch(spark):
            if capture:
                batch = settle(new_captures(batch, name), "captures")
            rows = job(batch)
            append_tab(rows, dest, tab, name)
            if capture:
                keys = batch.select(F.lit(name).alias("_delivery"), *capture)
                keys.write.mode("overwrite").parquet(f"{ledger}/{name}")
        if compact_every and (batch_id + 1) % compact_every == 0:
            compact_tab(spark, dest, tab, rows.columns)

    return (
        stream.writeStream.foreachBatch(deliver)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
