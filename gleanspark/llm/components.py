"""Connected components of a graph whose links are rows."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanspark.workspace import settle


def _mark(links: DataFrame):
    row = links.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return row["n"], row["x"]


def stars(links: DataFrame) -> DataFrame:
    """``(u, v)``: each linked node but the smallest of its component, and that smallest.

    ``links`` has two columns ``u`` and ``v`` of one orderable type, without
    nulls. Large-star and small-star steps in turn, until the links stay the
    same; the number of rounds grows with the logarithm of the component's size.
    No step gathers the neighbours of a node: it takes their least by a partial
    aggregate, and the join that follows may split a node with many links. Each
    round is a written table, so a lost executor repeats one round at most.
    """
    now = settle(
        links.where(F.col("u") != F.col("v"))
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct(),
        "links",
    )
    mark = _mark(now)
    while mark[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (
            both.where(F.col("v") > F.col("u"))
            .join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = (
            large.join(least, "u")
            .where(F.col("v") != F.col("m"))
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
        )
        kept = least.select("u", F.col("m").alias("v"))
        now = settle(moved.unionByName(kept).distinct(), "links")
        before, mark = mark, _mark(now)
        if before == mark:
            break
    return now
