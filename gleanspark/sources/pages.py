"""Captured pages and the other input tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanspark.schema import PAGE


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Captured pages: ``page_id, url, html``."""
    return spark.read.schema(PAGE).parquet(path)


def read_raw_pages(spark: SparkSession, path: str) -> DataFrame:
    """Page files as they were saved: ``url`` is the file, ``html`` its whole text."""
    files = spark.read.text(path, wholetext=True)
    return files.select(F.col("_metadata.file_path").alias("url"), F.col("value").alias("html"))
