"""A small document table with everything that is odd, and helpers of the tests."""

import tempfile
from pathlib import Path

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, "
    "kept string, fp string, shard string, component_id string, start string"
)


def documents(spark, extra=()):
    words = [f"w{i}" for i in range(400)]
    long = " ".join(words)
    texts = [
        (1, long),
        (2, long),
        (2, long),
        (3, None),
        (4, ""),
        (5, " \t\n\x0b\x0c\r "),
        (6, "one"),
        (7, "one two three"),
        (None, long + " more words at the end"),
        (None, None),
        (None, None),
        (8, "x " * 300_000),
        (9, "Ünïcode  spaces \x85 stay\n\nlines\nlines\n" * 20),
        (10, " ".join(words[100:300]) + " tail of its own"),
        (10, "another text under the same id"),
        (11, "a\nb\na\nb\n" + long.upper()),
        *extra,
    ]
    rows = [(i, t, None, "s", None, "k", "f", "s", "c", "st") for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA)


def folder(spark, **tables):
    """Write tables as the driver's: one Parquet per table; missing ones are empty."""
    path = tempfile.mkdtemp(prefix="run-")
    empty = {
        "documents": SCHEMA,
        "labels": "doc_id bigint, quality int, toxic int",
        "benchmark": "item_id bigint, text string",
        "pages": "page_id bigint, url string, html string",
        "conversations": "conv_id bigint, turn bigint, role string, text string",
    }
    for name, schema in empty.items():
        df = tables.get(name)
        df = spark.createDataFrame([], schema) if df is None else df
        df.write.parquet(f"{path}/{name}.parquet")
    return path


def small(sf_dir):
    return str(Path(sf_dir).parent / "sf0.001")


def rows_of(spark, sf_dir, table="documents"):
    return [tuple(r) for r in spark.read.parquet(f"{sf_dir}/{table}.parquet").collect()]


def words(text):
    return (text or "").encode().split()


def smaller(a, b):
    """Whether id ``a`` comes before id ``b``; null comes last."""
    return a is not None and (b is None or a < b)
