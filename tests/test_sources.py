"""Feeds, tabs, raw pages and the stream."""

import pytest
from pyspark.sql import functions as F

from gleanspark import workspace
from gleanspark.functions.text import clean_html
from gleanspark.schema import PAGE, POSTING_COLUMNS
from gleanspark.sources import feeds, pages
from gleanspark.streaming.ingest import ingest_to_tab, page_stream

AWKWARD = [
    (1, 'say "hi", twice', "line one\nline two"),
    (2, "back\\slash", 'ends with quote"'),
    (3, "  blanks  ", "tab\there"),
    (4, "naïve – ünï", "comma, and ''"),
]
SCHEMA = "n int, a string, b string"


def test_feed_round_trip(spark):
    df = spark.createDataFrame(AWKWARD, SCHEMA)
    path = workspace.fresh_path(spark, "feed")
    feeds.write_feed(df, path)
    assert sorted(map(tuple, feeds.read_feed(spark, path, SCHEMA).collect())) == AWKWARD


def test_feed_folds_missing_values(spark):
    rows = [(1, None, ""), (2, "NA", "nan"), (3, "x", "n/a "), (4, "None", "null")]
    path = workspace.fresh_path(spark, "feed")
    feeds.write_feed(spark.createDataFrame(rows, SCHEMA), path)
    got = sorted(map(tuple, feeds.read_feed(spark, path, SCHEMA).collect()))
    assert got == [(1, None, None), (2, None, None), (3, "x", "n/a "), (4, None, None)]


def test_inferred_and_text_schemas(spark):
    path = workspace.fresh_path(spark, "feed")
    feeds.write_feed(spark.createDataFrame(AWKWARD, SCHEMA), path)
    assert dict(feeds.read_feed(spark, path).dtypes)["n"] == "int"
    assert set(dict(feeds.read_feed(spark, path, all_string=True).dtypes).values()) == {"string"}


def test_feed_modes(spark):
    df = spark.createDataFrame(AWKWARD, SCHEMA)
    path = workspace.fresh_path(spark, "feed")
    feeds.write_feed(df, path)
    feeds.write_feed(df, path)
    assert feeds.read_feed(spark, path, SCHEMA).count() == 8
    feeds.write_feed(df.limit(1), path, mode="overwrite")
    assert feeds.read_feed(spark, path, SCHEMA).count() == 1


def test_null_tokens_by_choice(spark):
    df = spark.createDataFrame([("NA", "NA", 1), ("-", "", 2)], "a string, b string, n int")
    assert sorted(map(tuple, feeds.null_tokens(df, ["a"], ["-"]).collect()), key=str) == sorted(
        [("NA", "NA", 1), (None, "", 2)], key=str
    )


def test_drop_header_rows(spark):
    df = spark.createDataFrame([("n", "x"), ("x", "n"), (None, "y")], "n string, m string")
    assert {tuple(r) for r in feeds.drop_header_rows(df).collect()} == {("x", "n"), (None, "y")}
    numbers = spark.createDataFrame([(1,), (None,)], "n int")
    assert feeds.drop_header_rows(numbers).count() == 2


def test_tabs_keep_apart_and_batches_replace(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "n int, t string")
    dest = workspace.fresh_path(spark, "tabs")
    for tab, batch in [("A", "1"), ("B", "1"), ("A", "2"), ("A", "2")]:
        feeds.append_tab(df, dest, tab, batch)
    rows = feeds.read_tab(spark, dest, "A", ["n", "t"]).collect()
    assert sorted(map(tuple, rows)) == [("1", "a"), ("1", "a"), ("2", ""), ("2", "")]
    scan = feeds.read_tab(spark, dest, "B", ["n"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(tab" in scan


def test_raw_pages(spark, tmp_path):
    (tmp_path / "a.html").write_text("<h1>A</h1>\n<p>x</p>", encoding="utf-8")
    (tmp_path / "b.html").write_text("<h1>B</h1>", encoding="utf-8")
    rows = pages.read_raw_pages(spark, str(tmp_path)).orderBy("url").collect()
    assert [r.html for r in rows] == ["<h1>A</h1>\n<p>x</p>", "<h1>B</h1>"]
    assert rows[0].url.endswith("a.html")


def job(df):
    return df.select("page_id", clean_html(F.col("html")).alias("text"))


def test_stream_takes_new_captures_only(spark, sf_dir):
    source = spark.read.parquet(f"{sf_dir}/pages.parquet").select(*PAGE.names)
    landing, dest, progress = (workspace.fresh_path(spark, n) for n in ("in", "out", "progress"))

    def run():
        query = ingest_to_tab(page_stream(spark, landing, files_per_batch=2), job, dest, "P", progress)
        query.awaitTermination()
        return feeds.read_tab(spark, dest, "P", ["page_id", "text"])

    source.where("page_id < 100").repartition(5).write.parquet(landing)
    assert run().count() == 100
    assert run().count() == 100
    source.where("page_id >= 100").repartition(3).write.mode("append").parquet(landing)
    got = run()
    want = feeds.fill_blank(job(source))
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0


def test_streams_keep_apart(spark, sf_dir):
    source = spark.read.parquet(f"{sf_dir}/pages.parquet").select(*PAGE.names)
    one, two, dest = (workspace.fresh_path(spark, n) for n in ("one", "two", "out"))
    source.where("page_id < 100").write.parquet(one)
    source.where("page_id BETWEEN 100 AND 129").write.parquet(two)
    progress = [workspace.fresh_path(spark, "progress") for _ in range(3)]
    for landing, checkpoint in [(one, progress[0]), (two, progress[1]), (one, progress[0])]:
        ingest_to_tab(page_stream(spark, landing), job, dest, "P", checkpoint).awaitTermination()
    assert feeds.read_tab(spark, dest, "P", ["page_id"]).count() == 130
    # A renewed checkpoint is a new stream: it adds, and takes nothing away.
    ingest_to_tab(page_stream(spark, two), job, dest, "P", progress[2]).awaitTermination()
    assert feeds.read_tab(spark, dest, "P", ["page_id"]).count() == 160


def test_a_delivery_may_become_empty(spark):
    df, dest = spark.range(5), workspace.fresh_path(spark, "tabs")
    for rows in (df, df.limit(0)):
        feeds.append_tab(rows, dest, "A", "1:2")
    assert feeds.read_tab(spark, dest, "A", ["id"]).count() == 0
    with pytest.raises(ValueError):
        feeds.append_tab(df, dest, "A", "")


def test_inferred_types(spark):
    rows = [("1", "1.5", "true", "2024-01-01", None, "007", "1d"), (None, "-2e3", "False", "x", None, " 8", "2")]
    df = spark.createDataFrame(rows, "a string, b string, c string, d string, e string, f string, g string")
    got = feeds.inferred(df)
    kinds = [t for _, t in got.dtypes]
    assert kinds == ["int", "double", "boolean", "string", "string", "int", "string"]
    assert [r.f for r in got.collect()] == [7, 8]


def test_shared_dir_comes_from_the_session(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert workspace.fresh_path(spark, "x").startswith(folder)
    assert workspace.fresh_path(spark, "x") != workspace.fresh_path(spark, "x")


@pytest.mark.parametrize("columns", [POSTING_COLUMNS])
def test_posting_columns(columns):
    assert len(columns) == 15
    assert list(columns.values())[0] == "Job title"
    assert list(columns.values())[-1] == "Source"
