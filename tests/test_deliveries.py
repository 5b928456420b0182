"""Tabs of many deliveries, and captures that are delivered once."""

import pytest
from pyspark.sql import functions as F

from gleanspark.sources import feeds, versions
from gleanspark.streaming import ingest
from gleanspark.streaming.ingest import ingest_to_tab, page_stream

COLUMNS = ["a", "b"]


def table(spark, *rows):
    return spark.createDataFrame(rows, "a string, b string")


def read(spark, dest, tab="T"):
    return sorted(map(tuple, feeds.read_tab(spark, dest, tab, COLUMNS).collect()))


def files(path):
    return [p for p in path.rglob("*.parquet")]


def test_a_thousand_deliveries(spark, tmp_path):
    dest = str(tmp_path / "tabs")
    rows = spark.range(1000).selectExpr(
        "cast(id as string) a", "'x' b", "'T' tab", "concat('b-', id) batch"
    )
    rows.coalesce(1).write.partitionBy("tab", "batch").parquet(dest)
    feeds.append_tab(table(spark, ("o", "o")), dest, "Other", "b-1")
    feeds.compact_tab(spark, dest, "T", COLUMNS)
    every = {(str(i), "x") for i in range(1000)}
    assert set(read(spark, dest)) == every and len(read(spark, dest)) == 1000
    assert len(files(tmp_path)) <= 3
    assert read(spark, dest, "Other") == [("o", "o")]
    # Any of them is still replaced, also by nothing, before and after the next pack.
    feeds.append_tab(table(spark, ("new", "y")), dest, "T", "b-7")
    feeds.append_tab(table(spark), dest, "T", "b-8")
    expected = sorted((every - {("7", "x"), ("8", "x")}) | {("new", "y")})
    assert read(spark, dest) == expected
    feeds.compact_tab(spark, dest, "T", COLUMNS)
    assert read(spark, dest) == expected
    feeds.compact_tab(spark, dest, "T", COLUMNS)
    assert read(spark, dest) == expected


@pytest.mark.parametrize("step", ["write", "pointer", "delete"])
def test_a_failed_pack_changes_nothing(spark, tmp_path, monkeypatch, step):
    dest = str(tmp_path / "tabs")
    feeds.append_tab(table(spark, ("1", "x")), dest, "T", "one")
    feeds.compact_tab(spark, dest, "T", COLUMNS)
    feeds.append_tab(table(spark, ("2", "x")), dest, "T", "two")
    feeds.append_tab(table(spark, ("3", "x")), dest, "T", "one")

    def stop(*_):
        raise OSError

    real = versions.replace
    if step == "write":
        monkeypatch.setattr(versions, "replace", lambda s, p, write: real(s, p, stop))
    elif step == "pointer":
        monkeypatch.setattr(versions, "replace", lambda s, p, write: (write(f"{p}/v-x"), stop()))
    else:
        monkeypatch.setattr(versions, "delete", stop)
    with pytest.raises(OSError):
        feeds.compact_tab(spark, dest, "T", COLUMNS)
    monkeypatch.undo()
    assert read(spark, dest) == [("2", "x"), ("3", "x")]
    feeds.compact_tab(spark, dest, "T", COLUMNS)
    assert read(spark, dest) == [("2", "x"), ("3", "x")]


def test_what_is_sent_while_packing_stays(spark, tmp_path, monkeypatch):
    dest = str(tmp_path / "tabs")
    feeds.append_tab(table(spark, ("1", "x")), dest, "T", "one")
    feeds.append_tab(table(spark, ("2", "x")), dest, "T", "two")
    real = versions.replace

    def meanwhile(s, p, write):
        real(s, p, write)
        feeds.append_tab(table(spark, ("late", "y")), dest, "T", "one")
        feeds.append_tab(table(spark, ("3", "y")), dest, "T", "three")

    monkeypatch.setattr(versions, "replace", meanwhile)
    feeds.compact_tab(spark, dest, "T", COLUMNS)
    assert read(spark, dest) == [("2", "x"), ("3", "y"), ("late", "y")]


def pages(spark, folder, *ids):
    rows = [(i, f"https://x.example/{i}", f"<p>{i}</p>") for i in ids]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    df.coalesce(1).write.mode("append").parquet(folder)


def run(spark, tmp_path, progress, **more):
    stream = page_stream(spark, str(tmp_path / "pages"))
    job = more.pop("job", lambda df: df.select(F.col("page_id").alias("a"), F.lit("x").alias("b")))
    more.setdefault("capture", ["url"])
    ingest_to_tab(
        stream, job, str(tmp_path / "tabs"), "T", str(tmp_path / progress), **more
    ).awaitTermination()


def test_two_checkpoints_deliver_each_capture_once(spark, tmp_path):
    folder = str(tmp_path / "pages")
    pages(spark, folder, 1, 2, 2)
    run(spark, tmp_path, "one")
    pages(spark, folder, 2, 3)
    run(spark, tmp_path, "two", compact_every=1)
    run(spark, tmp_path, "one")
    run(spark, tmp_path, "three")
    assert [a for a, _ in read(spark, str(tmp_path / "tabs"))] == ["1", "2", "3"]


def test_a_delivery_that_failed_half_way_is_made_up_for(spark, tmp_path, monkeypatch):
    pages(spark, str(tmp_path / "pages"), 1, 2)

    def stop(*_):
        raise OSError

    # The tab is written, the ledger is not.
    monkeypatch.setattr(ingest, "append_tab", lambda *a: (feeds.append_tab(*a), stop()))
    with pytest.raises(Exception, match="OSError"):
        run(spark, tmp_path, "one")
    monkeypatch.undo()
    assert len(read(spark, str(tmp_path / "tabs"))) == 2
    run(spark, tmp_path, "two")
    run(spark, tmp_path, "one")
    assert [a for a, _ in read(spark, str(tmp_path / "tabs"))] == ["1", "2"]


def test_null_keys_are_always_delivered(spark, tmp_path):
    rows = [(1, None, "a"), (2, None, "a"), (3, "u", "a")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    df.write.parquet(str(tmp_path / "pages"))
    run(spark, tmp_path, "one")
    run(spark, tmp_path, "two")
    assert [a for a, _ in read(spark, str(tmp_path / "tabs"))] == ["1", "1", "2", "2", "3"]
