"""Feeds that are replaced: whole before, whole after, whatever fails."""

import pytest
from pyspark.sql import functions as F

from gleanspark.sources import feeds, versions
from gleanspark.workspace import scratch


def feed(spark, n):
    return spark.range(n).select(F.col("id").cast("string").alias("a"), F.lit("x").alias("b"))


def rows(spark, path):
    return sorted(int(r["a"]) for r in feeds.read_feed(spark, path, all_string=True).collect())


class Stop(Exception):
    pass


def stop(*_):
    raise Stop


@pytest.mark.parametrize("inside", [False, True])
@pytest.mark.parametrize("step", ["read", "write", "half", "pointer", "names"])
def test_a_failure_leaves_the_old_feed(spark, tmp_path, monkeypatch, step, inside):
    path = str(tmp_path / "feed")
    headers = spark.createDataFrame([("a", "b")], "a string, b string")
    feeds.write_feed(feed(spark, 9).unionByName(headers), path)
    feeds.write_feed(feed(spark, 7).unionByName(headers), path, mode="overwrite")

    real = versions.replace
    if step == "read":
        monkeypatch.setattr(feeds, "drop_header_rows", stop)
    elif step == "write":
        monkeypatch.setattr(versions, "replace", lambda s, p, write: real(s, p, stop))
    elif step == "half":

        def half(s, p, write):
            return real(s, p, lambda folder: (write(folder), stop()))

        monkeypatch.setattr(versions, "replace", half)
    elif step == "names":
        monkeypatch.setattr(versions, "_names", stop)
    else:
        monkeypatch.setattr(versions, "_pointers", stop)
    with pytest.raises(Stop):
        if inside:
            with scratch(spark):
                feeds.rewrite_without_headers(spark, path)
        else:
            feeds.rewrite_without_headers(spark, path)
    monkeypatch.undo()
    kept = feeds.read_feed(spark, path, all_string=True)
    assert kept.count() == 8 and kept.where("a = 'a'").count() == 1
    with scratch(spark):
        feeds.rewrite_without_headers(spark, path)
    assert rows(spark, path) == [*range(7)]


def test_a_feed_may_be_replaced_by_what_it_holds(spark, tmp_path):
    path = str(tmp_path / "feed")
    feeds.write_feed(feed(spark, 5), path)
    for n in (4, 3, 2):
        df = feeds.read_feed(spark, path, all_string=True).where(F.col("a") < n)
        feeds.write_feed(df, path, mode="overwrite")
        assert rows(spark, path) == [*range(n)]
    names = [p.name for p in (tmp_path / "feed").iterdir() if not p.name.endswith(".crc")]
    assert sum(n.startswith("v-") for n in names) == 2
    assert sum(n.startswith("_current-") for n in names) == 2
    assert not any(n.startswith("part-") for n in names)


def test_appending_goes_to_the_current_version(spark, tmp_path):
    path = str(tmp_path / "feed")
    feeds.write_feed(feed(spark, 2), path)
    feeds.write_feed(feed(spark, 3), path, mode="overwrite")
    feeds.write_feed(feed(spark, 1), path)
    assert rows(spark, path) == [0, 0, 1, 2]


def test_a_reader_that_began_before_goes_on(spark, tmp_path):
    path = str(tmp_path / "feed")
    feeds.write_feed(feed(spark, 5), path, mode="overwrite")
    begun = feeds.read_feed(spark, path, all_string=True)
    feeds.write_feed(feed(spark, 1), path, mode="overwrite")
    assert begun.count() == 5 and rows(spark, path) == [0]


def test_long_whole_numbers_stay_apart(spark):
    values = {
        "id19": ["1234567890123456789", "1234567890123456780", None],
        "most": ["9223372036854775807", "-9223372036854775808", "+1"],
        "id20": ["12345678901234567890", "1", " 2"],
        "mixed": ["12345678901234567890", "1.5", None],
        "small": ["1", None, "-2 "],
    }
    df = spark.createDataFrame([*zip(*values.values(), strict=True)], ", ".join(f"{n} string" for n in values))
    found = feeds.inferred(df)
    assert dict(found.dtypes) == {
        "id19": "bigint", "most": "bigint", "id20": "string", "mixed": "double", "small": "int",
    }
    assert [r["id19"] for r in found.collect()] == [1234567890123456789, 1234567890123456780, None]
    assert [r["id20"] for r in found.collect()] == values["id20"]
