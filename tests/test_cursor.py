"""Listings in several runs."""

import pytest
from pyspark.sql import functions as F

from gleanspark.operators.slices import until_first
from gleanspark.plans import cursor as cursors
from gleanspark.plans.cursor import run_listing
from gleanspark.sources import versions

SCHEMA = "g string, n int, m int, last boolean"
ROWS = [(g, n, m, n == 4 and m == 1 and g != "a") for g in ("a", "b", None) for n in range(6) for m in (0, 1)]


def visit(spark, tmp_path, rows, seen, fail=False):
    pages = spark.createDataFrame(rows, SCHEMA)

    def deliver(todo):
        found = until_first(todo, "g", ["n", "m"], F.coalesce("last", F.lit(False))).collect()
        if fail:
            raise OSError
        seen.extend(map(tuple, found))

    run_listing(pages, "g", ["n", "m"], F.col("last"), str(tmp_path / "cursor"), deliver)


def key(row):
    return tuple((x is not None, x) for x in row)


def test_three_runs_equal_one(spark, tmp_path):
    once, parts = [], []
    visit(spark, tmp_path / "once", ROWS, once)
    for most in (1, 3, 6, 6):
        visit(spark, tmp_path / "parts", [r for r in ROWS if r[1] < most], parts)
    assert sorted(parts, key=key) == sorted(once, key=key)
    assert len(once) == 12 + 10 + 10


def test_a_run_that_fails_is_made_up_for(spark, tmp_path):
    seen = []
    visit(spark, tmp_path, [r for r in ROWS if r[1] < 2], seen)
    with pytest.raises(OSError):
        visit(spark, tmp_path, ROWS, [], fail=True)
    visit(spark, tmp_path, ROWS, seen)
    assert len(seen) == len(set(seen)) == 32


def test_an_ended_listing_stays_ended(spark, tmp_path):
    seen = []
    visit(spark, tmp_path, ROWS, seen)
    visit(spark, tmp_path, [*ROWS, ("b", 9, 0, False), ("a", 9, 0, None), ("c", 0, 0, True)], seen)
    assert seen[32:] == [("a", 9, 0, None), ("c", 0, 0, True)] or seen[32:] == [
        ("c", 0, 0, True), ("a", 9, 0, None),
    ]
    visit(spark, tmp_path, [], seen)
    assert len(seen) == 34


def test_a_large_group_is_cut(spark, tmp_path):
    rows = spark.range(4000).selectExpr(
        "'x' AS g", "int(id) AS n", "0 AS m", "id = 3500 AS last"
    )
    counts = []
    for most in (1000, 3000, 4000, 4000):
        pages = rows.where(F.col("n") < most)
        run_listing(
            pages, "g", ["n", "m"], F.col("last"), str(tmp_path / "c"),
            lambda todo: counts.append(until_first(todo, "g", ["n", "m"], F.col("last")).count()),
        )
    assert counts == [1000, 2000, 501, 0]
    path = versions.current(spark, str(tmp_path / "c"))
    row = spark.read.parquet(path).first()
    assert row[cursors.AT]["n"] == 3500 and row[cursors.STOPPED]
