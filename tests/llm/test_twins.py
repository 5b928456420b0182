"""Each query that SQL can express against its twin."""

from pathlib import Path

import duckdb
import pytest

from gleanspark.llm import queries
from tests.test_twins import bag


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_twin(spark, sf_dir, name, sf):
    path = str(Path(sf_dir).parent / sf)
    con = duckdb.connect()
    for table in sorted(Path(path).glob("*.parquet")):
        con.execute(f"CREATE VIEW {table.stem} AS SELECT * FROM '{table}'")
    result = queries.QUERIES[name](spark, path)
    columns, rows = result.columns, result.collect()
    twin = con.execute(queries.ORACLE[name])
    twin_columns = [d[0] for d in twin.description]
    twin_rows = twin.fetchall()
    assert sorted(columns) == sorted(twin_columns)
    assert len(rows) == len(twin_rows) > 0
    left, right = bag(rows, columns), bag(twin_rows, twin_columns)
    assert list((left - right).items())[:3] == list((right - left).items())[:3] == []
