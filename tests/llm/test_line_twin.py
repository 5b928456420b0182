"""Line dedup against its twin, on lines where rules of counting differ."""

import duckdb
import numpy as np

from gleanspark.llm import queries
from tests.llm import odd


def texts():
    rng = np.random.default_rng(6)
    names = [f"name{chr(97 + i)}{chr(97 + j)}" for i in range(12) for j in range(12)]
    for i in range(160):
        lines = [f"own line of document number {'x' * (i + 1)} only here"]
        # A field whose values come three times or more each.
        lines.append(f"posted by {names[int(rng.integers(0, 8))]} on the second of may")
        lines.append(f"order of {names[i % 140]} sent by {names[int(rng.integers(0, 5))]} to the east")
        # Rows of numbers, half numbers, and short lines.
        lines.append(" ".join(map(str, rng.integers(0, 99, 6))))
        lines.append(f"total {i} of {i * 7} at {i % 3} for all")
        lines.append(f"page {i % 9}")
        lines += ["same words again here now"] * int(i % 4 == 0)
        yield i, "\n".join(lines)


def test_the_rule_as_it_is(spark, tmp_path):
    df = spark.createDataFrame([*texts()], "doc_id bigint, text string")
    path = odd.folder(spark, documents=df)
    found = sorted(map(tuple, queries.op4_line_dedup(spark, path).collect()))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/documents.parquet/*.parquet'")
    twin = sorted(con.execute(queries.ORACLE["op4_line_dedup"]).fetchall())
    assert found == twin
    assert sum(r[3] for r in found) > 300
    given = dict(texts())
    assert all(given[r[0]].split("\n")[3] in r[1].split("\n") for r in found)
