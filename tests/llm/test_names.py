"""Documents with a column for every name that the operators use inside."""

import ast
from collections import Counter
from pathlib import Path

import pytest

import corpus_pipeline
from gleanspark import llm
from gleanspark.llm import line_templates, packing, queries
from tests.llm import odd

OWN = {"doc_id", "text", "lang", "n_chars"}


def inner_names():
    """Every string in the subpackage's code that can be a column's name."""
    found = {}
    for file in Path(llm.__file__).parent.glob("*.py"):
        for node in ast.walk(ast.parse(file.read_text())):
            if isinstance(node, ast.Constant) and isinstance(node.value, str):
                if node.value.isidentifier() and len(node.value) < 25:
                    found.setdefault(node.value.lower(), node.value)
    names = {"_key_id", "_key_text", "_drop", "_lines", "_dropped", "of_key_id", "of_key_text"}
    assert {"_drop", "_lines", "_dropped", "_key_id"} <= found.keys()
    return sorted({found.get(n, n) for n in {*found, *names}} - OWN)


@pytest.fixture(scope="module")
def tables(spark):
    names = inner_names()
    filler = " ".join(f"w{i}" for i in range(60))
    line = "this line is found in every one of them"
    rows = [(i, f"{filler} number {i}\n{line}", "en", 5) for i in range(5)]
    rows += [(7, " ".join(f"v{i * j % 97}" for j in range(80)), "en", 5) for i in range(2)]
    plain = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, n_chars bigint")
    wide = plain.selectExpr("*", *(f"'{n} kept' AS `{n}`" for n in names))
    item = " ".join(f"v{j % 97}" for j in range(30))
    benchmark = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id bigint, quality int, toxic int")
    paths = [odd.folder(spark, documents=d, benchmark=benchmark, labels=labels) for d in (plain, wide)]
    return names, paths


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES[:-1])
def test_stages_keep_all_columns(spark, tables, name, stage):
    names, (plain, wide) = tables
    expected = stage(spark, spark.read.parquet(f"{plain}/documents.parquet"), plain)
    docs = spark.read.parquet(f"{wide}/documents.parquet")
    found = stage(spark, docs, wide)
    assert found.columns == docs.columns
    rows = found.collect()
    assert rows and all(r[n] == f"{n} kept" for r in rows for n in names)
    own = expected.columns
    assert Counter(tuple(r[c] for c in own) for r in rows) == Counter(map(tuple, expected.collect()))


def test_line_counts_find_a_name(spark, tables):
    names, (plain, wide) = tables
    docs = spark.read.parquet(f"{wide}/documents.parquet")
    found = line_templates.drop_recurring(docs)
    assert found.columns == [*docs.columns, "__lines", "__dropped"]
    assert found.agg({"__dropped": "sum"}).first()[0] == 4


@pytest.mark.parametrize(
    "name", [n for n in queries.QUERIES if not n.startswith(("op1_", "op4_", "op10_"))]
)
def test_queries_are_the_same(spark, tables, name):
    _, (plain, wide) = tables
    expected, found = (queries.QUERIES[name](spark, p) for p in (plain, wide))
    assert found.columns == expected.columns
    text = lambda rows: Counter(str(tuple(r)) for r in rows)
    if name.startswith(("op2_", "op6_")):
        # Places follow the order of rows, which files may change.
        assert found.count() == expected.count()
    else:
        assert text(found.collect()) == text(expected.collect())


def test_packing(spark, tables):
    _, (plain, wide) = tables
    counts = [
        packing.pack(spark.read.parquet(f"{p}/documents.parquet")).count() for p in (plain, wide)
    ]
    assert counts[0] == counts[1]
