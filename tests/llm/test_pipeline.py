"""Each stage of the pipeline against a brute-force version over its own input."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest
import tokenizers

import corpus_pipeline
from gleanspark.llm import quality, queries
from gleanspark.llm.tokens import VOCABULARY
from gleanspark.workspace import shared_dir
from tests.llm import odd, test_decontaminate, test_packing, test_quality, test_simhash


@pytest.fixture(scope="module", params=["sf0.001", "sf0.01", "odd"])
def stages(request, spark, sf_dir):
    """The input of each stage, and the last one's result."""
    if request.param == "odd":
        path = odd.folder(spark, documents=odd.documents(spark))
    else:
        path = sf_dir.rpartition("/")[0] + "/" + request.param
    docs = spark.read.parquet(f"{path}/documents.parquet")
    inputs = [docs.cache()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        inputs.append(stage(spark, inputs[-1], path).cache())
    return path, inputs, corpus_pipeline.STAGES[-1][1](spark, inputs[-1], path).collect()


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def test_columns_stay(stages):
    _, inputs, _ = stages
    assert all(i.dtypes == inputs[0].dtypes for i in inputs)


def test_quality_rules(spark, stages):
    path, (docs, kept, *_), _ = stages
    verdicts = quality.judge(docs, spark.read.parquet(f"{path}/labels.parquet")).collect()
    bad = Counter(r["_key_id"] for r in verdicts if not r["kept"])
    assert Counter(r[0] for r in (bag(docs) - bag(kept)).elements()) == bad
    assert not bag(kept) - bag(docs)
    assert all(not test_quality.base(r["text"])[-1] for r in kept.collect())


def test_line_dedup(stages):
    _, (_, docs, kept, *_), _ = stages
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(r["doc_id"] for r in docs.collect())
    rows = {(r["doc_id"], r["text"]) for r in docs.collect()}
    if None in {d for d, _ in rows} or len({d for d, _ in rows}) < len(rows):
        pytest.skip("the twin tells documents apart by id alone")
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", list(rows))
    twin = con.execute(f"SELECT doc_id, text FROM ({queries.ORACLE['op4_line_dedup']})").fetchall()
    assert {(r["doc_id"], r["text"]) for r in kept.collect()} == set(twin)


def test_simhash_near_dedup(stages):
    _, (_, _, docs, kept, _), _ = stages
    pairs = [(r["doc_id"], test_simhash.mark(r["text"])) for r in docs.collect()]
    firsts = {least for _, _, least in test_simhash.components(pairs)}
    assert {r["doc_id"] for r in kept.collect()} - {None} == firsts - {None}
    assert not bag(kept) - bag(docs)


def test_benchmark_decontamination(spark, stages):
    path, (_, _, _, docs, kept), _ = stages
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{path}/benchmark.parquet").collect()]
    held = [(i, r["text"]) for i, r in enumerate(docs.collect())]
    bad = {d for d, *_ in test_decontaminate.brute(held, items)}
    rows = docs.collect()
    assert bag(kept) == Counter(tuple(r) for i, r in enumerate(rows) if i not in bad)


def test_packing_stage(stages):
    _, inputs, packed = stages
    library = tokenizers.Tokenizer.from_file(VOCABULARY)
    library.encode_special_tokens = True
    docs = [
        (r["doc_id"], library.encode(r["text"] or "", add_special_tokens=False).ids + [0])
        for r in inputs[-1].collect()
    ]
    test_packing.check(packed, docs)


def test_run_is_the_stages_in_a_row(spark, sf_dir):
    path = odd.small(sf_dir)
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, path)
    assert sorted(docs.dtypes) == sorted(corpus_pipeline.run(spark, path).dtypes)
    run = corpus_pipeline.run(spark, path)
    assert sum(r["length"] for r in run.collect()) == sum(r["length"] for r in docs.collect())


def test_empty_tables(spark):
    assert corpus_pipeline.run(spark, odd.folder(spark)).count() == 0


def test_run_leaves_the_results_of_stages_only(spark):
    path = odd.folder(spark)
    shared = Path(shared_dir(spark).removeprefix("file:"))
    before = set(shared.iterdir())
    corpus_pipeline.run(spark, path).count()
    left = Counter(p.name.rpartition("-")[0] for p in set(shared.iterdir()) - before)
    names = [name.replace(" ", "-") for name, _ in corpus_pipeline.STAGES[:-1]]
    # Packing reads its tokens when its result is read.
    assert left == Counter([*names, "tokens"])
