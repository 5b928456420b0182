import tempfile
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

from gleanspark.llm import token_shards
from gleanspark.llm.queries import op2_token_output
from gleanspark.llm.tokens import VOCABULARY, Encoder
from tests.llm import odd


@pytest.mark.parametrize("n", [1, 2, 3, 5, 17, 64, 1000, 4097])
def test_permutation(n):
    found = token_shards.feistel(np.arange(n), n)
    assert sorted(found.tolist()) == list(range(n))
    other = token_shards.feistel(np.arange(n), n, key=9)
    assert n < 17 or found.tolist() != other.tolist()
    assert n < 1000 or abs(np.corrcoef(found, np.arange(n))[0, 1]) < 0.1


def made(spark, docs, length, per_shard, path=None):
    path = path or tempfile.mkdtemp(prefix="run-")
    index, places = token_shards.write_shards(docs, path, length=length, per_shard=per_shard)
    return path, index, places


@pytest.mark.parametrize("length, per_shard", [(64, 16), (1024, 1 << 13), (50, 7)])
def test_shards_hold_the_stream_in_training_order(spark, sf_dir, length, per_shard):
    docs = spark.read.parquet(f"{odd.small(sf_dir)}/documents.parquet")
    path, index, places = made(spark, docs, length, per_shard)
    encoder = Encoder(VOCABULARY)
    stream = []
    for r in docs.collect():
        stream += [*encoder.ids(r["text"] or ""), 0]
    n = -(-len(stream) // length)
    stream += [0] * (n * length - len(stream))
    slots = token_shards.feistel(np.arange(n), n)
    expected = {int(slots[i]): stream[i * length : (i + 1) * length] for i in range(n)}
    found = token_shards.read_sequences(index, path, 0, n, length).collect()
    assert {r["slot"]: np.frombuffer(r["ids"], "<u2").tolist() for r in found} == expected
    part = token_shards.read_sequences(index, path, n // 3, n // 2, length).collect()
    assert sorted(r["slot"] for r in part) == list(range(n // 3, n // 2))
    for r in index.collect():
        data = Path(path, "shards", r["file"]).read_bytes()
        assert zlib.crc32(data) == r["crc32"] and len(data) == 2 * length * r["sequences"]
    read = token_shards.read_pieces(places, index, path, length, per_shard).collect()
    texts = {r["doc_id"]: [*encoder.ids(r["text"] or ""), 0] for r in docs.collect()}
    for r in read:
        own = texts[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert r["ids_crc32"] == zlib.crc32(np.array(own, "<u4").tobytes())
        assert r["doc_tokens"] == len(texts[r["doc_id"]])
    assert Counter(r["doc_id"] for r in read for _ in range(r["length"])) == Counter(
        {d: len(ids) for d, ids in texts.items()}
    )


def test_a_run_resumes(spark, sf_dir):
    docs = spark.read.parquet(f"{odd.small(sf_dir)}/documents.parquet")
    path, index, _ = made(spark, docs, 64, 16)
    rows = index.orderBy("shard").collect()
    lost = [r for r in rows if r["shard"] % 3 == 0]
    other = tempfile.mkdtemp(prefix="run-")
    kept = spark.createDataFrame([r for r in rows if r not in lost], index.schema)
    kept.write.parquet(f"{other}/index")
    made(spark, docs, 64, 16, other)
    again = spark.read.parquet(f"{other}/index").orderBy("shard").collect()
    assert [(r["shard"], r["crc32"]) for r in again] == [(r["shard"], r["crc32"]) for r in rows]
    written = {p.name for p in Path(other, "shards").iterdir()}
    assert written == {r["file"] for r in again} - {r["file"] for r in rows}
    with pytest.raises(ValueError):
        made(spark, docs, 32, 16, other)


def test_odd_rows(spark):
    table = odd.documents(spark)
    rows = op2_token_output(spark, odd.folder(spark, documents=table)).collect()
    encoder = Encoder(VOCABULARY)
    expected = Counter()
    for r in table.collect():
        expected[r["doc_id"]] += len(encoder.ids(r["text"] or "")) + 1
    found = Counter()
    for r in rows:
        found[r["doc_id"]] += r["length"]
    assert found == expected
    assert len({(r["slot"], r["offset"]) for r in rows}) == len(rows)


def test_empty_table(spark):
    assert op2_token_output(spark, odd.folder(spark)).count() == 0


def test_a_folder_of_another_table_is_refused(spark):
    first = spark.createDataFrame([(i, f"text number {i}") for i in range(40)], "doc_id long, text string")
    other = spark.createDataFrame([(i, f"text number {39 - i}") for i in range(40)], first.schema)
    path, _, _ = made(spark, first, 16, 4)
    made(spark, first, 16, 4, path)
    with pytest.raises(ValueError, match="another table"):
        made(spark, other, 16, 4, path)
