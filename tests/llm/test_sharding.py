import zlib
from collections import Counter, defaultdict

import pytest

from gleanspark.llm import sharding
from gleanspark.llm.queries import op3_sharding
from tests.llm import odd


def check(spark, path, shards=16):
    docs = [(r[0], r[1]) for r in odd.rows_of(spark, path)]
    found = op3_sharding(spark, path).collect()
    expected = Counter(
        (d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in docs
    )
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in found) == expected
    slots, weights = defaultdict(list), Counter()
    for r in found:
        slots[r["shard"]].append(r["slot"])
        weights[r["shard"]] += r["size"]
        assert r["law"] == "bytes" and r["grown_shard"] is None and 0 <= r["shard"] < shards
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    total, most = sum(weights.values()), max(s for _, s, _ in expected)
    assert all(abs(weights[k] - total / shards) <= most for k in range(shards))


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_shards_of_equal_bytes(spark, sf_dir, sf):
    check(spark, sf_dir.rpartition("/")[0] + "/" + sf)


def test_odd_rows(spark):
    check(spark, odd.folder(spark, documents=odd.documents(spark)))


def test_empty_table(spark):
    assert op3_sharding(spark, odd.folder(spark)).count() == 0


def test_order_is_by_text_then_id_and_equal_texts_lie_together(spark, sf_dir):
    docs = spark.read.parquet(f"{odd.small(sf_dir)}/documents.parquet")
    places = {r["doc_id"]: (r["shard"], r["slot"]) for r in sharding.byte_shards(docs, 4).collect()}
    by_text = defaultdict(list)
    for d, t in docs.select("doc_id", "text").collect():
        by_text[t].append(places[d])
    sizes = Counter(s for s, _ in places.values())
    for spots in by_text.values():
        line = sorted(sum(sizes[k] for k in range(s)) + slot for s, slot in spots)
        assert line == list(range(line[0], line[0] + len(line)))


def test_no_range_is_overfull_when_a_third_is_one_row(spark):
    docs = spark.range(9000).selectExpr(
        "if(id % 3 = 0, 7, id) as _id", "id as _row", "1L as _size",
        "if(id % 3 = 0, 5L, xxhash64(id)) as _hash",
    )
    placed = sharding._placed(docs, 32)
    sizes = [r["count"] for r in placed.groupBy("_cell").count().collect()]
    assert sum(sizes) == 9000 and max(sizes) <= 3 * 9000 / 32
    rows = sorted(placed.collect(), key=lambda r: (r["_hash"], r["_id"], r["_row"]))
    cells = [r["_cell"] for r in rows]
    assert cells == sorted(cells)
