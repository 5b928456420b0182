from collections import Counter

import numpy as np
import pytest
import xxhash

from gleanspark.llm import simhash
from gleanspark.llm.components import stars
from gleanspark.llm.queries import op9_simhash_near_dedup
from tests.llm import odd


def mark(text):
    w = odd.words((text or "").encode().lower().decode())
    if not w:
        return 0
    shingles = [b" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def components(pairs, radius=4):
    """Rows (id, fp) to (id, hex, least reachable id)."""
    marks = sorted({fp for _, fp in pairs})
    up = {fp: fp for fp in marks}

    def root(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    x = np.array(marks, np.uint64)
    for i, fp in enumerate(marks):
        for j in np.flatnonzero(np.bitwise_count(x[i + 1 :] ^ x[i]) <= radius):
            up[root(marks[i + 1 + j])] = root(fp)
    least = {}
    for doc, fp in pairs:
        r = root(fp)
        if doc is not None:
            least[r] = min(least.get(r, doc), doc)
    return Counter((doc, f"{fp:016x}", least.get(root(fp))) for doc, fp in pairs)


def check(spark, path):
    pairs = [(r[0], mark(r[1])) for r in odd.rows_of(spark, path)]
    found = Counter(tuple(r) for r in op9_simhash_near_dedup(spark, path).collect())
    assert found == components(pairs)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_equals_brute_force(spark, sf_dir, sf):
    check(spark, sf_dir.rpartition("/")[0] + "/" + sf)


def test_odd_rows(spark):
    check(spark, odd.folder(spark, documents=odd.documents(spark)))


def test_empty_table(spark):
    assert op9_simhash_near_dedup(spark, odd.folder(spark)).count() == 0


@pytest.mark.parametrize("tile", [3, 16, 2048])
def test_tiles_find_every_link(spark, tile):
    rng = np.random.default_rng(5)
    centres = rng.integers(0, 1 << 63, 6, dtype=np.uint64)
    marks = set(rng.integers(0, 1 << 63, 300, dtype=np.uint64).tolist())
    for centre in centres.tolist():
        for _ in range(40):
            bits = rng.choice(64, rng.integers(0, 6), replace=False)
            marks.add(centre ^ sum(1 << int(b) for b in bits))
    pairs = list(enumerate(sorted(marks)))
    signed = [(int(np.uint64(fp).view(np.int64)),) for _, fp in pairs]
    found = stars(simhash.links(spark.createDataFrame(signed, "fp bigint"), 4, tile))
    root = {r["u"]: r["v"] for r in found.collect()}
    expected = components(pairs)
    groups, wanted = {}, {}
    for i, fp in pairs:
        own = int(np.uint64(fp).view(np.int64))
        groups.setdefault(root.get(own, own), set()).add(i)
    for (i, _, least), _ in expected.items():
        wanted.setdefault(least, set()).add(i)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, wanted.values()))


def test_long_chain_is_one_component(spark):
    links = spark.range(300).selectExpr("id as u", "id + 1 as v")
    found = stars(links).collect()
    assert len(found) == 300 and {r["v"] for r in found} == {0}


def test_keep_one(spark, sf_dir):
    path = odd.small(sf_dir)
    docs = spark.read.parquet(f"{path}/documents.parquet")
    kept = {r["doc_id"] for r in simhash.keep_one(docs).collect()}
    expected = components([(r[0], mark(r[1])) for r in odd.rows_of(spark, path)])
    assert kept == {least for _, _, least in expected}
    odd_docs = odd.documents(spark)
    kept = simhash.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert ids.count(None) == 3 and ids.count(1) == 1 and ids.count(2) == 0
