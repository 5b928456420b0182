import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from gleanspark.llm import batches, substring
from gleanspark.llm.queries import op7_substring_dedup
from tests.llm import odd


def brute(rows, size=50):
    holders = defaultdict(set)
    for doc, text in rows:
        w = odd.words(text)
        for i in range(len(w) - size + 1):
            holders[tuple(w[i : i + size])].add(doc)
    out = []
    for doc, text in rows:
        w = odd.words(text)
        gone = [False] * len(w)
        for i in range(len(w) - size + 1):
            if any(odd.smaller(h, doc) for h in holders[tuple(w[i : i + size])]):
                gone[i : i + size] = [True] * size
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((doc, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def check(spark, path):
    docs = [(r[0], r[1]) for r in odd.rows_of(spark, path)]
    found = Counter(tuple(r) for r in op7_substring_dedup(spark, path).collect())
    expected = brute(docs)
    assert found - expected == expected - found == Counter()


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_equals_brute_force(spark, sf_dir, sf):
    check(spark, sf_dir.rpartition("/")[0] + "/" + sf)


def test_odd_rows(spark):
    run = [f"r{i}" for i in range(70)]
    extra = [
        (20 + i, " ".join([f"a{i}", *run[: 50 + i], f"b{i}", *run[10:], f"c{i}"])) for i in range(8)
    ]
    rows = [(d, "y " * 200 if t and len(t) > 10_000 else t) for d, t in extra]
    check(spark, odd.folder(spark, documents=odd.documents(spark, rows)))


def test_empty_table(spark):
    assert op7_substring_dedup(spark, odd.folder(spark)).count() == 0


def test_hot_windows(spark):
    # Few partitions' worth of rows in a window make it hot; many in one document, too.
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, f"a{i} {passage} b{i}") for i in range(40)]
    rows += [(100, "same " * 500), (101, "same " * 60 + "end"), (None, passage)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    check(spark, odd.folder(spark, documents=docs))


def test_full_sketch_loses_nothing(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(substring, "LEAST_BITS", 4)
    monkeypatch.setattr(substring, "MOST_BITS", 4)
    check(spark, odd.small(sf_dir))


def test_kept_text(spark):
    docs = odd.documents(spark)
    kept = substring.remove_repeats(docs).collect()
    assert all(hashlib.sha256((r["kept"] or "").encode()).hexdigest() == r["kept_sha256"] for r in kept)
    assert len(kept) == docs.count()


def test_window_hashes_tell_windows_apart():
    values = np.arange(1000, dtype=np.uint64) % np.uint64(97) * np.uint64(0x9E3779B97F4A7C15)
    for size in (1, 2, 3, 8, 50):
        found = batches.windows(values, size)
        assert len(found) == 1000 - size + 1
        assert len(set(found.tolist())) == 97
        assert (found[:100] == found[97:197]).all()
