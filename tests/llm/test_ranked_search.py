import math
import re
from collections import Counter

import numpy as np
import pytest

from gleanspark.llm import ranked_search
from gleanspark.llm.queries import op12_ranked_search
from gleanspark.llm.ranked_search import Search, closed
from tests.llm import odd

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words_of(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return TERM.findall(lower)


def brute(docs, items, k=20):
    tfs = [(name, Counter(words_of(text))) for name, text in docs]
    tfs = [(name, tf, tf.total()) for name, tf in tfs if tf]
    n_all, length = len(tfs), sum(n for _, _, n in tfs)
    df = Counter(t for _, tf, _ in tfs for t in tf)
    out = []
    for item, text in items:
        found = []
        for name, tf, n in tfs:
            m = 75 + 25 * n * n_all // length
            score = sum(
                math.floor(1000 * math.log((2 * n_all + 2) / (2 * df[t] + 1)))
                * (1_000_000_000 * tf[t] // (1000 * tf[t] + 12 * m))
                for t in words_of(text)
                if tf[t]
            )
            if score > 0:
                found.append((-score, name is None, name or 0, name))
        for rank, (score, _, _, name) in enumerate(sorted(found)[:k], 1):
            out.append((item, rank, name, -score))
    return sorted(out, key=str)


def rows(df):
    return sorted((tuple(r)[:4] for r in df.collect()), key=str)


HOWS = [Search(), Search(shard_docs=4, block_bytes=1), Search(shard_postings=50, step=0.5, k=3)]


@pytest.mark.parametrize("how", HOWS)
def test_equals_brute_force(spark, how):
    rng = np.random.default_rng(2)
    names = [f"w{i}" for i in range(120)]
    chance = 1 / np.arange(1, 121)
    texts = [
        " ".join(rng.choice(names, rng.integers(1, 90), p=chance / chance.sum())) for _ in range(300)
    ]
    docs = [*enumerate(texts), *((300 + i, texts[5]) for i in range(40)), (5, texts[5]), (None, texts[6])]
    items = [(i, " ".join(rng.choice(names, 12))) for i in range(12)]
    items += [(12, ""), (13, None), (14, "nothing here"), (15, texts[5]), (15, texts[5]), (None, "W1 w1;w2")]
    found = ranked_search.search(
        spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3, "doc_id"),
        spark.createDataFrame(items, "item_id bigint, text string"),
        how=how,
    )
    assert rows(found) == brute(docs, items, how.k)


def test_all_terms_are_indexed_if_the_items_are_many(spark, monkeypatch):
    monkeypatch.setattr(ranked_search, "is_small", lambda df: False)
    docs = [(i, f"apple pear{i % 5} plum{i % 3}") for i in range(40)]
    items = [(0, "apple pear1"), (1, "plum2 plum1 plum2")]
    found = ranked_search.search(
        spark.createDataFrame(docs, "doc_id bigint, text string"),
        spark.createDataFrame(items, "item_id bigint, text string"),
    )
    assert rows(found) == brute(docs, items)


def test_odd_rows(spark):
    table = odd.documents(spark, [(40, "ÄÖ_x1 Äö x1"), (41, "a\x00b\x7fc a")])
    items = [(1, "w5 w7 ONE"), (2, "x"), (3, "Äö X1 ÄÖ"), (4, "a b"), (5, None)]
    docs = [(r["doc_id"], r["text"]) for r in table.collect()]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    path = odd.folder(spark, documents=table, benchmark=benchmark)
    assert rows(op12_ranked_search(spark, path)) == brute(docs, items)


def test_empty_tables(spark):
    some = spark.createDataFrame([(1, "a")], "item_id bigint, text string")
    assert op12_ranked_search(spark, odd.folder(spark)).count() == 0
    assert op12_ranked_search(spark, odd.folder(spark, benchmark=some)).count() == 0
    path = odd.folder(spark, documents=odd.documents(spark))
    assert op12_ranked_search(spark, path).count() == 0


def test_reading_stops_when_all_intervals_are_closed():
    rng = np.random.default_rng(3)
    size, k = 20_000, 20
    # The rare terms are in short documents.
    unit = np.sort(rng.integers(300, 2000, size))[::-1]
    lists, full = [], np.zeros(size, np.int64)
    for weight, df in ((900, 40), (700, 300), (20, 15_000), (10, 18_000)):
        docs = rng.choice(size if df > 300 else 400, df, replace=False)
        impacts = weight * unit[docs] * rng.integers(1, 4, df)
        order = np.argsort(-impacts)
        lists.append((docs[order], impacts[order], weight))
        full[docs] += impacts
    docs, scores, reads = closed(lists, unit, k, 0.75)
    best = np.sort(full)[::-1][:k]
    assert np.sort(scores)[::-1][:k].tolist() == best.tolist()
    assert all(full[d] == s for d, s in zip(docs.tolist(), scores.tolist(), strict=True))
    assert reads < 0.9 * sum(len(d) for d, _, _ in lists)


def test_a_long_text_is_counted_whole(spark):
    text = "alpha " * 900_000 + "omega"
    docs = [(1, text), (2, "omega beta"), (3, "gamma")]
    items = [(1, "omega alpha")]
    found = ranked_search.search(
        spark.createDataFrame(docs, "doc_id bigint, text string"),
        spark.createDataFrame(items, "item_id bigint, text string"),
    )
    assert rows(found) == brute(docs, items)
