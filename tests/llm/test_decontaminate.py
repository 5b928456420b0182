import random
from collections import Counter

from gleanspark.llm import decontaminate
from gleanspark.llm.decontaminate import plain_words, shingle_set
from tests.llm import odd


def brute(docs, items, threshold=0.8):
    held = [(d, shingle_set(plain_words((t or "").encode()), 5)) for d, t in docs]
    out = set()
    for item, text in items:
        wanted = shingle_set(plain_words((text or "").encode()), 5)
        for d, own in held:
            if wanted and len(wanted & own) >= threshold * len(wanted):
                out.add((d, item, len(wanted), len(wanted & own)))
    return out


def found(spark, docs, items, **size):
    docs = spark.createDataFrame(docs, "doc_id bigint, text string")
    items = spark.createDataFrame(items, "item_id bigint, text string")
    rows = decontaminate.contaminated(docs, items, **size).collect()
    assert all(r["containment"] == r["shared"] / r["item_shingles"] for r in rows)
    assert max(Counter(tuple(r) for r in rows).values(), default=1) == 1
    return {(r["doc_id"], r["item_id"], r["item_shingles"], r["shared"]) for r in rows}


def made(seed=1):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdef", k=4))
    items = [
        (i, " ".join(word() for _ in range(n)))
        for i, n in enumerate([1, 3, 4, 5, 6, 8, 9, 12, 13, 20, 37, 69, 70, 140, 700] * 3)
    ]
    docs = []
    for d in range(300):
        text = [word() for _ in range(rng.choice([0, 3, 40, 400, 3000]))]
        for _ in range(rng.choice([0, 1, 1, 2])):
            passage = rng.choice(items)[1].split()
            for _ in range(rng.choice([0, 0, 1, 2])):
                passage[rng.randrange(len(passage))] = word()
            at = rng.randrange(len(text) + 1)
            text[at:at] = passage
        docs.append((d, " ".join(text)))
    return docs, items


def test_equals_brute_force_at_every_size(spark):
    docs, items = made()
    expected = brute(docs, items)
    assert len(expected) > 100
    assert found(spark, docs, items) == expected


def test_halves_far_apart_count(spark):
    item = " ".join(f"i{k}" for k in range(40))
    words = item.split()
    filler = [f"f{k}" for k in range(2000)]
    docs = [(1, " ".join([*words[:20], *filler, *words[16:]]))]
    assert found(spark, docs, [(5, item)]) == brute(docs, [(5, item)]) != set()


def test_case_and_punctuation_do_not_matter(spark):
    item = "The quick, brown fox: jumps over the lazy dog!"
    docs = [(1, "so THE QUICK brown fox jumps; over the-lazy dog again"), (2, "the quick brown dog")]
    assert {r[:2] for r in found(spark, docs, [(5, item)])} == {(1, 5)}


def test_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(60))
    items = [(1, long), (1, long), (2, long), (None, long), (3, None), (4, ""), (5, "one two three")]
    docs = odd.documents(spark)
    pairs = [(r["doc_id"], r["text"]) for r in docs.collect()]
    rows = decontaminate.contaminated(
        docs, spark.createDataFrame(items, "item_id bigint, text string")
    ).collect()
    got = {(r["doc_id"], r["item_id"], r["item_shingles"], r["shared"]) for r in rows}
    assert got == brute(pairs, items) and len(got) == len(rows)


def test_keep_clean(spark):
    docs = odd.documents(spark)
    benchmark = spark.createDataFrame([(1, "one two three")], "item_id bigint, text string")
    kept = decontaminate.keep_clean(docs, benchmark)
    assert kept.columns == docs.columns
    gone = Counter(tuple(r) for r in docs.collect()) - Counter(tuple(r) for r in kept.collect())
    assert [r[0] for r in gone] == [7]


def test_empty_tables(spark):
    docs, items = made()
    assert found(spark, [], items) == set()
    assert found(spark, docs, []) == set()
    empty = spark.createDataFrame([], "item_id bigint, text string")
    df = odd.documents(spark)
    assert decontaminate.keep_clean(df, empty).count() == df.count()


def test_more_items_than_a_pass_holds(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "ITEM_BYTES", 2000)
    docs, items = made(2)
    assert found(spark, docs, items) == brute(docs, items)


def test_a_long_item_costs_what_it_weighs():
    import tracemalloc

    rng = random.Random(4)
    docs = [" ".join(rng.choices("abcdefgh", k=12)).encode() for _ in range(3000)]
    item = " ".join(f"i{k}" for k in range(100_000)).encode()
    index = decontaminate.ItemIndex([(1, item), (2, docs[7])], 5, 0.8)
    tracemalloc.start()
    hits = index.search([*docs, b"x y z " + item[: len(item) - 60]], decontaminate.WordHashes())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert {h[:2] for h in hits} >= {(7, 2), (3000, 1)}
    assert peak < 200e6
