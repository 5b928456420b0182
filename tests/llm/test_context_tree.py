import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from gleanspark.llm import context_tree
from gleanspark.llm.context_tree import BITS, END, Tree, climb, grams, log10_chances
from gleanspark.llm.pieces import Lookup
from gleanspark.llm.queries import op11_lm_scoring
from tests.llm import odd


def lower(text):
    return (text or "").encode().translate(context_tree.LOWER)


def held_out(name):
    return name is not None and zlib.crc32(str(name).encode()) % 10 == 0


def symbols(text, depth):
    """Contexts, latest byte first, and symbols of a text."""
    raw = bytes(depth) + text
    for i in range(len(text) + 1):
        yield raw[i : i + depth][::-1], text[i] if i < len(text) else END


def decisions(symbol):
    for j in range(BITS if symbol != END else 1):
        yield (j, symbol >> (BITS - j)), (symbol >> (BITS - 1 - j)) & 1


class Trees:
    """The same model by recursion over dictionaries."""

    def __init__(self, texts, depth):
        self.depth = depth
        self.counts = defaultdict(lambda: [0, 0])
        self.children = defaultdict(set)
        for text in texts:
            for context, symbol in symbols(text, depth):
                for node, bit in decisions(symbol):
                    for d in range(depth + 1):
                        self.counts[node, context[:d]][bit] += 1
                        if d < depth:
                            self.children[node, context[:d]].add(context[: d + 1])
        self.memo = {}

    def own(self, node, context):
        a, b = self.counts[node, context]
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    def weighted(self, node, context):
        key = node, context
        if key not in self.memo:
            own = self.own(node, context)
            if len(context) == self.depth:
                self.memo[key] = own
            else:
                below = sum(self.weighted(node, c) for c in self.children[key])
                self.memo[key] = np.logaddexp(own, below) - math.log(2)
        return self.memo[key]

    def chance(self, node, context, bit, d=0):
        here = context[:d]
        n = self.counts[node, here]
        mine = (n[bit] + 0.5) / (sum(n) + 1)
        if d == self.depth or (node, context[: d + 1]) not in self.counts:
            return mine
        share = math.exp(self.own(node, here) - math.log(2) - self.weighted(node, here))
        return share * mine + (1 - share) * self.chance(node, context, bit, d + 1)

    def score(self, text):
        return sum(
            math.log10(self.chance(node, context, bit))
            for context, symbol in symbols(text, self.depth)
            for node, bit in decisions(symbol)
        )


def base(rows):
    counts = Counter()
    for name, text in rows:
        if not held_out(name):
            counts.update([*lower(text).split(), None])
    n, v = sum(counts.values()), len(counts)
    for name, text in rows:
        tokens = [*lower(text).split(), None]
        known = sum(counts[t] > 0 for t in tokens)
        score = sum(math.log10((counts[t] + 0.1) / (n + 0.1 * (v + 1))) for t in tokens)
        yield name, held_out(name), len(tokens), known, n, score


def key(row):
    return (row[0] is None, row[0] or 0, row[2], round(row[5], 6))


@pytest.mark.parametrize("how", [Tree(depth=2), Tree(depth=4, part_bytes=700, chunk_bytes=900, slice_bytes=50)])
def test_scores_equal_recursion(spark, how):
    rows = [(i, f"The cat {i % 7} sat on the mat{'!' * (i % 3)}\nand the rat Ü{i * i}") for i in range(60)]
    rows += [(None, "a null id"), (60, None), (61, ""), (62, "\0\x01 \0"), (7, "THE CAT"), (7, "THE CAT")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    tree = Trees([lower(t) for i, t in rows if not held_out(i)], how.depth)
    expected = sorted(
        ((*b, tree.score(lower(t))) for b, (_, t) in zip(base(rows), rows, strict=True)), key=key
    )
    found = sorted((tuple(r)[:7] for r in context_tree.score(df, how=how).collect()), key=key)
    assert len(found) == len(expected)
    for a, b in zip(found, expected, strict=True):
        assert a[:5] == b[:5]
        assert a[5:] == pytest.approx(b[5:], rel=1e-6)


def test_chances_add_up_to_one():
    texts = [b"abracadabra", b"a barber", b""]
    how = Tree(depth=3)
    keys, n = np.unique(np.concatenate([k for _, _, k in grams(texts, how)]), return_counts=True)
    for context in {k >> BITS for k in keys.tolist()}:
        every = (context << BITS) + np.arange(END + 1)
        own = np.union1d(keys, every)
        counts = np.zeros(len(own), np.int64)
        counts[np.searchsorted(own, keys)] = n
        seen = np.zeros((256, END + 1), np.int64)
        np.add.at(seen, (own >> (BITS + 16), own & 511), counts)
        logs = np.zeros((256, 1 << BITS))
        for j, node, log, _, _ in climb(own, counts, 3):
            at = (1 << j) | (node & ((1 << j) - 1))
            np.add.at(logs, (node >> (j + 8), at), log)
        top = context_tree.Top.of(seen, logs)
        here = log10_chances(own, counts, 3, top)[np.searchsorted(own, every)]
        assert (10**here).sum() == pytest.approx(1)


def test_odd_rows(spark):
    table = odd.documents(spark)
    rows = [(r["doc_id"], r["text"]) for r in table.collect()]
    found = op11_lm_scoring(spark, odd.folder(spark, documents=table)).collect()
    expected = sorted(base(rows), key=key)
    assert len(found) == len(expected)
    for a, b in zip(sorted(map(tuple, found), key=key), expected, strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5])
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in found)
    assert {r["bits_per_byte"] is None for r in found if r["doc_id"] in (3, 4)} == {True}


def test_held_out_texts_are_foretold_better_than_by_words(spark, sf_dir):
    rows = [r for r in op11_lm_scoring(spark, sf_dir).collect() if r["held_out"]]
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)


def test_only_the_id_decides_what_is_learned(spark):
    names = [i for i in range(100) if held_out(i)][:3]
    rows = [(1, "a a a b"), (2, "b a"), *((i, "zebra " * 9) for i in names)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r["doc_id"]: r for r in context_tree.score(df).collect()}
    assert {r["train_tokens"] for r in found.values()} == {8}
    assert found[names[0]]["n_known"] == 1
    assert found[names[0]]["score"] < 10 * found[1]["score"]


def test_empty_table(spark):
    assert op11_lm_scoring(spark, odd.folder(spark)).count() == 0


def test_lookup_finds_every_key():
    rng = np.random.default_rng(1)
    for n in (0, 1, 7, 5000):
        keys = np.unique(rng.integers(0, 1 << 49, n))
        values = rng.normal(size=len(keys))
        asked = rng.integers(0, max(len(keys), 1), 3 * len(keys))
        found = Lookup(keys, values).of(keys[asked])
        assert found.tolist() == values[asked].tolist()
