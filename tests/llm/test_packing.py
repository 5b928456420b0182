import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import tokenizers

from gleanspark.llm import packing
from gleanspark.llm.queries import op6_packing
from gleanspark.llm.tokens import VOCABULARY, Encoder
from tests.llm import odd


@pytest.fixture(scope="module")
def library():
    found = tokenizers.Tokenizer.from_file(VOCABULARY)
    found.encode_special_tokens = True
    return lambda text: found.encode(text or "", add_special_tokens=False).ids + [0]


def check(rows, docs, length=1024, shards=1):
    """``docs``: (id, ids). Each id lies in exactly one piece, and sequences are full."""
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[r["doc_id"], r["doc_tokens"]].append((r["start"], r["length"], r["ids_crc32"]))
    for parts in sequences.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:i]) for i in range(len(parts))]
        assert sum(n for _, n in parts) <= length
    total = sum(len(ids) for _, ids in docs)
    assert len(sequences) <= total // length + shards
    expected = defaultdict(list)
    for doc, ids in docs:
        expected[doc, len(ids)].append(ids)
    assert pieces.keys() == expected.keys()
    for key, texts in expected.items():
        # Rows of one id and length are told apart by where their pieces begin again.
        assert Counter(i for s, n, _ in pieces[key] for i in range(s, s + n)) == Counter(
            {i: len(texts) for i in range(key[1])}
        )
        if len(texts) == 1:
            for s, n, crc in pieces[key]:
                assert zlib.crc32(np.array(texts[0][s : s + n], "<u4").tobytes()) == crc


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_every_id_once(spark, sf_dir, sf, library):
    path = sf_dir.rpartition("/")[0] + "/" + sf
    docs = [(r[0], library(r[1])) for r in odd.rows_of(spark, path)]
    check(op6_packing(spark, path).collect(), docs)


def test_odd_rows(spark, library):
    rows = [(30 + i, f"{i} <|endoftext|> [{i}]" * 9) for i in range(40)]
    table = odd.documents(spark, rows)
    docs = [(r["doc_id"], library(r["text"])) for r in table.collect()]
    check(op6_packing(spark, odd.folder(spark, documents=table)).collect(), docs)
    how = packing.Packing(length=16, shard_tokens=512)
    found = packing.pack(table, how=how).collect()
    check(found, docs, 16, 2 + sum(len(i) for _, i in docs) // 512)
    assert all(len(r["ids"]) == 2 * r["length"] for r in found)


def test_empty_table(spark):
    assert op6_packing(spark, odd.folder(spark)).count() == 0


def test_neighbours_share_windows():
    rng = np.random.default_rng(1)
    units = [rng.integers(1000 * (i % 4) + 1, 1000 * (i % 4) + 60, 30) for i in range(40)]
    idf = np.zeros(1 << 16)
    idf[:5000] = 1.0
    for window in packing.pack_units(units, idf, packing.Packing(length=150)):
        kinds = Counter(unit % 4 for unit, _, _ in window)
        assert len(kinds) <= 2


@pytest.mark.parametrize("n", [0, 1, 64, 65, 5000])
def test_ranked_is_a_stable_sort(n):
    rng = np.random.default_rng(n)
    for scores in (rng.random(n), rng.integers(0, 3, n) * 1.0, np.zeros(n)):
        assert list(packing.ranked(scores)) == np.argsort(-scores, kind="stable").tolist()


def nearest(units, idf, inside):
    """The best score among ``inside[i]`` of each unit, as a share of the best of all."""
    index, found = packing.Index(units, idf, packing.Packing()), []
    for i in range(len(units)):
        scores = index.scores(i)
        scores[i] = 0
        found.append(max(scores[inside[i]], default=0) / scores.max())
    return np.mean(found)


@pytest.mark.parametrize("n", [400, 1600])
def test_neighbours_share_a_shard_at_every_size(spark, n):
    rng, vocabulary = np.random.default_rng(n), tokenizers.Tokenizer.from_file(VOCABULARY).get_vocab()
    words = sorted(w[1:] for w in vocabulary if w[0] == "Ġ" and w[1:].isascii() and w[1:].isalpha())
    words = rng.permutation(words)
    topics = words[300:][: 4 * n].reshape(-1, 40)
    texts = []
    for i in range(n):
        own = [*rng.choice(topics[i % len(topics)], 30), *rng.choice(words[:300], 30)]
        texts.append(" ".join(["", *rng.permutation(own)]))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    how = packing.Packing(length=128, shard_tokens=3000)
    shard = {r["doc_id"]: r["sequence_id"] >> 32 for r in packing.pack(docs, how=how).collect()}
    shard = np.array([shard[i] for i in range(n)])
    sizes = 61 * np.bincount(shard)
    assert len(sizes) >= n * 61 // 3000 and sizes.max() <= 2 * 3000
    encoder = Encoder(VOCABULARY)
    units = [np.array(encoder.ids(t)) for t in texts]
    df = np.bincount(np.concatenate([np.unique(u) for u in units]), minlength=1 << 16)
    idf = np.where(df, np.maximum(0, np.log((n - df + 0.5) / (df + 0.5))), 0)
    share = nearest(units, idf, [np.flatnonzero(shard == s) for s in shard])
    print("nearest", n, len(sizes), round(share, 3))
    assert share >= 0.75


def test_copies_of_one_text_fill_many_shards(spark):
    docs = spark.createDataFrame([(i, "one text found often " * 5) for i in range(300)]
        + [(1000 + i, f"other {i} words {i * i}") for i in range(400)], "doc_id bigint, text string")
    how = packing.Packing(length=64, shard_tokens=512)
    found = packing.pack(docs, how=how).collect()
    shards = Counter(r["sequence_id"] >> 32 for r in found for _ in range(r["length"]))
    assert max(shards.values()) <= 2 * 512


def test_all_terms_of_a_seed_are_asked():
    units = [np.arange(1, 101), np.array([100, 7]), np.array([99, 200])]
    idf = np.zeros(1 << 16)
    idf[1:300] = np.linspace(9, 1, 299)
    found = packing.Index(units, idf, packing.Packing()).scores(0)
    assert found[1] > 0 and found[2] > 0


def test_scores_are_bm25():
    units = [np.array(u) for u in ([5, 6, 7, 5], [5, 8], [9, 9, 9], [6, 7])]
    idf = np.zeros(1 << 16)
    idf[5:10] = [1.0, 2.0, 3.0, 4.0, 5.0]
    how = packing.Packing()
    found = packing.Index(units, idf, how).scores(0)
    mean = 11 / 4

    def score(unit):
        total = 0.0
        for term in (5, 6, 7):
            tf = unit.count(term)
            total += idf[term] * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(unit) / mean))
        return total

    assert found == pytest.approx([score(u.tolist()) for u in units])


def test_encoder_agrees_with_the_library(library):
    encoder = Encoder(VOCABULARY)
    chars = [c for c in range(1, 0x30000, 11) if not 0xD800 <= c < 0xE000]
    texts = [f"a{chr(c)}b {chr(c)} {chr(c) * 2}1\n" for c in chars]
    texts += [" " * 5000 + "x", "ab" * 5000, "I'll we're\t\t\r\n  \x85\xa0 x", "<|endoftext|>"]
    assert all(encoder.ids(t) + [0] == library(t) for t in texts)


def test_document_frequencies(spark):
    docs = spark.createDataFrame([(1, "a a b"), (2, "a"), (3, None)], "doc_id int, text string")
    ids = Encoder(VOCABULARY).ids("a b c")
    found = packing.document_frequencies(packing.tokenized(docs, "doc_id", "text"))
    assert found[ids[0]] == 2 and found[ids[1]] == 1 and ids[2] not in found
