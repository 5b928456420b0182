import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from gleanspark.llm import packing, tokens
from gleanspark.llm.batches import lots
from gleanspark.llm.tokens import VOCABULARY, Encoder, WordEncoder

PARTS = [
    " ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", "　", "a", "bc", "'s", "'", "12", "é",
    "日本", "!", "<|endoftext|>", "\r", "foo ", "�", "😀",
]


@pytest.fixture(scope="module")
def texts():
    draw = random.Random(5)
    made = ["".join(draw.choices(PARTS, k=draw.randrange(30))) for _ in range(5000)]
    return [*made, "", " ", "  ", "\n ", " \n", "x" * 200_000, "word " * 50_000]


@pytest.mark.parametrize("lot, remembered", [(8 << 20, 600_000), (100, 20)])
def test_word_by_word_is_text_by_text(texts, monkeypatch, lot, remembered):
    monkeypatch.setattr(tokens, "_LOT", lot)
    found = WordEncoder(VOCABULARY, remembered).ids(texts)
    whole = Encoder(VOCABULARY)
    for text, ids in zip(texts, found, strict=True):
        assert np.frombuffer(ids, "<u2").tolist() == whole.ids(text)


def test_long_texts_are_cut_where_words_begin(texts):
    for size in (1, 6, 50):
        for text in texts[:500]:
            pieces = list(tokens._pieces(text, size))
            assert "".join(pieces) == text
            assert all(p[0] == " " and not p[1].isspace() for p in pieces[1:])


@pytest.mark.parametrize("lot", [1 << 22, 64])
def test_terms_and_keys_of_a_batch_are_those_of_its_documents(monkeypatch, lot):
    monkeypatch.setattr(packing, "COUNTED_IDS", lot)
    draw, how = np.random.default_rng(3), packing.Packing()
    docs = [draw.integers(0, 40, draw.integers(0, 30)) for _ in range(300)]
    blobs = [np.append(d, 0).astype("<u2").tobytes() for d in docs]
    weights = np.zeros(1 << 16)
    weights[5:40] = draw.random(35)
    found, at = [], 0
    for size, place, terms, counts in packing.counted_terms(blobs):
        found += list(zip((place + at).tolist(), terms.tolist(), counts.tolist(), strict=True))
        at += size
    expected = [
        (i, t, docs[i].tolist().count(t)) for i in range(300) for t in sorted(set(docs[i].tolist()))
    ]
    assert at == 300 and found == expected
    keys = packing.lexical_keys(blobs, weights, how)
    for d, key in zip(docs, keys.tolist(), strict=True):
        terms, counts = np.unique(d[weights[d] > 0] if len(d) else d, return_counts=True)
        terms = terms.astype(np.int64)
        strength = weights[terms] * counts / (counts + how.k1) / packing.DRAWS[terms]
        best = terms[np.argsort(-strength, kind="stable")[: packing.KEY_TERMS]].tolist()
        best += [0] * (packing.KEY_TERMS - len(best))
        assert key + (1 << 63) == sum(t << 16 * (3 - i) for i, t in enumerate(best))
    assert packing.lexical_keys([], weights, how).tolist() == []


def test_the_memory_of_encoding_does_not_grow_with_the_texts():
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(500)]
    texts = [" ".join(rng.choices(words, k=20_000)) for _ in range(70)]
    encoder = WordEncoder(VOCABULARY)
    encoder.ids(texts[:1])
    tracemalloc.start()
    try:
        found = encoder.ids(texts)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    # Beside the ids themselves, in pieces and joined: what a lot of text takes.
    assert peak - 2 * sum(map(len, found)) < 64 << 20


def test_lots_are_the_whole_batch_in_order():
    values = [b"a" * 5, None, b"", b"b" * 30, b"c", b"d" * 9, b"e" * 2, None]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(8)), pa.array(values, pa.binary())], names=["row", "text"]
    )
    for batch, n in ((batch, 8), (batch.slice(1, 6), 6), (batch.slice(0, 0), 0)):
        for size in (1, 10, 1000):
            cut = list(lots(batch, "text", size))
            assert [x for lot in cut for x in lot.column("row").to_pylist()] == (
                batch.column("row").to_pylist()
            )
            assert all(x.num_rows == 1 or sum(map(len, filter(None, x.column("text").to_pylist()))) <= size for x in cut)
        assert len(cut) == (n > 0)
