import hashlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece
import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from gleanspark.llm import token_alignment
from gleanspark.llm.perfect_hash import PerfectHash
from gleanspark.llm.queries import op13_token_alignment
from gleanspark.llm.token_alignment import PIECES, Alignment, Words, token_bytes
from gleanspark.llm.tokens import VOCABULARY
from tests.llm import odd

BYTES = token_bytes(Alignment())
NAMES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


class Whole:
    """Whole texts through the libraries."""

    def __init__(self):
        self.a = tokenizers.Tokenizer.from_file(VOCABULARY)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=PIECES)

    def groups(self, text):
        if not text:
            return [], [], []
        a = self.a.encode(" " + text, add_special_tokens=False).ids
        b = self.b.encode(text)
        raw = (" " + text).encode()
        if any(b"".join(own[i] for i in ids) != raw for own, ids in zip(BYTES, (a, b), strict=True)):
            return [], [], []
        ends_a = np.cumsum([len(BYTES[0][i]) for i in a]).tolist()
        ends_b = np.cumsum([len(BYTES[1][i]) for i in b]).tolist()
        groups, i, j = [], 0, 0
        for end in sorted({*ends_a} & {*ends_b}):
            k, m = ends_a.index(end, i) + 1, ends_b.index(end, j) + 1
            groups.append((a[i:k], b[j:m]))
            i, j = k, m
        return a, b, groups


@pytest.fixture(scope="module")
def whole():
    return Whole()


def written(groups):
    return ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)


def brute(whole, rows):
    found = [(name, *whole.groups(text)) for name, text in rows]
    counts = Counter((g[0][-1], g[1][-1]) for *_, groups in found for g in groups)
    best = Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    out = []
    for name, a, b, groups in found:
        links = [(g[0][-1], g[1][-1]) for g in groups]
        digest = hashlib.sha256(written(groups).encode()).hexdigest() if groups else ""
        most = sum(counts[x] == best[x[1]] for x in links)
        total = sum(counts[x] for x in links)
        out.append((name, len(a), len(b), len(groups), len(links), most, total, digest))
    return sorted(out, key=str)


def rows(df):
    return sorted((tuple(r[n] for n in ["doc_id", *NAMES]) for r in df.collect()), key=str)


def test_equals_brute_force(spark, sf_dir, whole):
    path = odd.small(sf_dir)
    assert rows(op13_token_alignment(spark, path)) == brute(
        whole, [r[:2] for r in odd.rows_of(spark, path)]
    )


EXTRA = [
    "two  spaces", " leading", "trailing ", "tab\t x", "line \n x", "line\n x\n\n y \n", "▁a b", "a▁",
    "<s> </s> <unk> <0x41> <|endoftext|>", "x\x00y \x01", "é é ﬁ", "a　b 　 c  d",
    "don't I'll 12345 67.89 ----- ....", "日本語 テキスト 🎉🎉", "=" * 500, " ", "\n", "   ", "word " * 3,
]


def test_odd_rows(spark, whole):
    table = odd.documents(spark, [(100 + i, t) for i, t in enumerate(EXTRA)])
    expected = brute(whole, [(r["doc_id"], r["text"]) for r in table.collect()])
    assert rows(op13_token_alignment(spark, odd.folder(spark, documents=table))) == expected
    # Few words remembered, many parts of the hash, a tree of several levels.
    how = Alignment(remembered=50, part_pairs=20, fan_in=2, kept_bytes=100)
    found = token_alignment.align(table.repartition(7), how=how)
    assert rows(found) == expected
    assert all(
        hashlib.sha256(r["groups"].encode()).hexdigest() == r["groups_sha256"]
        for r in found.collect()
        if r["groups"]
    )


def test_empty_table(spark):
    assert op13_token_alignment(spark, odd.folder(spark)).count() == 0


WORDS = Words(Alignment(remembered=300), with_text=True)
TEXTS = st.text(
    st.one_of(st.sampled_from(" \n\t\r\x0b\x85 　ab'sI1.▁"), st.characters(codec="utf-8")), max_size=30
)


@settings(max_examples=400, deadline=None)
@given(TEXTS)
def test_words_align_as_whole_texts(text):
    whole = test_words_align_as_whole_texts.whole
    a, b, groups = whole.groups(text)
    pieces = [piece for lot in WORDS.lots([text]) for piece in lot]
    if not all(sound for _, _, sound in pieces):
        assert a == b == []
        return
    found = [n for _, numbers, _ in pieces for n in numbers.tolist()]
    assert b";".join(WORDS.text[i] for i in found).decode() == written(groups)
    assert WORDS.n[found].sum(0).tolist() == [len(a), len(b), len(groups)]


test_words_align_as_whole_texts.whole = Whole()


def test_texts_in_several_lots(spark, whole, monkeypatch):
    # Small lots in the driver's own process.
    monkeypatch.setattr(token_alignment, "_LOT", 64)
    monkeypatch.setattr(token_alignment._pieces, "__defaults__", (64,))
    rng = np.random.default_rng(5)
    words = [f"word{i}," for i in range(300)]
    texts = [" ".join(rng.choice(words, n)) for n in (3, 200, 40, 1)] + ["x " * 50 + "▁"]
    table = spark.createDataFrame([*enumerate(texts)], "doc_id bigint, text string")
    found = token_alignment.align(table, how=Alignment(remembered=20))
    assert rows(found) == brute(whole, [*enumerate(texts)])


def test_long_texts_are_cut_between_words():
    text = "".join(f"word{i} \n x  y z" for i in range(500))
    pieces = [*token_alignment._pieces(text, 100)]
    assert len(pieces) > 20 and " ".join(pieces) == text


def test_hash_is_minimal_and_perfect():
    rng = np.random.default_rng(4)
    for n in (0, 1, 2, 5000):
        keys = np.unique(rng.integers(0, 1 << 31, n))
        found = PerfectHash(PerfectHash.build(keys)).of(keys)
        assert sorted(found.tolist()) == [*range(len(keys))]
