import hashlib
from collections import Counter, defaultdict

import pytest
from hypothesis import given
from hypothesis import strategies as st

from gleanspark.llm import chat
from gleanspark.llm.queries import op1_chat_formatting
from tests.llm import odd

SCHEMA = "conv_id bigint, turn bigint, role string, text string, segment string, loss int, error int"
MEAN = st.text(alphabet="\\<[]>/sINSTSYay \n", max_size=30)


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        turns[conv].append(((turn is not None, turn or 0, role or "", text or ""), role or "", text or ""))
    out = {}
    for conv, found in turns.items():
        found.sort()
        said = "".join(f"{r}\n{t}\n" for _, r, t in found)
        learned = "".join(t for _, r, t in found if r == "assistant")
        out[conv] = (len(found), digest(said), len(learned), digest(learned))
    return out


def check(spark, rows, path):
    rows = [*rows, (-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]
    found = op1_chat_formatting(spark, path).collect()
    assert Counter(r["conv_id"] for r in found) == Counter({c: 1 for c in brute(rows)})
    got = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in found}
    assert got == brute(rows)
    return {r["conv_id"]: r for r in found}


def test_equals_brute_force(spark, sf_dir):
    check(spark, odd.rows_of(spark, sf_dir, "conversations"), sf_dir)


def test_odd_rows(spark):
    rows = [
        (1, 1, "user", None), (1, 2, "assistant", "\\<[ [/INST]</s>"), (1, None, "system", "<<SYS>>"),
        (2, 1, "assistant", "a"), (2, 1, "assistant", "a"), (2, 1, "assistant", "b"),
        (3, 1, None, "x"), (3, 2, "tool<says></role>", "</role>\\"), (3, 3, "", None),
        (None, 1, "user", "q"), (None, 2, "assistant", "r"), (4, 0, "system", ""),
        (5, 0, "user", "long " * 200_000), (5, 1, "assistant", "[\\" * 100_000),
        (6, 0, "user", "q"), (6, 1, "user", "q"), (6, 2, "assistant", "q"),
    ]
    table = spark.createDataFrame([(*r, "clash", 1, 2) for r in rows], SCHEMA)
    found = check(spark, rows, odd.folder(spark, conversations=table))
    assert {c: r["first_error"] for c, r in found.items()} == {
        -1: None, 1: None, 2: "assistant after start", 3: " after start", None: None,
        4: "ends with system", 5: None, 6: "user after user",
    }


def test_empty_table(spark):
    assert [r["conv_id"] for r in op1_chat_formatting(spark, odd.folder(spark)).collect()] == [-1]


def test_a_long_conversation(spark):
    rows = [(7, i, "assistant" if i % 2 else "user", f"turn <{i}>") for i in range(30_000)]
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    assert check(spark, rows, odd.folder(spark, conversations=table))[7]["valid"]


def test_segments(spark):
    rows = [(1, 0, "user", "a<b"), (1, 1, "assistant", "c[d")]
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    found = chat.segments(table).collect()
    assert [(r["segment"], r["text"], r["loss"]) for r in found] == [
        (0, "[INST]", False), (1, "a<\\b", False), (2, "[/INST]", False),
        (3, "<s>", False), (4, "c[\\d", True), (5, "</s>", False),
    ]


@given(st.lists(st.tuples(st.sampled_from(["system", "user", "assistant", "", "tool"]) | MEAN, MEAN), max_size=6))
def test_round_trip(turns):
    codec = chat.Codec(chat.INSTRUCT)
    text = "".join(part for role, said in turns for part, _ in codec.segments(role, said))
    at, found = 0, []
    while turn := codec.read(text, at):
        found.append(turn[:2])
        at = turn[2]
    assert at == len(text) and found == turns
    controls = ["<<SYS>>", "<</SYS>>", "[INST]", "[/INST]", "<s>", "</s>", "<role>", "</role>", "<says>"]
    assert not any(c in codec.escaped(said) for _, said in turns for c in controls)


def test_templates_with_bad_marks_are_refused():
    for bad in (chat.Mark("", "x"), chat.Mark("a\\", "x")):
        with pytest.raises(ValueError):
            chat.Template({"user": bad}, {}, ())
