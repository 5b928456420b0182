import random
from collections import Counter

import pytest

from gleanspark.llm import line_templates
from tests.llm import odd


def letters(i):
    return "".join(chr(97 + int(d)) for d in str(i))


def dropped(spark, texts, **tree):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = line_templates.drop_recurring(docs, tree=line_templates.Tree(**tree))
    return {r["doc_id"]: r["text"] for r in found.collect()}


def test_a_line_stays_in_the_first_document(spark):
    foot = "All rights reserved by the owner"
    texts = [f"own {i}\n{foot}\n\nmore own {i}\n{foot}" for i in range(4)]
    found = dropped(spark, texts)
    assert found[0] == texts[0]
    assert all(found[i] == f"own {i}\n\nmore own {i}" for i in (1, 2, 3))


def test_two_documents_are_not_enough(spark):
    texts = ["same line here\na", "same line here\nb", "other line here"]
    assert dropped(spark, texts) == dict(enumerate(texts))


def test_variable_fields_are_generalised(spark):
    line = "user logged in from host{} at time {} with name {} today again".format
    names = ["ann", "bob", "cid", "dora"]
    texts = [f"{line(i, i * 7, n)}\nrest {n}" for i, n in enumerate(names)]
    found = dropped(spark, texts)
    assert found == {0: texts[0], 1: "rest bob", 2: "rest cid", 3: "rest dora"}


@pytest.mark.parametrize("n", [30, 300, 3000])
def test_a_template_drops_alike_in_few_and_many_documents(spark, n):
    rng = random.Random(n)
    texts = []
    for i in range(n):
        name, carrier = f"name{letters(rng.randrange(300))}", f"by{letters(rng.randrange(26))}"
        texts.append(f"Your parcel for {name} was handed to {carrier} this morning, thank you\nrest")
    found = dropped(spark, [t.replace("rest", letters(i)) for i, t in enumerate(texts)])
    assert sum("parcel" in t for t in found.values()) == 1
    assert all(t.endswith(letters(i)) for i, t in found.items())


def test_three_fields_of_a_hundred_values(spark):
    rng = random.Random(1)
    parts = ["we hereby confirm that", "has sent the order of", "to the house in", "with many thanks"]
    texts = []
    for _ in range(3000):
        fields = [letters(rng.randrange(100)) for _ in range(3)]
        texts.append(" ".join(x for p in zip(parts, [*fields, "today"]) for x in p))
    assert Counter(dropped(spark, texts).values())[""] == 2999


def test_a_leaf_may_hold_many_templates(spark):
    texts = []
    for i in range(6):
        kind = "alpha beta gamma delta" if i % 2 else "kappa lambda my ny"
        texts.append(f"we are here {kind} x{i}\nd{i}")
    found = dropped(spark, texts)
    assert found == {0: texts[0], 1: texts[1], **{i: f"d{i}" for i in range(2, 6)}}


def test_lines_with_little_in_common_stay(spark):
    texts = [f"we are here a{c} b{c} c{c} d{c} e{c}" for c in "uvwxyz"]
    assert dropped(spark, texts) == dict(enumerate(texts))


def test_number_lines_stay(spark):
    texts = ["1 2", "3 4", "5 6", "7 8"]
    assert dropped(spark, texts) == dict(enumerate(texts))


@pytest.mark.parametrize("n", [5, 7, 10])
def test_numeric_rows_stay(spark, n):
    rows = [" ".join(f"{1000 * i + 7 * j}.{i}" for j in range(n)) for i in range(6)]
    texts = [f"{r}\nBerlin {r}" for r in rows]
    assert dropped(spark, texts) == dict(enumerate(texts))


def test_numbers_between_words_are_fields(spark):
    texts = [f"{i}:00 job {i} of user {i * 7} took {i}ms\n{letters(i)}" for i in range(6)]
    assert dropped(spark, texts) == {0: texts[0], **{i: letters(i) for i in range(1, 6)}}


def test_white_space_does_not_tell_lines_apart(spark):
    texts = ["the same  line\t", "  the same line", "the\x0bsame line\r"]
    assert dropped(spark, texts) == {0: texts[0], 1: "", 2: ""}


def test_odd_rows(spark):
    docs = odd.documents(spark)
    found = line_templates.drop_recurring(docs)
    assert found.columns == [*docs.columns, "_lines", "_dropped"]
    rows = found.collect()
    assert len(rows) == docs.count()
    assert Counter(r["doc_id"] for r in rows) == Counter(r["doc_id"] for r in docs.collect())
    texts = Counter(r["text"] for r in rows)
    assert texts[None] == docs.where("text is null").count()
    by_id = {r["doc_id"]: r for r in rows if r["doc_id"] in (4, 5, 9)}
    assert by_id[4]["_lines"] == 1 and by_id[5]["text"] == " \t\n\x0b\x0c\r " and by_id[9]["_dropped"] == 0


def test_repeated_rows_are_one_document(spark):
    docs = spark.createDataFrame(
        [(1, "one and the same line")] * 5 + [(2, "one and the same line")],
        "doc_id bigint, text string",
    )
    found = line_templates.drop_recurring(docs).collect()
    assert all(r["text"] == "one and the same line" for r in found) and len(found) == 6


def test_empty_table(spark):
    empty = spark.createDataFrame([], odd.SCHEMA)
    assert line_templates.drop_recurring(empty).count() == 0


def test_no_python(spark, sf_dir):
    docs = spark.read.parquet(f"{odd.small(sf_dir)}/documents.parquet")
    plan = line_templates.drop_recurring(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("n", [1, 2, 7])
def test_rebuilding_around_dropped_lines(spark, n):
    from pyspark.sql import functions as F

    for mask in range(1, 1 << n):
        drop = [i for i in range(n) if mask >> i & 1]
        row = spark.createDataFrame([([str(i) for i in range(n)], drop)], "l array<string>, d array<int>")
        out = row.select(line_templates._without(F.col("l"), F.col("d")).alias("x")).first()["x"]
        assert out == "\n".join(str(i) for i in range(n) if i not in drop)
        if mask > 20:
            break
