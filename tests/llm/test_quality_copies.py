"""Copies of a labelled text are one piece of evidence."""

import numpy as np

from gleanspark.llm import quality

RISK = quality.Risk(limit=0.2, fit_rows=60)


def tables(spark, copies, own_ids):
    rng = np.random.default_rng(8)
    rows, labels = [], []
    for i in range(1200):
        bad = i % 4 == 0
        words = [f"{rng.choice(['ab', 'cd', 'ef'])}{i}x{j}" for j in range(25)]
        if bad:
            words = [w.upper() for w in words]
        for copy in range(copies):
            name = i + 10_000 * copy if own_ids else i
            rows.append((name, " ".join(words), "en"))
            labels.append((name, int(not bad), 0))
    # A few texts of which one copy is labelled bad, the other good.
    return (
        spark.createDataFrame(rows, "doc_id bigint, text string, lang string"),
        spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"),
    )


def cuts(spark, copies, own_ids):
    docs, labels = tables(spark, copies, own_ids)
    marks = quality._labels(labels, "doc_id", RISK)
    # The same share of labels in each case, so that the folds are the same.
    risk = quality.Risk(limit=RISK.limit, fit_rows=RISK.fit_rows * (copies if own_ids else 1))
    vocabulary = quality.fit_vocabulary(docs, marks, "doc_id", "text", risk)
    measured = quality.measure(docs, "doc_id", "text", "lang", {})
    found = quality.choose_cutoffs(measured, marks, risk).collect()
    return [tuple(r) for r in found], vocabulary


def test_ten_copies_are_as_good_as_one(spark):
    once = cuts(spark, 1, False)
    assert any(c is not None for c in once[0][0][1:])
    assert cuts(spark, 10, False) == once
    assert cuts(spark, 10, True) == once


def test_few_texts_in_many_copies_give_no_cutoff(spark):
    text = " ".join(f"word{i}" for i in range(30))
    rows = [(i, f"{text} {i % 20}" if i % 2 else text.upper() + f" {i % 20}", "en") for i in range(4000)]
    labels = [(i, i % 2, 0) for i in range(4000)]
    found = quality.judge(
        spark.createDataFrame(rows, "doc_id bigint, text string, lang string"),
        spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"),
    )
    assert found.where("kept").count() == 4000


def test_copies_share_a_fold_and_the_worst_label(spark):
    docs = spark.createDataFrame([(i, "k", i % 3 == 0, i / 100) for i in range(30)], "label_id bigint, key string, bad boolean, spot double")
    row = quality._draws(docs, "key", []).collect()
    assert [tuple(r) for r in row] == [("k", 0, 0.0, True)]
