import re
from collections import Counter

import numpy as np
import pytest

from gleanspark.llm import quality
from gleanspark.llm.queries import op8_quality_rules
from tests.llm import odd


def base(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    found = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = {
        j for i in range(len(w) - 7) if found[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)
    }
    failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    repeated = len(lines) - len(set(lines))
    return len(w), sum(map(len, w)), symbols, repeated, len(covered), failed


def check_base(spark, path):
    found = op8_quality_rules(spark, path).collect()
    got = Counter((r["doc_id"], *(r[c] for c in quality.BASE), r["base_failed"]) for r in found)
    assert got == Counter((r[0], *base(r[1])) for r in odd.rows_of(spark, path))
    assert not any(r["kept"] and r["base_failed"] for r in found)


def test_base_counts(spark, sf_dir):
    check_base(spark, sf_dir)


def test_odd_rows(spark):
    labels = [(1, 1, 0), (1, 0, 0), (2, None, None), (None, 1, 1), (77, 0, 1)]
    labels = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    check_base(spark, odd.folder(spark, documents=odd.documents(spark), labels=labels))


def test_empty_tables(spark):
    assert op8_quality_rules(spark, odd.folder(spark)).count() == 0


def test_keep_good_keeps_columns_and_rows(spark):
    docs = odd.documents(spark)
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    expected = Counter(r["doc_id"] for r in docs.collect() if not base(r["text"])[-1])
    assert Counter(r["doc_id"] for r in kept.collect()) == expected


def test_held_out_accuracy(spark, sf_dir):
    path = sf_dir.rpartition("/")[0] + "/sf0.1"
    found = {r["doc_id"]: r for r in op8_quality_rules(spark, path).collect()}
    docs = spark.read.parquet(f"{path}/documents.parquet")
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{path}/labels.parquet").collect()}
    strata = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    judged = [(d, r) for d, r in labels.items() if d in found and not found[d]["base_failed"]]
    english = [(found[d]["kept"], r) for d, r in judged if strata[d] == "en"]
    good = [kept for kept, r in english if r["quality"] and not r["toxic"]]
    toxic = [kept for kept, r in english if r["toxic"]]
    assert sum(good) >= 0.98 * len(good)
    assert sum(toxic) <= 0.1 * len(toxic)
    # The other strata have too few labels here for a cutoff, and lose nothing.
    assert all(found[d]["kept"] for d, _ in judged if strata[d] == "es")


def test_every_label_is_in_one_fold(spark, monkeypatch):
    n, risk = 400, quality.Risk(fit_rows=40)
    docs = [(i, " ".join(f"w{i}x{j}" for j in range(25)), "en") for i in range(n)]
    docs = spark.createDataFrame(docs, "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame(
        [(i, 1, 0) for i in range(n)], "doc_id bigint, quality int, toxic int"
    )
    marks = quality._labels(labels, "doc_id", risk).cache()
    fitted = {r[0] for r in marks.where(f"spot < {quality.fitted_share(marks, risk)}").collect()}
    held, settle = [], quality.settle

    def kept(df, label):
        held.append(df)
        return settle(df, label)

    monkeypatch.setattr(quality, "settle", kept)
    measured = quality.measure(docs, "doc_id", "text", "lang", {})
    quality.choose_cutoffs(measured, marks, risk)
    counted = held[0].groupBy("rule").agg(quality.F.sum("good").alias("n")).collect()
    assert 0 < len(fitted) < 0.2 * n
    assert {r["n"] for r in counted} == {n - len(fitted)}


def test_binomial_tail():
    assert quality.binomial_tail(0, 10, 0.1) == pytest.approx(0.9**10)
    assert quality.binomial_tail(1, 10, 0.1) == pytest.approx(0.9**10 + 10 * 0.1 * 0.9**9)
    assert quality.binomial_tail(10, 10, 0.1) == 1.0


def test_cutoffs_keep_their_guarantee():
    # Scores carry no signal, yet a cutoff may not lose more than the limit.
    rng = np.random.default_rng(3)
    broken, limit, error = 0, 0.02, 0.1
    truth = np.linspace(0.2, 0, 51)
    for _ in range(200):
        good = np.bincount(rng.choice(51, 2000, p=truth / truth.sum()), minlength=51)
        bad = np.bincount(rng.choice(51, 2000), minlength=51)
        cut = quality.pick_cutoff(good, bad, limit, error, 0.0)
        if cut is not None and (truth / truth.sum())[cut:].sum() > limit:
            broken += 1
    assert broken <= 200 * (error + 0.05)


def test_no_cutoff_without_enough_labels():
    assert quality.pick_cutoff(np.array([100, 0]), np.array([0, 50]), 0.005, 0.003, 10) is None
    assert quality.pick_cutoff(np.array([5000, 0]), np.array([0, 50]), 0.005, 0.003, 10) == 1
