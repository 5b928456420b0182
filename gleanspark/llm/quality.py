"""Quality rules whose cutoffs carry a guarantee.

A rule rejects a document whose score reaches its cutoff. Cutoffs are chosen on
labelled documents kept aside for it: for each stratum and rule they are tried
from the mildest on, and one stands as long as the exact binomial test still
excludes a false rejection rate above the limit. Trying in a fixed order needs no
correction; the strata and rules, tried side by side, share the error among them
(Bonferroni). Of the cutoffs that stand, the one is taken that catches most bad
documents for the good ones it costs.
"""

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanspark.llm.batches import WordHashes, as_bytes, texts, windows
from gleanspark.llm.rows import KEYS, key, matching
from gleanspark.workspace import settle

SYMBOLS = b"#*$%&|<>"
UPPER = bytes(range(65, 91))
PUNCTUATION = bytes(b for b in range(33, 127) if not chr(b).isalnum())
RULES = ["symbols", "capitals", "top_word", "vocabulary"]
# Cutoffs are tried at this many steps: shares in equal steps, the score of the
# vocabulary, which has no upper end, by its logarithm.
STEPS = 200
PER_DOUBLING = 40


@dataclass(frozen=True)
class Risk:
    """The guarantee and the bounds of the fit.

    With probability ``1 - error`` over the draw of the holdout, no stratum
    loses more than ``limit`` of its good documents to the rules. The vocabulary
    is fitted on about ``fit_rows`` labelled documents at most, and has
    ``vocabulary`` words at most; all other labelled documents are the holdout.
    Its words are ten times as frequent in bad documents, or whatever the logarithm
    ``odds`` says. A good document lost counts as much as ``price`` bad ones caught.
    """

    limit: float = 0.03
    error: float = 0.05
    fit_share: float = 0.3
    fit_rows: int = 20_000
    vocabulary: int = 2_000
    odds: float = 2.3
    price: float = 10.0


def _plain(word: bytes) -> bytes:
    return word.strip(PUNCTUATION).lower()


class _Weights(dict):
    def __init__(self, vocabulary: dict[bytes, float]):
        super().__init__()
        self.vocabulary = vocabulary

    def __missing__(self, word: bytes) -> float:
        if len(self) >= 200_000:
            self.clear()
        value = self[word] = self.vocabulary.get(_plain(word), 0.0)
        return value


def _repeat_words(values: np.ndarray, size: int = 8) -> int:
    """Words in windows of ``size`` words found twice or more."""
    found = windows(values, size)
    if not len(found):
        return 0
    _, back, counts = np.unique(found, return_inverse=True, return_counts=True)
    starts = np.flatnonzero(counts[back] > 1)
    edges = np.zeros(len(values) + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + size, -1)
    return int((np.cumsum(edges[:-1]) > 0).sum())


def _dup_lines(text: bytes) -> int:
    lines = [line for line in text.split(b"\n") if line.strip()]
    return len(lines) - len(set(lines))


def _measure(text: bytes, hashes: WordHashes, weights: _Weights) -> tuple:
    words = text.split()
    n = len(words)
    if not n:
        return 0, 0, 0, 0, 0, 0.0, 0.0, 0.0, 0.0
    joined = b"".join(words)
    chars = len(joined.decode("utf-8", "replace"))
    symbols = len(joined) - len(joined.translate(None, SYMBOLS))
    capitals = len(joined) - len(joined.translate(None, UPPER))
    counts = Counter(words)
    return (
        n,
        chars,
        symbols,
        _dup_lines(text),
        _repeat_words(hashes.of(words)),
        symbols / chars,
        capitals / chars,
        (counts.most_common(1)[0][1] - 1) / n,
        # Chance finds add up with the root of the words they are found among.
        sum(map(weights.__getitem__, counts)) / math.sqrt(len(counts)),
    )


BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def measure(
    df: DataFrame, id_col: str, text_col: str, stratum_col: str, vocabulary: dict[bytes, float]
) -> DataFrame:
    """Counts and rule scores of every whole text, one row per row."""
    wanted = df.select(
        *key(id_col, text_col), F.col(stratum_col).cast("string").alias("stratum"), as_bytes(text_col).alias("text")
    )
    id_type = dict(df.dtypes)[id_col]

    def work(batches):
        hashes, weights = WordHashes(), _Weights(vocabulary)
        for batch in batches:
            rows = [_measure(t, hashes, weights) for t in texts(batch, "text")]
            columns = list(zip(*rows, strict=True)) or [()] * 9
            kinds = [pa.int64()] * 5 + [pa.float64()] * 4
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(n) for n in [*KEYS, "stratum"]),
                    *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True)),
                ],
                names=[*KEYS, "stratum", *BASE, *RULES],
            )

    counts = ", ".join(f"{n} bigint" for n in BASE)
    scores = ", ".join(f"{n} double" for n in RULES)
    schema = f"{KEYS[0]} {id_type}, {KEYS[1]} bigint, stratum string, {counts}, {scores}"
    return wanted.mapInArrow(work, schema)


def _labels(labels: DataFrame, id_col: str, risk: Risk) -> DataFrame:
    """One label per id, the worst if there are several, and its fold."""
    spot = F.pmod(F.xxhash64(F.lit("fold"), "label_id"), F.lit(10_000)) / 10_000
    bad = (F.col("quality") == 0) | (F.col("toxic") == 1)
    return (
        labels.where(F.col(id_col).isNotNull() & F.coalesce("quality", "toxic").isNotNull())
        .groupBy(F.col(id_col).alias("label_id"))
        .agg(F.max(F.coalesce(bad, F.lit(False))).alias("bad"))
        .withColumn("spot", spot)
    )


def fitted_share(labels: DataFrame, risk: Risk) -> float:
    """The share of the labels below which ``spot`` is in the vocabulary's fold."""
    return min(risk.fit_share, risk.fit_rows / max(labels.count(), 1))


def _draws(rows: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """One row for each text: copies are no evidence of their own.

    A text has the fold and ``cols`` of its least labelled id, and its worst label, so that
    copies are never in both folds.
    """
    least = F.min(F.struct("label_id", "spot", *cols)).alias("least")
    return rows.groupBy(key).agg(least, F.max("bad").alias("bad")).select(key, "least.*", "bad")


def fit_vocabulary(
    df: DataFrame, labels: DataFrame, id_col: str, text_col: str, risk: Risk
) -> dict[bytes, float]:
    """Words that stand out in bad documents, with the logarithm of their odds.

    A word counts once per document, copies of a text are one. It needs five bad
    documents and a difference of four standard errors between bad and good ones.
    """
    share = fitted_share(labels, risk)
    keyed = df.select(F.col(id_col).alias("label_id"), F.xxhash64(text_col).alias("key"))
    drawn = _draws(keyed.join(labels, "label_id"), "key", [])
    sample = drawn.where(F.col("spot") < share).select("label_id", "key", "bad")
    # About ``fit_rows`` rows at most, as a share of the labels.
    sample = F.broadcast(settle(sample, "vocabulary-sample"))
    texts = df.select(F.col(id_col).alias("label_id"), F.col(text_col).alias("text"))
    texts = texts.withColumn("key", F.xxhash64("text")).join(sample, ["label_id", "key"])
    # A row that is there twice is one draw as well.
    texts = settle(texts.dropDuplicates(["label_id", "key"]), "vocabulary-texts")
    mark, space = r"[!-/:-@\[-`{-~]*", r"[\x20\x09-\x0D]+"
    plain = F.regexp_replace("text", f"{mark}(?:{space}|^|$){mark}", " ")
    plain = F.translate(plain, UPPER.decode(), UPPER.lower().decode())
    rows = texts.select("bad", F.array_distinct(F.split(plain, " ")).alias("words"))
    seen = texts.groupBy("bad").count().collect()
    n = {r["bad"]: r["count"] for r in seen}
    bad, good = n.get(True, 0), n.get(False, 0)
    if not bad or not good:
        return {}
    # The outer form, as the other makes Spark split each text twice.
    words = rows.select("bad", F.explode_outer("words").alias("word")).where(F.col("word") != "")
    found = words.groupBy("word").agg(
        F.count_if(F.col("bad")).alias("b"), F.count_if(~F.col("bad")).alias("g")
    )
    p, q = F.col("b") / bad, F.col("g") / good
    pooled = (F.col("b") + F.col("g")) / (bad + good)
    error = F.sqrt(pooled * (1 - pooled) * (1 / bad + 1 / good))
    odds = F.log((F.col("b") + 0.5) / (bad + 1)) - F.log((F.col("g") + 0.5) / (good + 1))
    chosen = (
        found.where((F.col("b") >= 5) & (p - q > 4 * error) & (odds >= risk.odds))
        .select("word", odds.alias("odds"), ((p - q) / error).alias("z"))
        .orderBy(F.desc("z"), "word")
        .limit(risk.vocabulary)
    )
    return {r["word"].encode(): r["odds"] for r in chosen.collect()}


def binomial_tail(k: int, n: int, p: float) -> float:
    """Probability of at most ``k`` hits in ``n`` draws of chance ``p``, term by term."""
    if k >= n:
        return 1.0
    log_n = math.lgamma(n + 1)
    total = 0.0
    for i in range(k + 1):
        term = log_n - math.lgamma(i + 1) - math.lgamma(n - i + 1)
        total += math.exp(term + i * math.log(p) + (n - i) * math.log1p(-p))
    return min(1.0, total)


def pick_cutoff(
    good: np.ndarray, bad: np.ndarray, limit: float, error: float, price: float
) -> int | None:
    """The step from which to reject, or None. ``good[i]``: good documents with score step ``i``."""
    n = int(good.sum())
    lost = np.cumsum(good[::-1])[::-1]
    caught = np.cumsum(bad[::-1])[::-1]
    best, found = 0.0, None
    for step in range(len(good) - 1, 0, -1):
        if n == 0 or binomial_tail(int(lost[step]), n, limit) > error:
            break
        gain = float(caught[step]) - price * float(lost[step])
        if gain > best:
            best, found = gain, step
    return found


def _step(rule: str):
    score = F.col(rule)
    steps = PER_DOUBLING * F.log2(1 + score) if rule == "vocabulary" else STEPS * score
    return F.least(F.floor(steps), F.lit(STEPS)).cast("int")


def choose_cutoffs(measured: DataFrame, labels: DataFrame, risk: Risk) -> DataFrame:
    """``stratum`` and one ``cut_<rule>`` column per rule (null: the rule rejects none there).

    The exact binomial test is over different texts, each drawn once. A stratum without enough
    good ones in the holdout gets no cutoff.
    """
    judged = measured.where(~base_failed()).join(labels, F.col(KEYS[0]) == F.col("label_id"))
    judged = _draws(judged, KEYS[1], ["stratum", *RULES])
    judged = judged.where(F.col("spot") >= fitted_share(labels, risk))
    steps = F.array(*(F.struct(F.lit(r).alias("rule"), _step(r).alias("step")) for r in RULES))
    counts = settle(
        judged.select("stratum", "bad", F.explode(steps).alias("at"))
        .groupBy("stratum", "at.rule", "at.step")
        .agg(F.count_if(~F.col("bad")).alias("good"), F.count_if(F.col("bad")).alias("bad")),
        "holdout",
    )
    strata = max(1, counts.select("stratum").distinct().count())
    error = risk.error / (strata * len(RULES))
    limit = risk.limit / len(RULES)

    def choose(rows: pd.DataFrame) -> pd.DataFrame:
        out = {"stratum": rows["stratum"].iloc[0]}
        for rule in RULES:
            good, bad = np.zeros(STEPS + 1, np.int64), np.zeros(STEPS + 1, np.int64)
            own = rows[rows["rule"] == rule]
            np.add.at(good, own["step"], own["good"])
            np.add.at(bad, own["step"], own["bad"])
            out[f"cut_{rule}"] = pick_cutoff(good, bad, limit, error, risk.price)
        return pd.DataFrame([out]).astype({f"cut_{r}": "Int32" for r in RULES})

    schema = "stratum string, " + ", ".join(f"cut_{r} int" for r in RULES)
    return counts.groupBy("stratum").applyInPandas(choose, schema)


def base_failed():
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def judge(
    df: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    stratum_col: str = "lang",
    risk: Risk = Risk(),
) -> DataFrame:
    """Counts, scores and verdict of each row, with its key.

    Null text counts as empty and fails the base rule. A null stratum is a
    stratum of its own; one without labels, or with too few for the guarantee,
    is judged by the base rule only. An id labelled more than once takes its
    worst label, a null label is none. Labelled texts that are equal are one
    draw, with the worst of their labels, in one fold. Repeated rows are judged alike, each for
    itself; an empty table gives an empty result.
    """
    if "toxic" not in labels.columns or "quality" not in labels.columns:
        raise ValueError("labels need the columns quality and toxic")
    marks = settle(_labels(labels, id_col, risk), "labels")
    vocabulary = fit_vocabulary(df, marks, id_col, text_col, risk)
    measured = settle(measure(df, id_col, text_col, stratum_col, vocabulary), "measured")
    cutoffs = choose_cutoffs(measured, marks, risk).withColumnRenamed("stratum", "cut_stratum")
    rows = measured.join(
        cutoffs, measured["stratum"].eqNullSafe(cutoffs["cut_stratum"]), "left"
    ).drop("cut_stratum")
    rejects = [F.coalesce(_step(r) >= F.col(f"cut_{r}"), F.lit(False)) for r in RULES]
    reasons = F.filter(
        F.array(*(F.when(hit, F.lit(r)) for r, hit in zip(RULES, rejects, strict=True))),
        lambda r: r.isNotNull(),
    )
    return (
        rows.withColumn("base_failed", base_failed())
        .withColumn("reasons", reasons)
        .withColumn("kept", ~F.col("base_failed") & (F.size("reasons") == 0))
    )


def keep_good(
    df: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    stratum_col: str = "lang",
    risk: Risk = Risk(),
) -> DataFrame:
    """The rows that ``judge`` keeps, all columns unchanged, whatever their names."""
    verdicts = settle(judge(df, labels, id_col, text_col, stratum_col, risk), "verdicts")
    bad = verdicts.where(~F.col("kept")).select(*KEYS).distinct()
    return matching(df, bad, id_col, text_col, "left_anti")
