"""Toxicity: cumulative-link ordinal regression on sparse text features.

P(grade <= k) = sigmoid(threshold_k - w.x): one weight vector serves all ordered thresholds.  x marks which features a text has:
its lower-case words (runs of letters and digits, whatever stands between them), the first 4, 5 and 6 letters of longer words, and
every run of 2, 3 and 4 letters in scripts written without spaces.  Texts are read to their end; a word over 40 letters counts as
its digest.  The score is the expected severity, sum over k of
P(grade > k); a text is toxic where P(grade > 0) exceeds `cut`.

Training takes at most `sample` labelled texts (20,000; those with the smallest hash of doc_id) and `n_features` features (4,000;
those with the largest chi-square against the toxic label, 20 at least).  Labels may carry a column of grades.  Where they only say toxic or
not, the grades of toxic texts come from how many telling features they hold: lower, middle and upper third become 1, 2 and 3.

Defined cases: a null or empty text has no features and gets the model's severity without features, which is not toxic.  Texts
without a label are scored like all others.  Repeated rows are scored one by one, but a labelled doc_id trains once, with its
smallest text; a doc_id labelled twice is toxic if one label says so.  Labels whose documents are not there count for nothing.
Without labelled texts of both kinds no text is toxic.  An empty table gives an empty result.  Other columns are neither read nor
touched.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Remembered, hash_sample, table, words_of
from .common import cut as written

PREFIXES = (4, 5, 6)
#: Odds ratio from which a feature counts as telling.
TELLING = 8.0


PARTS = re.compile(r"[^\W_]+")
#: Letters of scripts without spaces: Thai, Lao, Myanmar, Khmer, kana, Bopomofo, Han.
UNSPACED = re.compile("[\u0e01-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3041-\u312f\u31a0-\u31bf\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U000323af]{2,}")
RUNS = (2, 3, 4)
LONG = 40
#: Features that a task counts before it hands them on.
HELD = 500_000


def features_of(word: bytes) -> tuple[str, ...]:
    """Features of one word of a text: its letters in lower case, their beginnings, and runs of letters in scripts without spaces."""
    found = []
    for part in PARTS.findall(word.decode("utf-8", "replace").lower()):
        found.append(part if len(part) <= LONG else f"{xxhash.xxh3_128_hexdigest(part.encode())}#")
        found += [f"{part[:n]}~" for n in PREFIXES if len(part) > n]
        if not part.isascii():
            for run in UNSPACED.findall(part):
                found += {f"{run[i : i + n]}^" for n in RUNS for i in range(len(run) - n + 1)}
    return tuple(found)


@dataclass(frozen=True)
class Severity:
    """A fitted model: weight by feature, rising thresholds, and the cut on P(grade > 0)."""

    weights: dict
    thresholds: tuple
    cut: float = 0.4

    def above(self, scores: np.ndarray) -> np.ndarray:
        """P(grade > k) by row and k."""
        return sigmoid(scores[:, None] - np.array(self.thresholds)[None, :])


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit_thresholds_and_weights(rows: np.ndarray, cols: np.ndarray, grades: np.ndarray, n_cols: int, steps: int = 250, rate: float = 0.1, penalty: float = 5e-5) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds of largest likelihood (with an L2 penalty), by Adam over all rows.

    rows, cols: the pairs (text, feature) that are set.  Thresholds are a start and positive gaps, so they keep their order.
    """
    n, top = len(grades), max(1, int(grades.max(initial=1)))
    share = np.clip([(grades <= k).mean() for k in range(top)], 1e-3, 1 - 1e-3)
    start = np.log(share / (1 - share))
    theta = np.concatenate([np.zeros(n_cols), start[:1], np.log(np.maximum(np.diff(start), 0.1))])
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    at = np.arange(n)
    for step in range(1, steps + 1):
        w, gaps = theta[:n_cols], np.exp(theta[n_cols + 1 :])
        cuts = theta[n_cols] + np.concatenate([[0.0], np.cumsum(gaps)])
        score = np.bincount(rows, w[cols], n)
        below = np.concatenate([np.zeros((n, 1)), sigmoid(cuts[None, :] - score[:, None]), np.ones((n, 1))], axis=1)  # P(grade < k)
        p = np.maximum(below[at, grades + 1] - below[at, grades], 1e-9)
        slope = below * (1 - below)
        up, low = slope[at, grades + 1] / p, slope[at, grades] / p  # of log p by the upper and the lower threshold
        by_score = (up - low) / n
        by_cut = np.zeros(top + 2)
        np.add.at(by_cut, grades + 1, -up / n)
        np.add.at(by_cut, grades, low / n)
        by_cut = by_cut[1:-1]
        tails = np.cumsum(by_cut[::-1])[::-1]
        gradient = np.concatenate([np.bincount(cols, by_score[rows], n_cols) + penalty * w, tails[:1], tails[1:] * gaps])
        first, second = 0.9 * first + 0.1 * gradient, 0.999 * second + 0.001 * gradient**2
        theta = theta - rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return theta[:n_cols], theta[n_cols] + np.concatenate([[0.0], np.cumsum(np.exp(theta[n_cols + 1 :]))])


def derived_grades(toxic: np.ndarray, hits: np.ndarray) -> np.ndarray:
    """0 for texts that are not toxic; 1 to 3 for toxic ones, by thirds of their telling features."""
    grades = np.zeros(len(toxic), np.int64)
    if toxic.any():
        low, high = np.quantile(hits[toxic], [1 / 3, 2 / 3])
        grades[toxic] = 1 + (hits[toxic] > low) + (hits[toxic] > high)
    return grades


def fit(docs: DataFrame, labels: DataFrame, grade: str | None = None, sample: int = 20_000, n_features: int = 4_000, least_chi: float = 20.0, cut: float = 0.4) -> Severity:
    """A model of the labelled texts.  labels: doc_id, toxic (0 or 1) and, if named, a column of grades from 0."""
    graded = labels.where("toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.max(grade or "toxic").alias("grade"))
    picked = hash_sample(graded, "doc_id", sample)
    labelled = docs.select("doc_id", "text").where("text is not null").join(F.broadcast(picked), "doc_id")
    texts = written(labelled.groupBy("doc_id").agg(*[F.min(c).alias(c) for c in ("text", "toxic", "grade")]))  # at most `sample` rows

    def counted(batches):
        memory = Remembered(features_of, 50_000)
        clean, toxic = Counter(), Counter()

        def handed():
            names = list(clean.keys() | toxic.keys())
            return pd.DataFrame({"feature": names, "clean": [clean[x] for x in names], "toxic": [toxic[x] for x in names]})

        for batch in batches:
            for text, label in zip(batch["text"], batch["toxic"]):
                (toxic if label > 0 else clean).update({f for word in set(words_of(text)) for f in memory[word]})
                if len(clean) + len(toxic) >= HELD:
                    yield handed()
                    clean.clear(), toxic.clear()
        if clean or toxic:  # a frame without rows has no types
            yield handed()

    sizes = {r.bad: r["count"] for r in texts.groupBy((F.col("toxic") > 0).alias("bad")).count().collect()}
    bad, good = sizes.get(True, 0), sizes.get(False, 0)
    if not bad or not good:
        return Severity({}, (40.0,), cut)
    a, b = F.col("toxic"), F.col("clean")
    chi = (bad + good) / (bad * good) * (a * (good - b) - b * (bad - a)) ** 2 / ((a + b) * (bad + good - a - b + 1.0))
    found = (
        texts.mapInPandas(counted, "feature string, clean long, toxic long")
        .groupBy("feature")
        .agg(F.sum("clean").cast("double").alias("clean"), F.sum("toxic").cast("double").alias("toxic"))
        .where((a + b >= 3) & (chi >= least_chi))
        .orderBy(F.desc(chi), "feature")
        .limit(n_features)
        .collect()
    )
    index = {r.feature: i for i, r in enumerate(found)}
    odds = np.array([(r.toxic + 0.5) / (bad + 1) / ((r.clean + 0.5) / (good + 1)) for r in found])

    def vectors(batches):
        memory = Remembered(lambda word: tuple(index[f] for f in features_of(word) if f in index))
        for batch in batches:
            sets = [sorted({f for word in words_of(text) for f in memory[word]}) for text in batch["text"]]
            yield pd.DataFrame({"features": sets, "toxic": batch["toxic"], "grade": batch["grade"]})

    seen = texts.mapInPandas(vectors, "features array<int>, toxic int, grade int").toArrow()  # at most `sample` rows
    lists = seen["features"].combine_chunks()
    cols = lists.flatten().to_numpy(zero_copy_only=False)
    rows = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
    if grade is None:
        grades = derived_grades(seen["toxic"].to_numpy() > 0, np.bincount(rows, odds[cols] >= TELLING, len(lists)))
    else:
        grades = np.maximum(seen["grade"].to_numpy().astype(np.int64), 0)
    weights, thresholds = fit_thresholds_and_weights(rows, cols, grades, len(index))
    return Severity({f: float(weights[i]) for f, i in index.items()}, tuple(map(float, thresholds)), cut)


RESULT = "severity double, p_toxic double, grade int, toxic boolean, kept boolean"


def severity_of(model: Severity):
    """The model as a column function: text -> struct of RESULT."""

    @F.pandas_udf(RESULT)
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        weights = model.weights
        memory = Remembered(lambda word: tuple(f for f in features_of(word) if f in weights))
        for texts in batches:
            sums = np.zeros(len(texts))
            for i, text in enumerate(texts):
                if text:
                    sums[i] = sum(weights[f] for f in sorted({f for word in set(words_of(text)) for f in memory[word]}))
            above = model.above(sums)
            toxic = above[:, 0] > model.cut
            grade = np.where(toxic, np.maximum((above > 0.5).sum(axis=1), 1), 0).astype(np.int32)
            yield pd.DataFrame({"severity": above.sum(axis=1), "p_toxic": above[:, 0], "grade": grade, "toxic": toxic, "kept": ~toxic})

    return scored


def toxicity(docs: DataFrame, model: Severity) -> DataFrame:
    """doc_id, expected severity, P(grade > 0), most likely grade and the decision, for every row of docs (doc_id, text)."""
    return docs.select("doc_id", severity_of(model)("text").alias("s")).select("doc_id", "s.*")


def keep_civil(docs: DataFrame, model: Severity) -> DataFrame:
    """The rows of docs that are not toxic, with their columns as they were."""
    return docs.where(severity_of(model)("text")["kept"])


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity(docs, fit(docs, table(spark, sf_dir, "labels")))
