"""Quality grades by ordinal cumulative-link regression.

Texts are graded 0, 1, 2 and so on. One vector of weights over hashed text features, shared by all grades, gives a
text its place on a line; ordered thresholds cut the line into grades: the probability of a grade up to k is the
logistic function of threshold k minus the place. From these follow the expected grade and the tail
probability of reaching a given grade, by which documents are selected.

Features: hashed trigrams of character classes (letters by case, digits, spaces, each sign), as square roots of
their shares, and four shares of repeated and distinct words. The model is fitted on at most ``SAMPLE``
labelled rows, those with the smallest hash of their doc_id; every document is then scored.

Nulls and odd cases: a null or empty text has the features of an empty text; rows without label or doc_id are
not learned from; a document with several labels counts with its highest grade; repeated rows are scored each. With fewer than two
grades among the labels nothing is learned and every document is kept.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.llm import common

SAMPLE = 8000
HASHED = 1020
DIMENSIONS = HASHED + 4
STEPS = 300
RATE = 0.05
PENALTY = 1e-5

# Fixed value: signs that are a class of their own; other signs share one.
SIGNS = b"#*$%&|<>!?.,;:-_\"'()[]{}/\\=+@"


def _classes() -> np.ndarray:
    table = np.full(256, 5, np.int64)
    table[ord("a") : ord("z") + 1] = table[128:] = 0
    table[ord("A") : ord("Z") + 1] = 1
    table[ord("0") : ord("9") + 1] = 2
    table[[9, 11, 12, 13, 32]] = 3
    table[10] = 4
    for i, sign in enumerate(SIGNS):
        table[sign] = 6 + i
    return table


CLASSES = _classes()
KINDS = 6 + len(SIGNS)
BUCKETS = (np.arange(KINDS**3, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)).astype(np.int64) % HASHED


def features(text: str | None) -> np.ndarray:
    data = (text or "").encode("utf-8", "surrogatepass")
    vector = np.zeros(DIMENSIONS, np.float32)
    kinds = CLASSES[np.frombuffer(data, np.uint8)]
    if len(kinds) >= 3:
        codes = (kinds[:-2] * KINDS + kinds[1:-1]) * KINDS + kinds[2:]
        vector[:HASHED] = np.sqrt(np.bincount(BUCKETS[codes], minlength=HASHED) / len(codes))
    words = data.split()
    if words:
        repeated = sum(a == b for a, b in zip(words, words[1:]))
        lines = [x for x in data.split(b"\n") if x.strip()]
        shares = (repeated / len(words), 1 - len(set(words)) / len(words), 1 - len(set(lines)) / len(lines), 1 / len(words))
        vector[HASHED:] = np.sqrt(shares)
    return vector


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, vector: np.ndarray) -> np.ndarray:
        """The probabilities of reaching grade 1, 2 and so on."""
        return 1 / (1 + np.exp(np.clip(self.thresholds - float((self.weights * vector).sum()), -60, 60)))


def fit(x: np.ndarray, grades: np.ndarray) -> Model:
    """Maximum likelihood by adaptive gradient steps; the gaps between thresholds are positive by construction."""
    top = int(grades.max())
    centre = x.mean(0)
    x = x - centre
    reached = np.array([(grades >= k).mean() for k in range(1, top + 1)])
    start = -np.log((reached + 1e-3) / (1 - reached + 1e-3))
    weights, first, gaps = np.zeros(x.shape[1]), start[0], np.log(np.maximum(np.diff(start), 1e-2))
    moments = [np.zeros(x.shape[1] + top), np.zeros(x.shape[1] + top)]
    for step in range(1, STEPS + 1):
        thresholds = first + np.r_[0.0, np.cumsum(np.exp(gaps))]
        cut = 1 / (1 + np.exp(np.clip((x @ weights)[:, None] - thresholds, -60, 60)))
        below = np.concatenate([np.zeros((len(x), 1)), cut, np.ones((len(x), 1))], axis=1)
        rows = np.arange(len(x))
        likelihood = np.maximum(below[rows, grades + 1] - below[rows, grades], 1e-12)
        slope = below * (1 - below)
        high, low = slope[rows, grades + 1] / likelihood, slope[rows, grades] / likelihood
        by_cut = np.array([high[grades == k].sum() - low[grades == k + 1].sum() for k in range(top)]) / len(x)
        gradient = -x.T @ ((high - low) / len(x)) - PENALTY * weights
        tail = np.cumsum(by_cut[::-1])[::-1]
        gradient = np.r_[gradient, tail[0], tail[1:] * np.exp(gaps)]
        moments[0] = 0.9 * moments[0] + 0.1 * gradient
        moments[1] = 0.999 * moments[1] + 0.001 * gradient**2
        move = RATE * moments[0] / (1 - 0.9**step) / (np.sqrt(moments[1] / (1 - 0.999**step)) + 1e-8)
        weights, first, gaps = weights + move[: x.shape[1]], first + move[x.shape[1]], gaps + move[x.shape[1] + 1 :]
    thresholds = first + np.r_[0.0, np.cumsum(np.exp(gaps))]
    return Model(weights, thresholds + float((centre * weights).sum()))


def learn(docs: DataFrame, ratings: DataFrame, sample: int = SAMPLE) -> Model | None:
    """Fits (doc_id, grade) ratings of documents, in one task over at most ``sample`` rows."""
    common.ship(docs.sparkSession)
    rated = ratings.filter("doc_id is not null and grade >= 0").groupBy("doc_id").agg(F.max("grade").alias("grade"))
    # Written, so that the tasks' candidates meet in a task and not in the driver.
    chosen = common.written(rated.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample), "sample")
    # Bounded by the sample.
    rows = docs.join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"]).select("doc_id", "text", F.col("grade").cast("int"))

    @F.pandas_udf("binary")
    def vector(texts: pd.Series) -> pd.Series:
        return pd.Series([features(t).tobytes() for t in texts])

    def fitted(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("doc_id")
        grades = frame["grade"].to_numpy()
        if len(set(grades)) < 2:
            return pd.DataFrame({"weights": [], "thresholds": []})
        # Grades that do not occur would leave a threshold without limit; they are closed up.
        kinds, grades = np.unique(grades, return_inverse=True)
        model = fit(np.frombuffer(b"".join(frame["vector"]), np.float32).reshape(len(frame), -1).astype(np.float64), grades)
        thresholds = [model.thresholds[int(np.searchsorted(kinds, k)) - 1] if k > kinds[0] else -60.0 for k in range(1, int(kinds[-1]) + 1)]
        return pd.DataFrame({"weights": [model.weights.tolist()], "thresholds": [thresholds]})

    group = rows.select("doc_id", "grade", vector("text").alias("vector"), F.lit(0).alias("one")).groupBy("one")
    found = group.applyInPandas(fitted, "weights array<double>, thresholds array<double>").first()
    return Model(np.array(found["weights"]), np.array(found["thresholds"])) if found else None


def score(docs: DataFrame, model: Model | None, grade: int = 1, least: float = 0.5) -> DataFrame:
    """The rows with expected_grade, tail (the probability of reaching ``grade``) and kept (tail at least ``least``)."""
    common.ship(docs.sparkSession)

    @F.pandas_udf("expected_grade double, tail double")
    def graded(texts: pd.Series) -> pd.DataFrame:
        tails = [model.tails(features(t)) if model else np.ones(grade) for t in texts]
        found = [(float(t.sum()), float(t[grade - 1]) if len(t) >= grade else 0.0) for t in tails]
        return pd.DataFrame(found, columns=["expected_grade", "tail"])

    rows = docs.withColumn("graded_", graded("text"))
    return rows.select(*docs.columns, "graded_.*").withColumn("kept", F.col("tail") >= least)
