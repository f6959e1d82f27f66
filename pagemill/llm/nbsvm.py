"""Quality scores by a support vector machine on naive Bayes features.

A text is the set of its hashed n-grams: three bytes each, words that stand alone, and pairs of neighbouring
words of which only is kept whether they are the same. Indicators are scaled by the class log-count ratio of
their n-gram, and a linear model with hinge loss is fitted to them by dual coordinate descent. Held back from
the descent, some of the labelled rows turn margins into probabilities.

The classifier is fitted on a bounded sample, ``PER_CLASS`` rows of either label and ``MAX_CHARS`` characters
each; every text is scored whole. Null and empty texts have no n-grams and get the score of the bias. Rows
are kept as they are, repeated ones too. Without labels of both kinds every score is the share of label 1, one
half if there are none. Columns other than those named take no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.llm import logistic
from pagemill.llm.common import base_rate, known_labels, labelled_sample

PER_CLASS = 3_000
MAX_CHARS = 200_000
BITS = 16
# Classes of repetition take the last places of the hash space.
REPEATS = (0.0, 0.02, 0.1, 0.3, 0.6)
SMOOTHING = 1.0
COST = 1.0
EPOCHS = 20
# Every so many rows of the sample, by hash, set probabilities instead of weights.
CALIBRATION = 4
THRESHOLD = 0.3

_SIZE = 1 << BITS
_MIX = np.uint32(2654435761)


def ngrams(text: str | None) -> np.ndarray:
    """Numbers of the text's n-grams, ascending."""
    if not text:
        return np.zeros(0, dtype=np.uint16)
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8).astype(np.uint32)
    seen = np.zeros(_SIZE, dtype=bool)
    if len(raw) > 2:
        three = (raw[:-2] << 16) | (raw[1:-1] << 8) | raw[2:]
        seen[((three * _MIX) >> np.uint32(32 - BITS)).astype(np.uint16)] = True
    words = text.split()
    same = sum(map(str.__eq__, words, words[1:])) / max(1, len(words) - 1)
    seen[-len(REPEATS) :] = False
    for i, least in enumerate(REPEATS):
        if same > least:
            seen[_SIZE - 1 - i] = True
    return np.flatnonzero(seen).astype(np.uint16)


@dataclass
class Model:
    """``weights`` hold the log-count ratios already."""

    weights: np.ndarray
    bias: float
    probability: logistic.Logistic

    def margin(self, grams: np.ndarray) -> float:
        return float(self.weights[grams].sum() / np.sqrt(max(1, len(grams)))) + self.bias

    def score(self, text: str | None) -> float:
        return float(self.probability(np.asarray([[self.margin(ngrams(text))]]))[0])


def log_count_ratios(rows: list[np.ndarray], labels: np.ndarray, size: int = _SIZE) -> np.ndarray:
    counts = np.full((2, size), SMOOTHING)
    for grams, label in zip(rows, labels):
        counts[label, grams] += 1
    counts /= counts.sum(axis=1, keepdims=True)
    return np.log(counts[1] / counts[0])


def descend(rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, size: int, cost: float, epochs: int) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for the hinge loss; a constant feature of one is the bias.

    Each step solves the dual for one row: its multiplier moves against the gradient, within 0 and ``cost``, and
    the weights with it.
    """
    w, bias = np.zeros(size), 0.0
    alpha = np.zeros(len(rows))
    curve = np.asarray([float(v @ v) + 1.0 for v in values])
    order = np.random.default_rng(7)
    for _ in range(epochs):
        moved = 0.0
        for i in order.permutation(len(rows)):
            grams, v = rows[i], values[i]
            gradient = y[i] * (float(w[grams] @ v) + bias) - 1.0
            new = min(max(alpha[i] - gradient / curve[i], 0.0), cost)
            step = (new - alpha[i]) * y[i]
            if step:
                w[grams] += step * v
                bias += step
                moved = max(moved, abs(step))
                alpha[i] = new
        if moved < 1e-4:
            break
    return w, bias


def fit(sample: pd.DataFrame, rate: float) -> Model:
    """From ``doc_id, grams, label`` of the sample; ``rate`` is the share of label 1 in all labels."""
    sample = sample.sort_values("doc_id", kind="stable").reset_index(drop=True)
    rows = [np.frombuffer(g, dtype=np.uint16) for g in sample["grams"]]
    labels = sample["label"].to_numpy(dtype=np.int64)
    held = pd.util.hash_array(sample["doc_id"].to_numpy(dtype=np.int64)) % CALIBRATION == 0
    learn = np.flatnonzero(~held)
    if len(set(labels[learn].tolist())) < 2:
        return Model(np.zeros(_SIZE), 0.0, logistic.fit(np.zeros((0, 1)), np.zeros(0), rate))
    ratios = log_count_ratios([rows[i] for i in learn], labels[learn])
    kept = [rows[i] for i in learn]
    values = [ratios[g] / np.sqrt(max(1, len(g))) for g in kept]
    w, bias = descend(kept, values, np.where(labels[learn] == 1, 1.0, -1.0), _SIZE, COST, EPOCHS)
    model = Model(w * ratios, bias, logistic.Logistic(np.ones(1), 0.0))
    margins = np.asarray([[model.margin(rows[i])] for i in np.flatnonzero(held)]).reshape(-1, 1)
    model.probability = logistic.fit(margins, labels[held], rate)
    return model


def train(docs: DataFrame, labels: DataFrame, usable: Column, label: str = "quality", per_class: int = PER_CLASS, max_chars: int = MAX_CHARS) -> Model:
    """Fits the model to labels where ``usable`` (a test on ``doc_id``) holds."""

    def grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch[["doc_id", "label"]].assign(grams=[ngrams(t).tobytes() for t in batch["text"]])

    known = known_labels(labels, label, usable)
    sample = labelled_sample(docs, known, per_class, max_chars).mapInPandas(grams, "doc_id long, label int, grams binary")
    return fit(sample.toPandas(), base_rate(known))


def score_udf(docs: DataFrame, model: Model):
    """A column function from text to score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        one = shared.value
        margins = np.asarray([[one.margin(ngrams(t))] for t in texts]).reshape(-1, 1)
        return pd.Series(one.probability(margins))

    return score


def with_score(docs: DataFrame, model: Model, column: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1."""
    return docs.withColumn(column, score_udf(docs, model)("text"))
