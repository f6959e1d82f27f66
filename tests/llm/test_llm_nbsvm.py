import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from pagemill.llm import logistic, nbsvm
from pagemill.llm.common import bucket_of, row_bucket, table
from pagemill.llm.queries import op5_quality

SF_DIR = "/root/testdata/sf0.1"


def area(scores, labels):
    ranks = pd.Series(scores).rank().to_numpy()
    ones = int(labels.sum())
    return (ranks[labels == 1].sum() - ones * (ones + 1) / 2) / (ones * (len(labels) - ones))


def test_held_out_accuracy(spark):
    labels = {r["doc_id"]: r["quality"] for r in table(spark, SF_DIR, "labels").collect()}
    rows = op5_quality(spark, SF_DIR).collect()
    assert len(rows) == table(spark, SF_DIR, "documents").count()
    assert all(r["held_out"] == (bucket_of(r["doc_id"], 5) == 0) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    held = [r for r in rows if r["held_out"] and labels.get(r["doc_id"]) is not None]
    truth = np.array([labels[r["doc_id"]] for r in held])
    assert area([r["score"] for r in held], truth) > 0.98
    assert np.mean([r["predicted"] == t for r, t in zip(held, truth)]) > 0.97


def test_descent_meets_the_conditions_of_the_optimum():
    rng = np.random.default_rng(2)
    dense = rng.normal(size=(60, 4))
    y = np.where(dense[:, 0] + 0.3 * rng.normal(size=60) > 0, 1.0, -1.0)
    rows = [np.arange(4)] * 60
    w, bias = nbsvm.descend(rows, list(dense), y, 4, cost=0.5, epochs=5000)

    def objective(w, b):
        return 0.5 * (w @ w + b * b) + 0.5 * np.maximum(0, 1 - y * (dense @ w + b)).sum()

    best = objective(w, bias)
    for _ in range(300):
        assert objective(w + rng.normal(scale=0.02, size=4), bias + rng.normal(scale=0.02)) >= best - 1e-3


def test_ngrams():
    assert len(nbsvm.ngrams(None)) == len(nbsvm.ngrams("")) == 0
    assert len(nbsvm.ngrams("abcabcabc")) == 3
    last = (1 << nbsvm.BITS) - 1
    assert last in nbsvm.ngrams("word word word") and last not in nbsvm.ngrams("one two three")


def test_logistic_gives_back_the_share_of_all_data():
    x = np.zeros((40, 1))
    y = np.array([0, 1] * 20)
    assert abs(logistic.fit(x, y, 0.9)(np.zeros((1, 1)))[0] - 0.9) < 1e-6
    assert abs(logistic.fit(x[:0], y[:0], 0.25)(np.zeros((1, 1)))[0] - 0.25) < 1e-9


def test_odd_rows(spark):
    docs = spark.createDataFrame(
        [(i, ("good words here %d" % i) if i % 2 else "!!! ### !!!", 7.0) for i in range(40)] + [(None, None, 7.0), (50, "", 7.0), (50, "", 7.0)],
        "doc_id long, text string, score double",
    )
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(1, 1), (None, 1), (3, None), (5, 7)], "doc_id long, quality int")
    every = row_bucket(F.col("doc_id"), 5) >= 0
    model = nbsvm.train(docs, labels, every)
    rows = nbsvm.with_score(docs, model).collect()
    assert len(rows) == 43 and all(0 <= r["score"] <= 1 for r in rows)
    scores = {r["doc_id"]: r["score"] for r in rows}
    assert scores[11] > scores[12]
    assert scores[None] == scores[50]
    # Labels of one kind, or none: the share of label 1.
    one = nbsvm.train(docs, labels.where("quality = 1"), every)
    assert len({r["score"] for r in nbsvm.with_score(docs, one).collect()}) == 1
    none = nbsvm.train(docs, labels.where(F.lit(False)), every)
    assert {r["score"] for r in nbsvm.with_score(docs, none).collect()} == {0.5}
    assert nbsvm.with_score(docs.where(F.lit(False)), model).count() == 0
