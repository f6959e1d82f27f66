import math

import numpy as np
from pyspark.sql import functions as F

from pagemill.llm import pivots as P
from pagemill.llm.common import table
from pagemill.llm.queries import op3_permutation_search

SF_DIR = "/root/testdata/sf0.01"


def exact(ids, x, query, k):
    d = np.sqrt(((x - x[list(ids).index(query)]) ** 2).sum(axis=1))
    rows = sorted((float(d[i]), int(ids[i])) for i in range(len(ids)) if ids[i] != query)
    return rows[:k]


def test_recall_and_scores_of_the_query(spark):
    rows = table(spark, SF_DIR, "embeddings").orderBy("vec_id").collect()
    ids = np.array([r["vec_id"] for r in rows])
    x = np.array([r["embedding"] for r in rows], dtype=np.float64)
    at = {int(i): n for n, i in enumerate(ids)}
    found: dict = {}
    for r in op3_permutation_search(spark, SF_DIR).collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["score"], r["vec_id"]))
    assert sorted(found) == [i for i in ids if i % 100 == 0]
    hits = 0
    for query, own in found.items():
        own.sort()
        assert [r for r, _, _ in own] == list(range(1, 11))
        assert [(s, v) for _, s, v in own] == sorted((s, v) for _, s, v in own)
        for _, score, vec in own:
            assert math.isclose(score, float(np.sqrt(((x[at[vec]] - x[at[query]]) ** 2).sum())), rel_tol=1e-12)
        hits += len({v for _, _, v in own} & {v for _, v in exact(ids, x, query, 10)})
    assert hits >= 0.9 * 10 * len(found)


def test_footrules_equal_their_definition():
    rng = np.random.default_rng(1)
    x, pv = rng.normal(size=(40, 5)), rng.normal(size=(12, 5))
    prefix = 4
    near = P.permutations(x, pv, prefix)
    flat = near.ravel()
    by = np.argsort(flat, kind="stable")
    starts = np.searchsorted(flat[by], np.arange(13))
    got = P.footrules(near[0], starts, by // prefix, by % prefix, 40)

    def place(perm, p):
        return list(perm).index(p) if p in perm else prefix

    for i in range(40):
        both = set(near[0].tolist()) | set(near[i].tolist())
        assert got[i] == sum(abs(place(near[0].tolist(), p) - place(near[i].tolist(), p)) for p in both)


def test_odd_rows(spark):
    same = [1.0, 2.0]
    rows = [
        (0, same, 1), (1, same, 1), (2, same, 1), (3, None, 1), (4, [0.0, 0.0], 1), (5, [1.0, None], 1),
        (6, [float("nan"), 1.0], 1), (7, [float("inf"), 1.0], 1), (8, [1.0, 2.0, 3.0], 1), (None, same, 1), (9, [5.0, 2.0], 1),
        (0, same, 1), (9, [5.0, 2.0], 1),
    ]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int")
    found = P.search(vectors, F.col("vec_id") % 100 == 0, k=4).orderBy("rank").collect()
    # The other row of the same id is a candidate; the one that asks is not.
    assert [tuple(r) for r in found] == [(0, 1, 0, 0.0), (0, 2, 1, 0.0), (0, 3, 2, 0.0), (0, 4, 9, 4.0)]
    assert P.search(vectors.where(F.lit(False)), F.col("vec_id") % 100 == 0).count() == 0
    assert P.search(vectors, F.col("vec_id") == 77).count() == 0


def test_copies_beyond_what_is_measured_go_by_id(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [1.0, 0.0, 0.0]) for i in range(900)] + [(1000 + i, rng.normal(size=3).tolist()) for i in range(300)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").coalesce(2)
    found = P.search(vectors, F.col("vec_id") == 500, k=5).orderBy("rank").collect()
    assert [r["vec_id"] for r in found] == [0, 1, 2, 3, 4]


def test_only_the_row_that_asks_is_left_out(spark):
    rows = [(100, [1.0, 1.0]), (100, [1.0, 2.0]), (7, [1.0, 1.0]), (8, [4.0, 1.0]), (200, [9.0, 9.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    found = P.search(vectors, F.col("vec_id") % 100 == 0, k=2).orderBy("query_id", "rank").collect()
    assert [tuple(r) for r in found] == [
        (100, 1, 7, 0.0), (100, 2, 100, 1.0),
        (200, 1, 8, math.sqrt(89)), (200, 2, 100, math.sqrt(113)),
    ]


def test_an_id_with_very_many_rows(spark):
    rows = [(100, [1.0, 1.0, 0.0]) for _ in range(700)] + [(3, [1.0, 1.0, 0.0])] + [(i, [float(i), 1.0, 2.0]) for i in range(200, 300)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").coalesce(2)
    found = P.search(vectors, F.col("vec_id") == 100, k=5).orderBy("rank").collect()
    assert [(r["vec_id"], r["score"]) for r in found] == [(3, 0.0)] + [(100, 0.0)] * 4


def test_recall_of_the_bare_share(spark):
    """Without a least number of measured vectors, on the largest table."""
    rows = P.usable(table(spark, "/root/testdata/sf0.1", "embeddings"))
    pivots = P.draw_pivots(rows)
    asked = F.col("vec_id") % 100 == 0
    found = P.nearest(P.build(rows, pivots), rows.where(asked), pivots, least=0).collect()
    local = sorted((r["vec_id"], r["v"]) for r in rows.collect())
    ids, x = np.array([i for i, _ in local]), np.array([v for _, v in local])
    queries = [int(i) for i in ids if i % 100 == 0]
    near = {q: {v for _, v in exact(ids, x, q, 10)} for q in queries}
    hits = sum(r["vec_id"] in near[r["query_id"]] for r in found)
    assert len(found) == 10 * len(queries) and hits >= 0.9 * len(found)
