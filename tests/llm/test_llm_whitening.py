import numpy as np
import pytest
from pyspark.sql import functions as F

from pagemill.llm import whitening as W
from pagemill.llm.common import table
from pagemill.llm.queries import op11_whitening

SF_DIR = "/root/testdata/sf0.1"
SCHEMA = "vec_id long, embedding array<float>"


def brute_force(vectors, weights_by_count=False, components=4):
    """``vec_id, x`` pairs to the rows of the operator, and the unit axes, by plain numpy."""
    x = [tuple(int(np.floor(256 * float(np.float32(c)))) for c in v) for _, v in vectors]
    each = sorted(set(x))
    weight = np.array([x.count(v) if weights_by_count else 1 for v in each], dtype=float)
    n = int(weight.sum())
    a = np.array(each, dtype=float)
    mean = (a * weight[:, None]).sum(axis=0) / n
    centred = a - mean
    values, axes = np.linalg.eigh((centred * weight[:, None]).T @ centred / n)
    order = np.argsort(values)[::-1][:components]
    sums = [int(sum(int(w) * v[i] for w, v in zip(weight, each))) for i in range(len(each[0]))]
    rows = {}
    for (vec_id, _), v in zip(vectors, x):
        deviation = sum((n * c - s) ** 2 for c, s in zip(v, sums))
        for k, at in enumerate(order):
            rows.setdefault((vec_id, k + 1), []).append(
                (n, deviation, (np.array(v) - mean) @ axes[:, at] / np.sqrt(values[at]), values[at] / values.sum())
            )
    return rows


def compare(found, expected):
    assert len(found) == sum(map(len, expected.values()))
    sign = {}
    for r in found:
        n, deviation, value, share = expected[r["vec_id"], r["component"]][0]
        assert (r["n"], r["deviation"]) == (n, deviation)
        assert r["explained"] == pytest.approx(share, rel=1e-9)
        assert r["identity_error"] < 1e-9
        if abs(value) > 1e-6:
            s = sign.setdefault(r["component"], np.sign(value * r["whitened"]))
            assert r["whitened"] * s == pytest.approx(value, abs=1e-7)


def test_query_equals_brute_force(spark):
    result = op11_whitening(spark, SF_DIR)
    assert [t for _, t in result.dtypes] == ["bigint", "int", "bigint", "bigint", "double", "double", "double"]
    vectors = [(r["vec_id"], r["embedding"]) for r in table(spark, SF_DIR, "embeddings").collect()]
    compare(result.collect(), brute_force(vectors))


@pytest.mark.parametrize("by_count", [False, True])
def test_hot_vectors_and_weights(spark, by_count):
    rng = np.random.default_rng(1)
    vectors = [(i, rng.normal(size=5).round(2).tolist()) for i in range(120)]
    vectors += [(1000 + i, vectors[0][1]) for i in range(400)] + [(2000, vectors[1][1])]
    df = spark.createDataFrame(vectors, SCHEMA).repartition(5)
    compare(W.whiten(df, by_count, salts=8).collect(), brute_force(vectors, by_count))
    each = W.distinct(W.whole_vectors(df), salts=8)
    assert max(map(len, (r["salts"] for r in each.collect()))) == 8
    assert each.count() == 120


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(i, [float(i % 7), float(i * i % 11), -0.0]) for i in range(30)]
    bad = [(100, None), (101, [1.0, None, 2.0]), (102, [nan, 0.0, 0.0]), (103, [inf, 0.0, 0.0]), (104, [-inf, 0.0, 0.0]), (105, [])]
    twice = [good[3], (None, good[4][1]), (None, good[4][1])]
    rows = [(i, v, "a", 1) for i, v in good + bad + twice]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, x string, salt int")
    found = W.whiten(df).collect()
    # The third dimension is always zero: its component has no variance, hence no value.
    assert {r["component"] for r in found} == {1, 2, 3}
    assert all((r["whitened"] is None) == (r["component"] == 3) for r in found)
    assert all(r["identity_error"] < 1e-9 for r in found)
    assert all(r["explained"] == pytest.approx(0) for r in found if r["component"] == 3)
    assert {r["vec_id"] for r in found} == {i for i, _ in good} | {None}
    assert len(found) == 3 * (len(good) + len(twice))
    assert W.whiten(df.where(F.lit(False))).count() == 0
    assert W.whiten(df.where("vec_id >= 100")).count() == 0


def test_each_length_by_itself_and_single_vectors(spark):
    rng = np.random.default_rng(2)
    two = [(i, rng.normal(size=2).tolist()) for i in range(20)]
    six = [(100 + i, rng.normal(size=6).tolist()) for i in range(20)]
    df = spark.createDataFrame([*two, *six, (200, [1.0] * 3)], SCHEMA)
    found = W.whiten(df).collect()
    compare([r for r in found if r["vec_id"] < 100], brute_force(two))
    compare([r for r in found if 100 <= r["vec_id"] < 200], brute_force(six))
    alone = [r for r in found if r["vec_id"] == 200]
    assert [(r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in alone] == [(1, 0, None, None, None)] * 3


def test_entries_beyond_long(spark):
    df = spark.createDataFrame([(1, [3e38, 1.0]), (2, [-3e38, 2.0]), (3, [0.5, 0.25])], SCHEMA)
    found = W.whiten(df).collect()
    assert len(found) == 6
    assert all(r["deviation"] is None for r in found if r["vec_id"] < 3)


def test_deviations_are_exact_in_whole_numbers():
    x = np.array([[10**9, 3], [5, -7]], dtype=np.int64)
    for n in (2, 10**6, 10**9):
        sums = [int(v) for v in x.sum(axis=0)]
        expected = [sum((n * int(c) - s) ** 2 for c, s in zip(row, sums)) for row in x]
        assert W.deviations(x, n, sums) == [v if v < 1 << 63 else None for v in expected]
