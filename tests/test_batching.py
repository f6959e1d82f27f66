import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pagemill.operators import batching as B


def greedy(sizes, max_bytes, max_pages):
    """One loop over the pages: the meaning the distributed plan must keep."""
    numbers, batch, held, pages = [], 0, 0, 0
    for size in sizes:
        held, pages = held + size, pages + 1
        numbers.append(batch)
        if held >= max_bytes or pages >= max_pages:
            batch, held, pages = batch + 1, 0, 0
    return numbers


def by_tables(sizes, max_bytes, max_pages, chunk):
    """Follow chunk tables, and their combination, without Spark."""
    chunk = max(chunk, max_pages)
    sizes = np.array(sizes, dtype=np.int64)
    tables = []
    for lo in range(0, len(sizes), chunk):
        rows = sizes[lo : lo + chunk + max_pages - 1]
        tables.append(B.chunk_entries(rows, min(chunk, len(rows)), max_bytes, max_pages))
    whole = tables[0]
    for table in tables[1:]:
        whole = B.then(whole, table)
    return int(whole[1][0])


@given(
    st.lists(st.integers(0, 50), min_size=1, max_size=120),
    st.integers(1, 120),
    st.integers(1, 9),
    st.integers(1, 30),
)
@settings(max_examples=300, deadline=None)
def test_tables_count_the_greedy_batches(sizes, max_bytes, max_pages, chunk):
    expected = greedy(sizes, max_bytes, max_pages)[-1] + 1
    assert by_tables(sizes, max_bytes, max_pages, chunk) == expected


def frame(spark, shards):
    rows = [(name, i + 1, int(s)) for name, sizes in shards.items() for i, s in enumerate(sizes)]
    return spark.createDataFrame(rows, "s3_key string, pos long, size long")


def planned(df):
    found = {}
    for row in df.collect():
        found.setdefault(row["s3_key"], {})[row["pos"]] = row["batch_no"]
    return {k: [v[i] for i in sorted(v)] for k, v in found.items()}


@pytest.mark.parametrize("chunk,span", [(1, 2), (16, 3), (64, 256), (100000, 256)])
def test_plan_equals_greedy(spark, chunk, span):
    rng = np.random.default_rng(7)
    # One shard holds most of the pages.
    shards = {
        "hot": rng.integers(1, 400, 900),
        "small": rng.integers(1, 400, 40),
        "one": [5],
        "huge pages": [1000, 1000, 3, 1000],
        "exact": [250, 250, 500, 499, 1],
        "no bytes": [0] * 25,
    }
    plan = B.plan_batches(
        frame(spark, shards).repartition(5), "s3_key", max_bytes=500, max_pages=7, chunk=chunk, span=span
    )
    assert planned(plan) == {k: greedy(v, 500, 7) for k, v in shards.items()}


@given(st.lists(st.integers(0, 90), min_size=1, max_size=80), st.integers(1, 150), st.integers(1, 8))
@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_batch_properties(spark, sizes, max_bytes, max_pages):
    plan = B.plan_batches(
        frame(spark, {"f": sizes}), None, max_bytes=max_bytes, max_pages=max_pages, chunk=10, span=2
    )
    numbers = planned(plan)["f"]
    assert len(numbers) == len(sizes)
    assert numbers == sorted(numbers)
    for batch in range(numbers[-1] + 1):
        members = [s for s, n in zip(sizes, numbers) if n == batch]
        assert members
        reached = sum(members) >= max_bytes or len(members) >= max_pages
        assert reached or batch == numbers[-1]
        assert sum(members[:-1]) < max_bytes and len(members) <= max_pages


def test_empty_input_has_no_batches(spark):
    assert B.plan_batches(frame(spark, {}), "s3_key").count() == 0


def test_null_shard_is_a_shard(spark):
    df = spark.createDataFrame([(None, 1, 5), (None, 2, 5)], "s3_key string, pos long, size long")
    rows = B.plan_batches(df, "s3_key", max_bytes=5).orderBy("pos").collect()
    assert [r["batch_no"] for r in rows] == [0, 1]


def test_limits_must_be_positive(spark):
    with pytest.raises(ValueError):
        B.plan_batches(frame(spark, {"f": [1]}), "s3_key", max_pages=0)


def test_by_count(spark):
    rows = B.plan_batches_by_count(frame(spark, {"f": [1] * 10}), max_pages=4).orderBy("pos").collect()
    assert [r["batch_no"] for r in rows] == greedy([1] * 10, 10**9, 4)


def test_summary_names_depend_only_on_content(spark):
    def names(parts):
        df = frame(spark, {"f": [10] * 20}).repartition(parts)
        df = df.selectExpr("*", "concat_ws('_', s3_key, pos) AS custom_id")
        batched = B.plan_batches(df, "s3_key", max_bytes=35)
        return sorted((r["batch_no"], r["n_pages"], r["batch_key"]) for r in
                      B.summarise_batches(batched, ["s3_key"]).collect())

    assert names(1) == names(7)
    assert [n for _, n, _ in names(1)] == [4, 4, 4, 4, 4]
