import math
import zlib
from dataclasses import replace

import pytest
import xxhash
from pyspark.sql import functions as F

from pagemill.llm import sharding as S
from pagemill.llm.common import table
from pagemill.llm.queries import op4_hash_tree

SF_DIR = "/root/testdata/sf0.01"


def test_query(spark):
    docs = {r["doc_id"]: r["text"] or "" for r in table(spark, SF_DIR, "documents").collect()}
    result = op4_hash_tree(spark, SF_DIR)
    assert [t for _, t in result.dtypes[:7]] == ["bigint", "bigint", "bigint", "string", "int", "bigint", "int"]
    rows = result.collect()
    assert len(rows) == len(docs)
    slots: dict = {}
    for r in rows:
        text = docs[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"]) == (len(text) + 8, zlib.crc32(text))
        assert 0 <= r["shard"] < 24 and r["grown_shard"] in (r["shard"], 24)
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert any(r["grown_shard"] == 24 for r in rows)


def test_no_python_in_the_plan(spark):
    plan = op4_hash_tree(spark, SF_DIR)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_shares_follow_weights(spark):
    tree = tuple(replace(s, weight=3.0 if s.number == 5 else 1.0) for s in S.balanced(8, 2, 2))
    counts = S.with_shard(spark.range(40_000), "id", tree, "shard").groupBy("shard").count().collect()
    for r in counts:
        expected = 40_000 * (3.0 if r["shard"] == 5 else 1.0) / 10
        assert abs(r["count"] - expected) < 0.06 * expected + 60


def test_a_changed_weight_moves_rows_only_through_its_own_subtree(spark):
    tree = S.balanced(16, 2, 4)
    changed = tuple(replace(s, weight=2.0) if s.number == 6 else s for s in tree)
    moved = S.with_shard(S.with_shard(spark.range(20_000), "id", tree, "a"), "id", changed, "b").where("a <> b").collect()
    assert moved
    racks = {s.number: s.rack for s in tree}
    regions = {s.number: s.region for s in tree}
    for r in moved:
        # Weights change in shard 6, its rack and its region; a move ends within the smallest of them that it enters.
        assert regions[r["b"]] == regions[6]
        if regions[r["a"]] == regions[6]:
            assert racks[r["b"]] == racks[6]
            if racks[r["a"]] == racks[6]:
                assert r["b"] == 6


def test_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, None, 5), (1, None, 5), (None, "é", 5), (None, "é", 5), (2, "", 5)], "doc_id long, text string, shard int"
    )
    rows = S.assign(docs, S.balanced(24)).collect()
    assert len(rows) == 5
    assert {(r["doc_id"], r["size"]) for r in rows} == {(1, 8), (None, 10), (2, 8)}
    slots: dict = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert S.assign(docs.where(F.lit(False)), S.balanced(24)).count() == 0


def hashed(key, label):
    """Spark's xxhash64 of a long and a string."""
    seed = xxhash.xxh64_intdigest(key.to_bytes(8, "little", signed=True), 42)
    return xxhash.xxh64_intdigest(label.encode(), seed)


def by_definition(key, tree):
    """Region, rack and shard one after the other, each the child with the smallest draw."""
    left, path = list(tree), []
    for name in (lambda s: f"region:{s.region}", lambda s: f"rack:{s.region}:{s.rack}", lambda s: f"shard:{s.region}:{s.rack}:{s.number}"):
        weights: dict = {}
        for s in left:
            weights[name(s)] = weights.get(name(s), 0) + s.weight
        draws = {n: -math.log(((hashed(key, n) >> 11) + 0.5) / 2**53) / w for n, w in weights.items() if w > 0}
        path.append(min(draws, key=draws.get))
        left = [s for s in left if name(s) == path[-1]]
    return left[0].number


@pytest.mark.parametrize(
    "tree",
    [
        S.balanced(24),
        S.balanced(29),
        tuple(replace(s, weight=0.5 + s.number % 3) for s in S.balanced(13, 2, 3)),
        tuple(replace(s, weight=0.0 if s.number in (2, 4, 5) else 1.0) for s in S.balanced(8, 2, 2)),
    ],
)
def test_draws_equal_their_definition(spark, tree):
    placed = S.with_shard(spark.range(-400, 600), "id", tree, "shard").collect()
    assert [r["shard"] for r in placed] == [by_definition(r["id"], tree) for r in placed]


def test_the_number_of_shards_decides(spark):
    assert S.grown(S.balanced(24)) == S.balanced(25)
    rows = spark.range(20_000)
    for n in range(24, 29):
        rows = S.with_shard(rows, "id", S.balanced(n), f"of_{n}")
    for n in range(25, 29):
        moved = rows.where(F.col(f"of_{n}") != F.col(f"of_{n - 1}"))
        assert {r[0] for r in moved.select(f"of_{n}").distinct().collect()} == {n - 1}
        assert abs(moved.count() - 20_000 / n) < 0.15 * 20_000 / n


def test_trees_of_many_shards(spark):
    tree = S.balanced(400, 4, 5, founding=400)
    rows = S.with_shard(S.with_shard(spark.range(8_000), "id", tree, "a"), "id", S.grown(tree), "b").collect()
    assert {r["b"] for r in rows if r["a"] != r["b"]} == {400}
    assert len({r["a"] for r in rows}) == 400


def test_no_shards(spark):
    assert [r["s"] for r in S.with_shard(spark.range(2), "id", (), "s").collect()] == [None, None]


def test_a_very_long_text(spark):
    text = "é" * 3_000_000
    docs = spark.createDataFrame([(7, text)], "doc_id long, text string")
    row = S.assign(docs, S.balanced(24)).first()
    assert (row["size"], row["text_crc32"], row["slot"]) == (6_000_008, zlib.crc32(text.encode()), 0)
