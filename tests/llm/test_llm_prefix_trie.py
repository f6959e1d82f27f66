import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from pagemill.llm import prefix_trie as T
from pagemill.llm.queries import op13_prefix_trie

SF_DIR = "/root/testdata/sf0.01"
SCHEMA = "conv_id long, turn long, role string, text string"


def originals(rows):
    by_conv = {}
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32]
            by_conv.setdefault(conv_id, []).append((turn is not None, turn or 0, digest, role, text))
    return {c: [t[3:] for t in sorted(found)] for c, found in by_conv.items()}


def rebuilt(by_conv):
    out = {}
    for c, own in by_conv.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        out[c] = by_conv.get(base, [])[:h] + own[h:]
    return out


def brute_force(conversations):
    """Nodes by their whole prefixes, each told for itself."""
    members = {}
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = set()
    for node, convs in members.items():
        subtree = [n for n in members if n[: len(node)] == node]
        kids = [n for n in subtree if len(n) == len(node) + 1]
        leaves = [n for n in subtree if not any(m[:-1] == n for m in subtree if len(m) == len(n) + 1)]
        ends = ",".join(map(str, sorted(c for c in convs if len(conversations[c]) == len(node))))
        saved = sum((len(members[n]) - 1) * len(n[-1][1]) for n in subtree if n)
        parent = min(members[node[:-1]]) if node else None
        out.add((min(convs), len(node), parent, len(convs), len(kids), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return out


def result(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def random_rows(n, seed, depth=7):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        c = rng.randint(-250, 900) * rng.choice([1, 1, 1, 1 << 20])
        for turn in range(rng.randint(1, depth)):
            rows.append((c, rng.choice([turn, turn, None]), rng.choice(["user", "bot", None]), rng.choice(["a", "bé", "漢字c", "", None])))
    return rows


@pytest.mark.parametrize("most_turns, salts, bits", [(1, 2, 1), (12, 3, 4), (T.TURNS, T.SALTS, T.RANGE_BITS)])
def test_equals_brute_force_with_any_bounds(spark, most_turns, salts, bits):
    rows = random_rows(160, 3, 5)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    found = T.trie(T.rebuilt(T.turns(df)), most_turns, salts, bits)
    assert result(found) == brute_force(rebuilt(originals(rows)))


def test_without_rebuilding(spark):
    rows = random_rows(60, 4)
    found = T.trie(T.turns(spark.createDataFrame(rows, SCHEMA)), 10, 4)
    assert result(found) == brute_force(originals(rows))


def test_query_equals_brute_force(spark):
    found = op13_prefix_trie(spark, SF_DIR)
    assert [t for _, t in found.dtypes] == ["bigint"] * 7 + ["string"]
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert result(found) == brute_force(rebuilt(originals(rows)))


def test_long_common_beginnings_and_copies(spark):
    common = [("user", f"t{i}") for i in range(9)]
    conversations = {c: common + [("bot", "same")] for c in range(0, 60)}
    conversations |= {c: common[: c % 9 + 1] for c in range(100, 140)}
    conversations |= {c: common + [("bot", str(c))] * 3 for c in range(200, 230)}
    rows = [(c, i, r, t) for c, turns in conversations.items() for i, (r, t) in enumerate(turns)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert result(T.trie(T.turns(df), 4, 3, 2)) == brute_force(conversations)


def test_odd_rows(spark):
    rows = [
        (None, 0, "user", "lost"),
        (7, 0, "user", "hi"),
        (7, 0, "user", "hi"),
        (8, None, None, None),
        (9, 1, "", ""),
        (-3, 2, "a:b", "c"),
        (-4, 2, "a", ":bc"),
        (300, 0, "user", "x" * 300_000),
        (301, 0, "user", "x" * 300_000),
    ]
    extra = [(*r, "k", 5, "d") for r in rows]
    df = spark.createDataFrame(extra, SCHEMA + ", key string, depth int, chars string")
    assert result(T.trie(T.rebuilt(T.turns(df)))) == brute_force(rebuilt(originals(rows)))
    assert result(T.trie(T.turns(df))) == brute_force(originals(rows))
    assert T.trie(T.rebuilt(T.turns(df.where(F.lit(False))))).count() == 0
    assert T.trie(T.turns(df.where("conv_id is null"))).count() == 0


def test_conversations_without_turns(spark):
    # Short conversations whose first turns are replaced by those of an absent conversation.
    rows = [(c, 0, "user", f"t{c % 3}") for c in range(101, 140)]
    found = result(T.trie(T.rebuilt(T.turns(spark.createDataFrame(rows, SCHEMA)))))
    expected = rebuilt(originals(rows))
    assert any(not turns for turns in expected.values())
    assert found == brute_force(expected)
