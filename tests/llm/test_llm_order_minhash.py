import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagemill.llm import components as C
from pagemill.llm import order_minhash as M
from pagemill.llm.common import table, words
from pagemill.llm.queries import op7_order_minhash

SF_DIR = "/root/testdata/sf0.01"


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


SEQUENCES = st.lists(st.integers(0, 3), max_size=25)


@settings(max_examples=400, deadline=None)
@given(SEQUENCES, SEQUENCES, st.integers(0, 25))
def test_distance_within_a_band(a, b, limit):
    real = edits(a, b)
    got = M.distance(np.array(a, dtype=np.uint32), np.array(b, dtype=np.uint32), limit)
    assert got == (real if real <= limit else None)


@settings(max_examples=400, deadline=None)
@given(SEQUENCES, SEQUENCES, st.integers(0, 25))
def test_distance_by_columns(a, b, limit):
    real = edits(a, b)
    got = M.band_distance(np.array(a, dtype=np.uint32), np.array(b, dtype=np.uint32), limit)
    assert got == (real if real <= limit else None)


def test_distances_agree_on_long_sequences():
    rng = np.random.default_rng(3)
    for size, share in ((900, 0.1), (900, 0.3), (5_000, 0.02), (5_000, 0.15)):
        a = rng.integers(0, 200, size, dtype=np.uint32)
        b = np.insert(a, rng.integers(0, size, int(size * share / 3)), 7)
        b = np.delete(b, rng.integers(0, len(b), int(size * share / 3)))
        b[rng.random(len(b)) < share / 3] = 9
        limit = size // 5
        real = M.distance(a, b, limit)
        assert M.band_distance(a, b, limit) == real and (real is None) == (share == 0.3)
        assert M.band_distance(a, rng.integers(0, 200, size, dtype=np.uint32), limit) is None


@settings(max_examples=300, deadline=None)
@given(SEQUENCES, SEQUENCES)
def test_similar_by_definition(a, b):
    longer = max(len(a), len(b))
    assert M.similar(np.array(a, dtype=np.uint32), np.array(b, dtype=np.uint32)) == (5 * edits(a, b) <= longer)


def test_sketches_follow_order_and_occurrence():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 1 << 32, 400, dtype=np.uint32)
    near = a.copy()
    near[[50, 300]] = 7
    turned = np.concatenate((a[200:], a[:200]))
    own = M.sketches(a)
    assert (M.sketches(a.copy()) == own).all() and own.shape == (M.SKETCHES,)
    same = [(M.sketches(x) == own).mean() for x in (near, turned, np.tile(a, 2))]
    # Turning the halves keeps nearly all k-mers and changes their order; repeating adds occurrences.
    assert same[0] > 0.5 and same[1] < same[0] and same[2] < same[0]


def test_components(spark):
    rng = np.random.default_rng(4)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 300, (260, 2))] + [(i, i + 1) for i in range(1000, 1060)] + [(5, 5)]
    root = {v: v for p in pairs for v in p}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for a, b in pairs:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = {r["id"]: r["root"] for r in C.components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    assert got == {v: find(v) for v in root if find(v) != v}


def test_classes_of_the_documents(spark):
    """Every pair of different texts by brute force, on shingles of five words."""
    docs = [(r["doc_id"], words(r["text"])) for r in table(spark, SF_DIR, "documents").orderBy("doc_id").collect()]
    rows = {r["doc_id"]: r for r in op7_order_minhash(spark, SF_DIR).collect()}
    assert len(rows) == len(docs)
    shingles = {d: {b" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for d, w in docs if w}
    by_shingle: dict = {}
    for d, s in shingles.items():
        for x in s:
            by_shingle.setdefault(x, []).append(d)
    shared: dict = {}
    for ids in by_shingle.values():
        if len(ids) < 60:
            for i, a in enumerate(ids):
                for b in ids[:i]:
                    shared[b, a] = shared.get((b, a), 0) + 1
    near = [(a, b) for (a, b), n in shared.items() if n >= 0.8 * (len(shingles[a]) + len(shingles[b]) - n)]
    assert near
    missed = [(a, b) for a, b in near if rows[a]["class_id"] != rows[b]["class_id"]]
    assert not missed
    # Nothing is in a class without a text of it that aligns.
    texts = dict(docs)
    members: dict = {}
    for d, r in rows.items():
        members.setdefault(r["class_id"], []).append(d)
    for own in members.values():
        assert sum(rows[d]["kept"] for d in own) == 1 and min(own) in own
        for d in own:
            codes = M.word_codes(texts[d])
            others = [M.word_codes(texts[o]) for o in own if o != d]
            assert not others or any(M.similar(codes, o) for o in others)


@pytest.fixture(scope="module")
def base():
    rng = np.random.default_rng(9)
    return [f"w{n}" for n in rng.integers(0, 5000, 200)]


def test_groups_of_copies(spark, base):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(300):
        w = list(base)
        for at in rng.integers(0, 200, 2):
            w[at] = f"e{i}x{at}"
        rows.append((i, " ".join(w)))
    rows += [(1000 + i, " ".join(base)) for i in range(100)]
    rows += [(2000 + i, " ".join([f"o{i}y{n}" for n in range(180)] + base[:60])) for i in range(60)]
    result = {r["doc_id"]: r["class_id"] for r in M.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len({result[d] for d in result if d < 2000}) == 1
    # A shared passage alone makes no class.
    assert all(result[d] == d for d in result if d >= 2000)


def crowded(seed):
    """Two texts that align and share one sketch, and three of another length that share it too and lead it."""
    rng = np.random.default_rng(seed)
    while True:
        a = [f"a{seed}x{n}".encode() for n in rng.integers(0, 1 << 30, 210)]
        c = list(a)
        for at in rng.choice(210, 20, replace=False):
            c[at] = f"c{seed}x{at}".encode()
        codes = M.word_codes(a)
        own = M.sketches(codes)
        shared = np.flatnonzero(own == M.sketches(M.word_codes(c)))
        if len(shared) != 1:
            continue
        i = shared[0]
        at = np.sort(np.argsort(M._mix(M.with_occurrence(M.kmers(codes)) ^ M._SEEDS[i]))[: M.LENGTH])
        passage = [w for x in at for w in a[x : x + M.K]]
        leaders = [[*passage, f"d{seed}x{j}".encode()] for j in range(3)]
        if all(M.sketches(M.word_codes(d))[i] == own[i] for d in leaders):
            return [b" ".join(w).decode() for w in (a, c, *leaders)]


def test_every_pair_of_a_crowded_sketch(spark):
    texts = [t for seed in range(4) for t in crowded(seed)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r["class_id"] for r in M.classes(docs).collect()}
    codes = [M.word_codes(words(t)) for t in texts]
    near = [(a, b) for b in range(len(texts)) for a in range(b) if M.similar(codes[a], codes[b])]
    assert {(0, 1), (5, 6), (10, 11), (15, 16)} <= set(near)
    least = {d: min([d, *(a for a, b in near if b == d)]) for d in found}
    assert found == least


def test_word_classes_leave_out_no_pair_that_aligns():
    rng = np.random.default_rng(8)
    for _ in range(300):
        a = rng.integers(0, 1 << 32, rng.integers(1, 60), dtype=np.uint32)
        b = np.delete(a, rng.integers(0, len(a), rng.integers(0, 4)))
        b[rng.random(len(b)) < 0.15] = 7
        apart = int(np.abs(M.class_counts(a).astype(int) - M.class_counts(b)).sum())
        assert apart <= 2 * edits(a.tolist(), b.tolist())


def test_odd_rows(spark, base):
    text = " ".join(base)
    docs = spark.createDataFrame(
        [(3, text, "x"), (7, text.upper(), "x"), (7, text, "x"), (None, text, "x"), (4, None, "x"), (5, "", "x"), (6, "!!!", "x"),
         (8, "???", "x"), (9, "two words", "x"), (10, "two words", "x"), (None, "alone here", "x")],
        "doc_id long, text string, node string",
    )
    rows = sorted(M.classes(docs).collect(), key=lambda r: (r["doc_id"] or 0, r["class_id"] or 0))
    assert [(r["doc_id"], r["class_id"], r["kept"]) for r in rows] == [
        (None, None, True), (None, 3, False), (3, 3, True), (4, 4, True), (5, 4, False), (6, 6, True), (7, 3, False), (7, 3, False),
        (8, 8, True), (9, 9, True), (10, 9, False),
    ]
    assert M.classes(docs.where(F.lit(False))).count() == 0


def test_components_of_more_edges_than_a_task_holds(spark):
    pairs = [(int(a), int(b)) for a, b in np.random.default_rng(5).integers(0, 200, (150, 2))] + [(i, i + 1) for i in range(900, 940)]
    edges = spark.createDataFrame(pairs, "u long, v long").repartition(6)
    got = {tuple(r) for r in C.components(edges, together=20).collect()}
    assert got == {tuple(r) for r in C.components(edges).collect()}
    assert {(i, 900) for i in range(901, 941)} <= got


def test_a_passage_that_many_texts_share(spark, monkeypatch):
    """Texts move in blocks, not with each of their pairs; every pair is compared, and every link is found."""
    rng = np.random.default_rng(6)
    passage = [f"p{n}" for n in range(120)]
    own = [[f"o{i}x{n}" for n in range(int(rng.integers(20, 60)))] for i in range(70)]
    # Some share more than the passage.
    own[1::10] = [[*own[0][:10], *o] for o in own[1::10]]
    texts = [" ".join(o + passage) for o in own]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    monkeypatch.setattr(M, "BLOCK", 16)
    sizes = []
    monkeypatch.setattr(M, "_blocks", lambda rows, f=M._blocks: sizes.append((rows.count(), f(rows).count())) or f(rows))
    found = {r["doc_id"]: r["class_id"] for r in M.classes(docs).collect()}
    codes = [M.word_codes(words(t)) for t in texts]
    sketches = [M.sketches(c) for c in codes]
    root = list(range(len(texts)))
    for b in range(len(texts)):
        for a in range(b):
            if (sketches[a] == sketches[b]).any() and M.similar(codes[a], codes[b]):
                x, y = root[a], root[b]
                root = [min(x, y) if r in (x, y) else r for r in root]
    assert found == dict(enumerate(root)) and 1 < len(set(root)) < len(texts)
    # Blocks of a sketch are at most its texts by their number, and not its pairs.
    (rows, moved), = sizes
    assert rows < moved <= rows * 5
