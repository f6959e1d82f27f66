import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagemill.llm import decontaminate as D
from pagemill.llm.common import words
from pagemill.llm.queries import ORACLE, op8_decontamination
from tools.compare import canonical

SF_DIR = "/root/testdata/sf0.001"


def by_definition(text, items, size):
    w = words(text)
    hit, named = set(), set()
    for item, own in items:
        v = words(own)
        n = min(size, len(v))
        for i in range(max(1, len(v) - size + 1) if v else 0):
            for j in range(len(w) - n + 1):
                if w[j : j + n] == v[i : i + n]:
                    hit.update(range(j, j + n))
                    named.add(item)
    return len(w), hit, named


def machine(items, size):
    table: dict = {}
    for item, text in items:
        for window in D.windows(text, size):
            table.setdefault(window, []).append(item)
    return D.automaton([(w.decode("latin-1"), w.count(b" ") + 1, i) for w, i in table.items()])


WORDS = st.lists(st.sampled_from(["a", "B", "aa", "é", "1"]), max_size=14).map(" ".join)


@settings(max_examples=300, deadline=None)
@given(WORDS, st.lists(WORDS, max_size=3))
def test_occurrences_by_definition(text, texts):
    items = list(enumerate(texts))
    n, ranges, named = D.occurrences(text, machine(items, 3))
    expected = by_definition(text, items, 3)
    assert (n, {i for a, b in ranges for i in range(a, b)}, named) == expected


def test_query_equals_its_sql(spark):
    db = duckdb.connect()
    for name in ("documents", "benchmark"):
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    ours = op8_decontamination(spark, SF_DIR).toPandas()
    theirs = db.sql(ORACLE["op8_decontamination"]).df()
    assert canonical(ours) == canonical(theirs)
    assert ours["contaminated"].any()


def test_offsets_lead_to_the_original(spark):
    item = "Um zehn Uhr, ging - die GANZE Stadt über den Fluß; heim."
    text = "«Davor» steht dies.\nUM zehn uhr ging (die) ganze stadt über den fluß HEIM, dann mehr."
    docs = spark.createDataFrame([(1, text), (2, "nichts")], "doc_id long, text string")
    bench = spark.createDataFrame([(4, item)], "item_id long, text string")
    rows = D.hit_spans(docs, bench).collect()
    assert [(r["doc_id"], r["items"]) for r in rows] == [(1, ["4"])]
    span = rows[0]["spans"][0]
    # Letters outside ASCII keep their case and so must match as they are.
    assert text[span["start"] : span["end"]].startswith("UM zehn") and text[span["start"] : span["end"]].endswith("HEIM")


def test_blocks_of_the_benchmark_give_what_one_gives(spark):
    docs = spark.createDataFrame([(i, " ".join(f"w{(i * 7 + j) % 50}" for j in range(40))) for i in range(20)], "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(f"w{(i * 11 + j) % 50}" for j in range(14))) for i in range(12)], "item_id long, text string")
    one = D.digest(D.hits(docs, bench)).orderBy("doc_id").collect()
    many = D.digest(D.hits(docs, bench, block_bytes=600)).orderBy("doc_id").collect()
    assert one == many and any(r["contaminated"] for r in one)


def test_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, None, 9), (2, "", 9), (None, "a short item", 9), (3, "x A short. item y", 9), (3, "x A short. item y", 9)],
        "doc_id long, text string, hits int",
    )
    bench = spark.createDataFrame([(7, "a SHORT item"), (7, "a SHORT item"), (10, "item y"), (None, "x a"), (8, None), (9, "--")], "item_id long, text string")
    rows = D.digest(D.hits(docs, bench)).collect()
    assert sorted((r["doc_id"] or 0, r["n_words"], r["n_hit"], r["n_items"]) for r in rows) == [
        (0, 3, 3, 1), (1, 0, 0, 0), (2, 0, 0, 0), (3, 5, 5, 2), (3, 5, 5, 2),
    ]
    assert D.digest(D.hits(docs.where(F.lit(False)), bench)).count() == 0
    clean = D.digest(D.hits(docs, bench.where(F.lit(False)))).collect()
    assert [r["n_hit"] for r in clean] == [0] * 5 and max(r["n_words"] for r in clean) == 5
