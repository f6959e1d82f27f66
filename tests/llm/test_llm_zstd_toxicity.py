import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from pagemill.llm import zstd_toxicity as Z
from pagemill.llm.common import bucket_of, row_bucket, table
from pagemill.llm.queries import op9_toxicity

SF_DIR = "/root/testdata/sf0.1"


def area(scores, labels):
    ranks = pd.Series(scores).rank().to_numpy()
    ones = int(labels.sum())
    return (ranks[labels == 1].sum() - ones * (ones + 1) / 2) / (ones * (len(labels) - ones))


def test_held_out_accuracy(spark):
    labels = {r["doc_id"]: r["toxic"] for r in table(spark, SF_DIR, "labels").collect()}
    rows = op9_toxicity(spark, SF_DIR).collect()
    assert len(rows) == table(spark, SF_DIR, "documents").count()
    assert all(r["held_out"] == (bucket_of(r["doc_id"], 4) == 2) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    held = [r for r in rows if r["held_out"] and labels.get(r["doc_id"]) is not None]
    truth = np.array([labels[r["doc_id"]] for r in held])
    assert area([r["score"] for r in held], truth) > 0.9
    assert np.mean([r["predicted"] for r, t in zip(held, truth) if t == 0]) < 0.05


def test_windows_hold_the_whole_text():
    text = "one two  three\nfour " * 30 + "x" * 5000
    assert b"".join(Z.windows(text)).replace(b" ", b"").decode() == "".join(text.split())
    assert max(map(len, Z.windows(text))) <= Z.MAX_WINDOW_BYTES
    assert Z.windows(None) == Z.windows("") == []


def test_parts_hold_the_whole_window():
    text = "one two three four\u00a0five six seven eight nine ten é " * 9 + "y" * 1200
    for window in Z.windows(text):
        assert b"".join(Z.parts_of(window)) in (window, b" " + window)
        assert all(part.count(b" ") <= Z.PART for part in Z.parts_of(window))


def test_gain_of_known_stretches():
    rng = np.random.default_rng(0)
    syllables = ["ka", "lo", "mi", "ter", "un", "sa"]
    ordinary = " ".join("".join(rng.choice(syllables, 3)) for _ in range(3000)).encode()
    compressors = Z.Compressors(ordinary, b" horribleword nastything " * 4)
    assert compressors.gain(b" kalomi nastything untersa", Z.WHOLE) >= 4
    assert abs(compressors.gain(b" kalomi lomisa untersa", Z.WHOLE)) <= 1


def test_figures_by_definition():
    """Figures of a text against lengths that the library gives without prepared dictionaries."""
    import zstandard

    ordinary, toxic = b" one two three four five six seven eight nine ten " * 3, b" nastything horribleword "
    compressors = Z.Compressors(ordinary, toxic)
    text = "one two nastything four five six seven horribleword nine ten eleven twelve thirteen " * 5

    def length(window, content, level):
        known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        settings = zstandard.ZstdCompressionParameters.from_level(
            level, source_size=64, dict_size=len(content), format=zstandard.FORMAT_ZSTD1_MAGICLESS,
            write_checksum=0, write_content_size=0, write_dict_id=0,
        )
        return len(zstandard.ZstdCompressor(dict_data=known, compression_params=settings).compress(window))

    def gains(size, level):
        return [length(w, ordinary, level) - length(w, ordinary + toxic, level) for w in Z.windows(text, size)]

    counts = [sum(g >= t for g in gains(Z.WINDOW, Z.WHOLE)) for t in Z.WINDOW_GAINS]
    parts = [length(p, ordinary, Z.PARTS) - length(p, ordinary + toxic, Z.PARTS) for w in Z.windows(text) for p in Z.parts_of(w)]
    counts += [sum(g >= t for g in parts) for t in Z.PART_GAINS]
    assert np.expm1(compressors.figures(text)).round().astype(int).tolist() == [*counts, len(Z.windows(text))]
    assert max(counts) > 0


def test_odd_rows(spark):
    rng = np.random.default_rng(1)
    syllables = ["ka", "lo", "mi", "ter", "un", "sa"]

    def text(bad):
        w = ["".join(rng.choice(syllables, 3)) for _ in range(40)]
        if bad:
            w[int(rng.integers(40))] = "nastything"
            w[int(rng.integers(40))] = "horribleword"
        return " ".join(w)

    rows = [(i, text(i % 3 == 0), 5.0) for i in range(240)] + [(None, None, 5.0), (500, "", 5.0), (500, "", 5.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(200)] + [(None, 1), (7, None), (8, 5)], "doc_id long, toxic int")
    every = row_bucket(F.col("doc_id"), 4) >= 0
    model = Z.train(docs, labels, every)
    scores = {r["doc_id"]: r["score"] for r in Z.with_score(docs, model).collect()}
    fresh = [scores[i] for i in range(200, 240)]
    assert min(s for i, s in enumerate(fresh, 200) if i % 3 == 0) > max(s for i, s in enumerate(fresh, 200) if i % 3)
    assert scores[None] == scores[500]
    # Labels of one kind, or none: the share of label 1.
    one = Z.train(docs, labels.where("toxic = 0"), every)
    assert len({r["score"] for r in Z.with_score(docs, one).collect()}) == 1
    none = Z.train(docs, labels.where(F.lit(False)), every)
    assert {r["score"] for r in Z.with_score(docs, none).collect()} == {0.5}
    assert Z.with_score(docs.where(F.lit(False)), model).count() == 0
