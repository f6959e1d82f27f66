import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline as P
from pagemill.llm import decontaminate, nbsvm, order_minhash, prefix_bpe, secrets
from pagemill.llm.common import bucket_of, words
from pagemill.llm.queries import BYTE_RANKS

SF_DIR = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_each_stage_decides_as_its_definition_says(spark):
    """Stage by stage over all documents, each against plain Python over the rows that it was given."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    given = docs.collect()
    for (name, stage), after in zip(P.STAGES, [*P.STAGES[1:], None]):
        rows = stage(spark, docs, SF_DIR)
        if after:
            assert rows.columns == list(P.COLUMNS) and dict(rows.dtypes) == dict(docs.dtypes)
        rows = rows.collect()
        if name == "quality classifier":
            known = [d for d in given if d["doc_id"] in labels]
            left = {r["doc_id"] for r in rows}
            assert sum((d["doc_id"] in left) == bool(labels[d["doc_id"]]) for d in known) >= 0.97 * len(known)
        elif name == "near-duplicates":
            seen: dict = {}
            for r in rows:
                key = b" ".join(words(r["text"]))
                assert key not in seen
                seen[key] = r
            dropped = {d["doc_id"] for d in given} - {r["doc_id"] for r in rows}
            classes = {r["doc_id"]: r["class_id"] for r in order_minhash.classes(docs).collect()}
            assert dropped == {d for d, c in classes.items() if d != c}
        elif name == "benchmark decontamination":
            items = [words(b["text"]) for b in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
            windows = {tuple(w[i : i + 10]) for w in items if w for i in range(max(1, len(w) - 9))}
            sizes = {len(w) for w in windows}

            def clean(text):
                w = words(text)
                return not any(tuple(w[i : i + n]) in windows for n in sizes for i in range(len(w) - n + 1))

            assert sorted(r["doc_id"] for r in rows) == sorted(d["doc_id"] for d in given if clean(d["text"]))
        elif name == "secret scan":
            assert {r["doc_id"] for r in rows} == {d["doc_id"] for d in given}
            for r in rows:
                assert not secrets.base_spans(r["text"]) and r["n_chars"] == len(r["text"])
        else:
            library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=prefix_bpe.Vocabulary.load(BYTE_RANKS).ranks, special_tokens={})
            texts = {d["doc_id"]: d["text"] for d in given}
            assert len(rows) == len(given)
            for r in rows:
                assert r["ids"] == library.encode_ordinary(texts[r["doc_id"]]) and r["n_tokens"] == len(r["ids"])
        if after:
            docs = P.written(stage(spark, docs, SF_DIR), "test-stage")
            given = docs.collect()


def test_odd_rows(spark, tmp_path):
    text = "a few plain words that say something of no harm and go on for a while " * 3
    rows = [(1, text), (2, text), (None, None), (3, ""), (None, text), (4, text.replace("plain", "simple")), (4, text)]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], SCHEMA).withColumn("hits", F.lit(1))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    result = P.run(spark, str(tmp_path)).collect()
    # Without labels nothing is rejected; one document of a class stays, and rows without an id.
    assert sorted(r["doc_id"] or 0 for r in result) == [0, 0, 1, 3]
    spark.createDataFrame([], SCHEMA).write.mode("overwrite").parquet(str(tmp_path / "documents.parquet"))
    assert P.run(spark, str(tmp_path)).count() == 0
    assert bucket_of(None, 5) == 0 and nbsvm.THRESHOLD == 0.3 and decontaminate.WINDOW == 10
