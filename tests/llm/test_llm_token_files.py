import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from pagemill.llm import token_files as T
from pagemill.llm.common import table
from pagemill.llm.prefix_bpe import Vocabulary
from pagemill.llm.queries import BYTE_END, BYTE_RANKS, op2_separator_scan

SF_DIR = "/root/testdata/sf0.001"
END = 9


def by_definition(ids):
    out, start = [], 0
    for i, x in enumerate(ids):
        if x == END:
            out.append((len(out), start, i + 1 - start, True))
            start = i + 1
    if start < len(ids):
        out.append((len(out), start, len(ids) - start, False))
    return out


def rows_of(files, block):
    return [
        (f, b, np.asarray(ids[at : at + block], dtype="<u2").tobytes())
        for f, ids in files.items()
        for b, at in enumerate(range(0, len(ids), block))
    ]


@pytest.mark.parametrize("block", [1, 3, 7, 1000])
def test_documents_across_blocks_and_runs(spark, block):
    rng = np.random.default_rng(block)
    files = {f: rng.integers(1, 30 if f % 2 else 12, size=90 + f).tolist() for f in range(4)}
    files[9] = [END] * 5
    files[10] = [1] * 40
    files[11] = [1] * 20 + [END]
    blocks = spark.createDataFrame(rows_of(files, block), "file long, block long, data binary")
    found = T.documents(blocks, END, run=4).orderBy("file", "ordinal").collect()
    expected = [(f, *d) for f, ids in sorted(files.items()) for d in by_definition(ids)]
    assert [tuple(r) for r in found] == expected


def test_real_flat_files(spark, tmp_path):
    ids = [1, 2, END, 3, END, 4]
    (tmp_path / "a.bin").write_bytes(np.asarray(ids, dtype="<u2").tobytes() + b"\x01")
    (tmp_path / "b.bin").write_bytes(b"")
    found = T.documents(T.flat_files(spark, str(tmp_path), block=2), END).orderBy("ordinal").collect()
    assert [tuple(r)[1:] for r in found] == by_definition(ids)


def test_query_counts_what_the_library_counts(spark):
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=Vocabulary.load(BYTE_RANKS).ranks, special_tokens={})
    docs = table(spark, SF_DIR, "documents").collect()
    rows = {r["doc_id"]: r for r in op2_separator_scan(spark, SF_DIR).collect()}
    assert len(rows) == len(docs)
    for d in docs:
        assert rows[d["doc_id"]]["n_tokens"] == len(library.encode_ordinary(d["text"] or "")) + 1
        assert rows[d["doc_id"]]["ended"]


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 0), (None, "", 0), (2, "a b" * 50, 0), (2, "a b" * 50, 0)], "doc_id long, text string, file int")
    stored = T.store(docs.coalesce(1), BYTE_RANKS, public_tokenizers.PATTERN, BYTE_END, block=7)
    rows = T.named(T.documents(stored, BYTE_END), stored).orderBy("n_tokens").collect()
    assert sorted((r["doc_id"] or 0, r["n_tokens"] > 1) for r in rows) == [(0, False), (1, False), (2, True), (2, True)]
    none = T.store(docs.where(F.lit(False)), BYTE_RANKS, public_tokenizers.PATTERN, BYTE_END)
    assert T.documents(none, BYTE_END).count() == 0
    with pytest.raises(ValueError):
        T.store(docs, BYTE_RANKS, public_tokenizers.PATTERN, 70_000)
