import hashlib
import random

import pandas as pd
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from pagemill.llm import piece_chunks as P
from pagemill.llm.common import table
from pagemill.llm.queries import op12_piece_chunks

SF_DIR = "/root/testdata/sf0.01"
PATH = public_tokenizers.path("piece_bpe_32k.model")


def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def expected(sp, text):
    ids = sp.encode(text or "", add_bos=True, add_eos=True)
    raw = b"".join(i.to_bytes(4, "little") for i in ids)
    return len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(sp.decode(ids).encode()).hexdigest()


ODD = [
    None, "", " ", "   ", "a", " a", "a ", "a  b", "\n", "\t x", "▁", "a▁ b", "▁▁ a", "a\x00b",
    "<s>", "</s> <unk>", "<0x41>", "é  x", "�", "﻿ab", "​", "漢字 かな", "😀😀 x😀",
    "x" * 70_000, "word " * 30_000, " " * 5_000 + "end", "a\r\nb c",
]


def test_query_equals_the_library(spark):
    sp = library()
    docs = table(spark, SF_DIR, "documents").select("doc_id", "text").collect()
    rows = {r["doc_id"]: tuple(r)[1:] for r in op12_piece_chunks(spark, SF_DIR).collect()}
    assert rows == {d["doc_id"]: expected(sp, d["text"]) for d in docs}


@pytest.mark.parametrize("block_chars", [1, 200, P.BLOCK_CHARS])
def test_odd_texts_in_blocks_of_any_size(spark, block_chars):
    sp = library()
    rows = [(i, t, "x", "y") for i, t in enumerate(ODD)] + [(None, "null id", "x", "y"), (3, "again", "x", "y"), (3, "again", "x", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, block string, ids string").repartition(3)
    found = sorted(map(tuple, P.digest(docs, PATH, block_chars).collect()), key=str)
    assert found == sorted(((i, *expected(sp, t)) for i, t, _, _ in rows), key=str)
    assert P.digest(docs.where(F.lit(False)), PATH).count() == 0


def test_random_texts(spark):
    rng = random.Random(5)
    letters = ["a", "b", "the", " ", "  ", "\n", "é", "漢", "😀", "▁", ".", "</s>", "́", "ing"]
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 30))) for _ in range(600)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    encoded = P.encode(docs, PATH)
    back = {r["doc_id"]: r for r in P.decode(encoded, PATH).collect()}
    sp = library()
    for i, text in enumerate(texts):
        ids = sp.encode(text, add_bos=True, add_eos=True)
        assert list(back[i]["ids"]) == ids
        assert back[i]["text"] == sp.decode(ids)


def test_decoding_any_ids_equals_the_library():
    sp, model = library(), P.Model.load(PATH)
    rng = random.Random(6)
    some = [0, 1, 2, 3, 13, 28705, 259, 287, 264, 198 + 3, 230, 160, 9000]
    for _ in range(3000):
        ids = rng.choices(some, k=rng.randint(0, 6)) + rng.choices(range(32_000), k=rng.randint(0, 2))
        assert model.decode(ids).decode() == sp.decode(ids), ids


def test_each_distinct_word_is_segmented_once(monkeypatch):
    real, asked = P.Model.load(PATH), []

    class Counting:
        begin, end, decode = real.begin, real.end, real.decode

        def segment(self, words):
            asked.append(words)
            return real.segment(words)

    monkeypatch.setattr(P.Model, "load", classmethod(lambda cls, path: Counting()))
    batches = [
        pd.DataFrame({"doc_id": [1, 2], "text": ["one two one", "two three "]}),
        pd.DataFrame({"doc_id": [3], "text": ["one two"]}),
    ]
    columns = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    out = pd.concat(P._encoded(iter(batches), PATH, 21, columns, P._digest_row))
    assert asked == [["▁one", "▁two", "▁three", "▁"], ["▁one", "▁two"]]
    assert out["doc_id"].tolist() == [1, 2, 3]


def test_models_that_change_texts_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2

    for change in ("remove_extra_whitespaces", "piece"):
        spec = sentencepiece_model_pb2.ModelProto()
        spec.ParseFromString(open(PATH, "rb").read())
        if change == "piece":
            spec.pieces[1000].piece = "a▁b"
        else:
            spec.normalizer_spec.remove_extra_whitespaces = True
        path = tmp_path / f"{change}.model"
        path.write_bytes(spec.SerializeToString())
        with pytest.raises(ValueError):
            P.Model(str(path))
