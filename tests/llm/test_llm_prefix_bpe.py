import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagemill.llm import prefix_bpe as B
from pagemill.llm.common import table
from pagemill.llm.queries import BYTE_RANKS, op6_prefix_bpe

SF_DIR = "/root/testdata/sf0.001"
PATTERN = public_tokenizers.PATTERN
VOCABULARY = B.Vocabulary.load(BYTE_RANKS)
LIBRARY = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=VOCABULARY.ranks, special_tokens={})
ENCODER = B.TextEncoder(VOCABULARY, PATTERN)
TEXTS = st.one_of(st.text(max_size=40), st.text(alphabet=" \n\t'abrelst!é1２\x1c", max_size=60))


@settings(max_examples=400, deadline=None)
@given(TEXTS)
def test_equals_the_library_and_comes_back(text):
    ids = ENCODER.encode(text).tolist()
    assert ids == LIBRARY.encode_ordinary(text)
    assert VOCABULARY.decode(ids) == text.encode()


@settings(max_examples=300, deadline=None)
@given(st.binary(min_size=1, max_size=40))
def test_piece_equals_merging(piece):
    if piece not in VOCABULARY.ranks:
        assert VOCABULARY.encode(piece) == VOCABULARY.merged(piece)


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=30), st.binary(max_size=30), st.data())
def test_appends_and_edits_of_a_piece(start, more, data):
    prefixes = B.Prefixes(VOCABULARY)
    prefixes.append(start)
    prefixes.append(more)
    whole = start + more
    assert prefixes.ids() == VOCABULARY.merged(whole)
    a = data.draw(st.integers(0, len(whole)))
    b = data.draw(st.integers(a, len(whole)))
    prefixes.replace(a, b, b"xy")
    assert prefixes.data == whole[:a] + b"xy" + whole[b:]
    assert prefixes.ids() == VOCABULARY.merged(prefixes.data)


@settings(max_examples=300, deadline=None)
@given(TEXTS, st.text(alphabet="re'l \n", max_size=4), st.data())
def test_appends_and_edits_of_a_text(text, new, data):
    a = data.draw(st.integers(0, len(text)))
    b = data.draw(st.integers(a, len(text)))
    encoded = B.EncodedText(ENCODER, text)
    encoded.replace(a, b, new)
    assert encoded.text == text[:a] + new + text[b:]
    assert encoded.ids() == LIBRARY.encode_ordinary(encoded.text)
    encoded.append("'re on")
    assert encoded.ids() == LIBRARY.encode_ordinary(encoded.text)


def test_an_edit_encodes_only_what_is_near():
    text = "some words that stand in a row, " * 500
    encoded = B.EncodedText(ENCODER, text)
    assert encoded.replace(8000, 8001, "Z") < 12
    assert encoded.ids() == LIBRARY.encode_ordinary(encoded.text)
    prefixes = B.Prefixes(VOCABULARY)
    prefixes.append(b"abcdefgh" * 400)
    assert prefixes.replace(100, 101, b"q") < 400
    assert prefixes.ids() == VOCABULARY.merged(prefixes.data)


def test_long_pieces():
    for text in ("a" * 3000, " " * 3000 + "x", "\n" * 999, "ü" * 700):
        assert ENCODER.encode(text).tolist() == LIBRARY.encode_ordinary(text)


def test_runs_of_an_earlier_generation_stay():
    runs = B.Runs(lambda run: run.encode(), 2)
    assert [runs[x] for x in ("a", "b", "c", "a", "d")] == [b"a", b"b", b"c", b"a", b"d"]
    assert len(runs) <= 2


def test_query(spark):
    docs = {r["doc_id"]: r["text"] or "" for r in table(spark, SF_DIR, "documents").collect()}
    rows = op6_prefix_bpe(spark, SF_DIR).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ids = LIBRARY.encode_ordinary(docs[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(docs[r["doc_id"]].encode()).hexdigest()


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 3), (None, "", 3), (2, "a b", 3), (2, "a b", 3)], "doc_id long, text string, ids int")
    rows = B.digest(docs, BYTE_RANKS, PATTERN).collect()
    assert sorted(((r["doc_id"] or 0), r["n_tokens"]) for r in rows) == [(0, 0), (1, 0), (2, 2), (2, 2)]
    tokens = B.decoded(B.with_tokens(docs, BYTE_RANKS, PATTERN), BYTE_RANKS, PATTERN).collect()
    assert sorted(bytes(r["decoded"]) for r in tokens) == [b"", b"", b"a b", b"a b"]
    assert B.digest(docs.where(F.lit(False)), BYTE_RANKS, PATTERN).count() == 0


def test_a_byte_without_a_token_is_an_error():
    few = B.Vocabulary({b"a": 0, b"b": 1, b"ab": 2})
    assert few.encode(b"abab") == [2, 2]
    with pytest.raises(ValueError):
        few.encode(b"xx")
    assert np.array_equal(B.TextEncoder(few, r"\S+").encode(None), np.zeros(0))
