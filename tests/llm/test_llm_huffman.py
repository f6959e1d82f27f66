import heapq
import time
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pagemill.llm import huffman as H
from pagemill.llm.common import table
from pagemill.llm.queries import WORD_END, WORD_VOCABULARY, op10_huffman

SF_DIR = "/root/testdata/sf0.001"
LIBRARY = Tokenizer.from_file(WORD_VOCABULARY)


def unlimited_cost(counts):
    heap = list(counts)
    heapq.heapify(heap)
    total = 0
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        total += both
        heapq.heappush(heap, both)
    return total


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 1000), min_size=2, max_size=40))
def test_lengths_are_optimal_and_prefix_free(counts):
    n = np.array(counts)
    lengths = H.code_lengths(n).astype(int)
    assert (2.0**-lengths).sum() == 1.0
    assert (n * lengths).sum() == unlimited_cost(counts)


def test_lengths_keep_the_limit():
    counts = np.array([1, 1, 2, 3, 5, 8, 13, 21, 34, 55])
    lengths = H.code_lengths(counts, 4).astype(int)
    assert lengths.max() == 4 and (2.0**-lengths).sum() <= 1.0
    # By trying all codes of at most four bits.
    best = min(
        int((counts[::-1] * np.sort(c)).sum())
        for c in _lengths(10, 4)
    )
    assert int((counts * lengths).sum()) == best
    with pytest.raises(ValueError):
        H.code_lengths(np.ones(5, dtype=int), 2)


def _lengths(n, limit):
    def grow(left, room, least):
        if not left:
            yield []
            return
        for size in range(least, limit + 1):
            if 2.0**-size <= room:
                for rest in grow(left - 1, room - 2.0**-size, size):
                    yield [size, *rest]

    return [np.array(c) for c in grow(n, 1.0, 1)]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 900), min_size=1, max_size=1500))
def test_blocks_come_back(values):
    ids = np.array(values)
    counts = np.bincount(ids)
    at = np.flatnonzero(counts)
    book = H.Book(at, H.code_lengths(counts[at]))
    bits, offsets = H.pack(ids, book.lookup())
    assert (H.unpack(bits, offsets, len(ids), book.table()) == ids).all()


def test_codes_are_canonical():
    book = H.Book(np.array([7, 3, 9, 1]), np.array([2, 1, 3, 3], dtype=np.uint8))
    assert list(zip(book.ids.tolist(), book.codes.tolist())) == [(3, 0b0), (7, 0b10), (1, 0b110), (9, 0b111)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="abreT.,'|éÀ̀Σİ1２ \n\t\x1c\x85 <>endoftx", max_size=40), max_size=4))
def test_words_equal_the_library(texts):
    library = H.word_encoder(WORD_VOCABULARY, "<u2")
    whole = Tokenizer.from_file(WORD_VOCABULARY)
    for text, ids in zip(texts, library.encode(texts), strict=True):
        assert np.frombuffer(ids, dtype="<u2").tolist() == whole.encode(text, add_special_tokens=False).ids


def test_special_tokens_are_those_of_the_library():
    own = H.word_encoder(WORD_VOCABULARY, "<u2")
    texts = ["a <|endoftext|> b", "x<|endoftext|>y", "<|ENDOFTEXT|>", "<|startoftext|>|", "é<|endoftext|>É", "|<|endoftext", "don'T it'Sx 'LL"]
    for text, ids in zip(texts, own.encode(texts), strict=True):
        assert np.frombuffer(ids, dtype="<u2").tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet=[chr(c) for c in (*range(33, 127), *range(0xA0, 0x180), 0x301, 0x345, 0x2019)], max_size=30))
def test_plain_runs_equal_the_library(text):
    own = H.word_encoder(WORD_VOCABULARY, "<u2")
    assert np.frombuffer(own.encode([text])[0], dtype="<u2").tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


def test_runs_stay_known_when_the_cache_turns(monkeypatch):
    monkeypatch.setattr(H, "CACHE", 3)
    own = H.WordEncoder(WORD_VOCABULARY, "<u2")
    for text in ("one two", "three four | five|six", "one three", "two"):
        assert np.frombuffer(own.encode([text])[0], dtype="<u2").tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


def test_query(spark):
    docs = sorted((r["doc_id"], r["text"] or "") for r in table(spark, SF_DIR, "documents").collect())
    rows = {r["doc_id"]: r for r in op10_huffman(spark, SF_DIR).collect()}
    assert len(rows) == len(docs)
    start = 0
    for doc_id, text in docs:
        ids = [*LIBRARY.encode(text, add_special_tokens=False).ids, 2]
        row = rows[doc_id]
        assert (row["start"], row["n_tokens"]) == (start, len(ids))
        assert row["ids_crc32"] == zlib.crc32(np.array(ids, dtype="<u4").tobytes())
        start += len(ids)


def test_odd_rows(spark, monkeypatch):
    docs = spark.createDataFrame([(1, None, 1), (None, "b", 1), (2, "a b", 1), (2, "a b", 1), (3, "", 1)], "doc_id long, text string, ids int")
    blocks, book = H.store(docs, WORD_VOCABULARY, WORD_END, partitions=3)
    rows = sorted(H.checksums(blocks, book).collect(), key=lambda r: r["start"])
    assert [(r["doc_id"], r["start"], r["n_tokens"]) for r in rows] == [(None, 0, 2), (1, 2, 1), (2, 3, 3), (2, 6, 3), (3, 9, 1)]
    whole = {r["start"]: bytes(r["ids"]) for r in H.decode(blocks, book).collect()}
    assert np.frombuffer(whole[3], dtype="<u4").tolist() == [*LIBRARY.encode("a b", add_special_tokens=False).ids, 2]
    blocks, book = H.store(docs.where(F.lit(False)), WORD_VOCABULARY, WORD_END)
    assert H.checksums(blocks, book).count() == 0


def test_a_text_costs_the_same_whatever_the_cache_holds():
    own = H.WordEncoder(WORD_VOCABULARY, "<u2")
    own.encode(["a short text"])

    def seconds():
        start = time.process_time()
        for _ in range(50):
            own.encode(["a short text"])
        return time.process_time() - start

    empty = seconds()
    own.now.update((f"part{n}", b"") for n in range(400_000))
    assert seconds() < 20 * empty + 0.1
