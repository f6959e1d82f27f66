"""SentencePiece encoding by a table of distinct marked words.

A SentencePiece model writes blanks as a marker. Where none of its pieces has a marker after another character, no
merge crosses from a word to the marker of the next, so the words, each with the markers before it, are encoded
independently of each other. Words repeat: a task takes its documents in blocks, lists the distinct words of a block
in a table, segments each of them once, and reads the ids of every document from the table by the positions of its
words. A block has at most ``BLOCK_CHARS`` characters, or one document, so the table is bounded.

Blocks do not share their tables: one table for all documents sends every block's words, positions and ids through
shuffles, which takes more disk than the texts (README has figures), and saves little, as blocks are large. So there
is no shuffle, nothing is written, and a lost task is one block of texts again.

Null texts are empty; empty texts have the begin and end ids only. Rows are kept as they are, repeated and null ids
too; an empty table gives no rows. Columns other than ``doc_id`` and ``text`` take no part.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pandas as pd
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

MARK = "▁"
# Characters of the documents that share a table.
BLOCK_CHARS = 12_000_000

_WORD = re.compile(f"{MARK}+[^{MARK}]*")

DIGEST = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
IDS = "doc_id long, ids array<int>"

_models: dict[str, Model] = {}


class Model:
    """A SentencePiece model whose pieces do not cross markers."""

    def __init__(self, path: str) -> None:
        spec = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            spec.ParseFromString(file.read())
        self._check(path, spec)
        self.whole = whole = sentencepiece.SentencePieceProcessor(model_proto=spec.SerializeToString())
        # Words carry their markers already.
        spec.normalizer_spec.add_dummy_prefix = False
        self._words = sentencepiece.SentencePieceProcessor(model_proto=spec.SerializeToString())
        size = whole.vocab_size()
        self.begin, self.end = whole.bos_id(), whole.eos_id()
        self._control = {i for i in range(size) if whole.is_control(i)}
        self._surface = [self._bytes(i, whole.id_to_piece(i)) for i in range(size)]

    @staticmethod
    def _check(path: str, spec: sentencepiece_model_pb2.ModelProto) -> None:
        rules = spec.normalizer_spec
        plain = rules.add_dummy_prefix and rules.escape_whitespaces
        if not plain or rules.remove_extra_whitespaces or rules.precompiled_charsmap:
            raise ValueError(f"{path}: the model changes texts before it cuts them")
        if any(MARK in piece.piece.lstrip(MARK) for piece in spec.pieces):
            raise ValueError(f"{path}: pieces cross the marker of white space")
        if any(piece.type == piece.USER_DEFINED for piece in spec.pieces):
            raise ValueError(f"{path}: the model has symbols of its own")

    def _bytes(self, i: int, piece: str) -> bytes:
        if i in self._control:
            return b""
        if self.whole.is_unknown(i):
            return self.whole.decode([i]).encode()
        if self.whole.is_byte(i):
            return bytes([int(piece[3:5], 16)])
        return piece.replace(MARK, " ").encode()

    @classmethod
    def load(cls, path: str) -> Model:
        """The model, read once per worker."""
        if path not in _models:
            _models[path] = cls(path)
        return _models[path]

    def segment(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all marked words, one after another, and how many each has."""
        every = self._words.encode(words, num_threads=1)
        lengths = np.fromiter(map(len, every), np.int64, len(every))
        return np.fromiter(chain.from_iterable(every), np.int32, int(lengths.sum())), lengths

    def decode(self, ids: list[int]) -> bytes:
        """UTF-8 of the text that the ids stand for; bytes that are not UTF-8 become replacement characters."""
        surface = self._surface
        raw = b"".join([surface[i] for i in ids])
        first = next((i for i in ids if i not in self._control), None)
        if first is not None and raw.startswith(b" ") and not self.whole.is_unknown(first) and not self.whole.is_byte(first):
            raw = raw[1:]
        try:
            raw.decode()
            # A control id inside would part bytes that belong to one character.
            if self._control.isdisjoint(ids[1:-1]):
                return raw
        except UnicodeDecodeError:
            pass
        return self.whole.decode([int(i) for i in ids]).encode()


def marked_words(text: str | None) -> list[str]:
    """The marked words of a text; together they are the text behind one marker, blanks as markers."""
    return _WORD.findall(MARK + text.replace(" ", MARK)) if text else []


class Block:
    """Documents, the table of their distinct words, and the places in it of the words of every document."""

    def __init__(self) -> None:
        self.doc_ids: list = []
        self.places: list[np.ndarray] = []
        self.table: dict[str, int] = {}
        self.chars = 0

    def add(self, doc_id, text: str | None) -> None:
        words, place = marked_words(text), self.table.setdefault
        self.places.append(np.fromiter((place(w, len(self.table)) for w in words), np.int32, len(words)))
        self.doc_ids.append(doc_id)
        self.chars += len(text or "")

    def encoded(self, model: Model) -> Iterator[tuple]:
        """``doc_id, ids`` of every document, the begin and end ids included."""
        ids, lengths = model.segment(list(self.table))
        starts = np.cumsum(lengths) - lengths
        for doc_id, places in zip(self.doc_ids, self.places):
            sizes = lengths[places]
            # The place of each id in the table's ids: the start of its word, and how far it is into the word.
            into = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            yield doc_id, np.concatenate([[model.begin], ids[np.repeat(starts[places], sizes) + into], [model.end]]).astype("<u4")


def _encoded(batches: Iterator[pd.DataFrame], path: str, limit: int, columns: list[str], row) -> Iterator[pd.DataFrame]:
    model, block = Model.load(path), Block()

    def close() -> Iterator[pd.DataFrame]:
        rows = (row(doc_id, ids, model) for doc_id, ids in block.encoded(model))
        while part := list(islice(rows, 1000)):
            frame = pd.DataFrame(part, columns=columns)
            frame["doc_id"] = pd.array([r[0] for r in part], dtype="Int64")
            yield frame

    for batch in batches:
        for doc_id, text in zip(batch["doc_id"].astype("Int64"), batch["text"]):
            if block.doc_ids and block.chars + len(text or "") > limit:
                yield from close()
                block = Block()
            block.add(doc_id, text)
    yield from close()


def _digest_row(doc_id, ids: np.ndarray, model: Model) -> tuple:
    decoded = model.decode(ids.tolist())
    return doc_id, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(decoded).hexdigest()


def _read(docs: DataFrame, path: str, block_chars: int, schema: str, row) -> DataFrame:
    columns = [part.split()[0] for part in schema.split(", ")]
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return rows.mapInPandas(lambda batches: _encoded(batches, path, block_chars, columns, row), schema)


def encode(docs: DataFrame, path: str, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``doc_id, ids`` of every document, with begin and end ids."""
    return _read(docs, path, block_chars, IDS, lambda doc_id, ids, _: (doc_id, ids.astype(np.int32)))


def digest(docs: DataFrame, path: str, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every document."""
    return _read(docs, path, block_chars, DIGEST, _digest_row)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """The text of ``ids`` as column ``text``, other columns kept. Null ids have a null text."""

    def decoded(ids: pd.Series) -> pd.Series:
        model = Model.load(path)
        return ids.map(lambda row: None if row is None else model.decode([int(i) for i in row]).decode())

    return encoded.withColumn("text", F.pandas_udf(decoded, "string")("ids"))
