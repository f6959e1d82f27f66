"""Token ids as canonical, length-limited Huffman codes.

Ids are counted over the whole corpus; package-merge gives the shortest codes of at most ``LIMIT`` bits, and
canonical numbering makes the lengths alone the code book. Documents stand in ascending order of their ids in
blocks that decode on their own: a block is packed bits, the bit offset of every ``STEP``-th token, and the
lengths of its documents. A block ends at the first document boundary after ``BLOCK`` tokens. Decoding reads
``LIMIT`` bits at a time as an index into a table of (id, length), for all steps of a block side by side.

A file is a row per block, written by Spark: the shared folder need not be reachable from Python, and a lost
task leaves no half file. The code book is a table beside it.

Null and empty texts have no ids besides the end id. Rows are kept as they are; rows of equal ``doc_id`` follow
each other in the order of their ids, null ``doc_id`` come first. Empty tables give empty files.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from pagemill.llm.common import written

LIMIT = 16
STEP = 256
BLOCK = 131_072
# Distinct runs of text whose ids a worker keeps at a time, their characters, and how many it encodes in one call.
CACHE = 600_000
CACHE_CHARS = 8_000_000
TOGETHER = 512
# Texts whose runs are looked up together.
TEXTS = 256

IDS = StructType([StructField("doc_id", LongType()), StructField("ids", BinaryType())])
BLOCKS = "part int, block int, first long, n_tokens long, doc_ids array<long>, lengths array<int>, offsets binary, bits binary"

_ODD = re.compile("[\x1c-\x1f\x85]")
# Runs on which Python's and the tokenizer's idea of letters and lower case are the same.
_PLAIN = re.compile("[\t\n\r -~À-ÖØ-öø-ÿ]*")
# How the vocabulary cuts a normalised text, and the same for plain runs.
_CUT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_PIECE = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\\sa-zß-öø-ÿ0-9]+")
_NORMALIZERS = ["NFC", "Replace", "Lowercase"]
_tokenizers: dict = {}


def id_type(path: str) -> str:
    """The narrowest type that holds every id of the vocabulary."""
    from tokenizers import Tokenizer

    return "<u2" if Tokenizer.from_file(path).get_vocab_size() <= 1 << 16 else "<u4"


class WordEncoder:
    """Encodes texts by the tokenizers library, as little-endian unsigned ids.

    A text's ids are those of its parts; parts that come again are not encoded again. Plain texts are cut into the
    tokenizer's pieces here, and the library merges each new piece. Other texts are cut at white space, which the
    tokenizer drops and splits at before all else; new runs go through the library many at a time, with a mark
    between them by whose id they are told apart; a run that holds the mark goes alone. Control characters on which
    Python and the library may differ send the text through the library whole. Special tokens in a text are special
    tokens, as the library has it.
    """

    MARK = "|"

    def __init__(self, path: str, dtype: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.dtype = dtype
        self.now: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        self.chars = 0
        rules = json.loads(self.tokenizer.to_str())
        normal = [n["type"] for n in (rules["normalizer"] or {}).get("normalizers", [])]
        cut = [p.get("pattern", {}).get("Regex") for p in (rules["pre_tokenizer"] or {}).get("pretokenizers", [])]
        self.cuts_as_known = normal == _NORMALIZERS and cut == [_CUT, None]
        self.special = [t["content"] for t in rules["added_tokens"]]
        self.letters = _byte_letters()
        # Two or four bytes, in the order of the machine, which is that of the ids.
        self.code = "H" if np.dtype(dtype).itemsize == 2 else "I"
        mark = self._ids(self.MARK)
        self.mark = mark[0] if len(mark) == 1 else None

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _bytes(self, ids) -> bytes:
        return np.asarray(ids, dtype=self.dtype).tobytes()

    def _plain(self, text: str) -> bool:
        return self.cuts_as_known and _PLAIN.fullmatch(text) is not None and not any(t in text for t in self.special)

    def _merged(self, piece: str) -> list[int]:
        mapped = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.letters)
        return [token.id for token in self.model.tokenize(mapped)]

    def _learn_pieces(self, pieces: list[str]) -> None:
        for piece in pieces:
            self.now[piece] = array(self.code, self._merged(piece)).tobytes()

    def _learn_runs(self, runs: list[str]) -> None:
        alone = [r for r in runs if self.mark is None or self.MARK in r]
        for run in alone:
            self.now[run] = self._bytes(self._ids(run))
        runs = [r for r in runs if r not in self.now] if alone else runs
        for i in range(0, len(runs), TOGETHER):
            part = runs[i : i + TOGETHER]
            joined = self.tokenizer.encode_batch_fast([f" {self.MARK} ".join(part)], add_special_tokens=False)[0]
            ids = np.asarray(joined.ids, dtype=self.dtype)
            data, width = ids.tobytes(), ids.itemsize
            ends = (np.flatnonzero(ids == self.mark) * width).tolist() + [len(data)]
            start = 0
            for run, end in zip(part, ends, strict=True):
                self.now[run] = data[start:end]
                start = end + width

    def encode(self, texts: list[str]) -> list[bytes]:
        plain = [self._plain(t) for t in texts]
        split = [_PIECE.findall(t.lower()) if p else None if _ODD.search(t) else t.split() for t, p in zip(texts, plain)]
        pieces = set().union(*(s for s, p in zip(split, plain) if p))
        runs = set().union(*(s for s, p in zip(split, plain) if s and not p)) - pieces
        # difference() goes through the parts of these texts; an operator with keys() goes through the whole cache.
        new = [pieces.difference(self.now), runs.difference(self.now)]
        if len(self.now) + sum(map(len, new)) > CACHE or self.chars > CACHE_CHARS:
            # Frequent parts come back from the generation before.
            self.before, self.now, self.chars, new = self.now, {}, 0, [pieces, runs]
        for kind, learn in zip(new, (self._learn_pieces, self._learn_runs)):
            self.chars += sum(map(len, kind))
            known = {part: self.before[part] for part in kind if part in self.before}
            self.now.update(known)
            learn(list(kind.difference(known)))
        at = self.now.__getitem__
        return [self._bytes(self._ids(t)) if s is None else b"".join(map(at, s)) for t, s in zip(texts, split)]


def _byte_letters() -> dict[int, int]:
    """The letter that stands for each byte in a byte-level vocabulary: itself where it can be seen."""
    seen = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [byte for byte in range(256) if byte not in seen]
    return {byte: 256 + i for i, byte in enumerate(hidden)}


def word_encoder(path: str, dtype: str) -> WordEncoder:
    """One per worker process; its cache serves all tasks that run there."""
    if path not in _tokenizers:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        _tokenizers[path] = WordEncoder(path, dtype)
    return _tokenizers[path]


def token_ids(docs: DataFrame, path: str, end_id: int, dtype: str) -> DataFrame:
    """``doc_id, ids``: little-endian ids of every text, the end id last."""
    end = np.asarray([end_id], dtype=dtype).tobytes()

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        one = word_encoder(path, dtype)
        for batch in batches:
            texts = [t or "" for t in batch["text"]]
            for i in range(0, len(texts), TEXTS):
                part = one.encode(texts[i : i + TEXTS])
                ids = batch["doc_id"].iloc[i : i + TEXTS].astype("Int64")
                yield pd.DataFrame({"doc_id": ids, "ids": [x + end for x in part]})

    return docs.select("doc_id", "text").mapInPandas(encode, IDS)


def id_counts(ids: DataFrame, dtype: str) -> DataFrame:
    """``id, n`` over all rows; as many rows as there are ids."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(0, dtype=np.int64)
        for batch in batches:
            for value in batch["ids"]:
                n = np.bincount(np.frombuffer(value, dtype=dtype))
                if len(n) > len(total):
                    total = np.concatenate((total, np.zeros(len(n) - len(total), dtype=np.int64)))
                total[: len(n)] += n
        at = np.flatnonzero(total)
        yield pd.DataFrame({"id": at, "n": total[at]})

    return ids.select("ids").mapInPandas(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Lengths of the optimal prefix code with no code over ``limit`` bits, by package-merge.

    ``counts`` are positive. Each round pairs the cheapest items of the round before and merges the pairs with
    the symbols; the first ``2 n - 2`` items of the last round then say how often each symbol is taken.
    """
    n = len(counts)
    if n > 1 << limit:
        raise ValueError(f"{n} ids need codes of more than {limit} bits")
    if n <= 1:
        return np.ones(n, dtype=np.uint8)
    order = np.argsort(counts, kind="stable")
    leaf = counts[order].astype(np.int64)
    rounds, items = [], leaf
    for _ in range(limit - 1):
        pairs = items[0 : len(items) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate((leaf, pairs))
        by = np.argsort(both, kind="stable")
        rounds.append(by < n)
        items = both[by]
    lengths = np.zeros(n, dtype=np.int64)
    take = 2 * n - 2
    for is_leaf in reversed(rounds):
        leaves = int(is_leaf[:take].sum())
        lengths[:leaves] += 1
        take = 2 * (take - leaves)
    lengths[:take] += 1
    out = np.empty(n, dtype=np.uint8)
    out[order] = lengths
    return out


@dataclass
class Book:
    """Ids with their canonical codes; :meth:`table` serves decoding."""

    ids: np.ndarray
    lengths: np.ndarray

    def __post_init__(self) -> None:
        order = np.lexsort((self.ids, self.lengths))
        self.ids, self.lengths = self.ids[order], self.lengths[order]
        # A code starts where the codes before it end, in units of the longest length.
        width = np.left_shift(1, LIMIT - self.lengths.astype(np.int64))
        self.starts = np.concatenate(([0], np.cumsum(width)[:-1])).astype(np.int64)
        self.codes = self.starts >> (LIMIT - self.lengths.astype(np.int64))

    def lookup(self) -> tuple[np.ndarray, np.ndarray]:
        """Codes and lengths by id."""
        top = int(self.ids.max()) + 1 if len(self.ids) else 0
        code, length = np.zeros(top, dtype=np.uint64), np.zeros(top, dtype=np.int64)
        code[self.ids], length[self.ids] = self.codes, self.lengths
        return code, length

    def table(self) -> tuple[np.ndarray, np.ndarray]:
        """Id and code length by the next ``LIMIT`` bits."""
        width = np.left_shift(1, LIMIT - self.lengths.astype(np.int64))
        id_, length = np.repeat(self.ids, width), np.repeat(self.lengths, width)
        rest = (1 << LIMIT) - len(id_)
        return np.pad(id_, (0, rest)).astype("<u4"), np.pad(length, (0, rest)).astype(np.int64)


def pack(ids: np.ndarray, book: tuple[np.ndarray, np.ndarray]) -> tuple[bytes, bytes]:
    """Bits of ``ids``, and the offsets in bits of every ``STEP``-th of them."""
    code, length = book[0][ids], book[1][ids]
    ends = np.cumsum(length)
    starts = ends - length
    total = int(ends[-1]) if len(ends) else 0
    # A code of at most 16 bits lies in one or two 32-bit words; words add up, as bits do not overlap.
    word, shift = starts >> 5, (64 - (starts & 31) - length).astype(np.uint64)
    both = code << shift
    words = np.zeros((total >> 5) + 3, dtype=np.uint64)
    if len(ids):
        first = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
        at = word[first]
        words[at] += np.add.reduceat(both >> np.uint64(32), first)
        words[at + 1] += np.add.reduceat(both & np.uint64(0xFFFFFFFF), first)
    return words.astype(">u4").tobytes()[: (total + 7) // 8], starts[::STEP].astype("<u8").tobytes()


def unpack(bits: bytes, offsets: bytes, n: int, table: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The ``n`` ids of a block, all steps decoded side by side."""
    at = np.frombuffer(offsets, dtype="<u8").astype(np.int64)
    if not n:
        return np.zeros(0, dtype="<u4")
    data = np.frombuffer(bits + b"\0" * 8, dtype=np.uint8).astype(np.uint32)
    # The 24 bits from each byte on.
    three = (data[:-2] << 16) | (data[1:-1] << 8) | data[2:]
    out = np.zeros((len(at), STEP), dtype="<u4")
    last = len(three) - 1
    for k in range(STEP):
        live = len(at) if k < n - (len(at) - 1) * STEP else len(at) - 1
        here = at[:live]
        window = (three[np.minimum(here >> 3, last)] >> (24 - LIMIT - (here & 7)).astype(np.uint32)) & ((1 << LIMIT) - 1)
        out[:live, k] = table[0][window]
        at[:live] += table[1][window]
    return out.ravel()[:n]


def book_of(counts: DataFrame) -> Book:
    rows = counts.orderBy("id").collect()  # bounded by the vocabulary
    ids = np.asarray([r["id"] for r in rows], dtype=np.int64)
    return Book(ids, code_lengths(np.asarray([r["n"] for r in rows], dtype=np.int64)))


def encode(ids: DataFrame, book: Book, partitions: int, dtype: str) -> DataFrame:
    """Blocks of documents in ascending order; ``part`` orders the parts, ``block`` the blocks of a part."""
    shared = ids.sparkSession.sparkContext.broadcast(book)

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part, block = TaskContext.get().partitionId(), 0
        lookup, width = shared.value.lookup(), np.dtype(dtype).itemsize
        doc_ids: list = []
        values: list[bytes] = []
        size = first = 0

        def close() -> pd.DataFrame:
            joined = np.frombuffer(b"".join(values), dtype=dtype)
            bits, offsets = pack(joined, lookup)
            row = {
                "part": part, "block": block, "first": first, "n_tokens": len(joined), "doc_ids": list(doc_ids),
                "lengths": [len(v) // width for v in values], "offsets": offsets, "bits": bits,
            }
            return pd.DataFrame([row])

        for batch in batches:
            for doc_id, value in zip(batch["doc_id"], batch["ids"]):
                doc_ids.append(None if pd.isna(doc_id) else int(doc_id))
                values.append(value)
                size += len(value) // width
                if size >= BLOCK:
                    yield close()
                    block, first, size = block + 1, first + size, 0
                    doc_ids.clear()
                    values.clear()
        if values:
            yield close()

    # The ids come last in the order, so that rows of one doc_id have one order whatever the partitions.
    ordered = ids.repartitionByRange(partitions, "doc_id").sortWithinPartitions("doc_id", "ids")
    return ordered.mapInPandas(blocks, BLOCKS)


def part_starts(blocks: DataFrame) -> DataFrame:
    """``part, before``: tokens before each part, a prefix sum over one row per part."""
    parts = blocks.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))


def decode(blocks: DataFrame, book: Book) -> DataFrame:
    """``doc_id, start, ids`` of every document in the blocks."""
    return _read(blocks, book, "doc_id long, start long, ids binary", lambda ids: {"ids": ids.tobytes()})


def checksums(blocks: DataFrame, book: Book) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` from decoded blocks."""

    def sums(ids: np.ndarray) -> dict:
        return {"n_tokens": len(ids), "ids_crc32": zlib.crc32(ids.tobytes())}

    return _read(blocks, book, "doc_id long, start long, n_tokens long, ids_crc32 long", sums)


def _read(blocks: DataFrame, book: Book, schema: str, columns: Callable[[np.ndarray], dict]) -> DataFrame:
    shared = blocks.sparkSession.sparkContext.broadcast(book)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = shared.value.table()
        for batch in batches:
            for row in batch.itertuples(index=False):
                ids = unpack(row.bits, row.offsets, row.n_tokens, table)
                ends = np.cumsum(row.lengths)
                begin = ends - row.lengths
                found = [columns(ids[a:b]) for a, b in zip(begin, ends)]
                out = pd.DataFrame(found)
                out.insert(0, "doc_id", pd.array([None if pd.isna(x) else int(x) for x in row.doc_ids], dtype="Int64"))
                out.insert(1, "start", begin + row.first + row.before)
                yield out

    # As many rows as the files have parts, which is a number of partitions.
    placed = blocks.join(F.broadcast(part_starts(blocks)), "part")
    return placed.mapInPandas(read, schema)


def store(docs: DataFrame, path: str, end_id: int, partitions: int | None = None) -> tuple[DataFrame, Book]:
    """Encodes ``docs`` into written blocks; returns the blocks as read back, and the code book."""
    dtype = id_type(path)
    ids = written(token_ids(docs, path, end_id, dtype), "ids")
    book = book_of(id_counts(ids, dtype))
    partitions = partitions or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return written(encode(ids, book, partitions, dtype), "blocks"), book
