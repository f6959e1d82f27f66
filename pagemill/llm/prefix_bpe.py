"""Byte-level BPE by prefix dynamic programming.

Merging the lowest rank first gives every byte string one encoding, and the encoding of a prefix that ends at a
token border is a prefix of the encoding. So each prefix of a piece has exactly one valid last token: the token
``t`` that ends there and that may follow the valid last token of the prefix before ``t``. Two tokens may follow
each other if encoding their joined bytes gives just these two. The table of last tokens is filled from left to
right, read from right to left, goes on where bytes are appended, and stays right up to an edit.

A text is cut by the tokenizer's pattern and each match is encoded separately, as the vocabulary's library does.

Null texts are empty, empty texts have no tokens. Rows are kept as they are, repeated ones too; columns other
than ``doc_id`` and ``text`` take no part in :func:`digest` and stay in :func:`with_tokens`.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Distinct runs of text whose ids a worker keeps at a time, and the longest run it keeps.
CACHE = 700_000
CACHED_LENGTH = 64
# Pairs of tokens that are known to follow each other or not.
PAIRS = 500_000
_NEVER = 1 << 62
_SHORT = (2, 1)

# A blank with the characters after it, or white space that the pattern takes by itself.
_RUN = re.compile(r" ?\S+|\s+(?!\S)|\s")
# Where Python and the pattern's library may differ on white space.
_ODD = re.compile("[\x1c-\x1f]")

DIGEST = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


class Vocabulary:
    """Ranks of byte strings; encodes pieces, decodes ids."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.tokens = {i: token for token, i in ranks.items()}
        self.lengths = {i: len(token) for token, i in ranks.items()}
        self.longest = max(map(len, ranks))
        # Sizes of the tokens that end in three given bytes, from the longest down; others have at most two bytes.
        sizes: dict[bytes, set[int]] = {}
        for token in ranks:
            if len(token) > 2:
                sizes.setdefault(token[-3:], set()).add(len(token))
        self.sizes = {tail: (*sorted(found, reverse=True), 2, 1) for tail, found in sizes.items()}
        self._follow: dict[int, bool] = {}
        self._whole: dict[int, bool] = {}
        self._edges: dict[int, tuple[list, list]] = {}

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        with open(path, "rb") as lines:
            return cls({base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())})

    def merged(self, data: bytes) -> list[int]:
        """The encoding by its definition: merge the leftmost pair of lowest rank until none is left."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                rank = self.ranks.get(parts[i] + parts[i + 1])
                if rank is not None and (best is None or rank < best):
                    best, at = rank, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def whole(self, token: int) -> bool:
        """Whether the token's own bytes encode as the token."""
        known = self._whole.get(token)
        if known is None:
            known = self._whole[token] = self.merged(self.tokens[token]) == [token]
        return known

    def edges(self, token: int) -> tuple[list, list]:
        """What stands at the left and at the right edge while the token's bytes merge.

        Each as ``bytes, rank at which it merges into the next``, from one byte to the token itself. Ranks grow
        along an edge, as a token is merged from tokens of lower rank.
        """
        known = self._edges.get(token)
        if known is None:
            data = self.tokens[token]
            if len(data) == 1:
                known = [(data, _NEVER)], [(data, _NEVER)]
            else:
                first, second = self._halves(token)
                (left, _), (_, right) = self.edges(first), self.edges(second)
                known = (
                    [*left[:-1], (self.tokens[first], token), (data, _NEVER)],
                    [*right[:-1], (self.tokens[second], token), (data, _NEVER)],
                )
            self._edges[token] = known
        return known

    def _halves(self, token: int) -> tuple[int, int]:
        """The two tokens whose merge makes ``token``."""
        data = self.tokens[token]
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 2:
            ranks = [self.ranks.get(a + b, _NEVER) for a, b in zip(parts, parts[1:])]
            at = min(range(len(ranks)), key=ranks.__getitem__)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return self.ranks[parts[0]], self.ranks[parts[1]]

    def follows(self, left: int, right: int) -> bool:
        """Whether nothing merges across the border while both sides merge by themselves."""
        key = left << 32 | right
        known = self._follow.get(key)
        if known is None:
            if len(self._follow) >= PAIRS:
                self._follow.clear()
            known = self._follow[key] = self._stays(self.edges(left)[1], self.edges(right)[0])
        return known

    def _stays(self, ends: list, starts: list) -> bool:
        i = j = 0
        while True:
            (a, until_a), (b, until_b) = ends[i], starts[j]
            rank = self.ranks.get(a + b)
            # Of equal ranks the leftmost pair merges first.
            if rank is not None and rank < until_a and rank <= until_b:
                return False
            if until_a == until_b == _NEVER:
                return True
            if until_a <= until_b:
                i += 1
            else:
                j += 1

    def encode(self, piece: bytes) -> list[int]:
        """Ids of one piece. A piece that is a token is that token."""
        own = self.ranks.get(piece)
        if own is not None:
            return [own]
        last: list[int] = []
        self.fill(piece, last, len(piece))
        return self.read(piece, last)

    def fill(self, data: bytes, last: list[int], stop: int) -> None:
        """Appends the valid last tokens of ``data``'s prefixes to ``last``, up to the prefix of ``stop`` bytes."""
        rank_of, follow, sizes = self.ranks.get, self._follow, self.sizes.get
        for end in range(len(last) + 1, stop + 1):
            for size in sizes(data[end - 3 : end], _SHORT) if end > 2 else _SHORT:
                begin = end - size
                if begin < 0:
                    continue
                token = rank_of(data[begin:end])
                if token is None:
                    continue
                if begin:
                    before = last[begin - 1]
                    fits = follow.get(before << 32 | token)
                    if fits or fits is None and self.follows(before, token):
                        last.append(token)
                        break
                elif self.whole(token):
                    last.append(token)
                    break
            else:
                raise ValueError("a byte of the text has no token")

    def read(self, data: bytes, last: list[int]) -> list[int]:
        """The encoding, read from right to left."""
        out, at = [], len(data)
        while at:
            token = last[at - 1]
            out.append(token)
            at -= self.lengths[token]
        return out[::-1]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


class Prefixes:
    """The valid last token of every prefix of a growing byte string."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.data = b""
        self.last: list[int] = []

    def append(self, more: bytes) -> None:
        self.data += more
        self.vocabulary.fill(self.data, self.last, len(self.data))

    def replace(self, start: int, end: int, new: bytes) -> int:
        """Puts ``new`` in place of ``data[start:end]``; returns how many prefixes were computed anew.

        Prefixes up to ``start`` keep their tokens. Behind the edit a prefix depends on the bytes and tokens of
        the ``longest`` positions before it only: once that many agree with the old ones, the rest does too.
        """
        rest, old = self.data[end:], self.last[end:]
        self.data = self.data[:start] + new + rest
        self.last = self.last[:start]
        behind, agree, done = start + len(new), 0, 0
        for at in range(start + 1, len(self.data) + 1):
            self.vocabulary.fill(self.data, self.last, at)
            done += 1
            if at > behind:
                agree = agree + 1 if self.last[-1] == old[at - behind - 1] else 0
                if agree >= self.vocabulary.longest:
                    self.last += old[at - behind :]
                    break
        return done

    def ids(self) -> list[int]:
        return self.vocabulary.read(self.data, self.last)


class Runs(dict):
    """Ids by run of characters. Runs of the generation before stay at hand, so that frequent ones are kept."""

    def __init__(self, encode, most: int) -> None:
        super().__init__()
        self.encode, self.most, self.before = encode, most, {}

    def __missing__(self, run: str) -> bytes:
        ids = self.before.get(run)
        if ids is None:
            ids = self.encode(run)
        if len(run) <= CACHED_LENGTH:
            if len(self) >= self.most:
                self.before = dict(self)
                self.clear()
            self[run] = ids
        return ids


class TextEncoder:
    """Encodes texts, by runs of characters that come again and again."""

    def __init__(self, vocabulary: Vocabulary, pattern: str) -> None:
        self.vocabulary = vocabulary
        self.pattern = regex.compile(pattern)
        self.runs = Runs(self._run, CACHE)

    def pieces(self, text: str) -> list[str]:
        return [m.group() for m in self.pattern.finditer(text)]

    def _run(self, run: str) -> bytes:
        encode = self.vocabulary.encode
        ids = array("I")
        for piece in self.pieces(run):
            ids.extend(encode(piece.encode("utf-8", "surrogatepass")))
        return ids.tobytes()

    def encode(self, text: str | None) -> np.ndarray:
        """All ids of a text. Matches of the pattern never cross the borders of the runs it is cut into first."""
        if not text:
            return np.zeros(0, dtype="<u4")
        if _ODD.search(text):
            return np.frombuffer(self._run(text), dtype="<u4")
        return np.frombuffer(b"".join(map(self.runs.__getitem__, _RUN.findall(text))), dtype="<u4")


class EncodedText:
    """A text with the ids of its pieces, for appends and edits that encode only what changes."""

    def __init__(self, encoder: TextEncoder, text: str = "") -> None:
        self.encoder, self.text = encoder, ""
        self.starts: list[int] = []
        self.piece_ids: list[list[int]] = []
        self.replace(0, 0, text)

    def append(self, more: str) -> int:
        return self.replace(len(self.text), len(self.text), more)

    def replace(self, start: int, end: int, new: str) -> int:
        """Puts ``new`` in place of ``text[start:end]``; returns how many pieces were encoded anew.

        A match may depend on up to three characters behind it, so cutting starts two pieces before the one
        that touches the edit, and ends where a border behind the edit falls on an old one: the pattern does
        not look back, so all borders behind are the old ones.
        """
        shift = len(new) - (end - start)
        text = self.text[:start] + new + self.text[end:]
        keep = max(0, bisect_left(self.starts, start) - 3)
        at = self.starts[keep] if keep < len(self.starts) else 0
        starts, ids, done = [], [], 0
        resume = len(self.starts)
        for m in self.encoder.pattern.finditer(text, at):
            if m.start() >= start + len(new):
                old = bisect_right(self.starts, m.start() - shift) - 1
                if old >= 0 and self.starts[old] == m.start() - shift and self.starts[old] >= end:
                    resume = old
                    break
            starts.append(m.start())
            ids.append(self.encoder.vocabulary.encode(m.group().encode("utf-8", "surrogatepass")))
            done += 1
        self.starts = self.starts[:keep] + starts + [s + shift for s in self.starts[resume:]]
        self.piece_ids = self.piece_ids[:keep] + ids + self.piece_ids[resume:]
        self.text = text
        return done

    def ids(self) -> list[int]:
        return [i for piece in self.piece_ids for i in piece]


_encoders: dict[tuple[str, str], TextEncoder] = {}


def encoder(path: str, pattern: str) -> TextEncoder:
    """One encoder per worker process; its caches serve all tasks that run there."""
    if (path, pattern) not in _encoders:
        _encoders[path, pattern] = TextEncoder(Vocabulary.load(path), pattern)
    return _encoders[path, pattern]


def with_tokens(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``docs`` with ``ids`` and ``n_tokens``; columns of those names are replaced."""

    @F.pandas_udf("array<int>")
    def ids(texts: pd.Series) -> pd.Series:
        one = encoder(path, pattern)
        return texts.map(lambda t: one.encode(t).astype(np.int32), na_action=None)

    return docs.withColumn("ids", ids("text")).withColumn("n_tokens", F.size("ids").cast("long"))


def decoded(tokens: DataFrame, path: str, pattern: str) -> DataFrame:
    """``tokens`` with ``decoded``, the bytes that its ``ids`` stand for."""

    @F.pandas_udf("binary")
    def decode(ids: pd.Series) -> pd.Series:
        vocabulary = encoder(path, pattern).vocabulary
        return ids.map(lambda i: None if i is None else vocabulary.decode(i.tolist()))

    return tokens.withColumn("decoded", decode("ids"))


def digest(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Encodes, then decodes the ids, and reports digests of both."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        one = encoder(path, pattern)
        names = {i: str(i) for i in one.vocabulary.tokens}
        for batch in batches:
            rows = []
            for text in batch["text"]:
                ids = one.encode(text).tolist()
                line = " ".join(map(names.__getitem__, ids)).encode()
                back = one.vocabulary.decode(ids)
                rows.append((len(ids), hashlib.sha256(line).hexdigest(), hashlib.sha256(back).hexdigest()))
            out = pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])
            out.insert(0, "doc_id", batch["doc_id"].astype("Int64").to_numpy())
            yield out

    return docs.select("doc_id", "text").mapInPandas(work, DIGEST)
