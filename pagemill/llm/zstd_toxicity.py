"""Toxicity by compression distance: two zstandard dictionaries, and how much shorter one makes a text's windows.

The ordinary dictionary is trained on windows of ordinary text. The toxic one is trained on those stretches of
toxic texts whose character n-grams set them apart, and stands behind the ordinary content, so that a window
that holds nothing toxic compresses alike under both. Windows of ``WINDOW`` words are measured whole and in parts of
``PART`` words. How many windows gain how many bytes goes into a logistic regression that is fitted on labelled rows
kept from the dictionaries: it sets the thresholds.

The toxic dictionary is not trained on whole toxic texts: toxic words are a few among hundreds there, and with
dictionaries of all windows the lengths hardly tell the classes apart (README has figures).

Dictionaries and thresholds are fitted on a bounded sample, ``PER_CLASS`` rows of either label and ``MAX_CHARS``
characters each; every window of every text is scored. Null and empty texts have no windows. Rows are kept as
they are, repeated ones too. Without enough toxic text for a dictionary, or without labels of both kinds, every
score is the share of label 1, one half if there are no labels. Columns other than those named take no part.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.llm import logistic
from pagemill.llm.common import base_rate, known_labels, labelled_sample

PER_CLASS = 2_500
MAX_CHARS = 200_000
# Of the sample, by turns of the id's hash: so many of ten parts train dictionaries, the others thresholds.
FOR_DICTIONARIES = 5
THRESHOLD = 0.3

WINDOW = 12
PART = 4
MAX_WINDOW_BYTES = 512
ORDINARY_BYTES = 65_536
TOXIC_BYTES = 4_096
GRAM = 8
LEAST_DOCS = 5
LEAST_RATIO = 8.0

# Levels at which windows and their parts are measured.
WHOLE, PARTS = 6, 13
# Gains that a worker keeps for each level: copies and common passages are not measured again.
KNOWN = 400_000
WINDOW_GAINS = range(1, 10)
PART_GAINS = range(1, 7)


def windows(text: str | None, size: int = WINDOW) -> list[bytes]:
    """The text in windows of ``size`` words, each with a blank before every word; overlong ones in pieces."""
    words = text.split() if text else []
    out = []
    for i in range(0, len(words), size):
        window = (" " + " ".join(words[i : i + size])).encode("utf-8", "surrogatepass")
        if len(window) <= MAX_WINDOW_BYTES:
            out.append(window)
        else:
            out += [window[j : j + MAX_WINDOW_BYTES] for j in range(0, len(window), MAX_WINDOW_BYTES)]
    return out


def parts_of(window: bytes) -> list[bytes]:
    """A window in parts of ``PART`` words, each with a blank before every word."""
    words = window.split(b" ")[1:] if window.startswith(b" ") else window.split(b" ")
    return [b" " + b" ".join(words[i : i + PART]) for i in range(0, len(words), PART)]


def _grams(word: str) -> list[str]:
    word = " " + word
    return [word[i : i + GRAM] for i in range(max(1, len(word) - GRAM + 1))]


def _document_counts(texts: list[str]) -> Counter:
    counts: Counter = Counter()
    for text in texts:
        counts.update({g for word in set(text.split()) for g in _grams(word)})
    return counts


def toxic_stretches(toxic: list[str], ordinary: list[str]) -> list[bytes]:
    """Stretches of toxic words made of n-grams that many toxic and hardly any ordinary texts have."""
    there, elsewhere = _document_counts(toxic), _document_counts(ordinary)
    telling = {
        g
        for g, n in there.items()
        if n >= LEAST_DOCS and (n / len(toxic)) >= LEAST_RATIO * (elsewhere[g] + 0.5) / max(1, len(ordinary))
    }
    out = []
    for text in toxic:
        for word in text.split():
            grams = _grams(word)
            inside = [g in telling for g in grams]
            if any(inside):
                covered = np.convolve(inside, np.ones(GRAM)) > 0
                kept = "".join(c if keep else "\0" for c, keep in zip(" " + word, covered))
                out += [x.encode("utf-8", "surrogatepass") for x in kept.split("\0") if x]
    return out


def train_dictionary(samples: list[bytes], size: int) -> bytes:
    """A trained dictionary of at most ``size`` bytes; of less where there is little to train on, or none."""
    while size >= 256 and len(samples) >= 16:
        try:
            return zstandard.train_dictionary(size, samples).as_bytes()
        except zstandard.ZstdError:
            size //= 2
    return b""


class Compressors:
    """Compressed lengths of windows under both dictionaries; built in the process that uses it."""

    def __init__(self, ordinary: bytes, toxic: bytes) -> None:
        self.pairs = {
            level: (self._compressor(ordinary, level), self._compressor(ordinary + toxic, level))
            for level in (WHOLE, PARTS)
        }
        self._known: dict[int, dict[bytes, int]] = {WHOLE: {}, PARTS: {}}

    @staticmethod
    def _compressor(content: bytes, level: int) -> zstandard.ZstdCompressor:
        settings = zstandard.ZstdCompressionParameters.from_level(
            level,
            source_size=64,
            dict_size=len(content),
            format=zstandard.FORMAT_ZSTD1_MAGICLESS,
            write_checksum=0,
            write_content_size=0,
            write_dict_id=0,
        )
        known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        known.precompute_compress(compression_params=settings)
        return zstandard.ZstdCompressor(dict_data=known, compression_params=settings)

    def gain(self, window: bytes, level: int) -> int:
        """Bytes that the toxic dictionary saves."""
        ordinary, toxic = self.pairs[level]
        return len(ordinary.compress(window)) - len(toxic.compress(window))

    def known_gain(self, piece: bytes, level: int) -> int:
        """:meth:`gain`, measured once for what comes again."""
        known = self._known[level]
        gain = known.get(piece)
        if gain is None:
            if len(known) >= KNOWN:
                known.clear()
            gain = known[piece] = self.gain(piece, level)
        return gain

    def figures(self, text: str | None) -> np.ndarray:
        """Logarithms of the numbers of windows and parts that gain so much, and of all windows."""
        whole = np.zeros(len(WINDOW_GAINS) + 1)
        parts = np.zeros(len(PART_GAINS) + 1)
        all_windows = windows(text)
        for window in all_windows:
            whole[max(0, min(self.known_gain(window, WHOLE), len(WINDOW_GAINS)))] += 1
            for part in parts_of(window):
                parts[max(0, min(self.known_gain(part, PARTS), len(PART_GAINS)))] += 1
        at_least = np.concatenate([np.cumsum(x[::-1])[::-1][1:] for x in (whole, parts)])
        return np.log1p(np.append(at_least, len(all_windows)))


_compressors: dict[tuple[bytes, bytes], Compressors] = {}


def shared_compressors(model: Model) -> Compressors:
    """Those of the model that the worker uses; one at a time, for all its tasks."""
    key = model.ordinary, model.toxic
    if key not in _compressors:
        _compressors.clear()
        _compressors[key] = Compressors(*key)
    return _compressors[key]


@dataclass
class Model:
    ordinary: bytes
    toxic: bytes
    probability: logistic.Logistic

    def scores(self, texts: list[str | None], compressors: Compressors) -> np.ndarray:
        return self.probability(np.asarray([compressors.figures(t) for t in texts]).reshape(len(texts), -1))


def fit(sample: pd.DataFrame, rate: float) -> Model:
    """From ``doc_id, text, label`` of the sample; ``rate`` is the share of label 1 in all labels."""
    sample = sample.sort_values("doc_id", kind="stable").reset_index(drop=True)
    turn = pd.util.hash_array(sample["doc_id"].to_numpy(dtype=np.int64)) % 10
    first = turn < FOR_DICTIONARIES
    texts = [t if isinstance(t, str) else "" for t in sample["text"]]
    labels = sample["label"].to_numpy(dtype=np.int64)

    def chosen(label: int) -> list[str]:
        return [texts[i] for i in np.flatnonzero(first & (labels == label))]

    toxic, ordinary = chosen(1), chosen(0)
    model = Model(b"", b"", logistic.fit(np.zeros((0, _FIGURES)), np.zeros(0), rate))
    if not toxic or not ordinary:
        return model
    stretches = toxic_stretches(toxic, ordinary)
    # Eight stretches make one sample: the trainer wants samples longer than a word.
    joined = [b"".join(stretches[i : i + 8]) for i in range(0, len(stretches), 8)]
    model.toxic = train_dictionary(joined, TOXIC_BYTES)
    if not model.toxic:
        # Too little for the trainer: what there is, once each.
        model.toxic = b"".join(dict.fromkeys(stretches))[-TOXIC_BYTES:]
    if not model.toxic:
        return model
    passages = [w for t in ordinary[: len(toxic) * 2] for w in windows(t, 80)]
    model.ordinary = train_dictionary(passages, ORDINARY_BYTES) or b"".join(passages)[-ORDINARY_BYTES:]
    compressors = Compressors(model.ordinary, model.toxic)
    rest = np.flatnonzero(~first)
    if len(rest):
        figures = np.asarray([compressors.figures(texts[i]) for i in rest])
        model.probability = logistic.fit(figures, labels[rest], rate)
    return model


_FIGURES = len(WINDOW_GAINS) + len(PART_GAINS) + 1


def train(docs: DataFrame, labels: DataFrame, usable: Column, label: str = "toxic", per_class: int = PER_CLASS, max_chars: int = MAX_CHARS) -> Model:
    """Fits dictionaries and thresholds to labels where ``usable`` (a test on ``doc_id``) holds."""
    known = known_labels(labels, label, usable)
    return fit(labelled_sample(docs, known, per_class, max_chars).toPandas(), base_rate(known))


def with_score(docs: DataFrame, model: Model, column: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        one = shared.value
        if not one.toxic:
            for texts in parts:
                yield pd.Series(np.full(len(texts), float(one.probability(np.zeros((1, _FIGURES)))[0])))
            return
        compressors = shared_compressors(one)
        for texts in parts:
            yield pd.Series(one.scores(list(texts), compressors))

    return docs.withColumn(column, score("text"))
