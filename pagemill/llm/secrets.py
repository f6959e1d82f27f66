"""Secret scans: fixed patterns, and strings that a character model takes for random rather than written.

Two first-order Markov chains over characters, one of random strings and one of ordinary text, are counted
from labelled samples. A string is reported if the log of the ratio of its likelihoods under the two is high
enough. Strings are runs of at least :data:`MIN_STRING` characters of :data:`ALPHABET`. In a string that fixed
patterns cover in part, only what they leave is judged, and the whole string is reported. Without samples at hand,
:func:`train` labels them itself: the values that the fixed patterns find are random, the rest of every text is
ordinary.

Null and empty texts have no spans. Rows are kept as they are, repeated ones too; columns other than
``doc_id`` and ``text`` take no part. An empty table gives an empty result, and a model of no samples knows
only its prior, under which both chains are alike and nothing is reported.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "random")

# Fixed patterns. Letters of the key words in either case, ASCII only; a value keeps its case.
_ASSIGN = re.compile(
    r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"[0-9a-f]{16,}")
_MIN_VALUE = 12

# Characters that strings of the models are made of; others end a string.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
SYMBOLS = len(ALPHABET) + 1  # 0 stands before the first character
_CODES = np.zeros(256, dtype=np.uint16)
for _i, _c in enumerate(ALPHABET):
    _CODES[ord(_c)] = _i + 1
# Shorter strings are not judged by the model.
MIN_STRING = 20
_STRING = re.compile(r"[A-Za-z0-9+/_=\-]{%d,}" % MIN_STRING)

MODEL_SCHEMA = "random boolean, before int, after int, n long"

# A string must be so many times likelier under the random chain, as a natural logarithm.
MIN_LOG_RATIO = 12.0
# Pseudo-counts of every transition.
PRIOR = 1.0


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """``start, end, kind`` of the fixed patterns, by start and then by the order of :data:`KINDS`."""
    found = []
    if ":" in text or "=" in text:
        # The shortest allowed value is tested after matching: a failing match still uses up its characters.
        found += [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if m.end(1) - m.start(1) >= _MIN_VALUE]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text)]
    found += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]
    found.sort(key=_order)
    return found


def _order(span: tuple[int, int, str]) -> tuple[int, int, int]:
    return span[0], KINDS.index(span[2]), span[1]


def transitions(text: str) -> np.ndarray:
    """Counts of character pairs in the text's strings, as one row of ``SYMBOLS * SYMBOLS``."""
    codes = _CODES[np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)]
    before = np.concatenate((codes[:0], np.zeros(1, np.uint16), codes[:-1])) if len(codes) else codes
    pairs = before * np.uint16(SYMBOLS) + codes
    return np.bincount(pairs[codes > 0], minlength=SYMBOLS * SYMBOLS)


def _rows(counts: dict[bool, np.ndarray]) -> pd.DataFrame:
    parts = []
    for random, n in counts.items():
        at = np.flatnonzero(n)
        parts.append(
            pd.DataFrame({"random": random, "before": (at // SYMBOLS).astype("int32"), "after": (at % SYMBOLS).astype("int32"), "n": n[at]})
        )
    return pd.concat(parts)


def _zero() -> dict[bool, np.ndarray]:
    return {kind: np.zeros(SYMBOLS * SYMBOLS, dtype=np.int64) for kind in (False, True)}


def _count_samples(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts = _zero()
    for batch in batches:
        for text, random in zip(batch["text"], batch["random"]):
            counts[bool(random)] += transitions(text)
    yield _rows(counts)


def _count_documents(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts = _zero()
    for batch in batches:
        for text in batch["text"]:
            if not text:
                continue
            ordinary, random, at = [], [], 0
            for start, end, kind in base_spans(text):
                # The same match again: nothing before its start takes part in it.
                first = _ASSIGN.match(text, start).start(1) if kind == "assign" else start
                random.append(text[first:end])
                ordinary.append(text[at : max(at, start)])
                at = max(at, end)
            ordinary.append(text[at:])
            counts[False] += transitions("\n".join(ordinary))
            if random:
                counts[True] += transitions("\n".join(random))
    yield _rows(counts)


def _summed(counts: DataFrame) -> DataFrame:
    return counts.groupBy("random", "before", "after").agg(F.sum("n").alias("n"))


def train(docs: DataFrame) -> DataFrame:
    """Transition counts of both chains over all of ``docs``; at most ``2 * SYMBOLS ** 2`` rows."""
    texts = docs.select("text").where(F.col("text").isNotNull())
    return _summed(texts.mapInPandas(_count_documents, MODEL_SCHEMA))


def train_on(samples: DataFrame) -> DataFrame:
    """Transition counts from ``text, random``: strings, or texts of strings, with their label."""
    known = samples.select("text", "random").where(F.col("text").isNotNull() & F.col("random").isNotNull())
    return _summed(known.mapInPandas(_count_samples, MODEL_SCHEMA))


def log_ratios(model: DataFrame) -> np.ndarray:
    """Log-likelihood ratio of every transition, random against ordinary."""
    n = {kind: np.full((SYMBOLS, SYMBOLS), PRIOR) for kind in (False, True)}
    for row in model.collect():  # bounded by the alphabet
        n[row["random"]][row["before"], row["after"]] += row["n"]
    for counts in n.values():
        counts[:, 0] = 0
    likely = {kind: np.log(np.maximum(c, 1e-300) / c.sum(axis=1, keepdims=True)) for kind, c in n.items()}
    ratio = likely[True] - likely[False]
    ratio[:, 0] = 0
    return ratio.ravel()


def random_spans(text: str, taken: list[tuple[int, int, str]], ratios: np.ndarray, least: float) -> list[tuple[int, int, str]]:
    """Strings whose characters outside the spans of ``taken``, which are in order of their starts, look random."""
    found, covers, at = [], merged(taken), 0
    for m in _STRING.finditer(text):
        start, end = m.span()
        while at < len(covers) and covers[at][1] <= start:
            at += 1
        codes = _CODES[np.frombuffer(m.group().encode(), dtype=np.uint8)].astype(np.int64)
        pairs = np.concatenate(([0], codes[:-1])) * SYMBOLS + codes
        score = ratios[pairs]
        # A span may reach into the next string, so ``at`` stays on the last one that begins here.
        while at < len(covers) and covers[at][0] < end:
            score[max(0, covers[at][0] - start) : covers[at][1] - start] = 0
            if covers[at][1] > end:
                break
            at += 1
        if score.sum() >= least:
            found.append((start, end, "random"))
    return found


def merged(spans: list[tuple[int, int, str]]) -> list[tuple[int, int]]:
    """Stretches that spans, in order of their starts, cover together."""
    out: list[tuple[int, int]] = []
    for start, end, _ in spans:
        if out and start <= out[-1][1]:
            out[-1] = out[-1][0], max(end, out[-1][1])
        else:
            out.append((start, end))
    return out


def all_spans(text: str | None, ratios: np.ndarray, least: float = MIN_LOG_RATIO) -> list[tuple[int, int, str]]:
    if not text:
        return []
    base = base_spans(text)
    more = random_spans(text, base, ratios, least)
    return sorted(base + more, key=_order) if more else base


def scan(docs: DataFrame, model: DataFrame, min_log_ratio: float = MIN_LOG_RATIO) -> DataFrame:
    """``doc_id`` and ``found``: an array of (start, end, kind) in code points, end exclusive."""
    shared = docs.sparkSession.sparkContext.broadcast(log_ratios(model))

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            spans = [
                [{"start": s, "end": e, "kind": k} for s, e, k in all_spans(text, shared.value, min_log_ratio)]
                for text in batch["text"]
            ]
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "found": spans})

    return docs.select("doc_id", "text").mapInPandas(find, "doc_id long, found array<struct<start:int,end:int,kind:string>>")


def redact(docs: DataFrame, model: DataFrame, mark: str = "[secret]", min_log_ratio: float = MIN_LOG_RATIO) -> DataFrame:
    """``docs`` with every span replaced by ``mark``; overlapping spans become one. Other columns stay."""
    shared = docs.sparkSession.sparkContext.broadcast(log_ratios(model))

    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        return texts.map(lambda text: covered(text, all_spans(text, shared.value, min_log_ratio), mark))

    return docs.withColumn("text", clean("text"))


def covered(text: str | None, spans: list[tuple[int, int, str]], mark: str) -> str | None:
    if not spans:
        return text
    out, at = [], 0
    for start, end, _ in spans:
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    out.append(text[at:])
    return "".join(out)


def digest(found: DataFrame) -> DataFrame:
    """Counts by kind, a digest of the base spans, and all spans as text."""

    def joined(column):
        parts = F.transform(column, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string")))
        return F.array_join(parts, ",")

    def count(kind: str):
        return F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("found", lambda x: x["kind"] != "random")
    return found.select(
        "doc_id",
        count("assign"),
        count("access"),
        count("hex"),
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("found")).alias("spans"),
        count("random"),
    )


def span_digest(spans: list[tuple[int, int, str]]) -> str:
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for s, e, k in spans).encode()).hexdigest()
