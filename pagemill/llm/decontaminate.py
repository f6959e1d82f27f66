"""Benchmark decontamination: one Aho-Corasick automaton over windows of the benchmark's words.

A window is ``size`` consecutive words of an item; an item of fewer words, but of at least one, is one
window. Words are compared after :func:`pagemill.llm.common.words`. The automaton holds every window with
its items; a document's words, joined by blanks, pass through it once, and each end of a match is led back
to the word it stands for, and from there to the original text.

The benchmark is taken in blocks of bounded bytes, one automaton each, so that neither the driver nor a task
holds more of it than that. With one block, the usual case, documents are not shuffled at all.

Null and empty texts have no words. Rows of ``docs`` are kept as they are, repeated ones too. An item whose
id is null cannot be named: its windows still mark words, but it is not listed. Repeated items count once.
An empty benchmark marks nothing. Columns other than those named take no part.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.llm.common import words, written

WINDOW = 10
# Bytes of windows in one automaton; it takes some sixty times that in memory.
BLOCK_BYTES = 4 * 1024 * 1024

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})

def windows(text: str | None, size: int = WINDOW) -> set[bytes]:
    w = words(text)
    if not w:
        return set()
    return {b" ".join(w[i : i + size]) for i in range(max(1, len(w) - size + 1))}


def _windows_udf(size: int):
    @F.pandas_udf("array<string>")
    def split(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [w.decode("utf-8", "surrogatepass") for w in sorted(windows(t, size))])

    return split


def window_table(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """``window, items``: each distinct window with the ids of the items that have it."""
    rows = benchmark.select(
        F.col("item_id").cast("string").alias("item"), F.explode(_windows_udf(size)("text")).alias("window")
    )
    # collect_set leaves null ids out.
    return rows.groupBy("window").agg(F.collect_set("item").alias("items"))


def blocks(table: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[list]:
    """The windows in blocks of about ``block_bytes``, cut by a hash; each is collected on its own."""
    size = table.agg(F.sum(F.octet_length("window") + 8 * F.size("items"))).first()[0] or 0
    n = max(1, -(-size // block_bytes))
    for block in range(n):
        yield table.where(F.pmod(F.xxhash64("window"), F.lit(n)) == block).collect()


def automaton(patterns: list[tuple[str, int, list[str]]]) -> ahocorasick.Automaton:
    """Of ``window, number of words, items``; blanks on both sides keep matches at word ends."""
    found = ahocorasick.Automaton()
    for window, n, items in patterns:
        found.add_word(f" {window} ", (n, items))
    found.make_automaton()
    return found


def occurrences(text: str | None, machine: ahocorasick.Automaton) -> tuple[int, list[tuple[int, int]], set[str]]:
    """Number of words, merged (first, past) word ranges inside windows, and the items that occur."""
    w = words(text)
    if not w:
        return 0, [], set()
    if not len(machine):
        return len(w), [], set()
    joined = (b" " + b" ".join(w) + b" ").decode("latin-1")
    matches = list(machine.iter(joined))
    if not matches:
        return len(w), [], set()
    items: set[str] = set()
    # A match ends at the blank after a word: the number of blanks before it is the number of words so far.
    ends = np.cumsum(np.fromiter(map(len, w), dtype=np.int64, count=len(w)) + 1)
    past = np.searchsorted(ends, [end for end, _ in matches]) + 1
    delta = np.zeros(len(w) + 1, dtype=np.int64)
    for p, (_, (n, of)) in zip(past, matches):
        delta[p - n] += 1
        delta[p] -= 1
        items.update(of)
    inside = np.cumsum(delta[:-1]) > 0
    edges = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).astype(np.int8)))
    return len(w), list(zip(edges[::2].tolist(), edges[1::2].tolist())), items


HIT = "n_words long, hits array<struct<first:int,past:int>>, items array<string>"


def with_hits(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with ``n_words, hits, items``; a hit is a range of word numbers. Columns of those names are replaced.

    With more than one block, rows are written between the passes, so that only one automaton is held at a time.
    """
    found = docs.drop("n_words", "hits", "items", "_hit").withColumn("_hit", F.expr(f"CAST(NULL AS STRUCT<{_struct()}>)"))
    for i, rows in enumerate(blocks(window_table(benchmark, size), block_bytes)):
        found = (written(found, "hits") if i else found).withColumn("_hit", _finder(docs, rows)("text", "_hit"))
    return found.select(*(c for c in found.columns if c != "_hit"), "_hit.*")


def hits(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id, text, n_words, hits, items`` of every row."""
    return with_hits(docs.select("doc_id", "text"), benchmark, size, block_bytes)


def _struct() -> str:
    return HIT.replace(" long", ":long", 1).replace(" array", ":array").replace(", ", ",")


def _finder(docs: DataFrame, rows: list):
    patterns = [(r["window"].encode().decode("latin-1"), r["window"].count(" ") + 1, r["items"]) for r in rows]
    shared = docs.sparkSession.sparkContext.broadcast(patterns)

    @F.pandas_udf(HIT)
    def find(parts: Iterator[tuple[pd.Series, pd.DataFrame]]) -> Iterator[pd.DataFrame]:
        machine = automaton(shared.value)
        for texts, known in parts:
            out = []
            for text, before, named in zip(texts, known["hits"], known["items"]):
                n, ranges, items = occurrences(text, machine)
                if before is not None:
                    ranges = merged([(r["first"], r["past"]) for r in before] + ranges)
                    items = {*items, *named}
                out.append((n, [{"first": a, "past": b} for a, b in ranges], sorted(items)))
            yield pd.DataFrame(out, columns=["n_words", "hits", "items"])

    return find


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, past in sorted(ranges):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(past, out[-1][1]))
        else:
            out.append((first, past))
    return out


def spans(text: str, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Word ranges as (start, end) code points of the original text."""
    at = [m.span() for m in _WORD.finditer(text.translate(_LOWER))]
    return [(at[first][0], at[past - 1][1]) for first, past in ranges]


def hit_spans(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id, items, spans``: where benchmark text stands in each document that holds some."""

    def locate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [
                [{"start": a, "end": b} for a, b in spans(text, [(r["first"], r["past"]) for r in ranges])]
                for text, ranges in zip(batch["text"], batch["hits"])
            ]
            yield batch[["doc_id", "items"]].assign(spans=found)

    hit = hits(docs, benchmark, size, block_bytes).where(F.size("hits") > 0)
    return hit.mapInPandas(locate, "doc_id long, items array<string>, spans array<struct<start:int,end:int>>")


def digest(found: DataFrame) -> DataFrame:
    """The hits of a document as numbers and a digest of its items."""
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, r: n + r["past"] - r["first"])
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )
