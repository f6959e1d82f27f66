"""Connected components of a graph of long ids.

Every task first replaces its edges, ``TOGETHER`` at a time, by stars of the same components. Where that was the
whole graph, it is done; else alternating large-star and small-star steps follow.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.llm.common import written

# Edges that a task holds at a time.
TOGETHER = 100_000


def _large_star(edges: DataFrame) -> DataFrame:
    """Links each larger neighbour of a vertex to the vertex's smallest neighbour, itself included."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Links a vertex and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    linked = down.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_003), F.sum("v")).first()
    return tuple(row)


def _stars(edges: pd.DataFrame) -> pd.DataFrame:
    """Each vertex with the smallest id it is connected to, roots left out."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := root.setdefault(x, x)) != x:
            root[x] = x = root[up]
        return x

    for u, v in zip(edges["u"].tolist(), edges["v"].tolist()):
        a, b = find(u), find(v)
        root[max(a, b)] = min(a, b)
    found = [(x, find(x)) for x in list(root)]
    return pd.DataFrame([(x, r) for x, r in found if x != r], columns=["u", "v"], dtype="int64")


def components(edges: DataFrame, together: int = TOGETHER) -> DataFrame:
    """``u, v`` pairs to ``id, root``: each vertex with the smallest id it is connected to. Roots are left out."""

    def contract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for batch in batches:
            for i in range(0, len(batch), together):
                part = batch.iloc[i : i + together]
                if held and sum(map(len, held)) + len(part) > together:
                    yield _stars(pd.concat(held))
                    held = []
                held.append(part)
        if held:
            yield _stars(pd.concat(held))

    edges = written(edges.where("u != v").select("u", "v").distinct(), "edges")
    tasks = max(1, -(-edges.count() // together))
    edges = written(edges.coalesce(tasks).mapInPandas(contract, "u long, v long"), "edges")
    before = _state(edges) if tasks > 1 else None
    while tasks > 1:
        edges = written(_small_star(written(_large_star(edges), "edges")), "edges")
        now = _state(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("id"), F.col("v").alias("root"))
