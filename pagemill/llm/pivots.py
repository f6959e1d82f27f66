"""Approximate nearest neighbours by a permutation index.

A vector is represented by its nearest pivots in order of distance. The index is cut into blocks of vectors; a
block holds an inverted file that posts each vector, with the position it gives the pivot, under each of its
``prefix`` nearest pivots. A query adds up footrule distances over the lists of its own pivots (a pivot missing
on one side counts as if it stood behind the last position), keeps the best ``share`` of a block, and measures
those exactly on the original vectors in double precision.

Pivots are drawn by a hash from all vectors, as many as ``pivots`` says: a bounded sample. Every vector is
indexed. Queries come in groups of bounded size, each against all blocks. Between blocks only each task's best
``k`` per query pass on.

Vectors that are null or zero, that hold null or non-finite components, that have no id, or whose length is not
the table's most frequent one (the smaller of equally frequent ones) take no part. Equal distances go to the
smaller id. A row is never its own neighbour; other rows with its id are candidates like any. A query id that repeats
is asked once, with the smallest of its vectors. An empty table gives an empty result. Columns other than id and vector take no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagemill.llm.common import written

PIVOTS = 256
PREFIX = 64
BLOCK = 8192
# Measured on original vectors: this share of a block, and at least so many vectors.
SHARE = 0.12
LEAST = 512
# Queries in one group; with 64 doubles each, half a megabyte.
GROUP = 1024

INDEX = "vec_ids binary, vectors binary, pivot_starts binary, posted binary, positions binary"
FOUND = "query_id long, vec_id long, score double"
RESULT = "query_id long, rank int, vec_id long, score double"


def usable(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``vec_id, v``: vectors that take part, as arrays of doubles of one length."""
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("v"))

    def bad(x: Column) -> Column:
        return x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))

    rows = rows.where(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull() & ~F.exists("v", bad) & F.exists("v", lambda x: x != 0)
    )
    sizes = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").head(1)
    return rows.where(F.size("v") == (sizes[0]["d"] if sizes else -1))


def draw_pivots(vectors: DataFrame, pivots: int = PIVOTS) -> np.ndarray:
    """Different vectors, those with the smallest hashes; at most ``pivots``."""
    # A vector that repeats very often must not fill the draw: equal vectors count once.
    rows = vectors.groupBy(F.xxhash64("v").alias("h")).agg(F.first("v").alias("v")).orderBy("h").limit(pivots).collect()
    return np.asarray(sorted(r["v"] for r in rows), dtype=np.float64)


def permutations(vectors: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """The ``prefix`` nearest pivots of each vector in order; equal distances by pivot number."""
    far = (pivots**2).sum(axis=1) - 2.0 * vectors @ pivots.T
    return np.argsort(far, axis=1, kind="stable")[:, :prefix].astype(np.uint16)


def _matrix(values: pd.Series) -> np.ndarray:
    return np.asarray(values.tolist(), dtype=np.float64)


def build(vectors: DataFrame, pivots: np.ndarray, prefix: int = PREFIX, block: int = BLOCK) -> DataFrame:
    """The index: a row per block, its vectors in ascending order of their ids with an inverted file."""
    shared = vectors.sparkSession.sparkContext.broadcast(pivots)

    def index(ids: np.ndarray, x: np.ndarray) -> pd.DataFrame:
        order = np.argsort(ids, kind="stable")
        ids, x = ids[order], x[order]
        near = permutations(x, shared.value, prefix)
        flat = near.ravel()
        by_pivot = np.argsort(flat, kind="stable")
        starts = np.searchsorted(flat[by_pivot], np.arange(len(shared.value) + 1))
        return pd.DataFrame(
            [
                {
                    "vec_ids": ids.astype("<i8").tobytes(),
                    "vectors": x.astype("<f8").tobytes(),
                    "pivot_starts": starts.astype("<i8").tobytes(),
                    "posted": (by_pivot // near.shape[1]).astype("<u4").tobytes(),
                    "positions": (by_pivot % near.shape[1]).astype("<u2").tobytes(),
                }
            ]
        )

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, parts, n = [], [], 0
        for batch in batches:
            if not len(batch):
                continue
            ids.append(batch["vec_id"].to_numpy(dtype=np.int64))
            parts.append(_matrix(batch["v"]))
            n += len(batch)
            while n >= block:
                all_ids, x = np.concatenate(ids), np.concatenate(parts)
                yield index(all_ids[:block], x[:block])
                ids, parts, n = [all_ids[block:]], [x[block:]], n - block
        if n:
            yield index(np.concatenate(ids), np.concatenate(parts))

    return vectors.mapInPandas(blocks, INDEX)


def footrules(near: np.ndarray, starts: np.ndarray, posted: np.ndarray, positions: np.ndarray, n: int) -> np.ndarray:
    """Footrule distance of a query's pivots to each of a block's ``n`` vectors, over the inverted lists."""
    prefix = len(near)
    # Both sides miss every pivot at first: each position counts its way to behind the last.
    total = np.full(n, prefix * (prefix + 1), dtype=np.int64)
    for at, pivot in enumerate(near):
        rows = posted[starts[pivot] : starts[pivot + 1]]
        there = positions[starts[pivot] : starts[pivot + 1]].astype(np.int64)
        # A vector stands at most once in a list.
        total[rows] += np.abs(there - at) - (prefix - at) - (prefix - there)
    return total


def nearest(
    index: DataFrame,
    queries: DataFrame,
    pivots: np.ndarray,
    k: int = 10,
    prefix: int = PREFIX,
    share: float = SHARE,
    least: int = LEAST,
    group: int = GROUP,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found of each query, as ``vec_id, v`` rows."""
    spark = index.sparkSession
    asked = queries.groupBy("vec_id").agg(F.min("v").alias("v"))
    groups = -(-asked.count() // group)
    asked = asked.withColumn("g", F.pmod(F.xxhash64("vec_id"), F.lit(max(1, groups))))
    # The row that asks is found like the others and taken out at the end: so one more is looked for.
    found = None
    for g in range(max(1, groups)):
        rows = asked.where(F.col("g") == g).orderBy("vec_id").collect()  # about ``group`` of them
        if not rows:
            continue
        ids = np.asarray([r["vec_id"] for r in rows], dtype=np.int64)
        x = np.asarray([r["v"] for r in rows], dtype=np.float64)
        part = index.mapInPandas(_search(spark.sparkContext.broadcast((ids, x, pivots)), k + 1, prefix, share, least), FOUND)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], RESULT)
    # At most ``k + 1`` rows per query and task. Rows of the query's id at no distance are all alike: any one is its own.
    alike = Window.partitionBy("query_id", "vec_id", "score").orderBy("vec_id")
    own = (F.col("vec_id") == F.col("query_id")) & (F.col("score") == 0) & (F.col("copy") == 1)
    found = found.withColumn("copy", F.row_number().over(alike)).where(~own)
    by = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _search(shared, k: int, prefix: int, share: float, least: int):
    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        query_ids, q, pivots = shared.value
        near = permutations(q, pivots, prefix)
        best: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0))] * len(query_ids)
        for batch in batches:
            for row in batch.itertuples(index=False):
                ids = np.frombuffer(row.vec_ids, dtype="<i8")
                x = np.frombuffer(row.vectors, dtype="<f8").reshape(len(ids), -1)
                lists = (
                    np.frombuffer(row.pivot_starts, dtype="<i8"),
                    np.frombuffer(row.posted, dtype="<u4"),
                    np.frombuffer(row.positions, dtype="<u2"),
                )
                keep = max(least, int(len(ids) * share))
                for i, query in enumerate(query_ids):
                    same = np.flatnonzero(ids == query)
                    own = same[(x[same] == q[i]).all(axis=1)][:1]
                    far = footrules(near[i], *lists, len(ids))
                    # Ids ascend within a block, so that equal ranks go to the smaller id.
                    order = far * len(ids) + np.arange(len(ids))
                    order[own] = -1
                    measured = keep + len(own)
                    rows = np.argpartition(order, measured)[:measured] if measured < len(ids) else np.arange(len(ids))
                    score = np.sqrt(((x[rows] - q[i]) ** 2).sum(axis=1))
                    score, names = np.concatenate((best[i][1], score)), np.concatenate((best[i][0], ids[rows]))
                    top = np.lexsort((names, score))[:k]
                    best[i] = names[top], score[top]
        yield pd.DataFrame(
            {
                "query_id": np.repeat(query_ids, [len(names) for names, _ in best]),
                "vec_id": np.concatenate([names for names, _ in best]),
                "score": np.concatenate([score for _, score in best]),
            }
        )

    return search


def search(vectors: DataFrame, queries: Column, k: int = 10, name: str = "pivot-index") -> DataFrame:
    """Builds the index over ``vectors`` and asks for the rows where ``queries`` (a test on ``vec_id``) holds."""
    rows = usable(vectors)
    pivots = draw_pivots(rows)
    if not len(pivots):
        return rows.sparkSession.createDataFrame([], RESULT)
    prefix = min(PREFIX, len(pivots))
    index = written(build(rows, pivots, prefix), name)
    return nearest(index, rows.where(queries), pivots, k, prefix)
