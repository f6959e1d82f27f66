"""Whitening from a weighted covariance of distinct vectors.

Vectors become whole numbers (``floor(scale * c)``), so equal ones can be told exactly. Each distinct vector is kept
once with its count. Mean and covariance are sums over the distinct vectors, each weighing one or its count: tasks
multiply their centred blocks, the blocks' products add up in Spark, and the driver holds one matrix of the
dimensions. Each distinct vector is projected once, and the result is joined back to its rows.

A vector that stands in a large share of all rows would meet all of them in one task. Rows carry one of ``SALTS``
numbers by their id; the distinct vector is joined once for every number that its rows have.

Vectors that are null, empty, or hold null or non-finite entries take no part. Vectors of each length are fitted and
whitened among themselves. Entries beyond the range of long stand at its limits. A component without variance (one
vector, or fewer than there are dimensions) has a null ``whitened``; where no component has any, ``explained`` and
``identity_error`` are null too. ``deviation`` is null where it is beyond the range of long. Repeated rows and null
ids are kept. Columns other than the two named take no part. No vector gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.llm.common import written

SALTS = 64
COMPONENTS = 4
SCALE = 256
# Variance below this share of the largest is rounding.
NOISE = 1e-12
_SAFE = 1 << 62

OUTPUT = (
    "vec_id",
    "component",
    "n",
    "deviation",
    "whitened",
    "explained",
    "identity_error",
)


@dataclass
class Fit:
    """Whitening of the vectors of one length."""

    n: int
    sums: list[int]
    # One row per component, divided by the root of its variance; NaN where there is none.
    projection: np.ndarray
    explained: list[float | None]

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])


def whole_vectors(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """``vec_id, x``: the usable vectors as arrays of long."""
    rows = vectors.select(F.col("vec_id"), F.col("embedding").cast("array<double>").alias("e"))
    unusable = F.exists("e", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    usable = rows.where(F.col("e").isNotNull() & (F.size("e") > 0) & ~unusable)
    # Nothing of a usable vector is null, so neither is the comparison.
    return usable.select("vec_id", F.transform("e", lambda c: F.floor(c * F.lit(float(scale)))).alias("x"))


def _salt(salts: int):
    return F.pmod(F.xxhash64("vec_id"), F.lit(salts)).cast("int")


def distinct(rows: DataFrame, salts: int = SALTS) -> DataFrame:
    """``x, rows, salts``: each distinct vector, its count, and the salts that its rows have (at most ``salts``)."""
    cells = rows.withColumn("salt", _salt(salts)).groupBy("x", "salt").agg(F.count("*").alias("rows"))
    return cells.groupBy("x").agg(F.sum("rows").alias("rows"), F.collect_list("salt").alias("salts"))


def _weight(by_count: bool):
    return F.col("rows") if by_count else F.lit(1).cast("long")


def _moments(vectors: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """Weight and exact sums of the vectors of each length."""
    wide = vectors.select("w", F.size("x").alias("dim"), F.posexplode("x").alias("i", "v"))
    # Decimals: sums of longs may be beyond long.
    each = F.col("v").cast("decimal(19,0)") * F.col("w").cast("decimal(19,0)")
    found = wide.groupBy("dim", "i").agg(F.sum("w").alias("n"), F.sum(each.cast("decimal(28,0)")).alias("s")).collect()
    out: dict[int, tuple[int, list[int]]] = {}
    for row in sorted(found, key=lambda r: (r["dim"], r["i"])):
        out.setdefault(row["dim"], (row["n"], []))[1].append(int(row["s"]))
    return out


def _products(batches: Iterator[pd.DataFrame], means: dict[int, np.ndarray]) -> Iterator[pd.DataFrame]:
    """Weighted products of the centred vectors of a task, one row for each length and dimension."""
    total = {dim: np.zeros((dim, dim)) for dim in means}
    for batch in batches:
        for dim, part in batch.groupby(batch["x"].map(len)):
            centred = np.stack(part["x"].to_list()).astype(float) - means[dim]
            total[dim] += (centred * part["w"].to_numpy(float)[:, None]).T @ centred
    for dim, matrix in total.items():
        if matrix.any():
            yield pd.DataFrame({"dim": dim, "i": range(dim), "row": list(matrix)})


def _covariances(vectors: DataFrame, moments: dict) -> dict[int, np.ndarray]:
    means = {dim: np.array([s / n for s in sums]) for dim, (n, sums) in moments.items()}
    parts = vectors.select("x", "w").mapInPandas(
        lambda batches: _products(batches, means), "dim int, i int, row array<double>"
    )
    cells = parts.select("dim", "i", F.posexplode("row").alias("j", "v")).groupBy("dim", "i", "j").agg(F.sum("v").alias("v"))
    out = {dim: np.zeros((dim, dim)) for dim in moments}
    for row in cells.collect():
        out[row["dim"]][row["i"], row["j"]] = row["v"] / moments[row["dim"]][0]
    return out


def fit(vectors: DataFrame, by_count: bool = False, components: int = COMPONENTS) -> dict[int, Fit]:
    """A fit for each length among the :func:`distinct` vectors, which weigh one each or their counts."""
    weighed = vectors.withColumn("w", _weight(by_count))
    moments = _moments(weighed)
    fits = {}
    for dim, covariance in _covariances(weighed, moments).items():
        values, columns = np.linalg.eigh((covariance + covariance.T) / 2)
        order = np.argsort(values)[::-1][:components]
        trace = float(np.trace(covariance))
        real = values[order] > NOISE * max(values.max(), 0.0)
        scale = np.where(real, 1 / np.sqrt(np.where(real, values[order], 1.0)), np.nan)
        explained = [float(values[k]) / trace if trace > 0 else None for k in order]
        n, sums = moments[dim]
        fits[dim] = Fit(n, sums, columns[:, order].T * scale[:, None], explained)
    return fits


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """The sum of ``(n * x - sums)`` squared of every row, exact; none where long cannot hold it."""
    largest = max(int(np.abs(x.astype(object)).max()) * n, max(map(abs, sums)))
    if 4 * largest * largest * x.shape[1] < _SAFE:
        away = n * x - np.array(sums, dtype=np.int64)
        return (away * away).sum(axis=1).tolist()
    away = n * x.astype(object) - np.array(sums, dtype=object)
    every = (away * away).sum(axis=1)
    return [int(v) if v < 1 << 63 else None for v in every]


def _whitened(batches: Iterator[pd.DataFrame], fits: dict[int, Fit]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for dim, part in batch.groupby(batch["x"].map(len)):
            model = fits[dim]
            x = np.stack(part["x"].to_list())
            w = (x.astype(float) - model.mean) @ model.projection.T
            frame = part[["x", "rows", "salts"]].copy()
            frame["deviation"] = pd.array(deviations(x, model.n, model.sums), dtype="Int64")
            frame["w"] = [[None if np.isnan(v) else float(v) for v in row] for row in w]
            yield frame


def whitened(vectors: DataFrame, fits: dict[int, Fit]) -> DataFrame:
    """``x, rows, salts, deviation, w`` of every distinct vector, ``w`` being its components."""
    schema = "x array<long>, rows long, salts array<int>, deviation long, w array<double>"
    return vectors.mapInPandas(lambda batches: _whitened(batches, fits), schema)


def identity_errors(projected: DataFrame, by_count: bool = False) -> dict[int, float]:
    """For each length the largest difference of the whitened vectors' covariance, centred, from the identity."""
    rows = projected.select(F.size("x").alias("dim"), _weight(by_count).alias("k"), F.posexplode("w").alias("i", "v"))
    means = rows.where("v is not null").groupBy("dim", "i").agg(F.sum("k").alias("n"), F.sum(F.col("k") * F.col("v")).alias("s"))
    known = {(r["dim"], r["i"]): (r["n"], r["s"] / r["n"]) for r in means.collect()}
    if not known:
        return {}
    out: dict[int, float] = {}
    for dim in sorted({d for d, _ in known}):
        axes = sorted(i for d, i in known if d == dim)
        away = {i: F.col("w")[i] - F.lit(known[dim, i][1]) for i in axes}
        pairs = [(i, j) for i in axes for j in axes if i <= j]
        row = (
            projected.where(F.size("x") == dim)
            .agg(*[F.sum(_weight(by_count) * away[i] * away[j]).alias(f"p{i}_{j}") for i, j in pairs])
            .first()
        )
        out[dim] = max(abs(row[f"p{i}_{j}"] / known[dim, i][0] - (i == j)) for i, j in pairs)
    return out


def whiten(vectors: DataFrame, by_count: bool = False, salts: int = SALTS, components: int = COMPONENTS) -> DataFrame:
    """:data:`OUTPUT` for every usable row of ``vec_id, embedding`` and each of its first components."""
    spark = vectors.sparkSession
    rows = whole_vectors(vectors)
    each = written(distinct(rows, salts), "distinct-vectors")
    fits = fit(each, by_count, components)
    projected = written(whitened(each, fits), "whitened-vectors")
    errors = identity_errors(projected, by_count)
    facts = [
        (dim, k + 1, model.n, share, errors.get(dim))
        for dim, model in fits.items()
        for k, share in enumerate(model.explained)
    ]
    facts = spark.createDataFrame(facts, "dim int, component int, n long, explained double, identity_error double")
    cells = projected.select("x", F.explode("salts").alias("salt"), "deviation", "w")
    back = rows.withColumn("salt", _salt(salts)).join(cells, ["x", "salt"])
    long = back.select("vec_id", "deviation", F.size("x").alias("dim"), F.posexplode("w").alias("k", "whitened"))
    # One row for each length and component.
    return long.withColumn("component", F.col("k") + 1).join(F.broadcast(facts), ["dim", "component"]).select(*OUTPUT)
