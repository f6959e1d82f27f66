"""Dense positions within a group, without bringing a whole group into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pagemill.functions.whole import quotient

DEFAULT_SPAN = 1 << 16


def with_ordinal(
    df: DataFrame,
    keys: list[str],
    order: str,
    name: str = "page_no",
    span: int = DEFAULT_SPAN,
) -> DataFrame:
    """Add the 1-based rank of ``order`` (a unique integer) within ``keys``.

    A plain ``row_number`` sorts each group in a single task, so one file holding a
    third of all pages would be sorted by one executor. Here a group is cut into id
    ranges of ``span``; ranges are numbered on their own and shifted by the row count
    of the ranges before them. A range holds at most ``span`` rows, and the shuffle on
    ``keys`` + range is the only time the rows move. The counts are combined before
    they are shuffled: one row per range.

    ``keys`` and ``order`` must not be NULL.
    """
    block = [*keys, "_block"]
    # Spark would accept a partitioning on ``keys`` alone, which a hot key makes useless.
    cut = df.withColumn("_block", quotient(F.col(order), span)).repartition(*block)
    counts = df.select(*keys, quotient(F.col(order), span).alias("_block"))
    counts = counts.groupBy(*block).agg(F.count("*").alias("_rows"))
    before = W.partitionBy(*keys).orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    shifts = counts.select(*block, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_shift"))
    inside = W.partitionBy(*block).orderBy(order)
    ranked = cut.withColumn("_rank", F.row_number().over(inside))
    return (
        ranked.join(shifts, block)
        .withColumn(name, F.col("_shift") + F.col("_rank"))
        .drop("_block", "_shift", "_rank")
    )


def file_positions(
    pages: DataFrame,
    shard: list[str],
    file: str,
    page_no: str = "page_no",
    name: str = "pos",
    span: int = DEFAULT_SPAN,
) -> DataFrame:
    """Position of each page in the sequence of its shard: files in order, pages in order.

    ``page_no`` must already be dense within its file, so a page's position is its own
    number plus the page counts of the files before it. Only file counts are sorted. The
    pages meet them on runs of ``span`` page numbers, so that a file with a third of all
    pages is not joined in one task. ``shard`` and ``file`` must not be NULL.
    """
    cut = pages.withColumn("_block", quotient(F.col(page_no), span))
    blocks = cut.groupBy(*shard, file, "_block").agg(F.count("*").alias("_pages"))
    files = blocks.groupBy(*shard, file).agg(
        F.sum("_pages").alias("_pages"), F.collect_list("_block").alias("_blocks")
    )
    window = W.partitionBy(*shard) if shard else W.partitionBy(F.lit(0))
    before = window.orderBy(file).rowsBetween(W.unboundedPreceding, -1)
    shifted = files.withColumn("_shift", F.coalesce(F.sum("_pages").over(before), F.lit(0)))
    shifts = shifted.select(*shard, file, "_shift", F.explode("_blocks").alias("_block"))
    return (
        cut.join(shifts, [*shard, file, "_block"])
        .withColumn(name, F.col("_shift") + F.col(page_no))
        .drop("_shift", "_block")
    )


def running_fill(batched: DataFrame, batch: list[str], order: str, size: str) -> DataFrame:
    """Bytes and pages in a batch up to and including each page; a batch is bounded."""
    upto = W.partitionBy(*batch).orderBy(order).rowsBetween(W.unboundedPreceding, W.currentRow)
    return batched.withColumn("running_bytes", F.sum(size).over(upto)).withColumn(
        "running_pages", F.count("*").over(upto)
    )


def shard_of(key: Column, shards: int) -> Column:
    """Shard number as a function of the data, so that a rerun gives the same one."""
    return F.pmod(F.xxhash64(key), F.lit(shards)).cast("int")
