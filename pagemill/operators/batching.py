"""Bounded greedy batching of a page sequence.

A page is added to the open batch; the batch closes when, after adding, it has reached
the byte limit or the page limit. Where a batch starts therefore depends on every batch
before it, which looks like one long loop per shard. It is not: a batch that starts at a
given page always ends at the same page, and holds at most ``max_pages`` pages. So

1. *chunks* – each chunk of consecutive pages works out, for every position at which
   a batch can start near its beginning, where the first batch of the next chunk would
   start and how many batches were opened on the way (``max_pages`` entries per chunk);
2. *spans* – runs of chunks combine their entries in the same way;
3. a shard follows its spans from its first page, its spans follow their chunks, and
   each chunk then numbers its own batches.

The result is exactly the greedy sequence of the whole shard, and no task ever holds
more than a chunk of (position, size) pairs or a span of entry tables. Pages themselves
are not needed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagemill import constants as C
from pagemill.functions import keys as K
from pagemill.functions.whole import quotient

DEFAULT_CHUNK = 1 << 14
DEFAULT_SPAN = 256

Key = tuple[pa.Scalar, ...]


def batch_ends(sizes: np.ndarray, max_bytes: int, max_pages: int) -> np.ndarray:
    """For a batch starting at each position, the position after its last page."""
    total = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
    first = np.arange(len(sizes))
    by_bytes = np.searchsorted(total, total[:-1] + max_bytes, side="left")
    return np.minimum(np.minimum(np.maximum(by_bytes, first + 1), first + max_pages), len(sizes))


def chunk_entries(sizes: np.ndarray, own: int, max_bytes: int, max_pages: int):
    """Entry table of a chunk: ``own`` pages followed by the start of the next chunk."""
    step = np.arange(len(sizes) + 1)
    step[:own] = batch_ends(sizes, max_bytes, max_pages)[:own]
    opened = (step > np.arange(len(step))).astype(np.int64)
    entries = min(max_pages, own)
    # Follow all starts at once, twice as far in each round.
    while (step[:entries] < own).any():
        opened = opened + opened[step]
        step = step[step]
    return (step[:entries] - own).astype(np.int32), opened[:entries]


def then(first, second):
    """Entry table of two neighbouring stretches."""
    exits, opened = first
    next_exits, next_opened = second
    # Only the last, partly filled stretch of a shard has a short table; an entry past
    # its end means that no batch starts there.
    at = np.minimum(exits, len(next_exits) - 1)
    past = exits >= len(next_exits)
    return np.where(past, 0, next_exits[at]), opened + np.where(past, 0, next_opened[at])


def follow(exits: pa.Array, opened: pa.Array, start: int, before: int) -> Iterator[tuple[int, int]]:
    """Start position and number of batches opened before, for each stretch in turn."""
    for i in range(len(exits)):
        yield start, before
        table = exits[i].values
        if start < len(table):
            before += opened[i].values[start].as_py()
            start = table[start].as_py()


def plan_batches(
    pages: DataFrame,
    shard: str | None,
    pos: str = "pos",
    size: str = "size",
    max_bytes: int = C.MAX_BATCH_BYTES,
    max_pages: int = C.MAX_BATCH_PAGES,
    chunk: int = DEFAULT_CHUNK,
    span: int = DEFAULT_SPAN,
) -> DataFrame:
    """Number the batches of each shard from 0 and add ``batch_no`` to every page.

    ``pos`` must be dense and 1-based within ``shard`` (see ``with_ordinal`` and
    ``file_positions``); without a shard there is one sequence over everything. The
    columns of ``pages`` travel along, so pass ids and sizes and leave payloads out.
    """
    if max_bytes < 1 or max_pages < 1:
        raise ValueError("limits must be positive")
    if shard is None:
        whole = plan_batches(
            pages.withColumn("_all", F.lit(0)), "_all", pos, size, max_bytes, max_pages, chunk, span
        )
        return whole.drop("_all")
    chunk = max(chunk, max_pages)

    # The first pages of a chunk also go to the chunk before it, where the batches that
    # run over the border are finished.
    at = F.col(pos) - 1
    own = quotient(at, chunk)
    border = (own > 0) & (at % chunk < max_pages - 1)
    spread = pages.withColumn(
        "_chunk", F.explode(F.when(border, F.array(own, own - 1)).otherwise(F.array(own)))
    )
    # Said outright, because Spark would accept pages partitioned by shard alone. Both uses
    # below share this one shuffle.
    spread = spread.repartition(shard, "_chunk")

    shard_field = T.StructField(shard, pages.schema[shard].dataType)
    long = T.LongType()
    table_fields = [
        T.StructField("exits", T.ArrayType(T.IntegerType())),
        T.StructField("opened", T.ArrayType(long)),
    ]
    start_fields = [T.StructField("start", long), T.StructField("before", long)]

    def schema(*fields) -> T.StructType:
        return T.StructType([shard_field, *fields])

    def entries(key: Key, rows: pa.Table) -> pa.Table:
        sizes = rows.sort_by(pos)[size].to_numpy()
        exits, opened = chunk_entries(sizes, min(chunk, len(sizes)), max_bytes, max_pages)
        return pa.table(
            {
                shard: pa.repeat(key[0], 1),
                "_span": pa.array([key[1].as_py() // span], pa.int64()),
                "_chunk": pa.repeat(key[1], 1),
                "exits": pa.array([exits], pa.list_(pa.int32())),
                "opened": pa.array([opened], pa.list_(pa.int64())),
            }
        )

    def combine(key: Key, rows: pa.Table) -> pa.Table:
        ordered = rows.sort_by("_chunk").combine_chunks()
        tables = [
            (e.values.to_numpy(), o.values.to_numpy())
            for e, o in zip(ordered["exits"], ordered["opened"])
        ]
        combined = tables[0]
        for following in tables[1:]:
            combined = then(combined, following)
        return pa.table(
            {
                shard: pa.repeat(key[0], 1),
                "_span": pa.repeat(key[1], 1),
                "exits": pa.array([combined[0].astype(np.int32)], pa.list_(pa.int32())),
                "opened": pa.array([combined[1]], pa.list_(pa.int64())),
            }
        )

    def started(key: Key, ordered: pa.Table, stretch: str, start: int, before: int) -> pa.Table:
        found = list(follow(ordered["exits"], ordered["opened"], start, before))
        return pa.table(
            {
                shard: pa.repeat(key[0], len(found)),
                stretch: ordered[stretch],
                "start": pa.array([s for s, _ in found], pa.int64()),
                "before": pa.array([b for _, b in found], pa.int64()),
            }
        )

    def start_spans(key: Key, rows: pa.Table) -> pa.Table:
        return started(key, rows.sort_by("_span"), "_span", 0, 0)

    def start_chunks(key: Key, rows: pa.Table, entry: pa.Table) -> pa.Table:
        start, before = entry["start"][0].as_py(), entry["before"][0].as_py()
        return started(key, rows.sort_by("_chunk"), "_chunk", start, before)

    def number(key: Key, rows: pa.Table, entry: pa.Table) -> pa.Table:
        ordered = rows.sort_by(pos)
        mine = int(((ordered[pos].to_numpy() - 1) // chunk == key[1].as_py()).sum())
        ends = batch_ends(ordered[size].to_numpy(), max_bytes, max_pages)
        starts_here = np.zeros(mine, dtype=np.int64)
        page = entry["start"][0].as_py()
        while page < mine:
            starts_here[page] = 1
            page = int(ends[page])
        # Pages before the first start belong to the batch left open by the chunk before.
        batch_no = entry["before"][0].as_py() - 1 + np.cumsum(starts_here)
        return (
            ordered.slice(0, mine)
            .select(pages_columns)
            .append_column("batch_no", pa.array(batch_no, pa.int64()))
        )

    pages_columns = pages.columns
    span_field, chunk_field = T.StructField("_span", long), T.StructField("_chunk", long)

    chunks = spread.groupBy(shard, "_chunk").applyInArrow(
        entries, schema(span_field, chunk_field, *table_fields)
    )
    span_starts = (
        chunks.groupBy(shard, "_span")
        .applyInArrow(combine, schema(span_field, *table_fields))
        .groupBy(shard)
        .applyInArrow(start_spans, schema(span_field, *start_fields))
    )
    chunk_starts = (
        chunks.groupBy(shard, "_span")
        .cogroup(span_starts.groupBy(shard, "_span"))
        .applyInArrow(start_chunks, schema(chunk_field, *start_fields))
    )
    return (
        spread.groupBy(shard, "_chunk")
        .cogroup(chunk_starts.groupBy(shard, "_chunk"))
        .applyInArrow(number, T.StructType([*pages.schema.fields, T.StructField("batch_no", long)]))
    )


def plan_batches_by_count(pages: DataFrame, pos: str = "pos", max_pages: int = C.MAX_BATCH_PAGES) -> DataFrame:
    """The page limit alone needs no look back: every ``max_pages`` positions are a batch."""
    return pages.withColumn("batch_no", quotient(F.col(pos) - 1, max_pages))


def summarise_batches(batched: DataFrame, shard: list[str], pos: str = "pos") -> DataFrame:
    """One row per batch with its size, its ends and its object name."""
    return (
        batched.withColumn("_page", K.page_digest(F.col("custom_id"), F.col("size")))
        .groupBy(*shard, "batch_no")
        .agg(
            F.count("*").alias("n_pages"),
            F.sum("size").alias("n_bytes"),
            F.min_by("custom_id", pos).alias("first_id"),
            F.max_by("custom_id", pos).alias("last_id"),
            F.sum("_page.a").alias("_a"),
            F.sum("_page.b").alias("_b"),
        )
        .withColumn("batch_key", K.batch_key((F.col("_a"), F.col("_b")), F.col("n_pages")))
        .drop("_a", "_b")
    )


def assign_batch_keys(batched: DataFrame, shard: list[str], pos: str = "pos") -> DataFrame:
    """Add each page's ``batch_key``.

    A window over the batch, which is bounded, so that the plan is not computed once for
    its summary and again to be joined with it.
    """
    batch = W.partitionBy(*shard, "batch_no")
    paged = batched.withColumn("_page", K.page_digest(F.col("custom_id"), F.col("size")))
    sums = {
        "_pages": F.count("*").over(batch),
        "_a": F.sum("_page.a").over(batch),
        "_b": F.sum("_page.b").over(batch),
    }
    name = K.batch_key((F.col("_a"), F.col("_b")), F.col("_pages"))
    return paged.withColumns(sums).withColumn("batch_key", name).drop("_page", *sums)
