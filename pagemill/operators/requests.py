"""From pages to batched requests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pagemill import constants as C
from pagemill.functions import encoding, keys
from pagemill.functions.whole import quotient
from pagemill.operators import batching, ordinals

STRETCH = 1024


def page_requests(pages: DataFrame) -> DataFrame:
    """``custom_id, body`` of every page."""
    return pages.select(
        "s3_key",
        "page_no",
        keys.page_id(F.col("s3_key"), F.col("page_no")).alias("custom_id"),
        encoding.request_body(F.col("page_bytes")).alias("body"),
    )


def page_sizes(pages: DataFrame) -> DataFrame:
    """``s3_key, page_no, custom_id, size``: all that batching needs to know of a page.

    ``n_bytes`` is taken if present, so that callers can drop the payload before they
    shuffle.
    """
    n_bytes = F.col("n_bytes") if "n_bytes" in pages.columns else F.octet_length("page_bytes")
    custom_id = keys.page_id(F.col("s3_key"), F.col("page_no"))
    return pages.select(
        "s3_key",
        "page_no",
        custom_id.alias("custom_id"),
        encoding.request_size(custom_id, n_bytes).alias("size"),
    )


def batch_members(
    sizes: DataFrame,
    mixed: bool = False,
    shards: int = 1,
    max_bytes: int = C.MAX_BATCH_BYTES,
    max_pages: int = C.MAX_BATCH_PAGES,
    **plan: int,
) -> DataFrame:
    """Batch number of every page; ``pos`` is its place in its sequence.

    By default each file is batched on its own. ``mixed`` puts the files one after the
    other in key order, so that a batch may hold pages of several files: one sequence
    over everything, or with ``shards`` > 1 one for each share of the files. Only the
    last batch of a sequence falls short of the limits.
    """
    if mixed:
        shared = sizes.withColumn("shard", ordinals.shard_of(F.col("s3_key"), shards))
        placed = ordinals.file_positions(shared, ["shard"], "s3_key")
        return batching.plan_batches(placed, "shard", "pos", "size", max_bytes, max_pages, **plan)
    placed = sizes.withColumn("pos", F.col("page_no").cast("long"))
    return batching.plan_batches(placed, "s3_key", "pos", "size", max_bytes, max_pages, **plan)


def continued_members(
    sizes: DataFrame,
    waiting: DataFrame,
    shards: int = 1,
    max_bytes: int = C.MAX_BATCH_BYTES,
    max_pages: int = C.MAX_BATCH_PAGES,
) -> DataFrame:
    """Mixed batches that begin with the pages that wait in the open batch of their shard.

    ``waiting`` has the columns ``shard, pos, s3_key, page_no, custom_id, size`` of at most one batch per shard,
    ``pos`` counted from 1. A batch that starts at a page always ends at the same page, so the sequence goes on
    as if it had never been cut. ``full`` tells batches that reached a limit; one per shard may not have.
    """
    columns = ["shard", "pos", "s3_key", "page_no", "custom_id", "size"]
    shared = sizes.withColumn("shard", ordinals.shard_of(F.col("s3_key"), shards))
    placed = ordinals.file_positions(shared, ["shard"], "s3_key")
    before = waiting.groupBy("shard").agg(F.count("*").alias("_before"))
    placed = placed.join(before, "shard", "left").withColumn("pos", F.col("pos") + F.coalesce("_before", F.lit(0)))
    both = waiting.select(*columns).unionByName(placed.select(*columns))
    members = batching.plan_batches(both, "shard", "pos", "size", max_bytes, max_pages)
    batch = W.partitionBy("shard", "batch_no")
    full = (F.sum("size").over(batch) >= max_bytes) | (F.count("*").over(batch) >= max_pages)
    return members.withColumn("full", full)


def name_batches(members: DataFrame, mixed: bool = False) -> DataFrame:
    """Add ``batch_key``, the same one in every run over the same pages."""
    return batching.assign_batch_keys(members, ["shard"] if mixed else ["s3_key"])


def page_runs(named: DataFrame) -> DataFrame:
    """``batch_key, s3_key, first_page, last_page, first_pos``: the plan, much shorter.

    The pages of a file in one batch are a run of page numbers, so one row stands for up
    to ``max_pages`` pages.
    """
    return named.groupBy("batch_key", "s3_key").agg(
        F.min("page_no").alias("first_page"),
        F.max("page_no").alias("last_page"),
        F.min("pos").alias("first_pos"),
    )


def batched_pages(pages: DataFrame, runs: DataFrame) -> DataFrame:
    """``batch_key, pos, custom_id, page_bytes``: raw pages with the batch they go to.

    Both sides meet on stretches of ``STRETCH`` page numbers, so that a large file is spread
    over many tasks. The plan is one row for many pages; where its measured size allows, Spark
    sends it to the pages and they stay where they are.
    """
    first, last = F.col("first_page"), F.col("last_page")
    stretches = F.sequence(quotient(first, STRETCH), quotient(last, STRETCH))
    plan = runs.withColumn("_stretch", F.explode(stretches))
    narrow = pages.select("s3_key", "page_no", "page_bytes", quotient(F.col("page_no"), STRETCH).alias("_stretch"))
    return (
        narrow.join(plan, ["s3_key", "_stretch"])
        .filter(F.col("page_no").between(first, last))
        .select(
            "batch_key",
            (F.col("first_pos") + F.col("page_no") - first).alias("pos"),
            keys.page_id(F.col("s3_key"), F.col("page_no")).alias("custom_id"),
            "page_bytes",
        )
    )


def encoded(batched: DataFrame) -> DataFrame:
    """``batch_key, pos, custom_id, body`` from raw pages; encode after the last shuffle."""
    return batched.select("batch_key", "pos", "custom_id", encoding.request_body(F.col("page_bytes")).alias("body"))
