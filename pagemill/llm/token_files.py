"""Token counts from flat files of token ids: where documents end is found by a scan for the end id.

A flat file is ids of fixed width one after another, without an index. It is scanned in blocks: each block is
searched for the end id as one vector, and says how many ends it has and where its last one is. A prefix scan
over these figures, first within runs of blocks and then over the runs, gives every block the number of
documents before it and the place where the document that reaches into it began. No task sees a whole file.

Blocks come as rows ``file, block, data``: from :func:`store`, or from files in any store by :func:`flat_files`.
What stands behind the last end id of a file is a document without an end. Empty files have no documents.

For :func:`store`, null and empty texts are documents of no tokens besides the end id; rows are kept as they
are, repeated ones too, and columns other than ``doc_id`` and ``text`` take no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from pagemill.llm.common import written
from pagemill.llm.prefix_bpe import encoder

# Ids in a block, and blocks in a run of the prefix scan.
BLOCK = 1 << 18
RUN = 1024

STORED = "file long, block long, data binary, first long, doc_ids array<long>"
SCANNED = "file long, block long, n_ids long, ends array<long>"


def store(docs: DataFrame, path: str, pattern: str, end_id: int, dtype: str = "<u2", block: int = BLOCK) -> DataFrame:
    """Writes texts as flat token files, one per task, and returns their rows.

    Besides its blocks, a row names the documents that end in it and the number of the first of them in the
    file. That is for telling documents apart afterwards; scans do not read it.
    """
    if end_id > np.iinfo(np.dtype(dtype)).max:
        raise ValueError(f"{end_id} does not fit {dtype}")
    width = np.dtype(dtype).itemsize
    end = np.asarray([end_id], dtype=dtype).tobytes()

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        one, file = encoder(path, pattern), TaskContext.get().partitionId()
        waiting, number, first, size = bytearray(), 0, 0, block * width
        named: list = []

        def row(data: bytes) -> pd.DataFrame:
            return pd.DataFrame([{"file": file, "block": number, "data": data, "first": first, "doc_ids": list(named)}])

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                waiting += one.encode(text).astype(dtype).tobytes() + end
                # A document is named in the block that holds its end id.
                while len(waiting) > size:
                    yield row(bytes(waiting[:size]))
                    del waiting[:size]
                    number, first = number + 1, first + len(named)
                    named.clear()
                named.append(None if pd.isna(doc_id) else int(doc_id))
        if waiting:
            yield row(bytes(waiting))

    return written(docs.select("doc_id", "text").mapInPandas(write, STORED), "tokens")


def flat_files(spark: SparkSession, path: str, block: int = BLOCK, dtype: str = "<u2") -> DataFrame:
    """Rows of blocks from flat files below ``path``. A file is read by one task and may have up to 2 GB.

    Files are numbered by the hash of their path. Bytes behind the last whole id are left out.
    """
    width = np.dtype(dtype).itemsize

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file, content in zip(batch["file"], batch["content"]):
                whole = len(content) // width * width
                for number, at in enumerate(range(0, whole, block * width)):
                    data = content[at : min(at + block * width, whole)]
                    yield pd.DataFrame({"file": [file], "block": [number], "data": [data]})

    files = spark.read.format("binaryFile").load(path).select(F.xxhash64("path").alias("file"), "content")
    return files.mapInPandas(cut, "file long, block long, data binary")


def _scan(end_id: int, dtype: str):
    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            n, ends = [], []
            for data in batch["data"]:
                ids = np.frombuffer(data, dtype=dtype)
                n.append(len(ids))
                ends.append(np.flatnonzero(ids == end_id))
            yield batch[["file", "block"]].assign(n_ids=n, ends=ends)

    return scan


def documents(blocks: DataFrame, end_id: int, dtype: str = "<u2", run: int = RUN) -> DataFrame:
    """``file, ordinal, start, n_tokens, ended``: every document, its place in ids, and its size with the end id."""
    scanned = blocks.select("file", "block", "data").mapInPandas(_scan(end_id, dtype), SCANNED)
    # Places count from the start of the block at first; a block without an end has no last one.
    scanned = written(
        scanned.withColumn("run", F.floor(F.col("block") / run))
        .withColumn("n_ends", F.size("ends").cast("long"))
        .withColumn("last", F.expr("try_element_at(ends, -1)")),
        "scanned",
    )
    inside = Window.partitionBy("file", "run").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)

    def before(column: str, window: WindowSpec) -> Column:
        return F.coalesce(F.sum(column).over(window), F.lit(0))

    # Within a run: ids and ends before the block, and the last end before it, counted from the run's start.
    placed = scanned.withColumn("ids_before", before("n_ids", inside)).withColumn("ends_before", before("n_ends", inside))
    placed = placed.withColumn("here", F.col("ids_before") + F.col("last"))
    placed = placed.withColumn("last_before", F.max("here").over(inside))
    runs = placed.groupBy("file", "run").agg(
        F.sum("n_ids").alias("n_ids"), F.sum("n_ends").alias("n_ends"), F.max("here").alias("last"),
        F.max("block").alias("run_end"),
    )
    # Over the runs of a file: one row for so many blocks.
    over = Window.partitionBy("file").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("run_ids", before("n_ids", over)).withColumn("run_ends", before("n_ends", over))
    runs = runs.withColumn("there", F.col("run_ids") + F.col("last"))
    runs = runs.withColumn("run_last", F.max("there").over(over))
    final = F.max("run_end").over(Window.partitionBy("file"))
    runs = runs.select("file", "run", "run_ids", "run_ends", "run_last", final.alias("file_end"))
    joined = placed.join(runs, ["file", "run"])
    start = F.col("run_ids") + F.col("ids_before")
    joined = joined.select(
        "file",
        start.alias("start"),
        (F.col("run_ends") + F.col("ends_before")).alias("ordinal"),
        # The document that reaches into the block began behind the last end before it.
        (F.coalesce(F.col("run_ids") + F.col("last_before"), "run_last", F.lit(-1)) + 1).alias("begun"),
        "ends",
        # The rest of a file is a document if ids stand behind its last end.
        F.when(
            (F.col("block") == F.col("file_end")) & (F.coalesce("last", F.lit(-1)) < F.col("n_ids") - 1), F.col("n_ids")
        ).alias("rest"),
    )
    bounds = F.transform("ends", lambda e: F.col("start") + e + 1)
    all_bounds = F.when(F.col("rest").isNull(), bounds).otherwise(F.concat(bounds, F.array(F.col("start") + F.col("rest"))))
    rows = joined.select("file", "ordinal", "begun", F.size("ends").alias("whole"), all_bounds.alias("bounds"))
    rows = rows.select("file", "ordinal", "begun", "whole", "bounds", F.posexplode("bounds").alias("i", "past"))
    begin = F.when(F.col("i") == 0, F.col("begun")).otherwise(F.element_at("bounds", F.greatest("i", F.lit(1))))
    return rows.select(
        "file",
        (F.col("ordinal") + F.col("i")).alias("ordinal"),
        begin.alias("start"),
        (F.col("past") - begin).alias("n_tokens"),
        (F.col("i") < F.col("whole")).alias("ended"),
    )


def named(found: DataFrame, stored: DataFrame) -> DataFrame:
    """``found`` with the ``doc_id`` of each document of files that :func:`store` wrote."""
    names = stored.select("file", "first", F.posexplode("doc_ids").alias("i", "doc_id"))
    names = names.select("file", (F.col("first") + F.col("i")).alias("ordinal"), "doc_id")
    # Both sides grow with the documents; the small file that ``found`` comes from must not mislead the join.
    return found.hint("merge").join(names, ["file", "ordinal"])
