"""Page files and page tables: scanning, counting, staging."""

from __future__ import annotations

import io
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagemill import constants as C
from pagemill import schemas
from pagemill.functions import bodies
from pagemill.functions.whole import quotient
from pagemill.operators import ordinals, state
from pagemill.sources.listing import key_under

PAGE_TABLE = T.StructType(
    [
        T.StructField("page_no", T.LongType()),
        T.StructField("page_bytes", T.BinaryType()),
        # Null in tables from before it was stored, and where the page is.
        T.StructField("n_bytes", T.LongType()),
        T.StructField("s3_key", T.StringType()),
    ]
)
# What Spark's reader of whole files gives of a page table's files.
TABLE_FILES = "path string, modificationTime timestamp, length long, content binary, s3_key string"

PAGES_PER_FILE = 4096
PAGE_COLUMN = schemas.PAGE_FILE.names[0]


def scan_pages(spark: SparkSession, root: str, paths: list[str] | None = None) -> DataFrame:
    """``s3_key, page_no, page_bytes`` of the page files below ``root``, or of ``paths`` there.

    Every file is one key. The page number is the row's position in its file, which the
    Parquet reader gives without a shuffle; other columns of the files are not read.
    """
    reader = spark.read.schema(schemas.PAGE_FILE).option("recursiveFileLookup", "true")
    pages = reader.parquet(*paths) if paths is not None else reader.parquet(root)
    return pages.select(
        key_under(root, F.col("_metadata.file_path")).alias("s3_key"),
        (F.col("_metadata.row_index") + 1).alias("page_no"),
        "page_bytes",
    )


def broken_files(spark: SparkSession, root: str, paths: list[str]) -> DataFrame:
    """``s3_key, error`` of the files among ``paths`` that cannot be read as page files.

    One job tests every file on its own, where it is read: its footer, its column, and its
    pages by row groups.
    """

    def problem(content: bytes) -> str | None:
        try:
            file = pq.ParquetFile(io.BytesIO(content))
            kind = file.schema_arrow.field(PAGE_COLUMN).type
            if not (pa.types.is_binary(kind) or pa.types.is_large_binary(kind) or pa.types.is_string(kind)):
                return f"column {PAGE_COLUMN} is {kind}"
            for group in range(file.num_row_groups):
                file.read_row_group(group, columns=[PAGE_COLUMN])
        except (pa.ArrowException, OSError, KeyError, ValueError) as found:
            return f"{type(found).__name__}: {found}"
        return None

    def test(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"s3_key": batch["s3_key"], "error": [problem(c) for c in batch["content"]]})

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
    named = files.select(key_under(root, F.col("_metadata.file_path")).alias("s3_key"), "content")
    return named.mapInPandas(test, "s3_key string, error string").filter("error IS NOT NULL")


def scan_page_parts(spark: SparkSession, root: str) -> DataFrame:
    """``page_no, page_bytes`` of a page file stored as a folder of part files.

    Parts are numbered in name order. Only the row counts of the parts are sorted, and
    those come from the footers.
    """
    parts = scan_pages(spark, root).withColumnRenamed("s3_key", "part")
    return ordinals.file_positions(parts, [], "part", name="pos").select(
        F.col("pos").alias("page_no"), "page_bytes"
    )


def write_page_files(pages: DataFrame, order: str, path: str) -> None:
    """Store pages in ``order`` as a folder of part files, with nothing in one task."""
    pages.repartitionByRange(order).sortWithinPartitions(order).select("page_bytes").write.mode(
        "overwrite"
    ).parquet(path)


def write_page_table(pages: DataFrame, root: str, gathered: bool = False) -> None:
    """Store ``s3_key, page_no, page_bytes`` with one folder per key, and how long each page is.

    A key is cut into runs of pages, so a large key is written by many tasks, and a run
    goes to one file. ``gathered`` pages are in such runs already, as ``with_ordinal`` leaves them:
    they are written where they are.
    """
    run = quotient(F.col("page_no"), PAGES_PER_FILE)
    measured = pages.withColumn("n_bytes", F.octet_length("page_bytes").cast("long")).select(*PAGE_TABLE.names)
    (
        (measured if gathered else measured.repartition("s3_key", run))
        .sortWithinPartitions("s3_key", "page_no")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("s3_key")
        .parquet(root)
    )


def scan_page_table(spark: SparkSession, root: str) -> DataFrame:
    """A page table; a filter on ``s3_key`` selects folders before any file is opened."""
    return spark.read.schema(PAGE_TABLE).parquet(root).select("s3_key", "page_no", "page_bytes")


def scan_page_lengths(spark: SparkSession, root: str) -> DataFrame:
    """``s3_key, page_no, n_bytes`` of a page table, without its pages where their length is stored.

    Pages whose length is not stored are measured; row groups that have none are skipped by their statistics.
    """
    stored = spark.read.schema(PAGE_TABLE).parquet(root)
    known = stored.filter(F.col("n_bytes").isNotNull()).select("s3_key", "page_no", "n_bytes")
    measured = F.octet_length("page_bytes").cast("long").alias("n_bytes")
    return known.unionByName(stored.filter(F.col("n_bytes").isNull()).select("s3_key", "page_no", measured))


def page_table_keys(spark: SparkSession, root: str) -> DataFrame:
    """``s3_key`` of every key of a page table. Its files are listed; none is opened."""
    files = spark.read.format("binaryFile").schema(TABLE_FILES).load(root)
    return files.select("s3_key").distinct()


def pages_per_file(pages: DataFrame) -> DataFrame:
    """Rows per file; on a scan no page data is read, only row counts from the footers."""
    return pages.groupBy("s3_key").agg(F.count("*").alias("total_pages"))


def stage_pages(
    pages: DataFrame, root: str, log: DataFrame, at: Column, keys: DataFrame | None = None, gathered: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Write page files to the page table, then register and announce them.

    All files of the table are announced, or those of ``keys`` if the table holds others. ``gathered`` as for
    :func:`write_page_table`.

    Returns the state events and the messages to append, in that order. A key that is
    registered already gets no second event; it is announced again, and the receiving
    stage's skip check decides.
    """
    write_page_table(pages, root, gathered)
    # Keys come from what was written: folder names, for which no page is computed again.
    asked = page_table_keys(pages.sparkSession, root)
    staged = asked if keys is None else asked.join(keys, "s3_key", "left_semi")
    events = state.register_absent(staged, log, C.STAGE_PAGES, at)
    messages = staged.select(
        F.sha2("s3_key", 256).alias("message_id"),
        bodies.announcement(F.col("s3_key")).alias("body"),
        F.lit(None).cast("map<string,string>").alias("attributes"),
    )
    return events, messages
