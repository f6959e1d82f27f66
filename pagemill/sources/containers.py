"""Containers of request batches: Parquet objects with many batches each, and an index of where a batch is.

A job writes one object per task, however many batches it has. The pages of a batch are in one object, next to each
other and in order, as raw bytes; an object is sorted by ``batch_key``, so the statistics of its row groups tell readers
which to skip. The index names the object of each batch. Batches leave as JSON lines, one object each, by
:func:`pagemill.sources.requests.write_batches`, which takes what :func:`read` gives.

A batch that was written again is in several objects with the same pages, as its name is a digest of them; one is read.
Index rows whose object is gone count as if they were not there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagemill.sources import listing

PAGES = "batch_key string, pos long, custom_id string, page_bytes binary"
# A few batches at their limit: what a reader of one batch has to read.
ROW_GROUP_BYTES = 32 * 1024 * 1024


def write(batched: DataFrame, folder: str) -> None:
    """Replace ``folder`` by containers of ``batch_key, pos, custom_id, page_bytes``.

    Raw pages meet by batch in one task, and leave it as they are. Stored positions count from 1 in each batch.
    """
    placed = batched.select("batch_key", "pos", "custom_id", "page_bytes").repartition("batch_key")
    # The numbering sorts by name and position, which is the order that is stored; it holds one batch at a time.
    place = F.row_number().over(Window.partitionBy("batch_key").orderBy("pos")).cast("long")
    (
        placed.withColumn("pos", place)
        .write.mode("overwrite")
        .option("maxRecordsPerFile", 0)
        .option("parquet.block.size", ROW_GROUP_BYTES)
        .parquet(folder)
    )


def index(spark: SparkSession, root: str, folder: str) -> DataFrame:
    """``batch_key, object, pages`` of the containers in ``folder``, objects as paths below ``root``.

    Only the column of names is read.
    """
    rows = spark.read.schema("batch_key string").parquet(folder)
    named = rows.select("batch_key", listing.key_under(root, F.col("_metadata.file_path")).alias("object"))
    return named.groupBy("batch_key", "object").agg(F.count("*").alias("pages"))


def located_once(spark: SparkSession, root: str, located: DataFrame, size: int = listing.SLICE_KEYS) -> DataFrame:
    """``batch_key, object`` of index rows, for every batch one of its objects that are there.

    Objects are named on the driver in slices of about ``size``; batches, of which an object has many, are not.
    """
    objects = located.select(F.col("object").alias("s3_key")).distinct().persist()
    try:
        n = listing.slices(objects, size)
        there = [(name,) for i in range(n) for name in listing.existing(spark, root, listing.names_of(objects, i, n))]
    finally:
        objects.unpersist()
    present = F.broadcast(spark.createDataFrame(there, "object string"))
    return located.join(present, "object", "left_semi").groupBy("batch_key").agg(F.max("object").alias("object"))


def read(spark: SparkSession, root: str, located: DataFrame) -> DataFrame:
    """``batch_key, pos, custom_id, page_bytes`` of the batches of ``located``, index rows whose objects can be named."""
    return read_located(spark, root, located_once(spark, root, located))


def read_located(spark: SparkSession, root: str, once: DataFrame) -> DataFrame:
    """The same for rows of :func:`located_once`.

    Only their objects are opened, each once. Pages and names meet by batch; where Spark measures the names to be
    few, pages do not move for it.
    """
    objects = [row["object"] for row in once.select("object").distinct().collect()]
    if not objects:
        return spark.createDataFrame([], PAGES)
    stored = spark.read.schema(PAGES).parquet(*listing.paths_of(root, objects))
    stored = stored.withColumn("_object", listing.key_under(root, F.col("_metadata.file_path")))
    return stored.join(once, "batch_key").filter("object = _object").drop("object", "_object")


def read_all(spark: SparkSession, folder: str) -> DataFrame:
    """``batch_key, pos, custom_id, page_bytes`` of all containers that one :func:`write` left in ``folder``."""
    return spark.read.schema(PAGES).parquet(folder)


def as_lines(pages: DataFrame) -> DataFrame:
    """``batch_key, line_no, custom_id, page, malformed``, as the lines of a stored batch; ``page`` is not encoded."""
    return pages.select(
        "batch_key",
        F.col("pos").cast("int").alias("line_no"),
        "custom_id",
        F.col("page_bytes").alias("page"),
        F.col("page_bytes").isNull().alias("malformed"),
    )
