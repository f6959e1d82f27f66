"""Request batches as JSON lines: one object per batch, or the lines of many batches in an object."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagemill import schemas
from pagemill.operators.requests import encoded

CORRUPT = "_corrupt_record"
LINES = "batch_key string, line_no int, line string"


def write_batches(batched: DataFrame, root: str) -> None:
    """Write ``custom_id, body`` lines under one folder per ``batch_key``, in ``pos`` order.

    Raw pages meet by batch in one task, so a batch is one object; the batch limits bound it,
    so tasks do not grow with the input. Pages are encoded there, after they have moved. Only
    the folders of the batches at hand are replaced, and a batch's name is fixed by its content.
    """
    # A nullable partition column would be rewritten by the writer, which then sorts by it
    # again and loses the order within a batch.
    key = F.coalesce("batch_key", F.lit("")).alias("batch_key")
    placed = (
        batched.select(key, "pos", "custom_id", "page_bytes")
        .repartition("batch_key")
        .sortWithinPartitions("batch_key", "pos")
    )
    (
        encoded(placed)
        .drop("pos")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_key")
        .json(root)
    )


def read_batches(spark: SparkSession, root: str, paths: list[str] | None = None) -> DataFrame:
    """``batch_key, line_no, custom_id, url, malformed`` of stored batches.

    Objects are read whole, which their size limit allows, because only then is the
    line number known. A malformed line is marked rather than failing the query: it
    fails its own batch (see ``inference``), not all the others read with it.
    """
    reader = spark.read.schema("value string, batch_key string").option("basePath", root)
    objects = reader.text(paths if paths is not None else root, wholetext=True)
    lines = objects.filter(F.col("value") != "").select(
        "batch_key",
        F.posexplode(F.split(F.regexp_replace("value", r"\n\z", ""), "\n")).alias("_at", "_line"),
    )
    return _parsed(lines.withColumn("line_no", F.col("_at") + 1))


def write_lines(batched: DataFrame, folder: str) -> None:
    """Replace ``folder`` by the lines of all batches: ``batch_key, line_no, line``, many batches to an object.

    A job commits one object per task, however many batches it has; the lines of a batch are in one object, next to
    each other and in order. Raw pages move, and are encoded where they are written. Lines are those of
    :func:`write_batches`.
    """
    placed = batched.select("batch_key", "pos", "custom_id", "page_bytes").repartition("batch_key")
    # The numbering sorts by name and position, which is the order that is stored; it holds one batch at a time.
    place = F.row_number().over(Window.partitionBy("batch_key").orderBy("pos"))
    lines = encoded(placed.withColumn("pos", place)).select(
        "batch_key", F.col("pos").alias("line_no"), F.to_json(F.struct("custom_id", "body")).alias("line")
    )
    lines.write.mode("overwrite").option("maxRecordsPerFile", 0).parquet(folder)


def read_lines(spark: SparkSession, folder: str) -> DataFrame:
    """What :func:`read_batches` gives, from the lines of many batches. A malformed line fails its own batch."""
    return _parsed(spark.read.schema(LINES).parquet(folder).withColumnRenamed("line", "_line"))


def _parsed(lines: DataFrame) -> DataFrame:
    """``batch_key, line_no, custom_id, url, malformed`` of lines in ``_line``."""
    line_type = T.StructType([*schemas.REQUEST_LINE.fields, T.StructField(CORRUPT, T.StringType())])
    parsed = lines.withColumn(
        "_request", F.from_json("_line", line_type, {"columnNameOfCorruptRecord": CORRUPT})
    )
    url = F.col("_request.body.document.image_url")
    return parsed.select(
        "batch_key",
        "line_no",
        "_request.custom_id",
        url.alias("url"),
        (F.col(f"_request.{CORRUPT}").isNotNull() | url.isNull()).alias("malformed"),
    )
