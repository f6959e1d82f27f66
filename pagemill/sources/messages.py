"""Message queues: a landing folder of JSON lines, or Kafka."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagemill import constants as C
from pagemill import schemas

CORRUPT = "_corrupt_record"
NOT_A_MESSAGE = "not a message"


def message_stream(spark: SparkSession, path: str, max_files: int = C.MAX_MESSAGES_PER_POLL) -> DataFrame:
    """Messages from a landing folder, at most ``max_files`` files per micro-batch.

    A file holds one message or many, so files are what is limited, not messages. A line that
    is not a message is one all the same: its id is a digest of the line, its body the line's
    text, and its delivery count is not a number, so that it is put aside as it is.
    """
    lines = (
        spark.readStream.option("maxFilesPerTrigger", max_files)
        .option("recursiveFileLookup", "true")
        .text(path)
    )
    return parsed_messages(lines.filter(F.trim("value") != ""))


def parsed_messages(lines: DataFrame) -> DataFrame:
    """Messages from JSON lines in ``value``."""
    kind = T.StructType([*schemas.MESSAGE.fields, T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json("value", kind, {"columnNameOfCorruptRecord": CORRUPT})
    rows = lines.withColumn("_message", parsed)
    broken = F.col(f"_message.{CORRUPT}").isNotNull()
    unknown = F.create_map(F.lit(C.RECEIVE_COUNT_ATTRIBUTE), F.lit(NOT_A_MESSAGE))
    return rows.select(
        F.when(broken, F.sha2("value", 256)).otherwise(F.col("_message.message_id")).alias("message_id"),
        F.when(broken, F.col("value")).otherwise(F.col("_message.body")).alias("body"),
        F.when(broken, unknown).otherwise(F.col("_message.attributes")).alias("attributes"),
    )


def kafka_stream(
    spark: SparkSession, servers: str, topic: str, max_messages: int = C.MAX_MESSAGES_PER_POLL, **options: str
) -> DataFrame:
    """Messages from a topic; needs Spark's Kafka connector on the class path."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
    for name, value in options.items():
        reader = reader.option(name, value)
    reader = reader.option("includeHeaders", "true")
    rows = reader.option("subscribe", topic).option("maxOffsetsPerTrigger", max_messages).load()
    return kafka_messages(rows)


def kafka_messages(rows: DataFrame) -> DataFrame:
    """Messages from a topic's rows; a record's headers are the message's attributes.

    Of headers with one name the last counts.
    """
    named = F.transform("headers", lambda h: F.struct(h["key"].alias("key"), h["value"].cast("string").alias("value")))
    last = F.aggregate(
        named,
        F.expr("CAST(map() AS map<string,string>)"),
        lambda found, h: F.map_concat(F.map_filter(found, lambda k, _: k != h["key"]), F.create_map(h["key"], h["value"])),
    )
    return rows.select(
        F.concat_ws("-", "topic", "partition", "offset").alias("message_id"),
        F.col("value").cast("string").alias("body"),
        last.alias("attributes"),
    )


def announcement_stream(spark: SparkSession, path: str, max_files: int = C.MAX_MESSAGES_PER_POLL) -> DataFrame:
    """Announcements of another stage as messages.

    A micro-batch of that stage that is run again replaces its files; the new ones are
    delivered once more and the skip check drops them.
    """
    rows = (
        spark.readStream.schema(schemas.ANNOUNCEMENT)
        .option("maxFilesPerTrigger", max_files)
        .option("recursiveFileLookup", "true")
        .option("ignoreMissingFiles", "true")
        .parquet(path)
    )
    return rows.select(
        F.sha2("body", 256).alias("message_id"),
        "body",
        F.lit(None).cast("map<string,string>").alias("attributes"),
    )


def write_messages(messages: DataFrame, path: str) -> None:
    """Put messages into a landing folder; the same ``path`` again replaces them."""
    messages.select(*schemas.MESSAGE.names).write.mode("overwrite").json(path)
