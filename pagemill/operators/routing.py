"""What happens to a message: process it, or put it aside as a dead letter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill import constants as C
from pagemill.functions import bodies
from pagemill.functions import keys as K


def with_receive_count(messages: DataFrame) -> DataFrame:
    return messages.withColumn("receive_count", bodies.receive_count(F.col("attributes")))


def is_poison(receive_count: Column, limit: int = C.MAX_RECEIVE_COUNT) -> Column:
    """Delivered too often, or nobody can tell how often: not processed again."""
    return F.coalesce(receive_count >= limit, F.lit(True))


def split_poison(messages: DataFrame, limit: int = C.MAX_RECEIVE_COUNT) -> tuple[DataFrame, DataFrame]:
    """Messages to process, and messages to put aside as they are."""
    poison = is_poison(F.col("receive_count"), limit)
    return messages.filter(~poison), messages.filter(poison)


def message_keys(messages: DataFrame) -> DataFrame:
    """One row per key a message names; ``s3_key`` is NULL where it names none.

    A key given as the URI of an object stands for the object's key in its bucket.
    """
    body = F.col("body")
    # One step per column: each is evaluated once, whichever branches use it.
    parsed = messages.withColumns({"_kind": bodies.body_kind(body), "_json": bodies.parsed_fields(body)})
    fields = parsed.withColumn("_fields", bodies.key_fields(F.col("_json")))
    named = fields.withColumn("_work", bodies.named_work(body, F.col("_kind"), F.col("_fields")))
    keys = named.withColumn("_keys", bodies.work_keys(F.col("_work")))
    named = keys.select(*messages.columns, F.explode_outer("_keys").alias("s3_key"))
    return named.withColumn("s3_key", K.object_key(F.col("s3_key")))


def raw_letters(messages: DataFrame, at: Column) -> DataFrame:
    """Dead letters that carry the message body unchanged."""
    return messages.select(
        "body",
        F.lit(None).cast("string").alias("reason"),
        F.array().cast("array<string>").alias("keys"),
        at.alias("at"),
    )


def failed_key_letters(failed: DataFrame, at: Column) -> DataFrame:
    """One dead letter per failed key."""
    keys = F.array("s3_key")
    return failed.select(
        bodies.failed_keys_letter(keys).alias("body"),
        F.lit(C.REASON_WORKER).alias("reason"),
        keys.alias("keys"),
        at.alias("at"),
    )


def failed_page_letters(failed: DataFrame, at: Column) -> DataFrame:
    """One dead letter per failed batch."""
    return failed.select(
        bodies.failed_pages_letter(F.col("s3_key")).alias("body"),
        F.lit(C.REASON_OCR).alias("reason"),
        F.array("s3_key").alias("keys"),
        at.alias("at"),
    )


def is_acknowledged(outcome: Column) -> Column:
    """Outcomes after which a message is not delivered again."""
    return F.coalesce(outcome.isin(*C.ACKNOWLEDGED_OUTCOMES), F.lit(False))


def split_retry(failed: DataFrame, limit: int = C.MAX_ATTEMPTS) -> tuple[DataFrame, DataFrame]:
    """Failed work with ``attempts`` left, and failed work that is given up."""
    again = F.col("attempts") < limit
    return failed.filter(again), failed.filter(~again)
