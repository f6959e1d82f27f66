"""The given tables in the roles the operators expect.

``documents`` stand in for page files: a source is a file and a document is a page.
``events`` stand in for messages, state events and message outcomes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill import constants as C
from pagemill.functions import clock
from pagemill.functions import text as X
from pagemill.operators import ordinals
from pagemill.operators import requests as R
from pagemill.session import working_folder

# Small enough for both limits and short tails to occur on the given data.
MAX_BYTES = 40_000
MAX_PAGES = 9


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def page_key() -> Column:
    return F.concat(F.lit(C.PARQUET_PREFIX + "/"), F.col("source"), F.lit(".parquet"))


def numbered(docs: DataFrame) -> DataFrame:
    """Documents with ``s3_key`` and ``page_no``; select what is needed before."""
    return ordinals.with_ordinal(docs.withColumn("s3_key", page_key()), ["s3_key"], "doc_id")


def document_pages(spark: SparkSession, sf_dir: str, payload: Column | None = None) -> DataFrame:
    """``doc_id, s3_key, page_no, page_bytes``."""
    payload = F.encode("text", "UTF-8") if payload is None else payload
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", payload.alias("page_bytes"))
    return numbered(docs).select("doc_id", "s3_key", "page_no", "page_bytes")


def document_sizes(spark: SparkSession, sf_dir: str, pdf: bool = False) -> DataFrame:
    """Request sizes; the text is measured in the scan and never shuffled.

    With ``pdf`` those of :func:`pdf_pages`.
    """
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "source", F.octet_length("text").cast("long").alias("n_bytes")
    )
    if pdf:
        toxic = toxic_ids(spark, sf_dir).withColumn("_toxic", F.lit(1))
        header = F.when(F.col("_toxic").isNull(), len(C.PDF_MARK)).otherwise(0)
        docs = docs.join(toxic, "doc_id", "left").withColumn("n_bytes", F.col("n_bytes") + header).drop("_toxic")
    return R.page_sizes(numbered(docs))


def toxic_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").filter("toxic = 1").select("doc_id")


def members(spark: SparkSession, sf_dir: str, mixed: bool = False, pdf: bool = False, **plan: int) -> DataFrame:
    sizes = document_sizes(spark, sf_dir, pdf)
    return R.batch_members(sizes, mixed, max_bytes=MAX_BYTES, max_pages=MAX_PAGES, **plan)


def stored_runs(spark: SparkSession, sf_dir: str, pdf: bool = False) -> DataFrame:
    """The batch plan as runs of pages, planned once and stored."""
    root = working_folder(spark, "runs")
    R.page_runs(R.name_batches(members(spark, sf_dir, pdf=pdf))).write.parquet(root)
    return spark.read.parquet(root)


def pdf_payload(toxic: Column) -> Column:
    """Pages marked toxic lack the PDF header."""
    text = F.encode("text", "UTF-8")
    return F.when(F.coalesce(toxic, F.lit(0)) == 1, text).otherwise(
        F.concat(F.lit(C.PDF_MARK.encode()), text)
    )


def pdf_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document pages with a PDF header, except those whose label is toxic."""
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    marked = docs.join(labels, "doc_id", "left").select(
        "doc_id", "source", pdf_payload(F.col("toxic")).alias("page_bytes")
    )
    return numbered(marked).select("doc_id", "s3_key", "page_no", "page_bytes")


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_messages(table(spark, sf_dir, "events"))


def as_messages(events: DataFrame) -> DataFrame:
    """Events as queue messages with every shape of body a queue may hold."""
    key = F.concat(F.lit("parquets/"), F.col("user_id"), F.lit(".parquet"))
    quoted = F.concat(F.lit('"'), key, F.lit('"'))
    shape = F.col("event_id") % 12
    body = (
        F.when(shape == 0, F.concat(F.lit('{"s3_key": '), quoted, F.lit("}")))
        .when(shape == 1, key)
        .when(shape == 2, F.concat(F.lit('{"bucket": "b", "key": '), quoted, F.lit(', "job_id": "j1"}')))
        .when(shape == 3, F.concat(F.lit('{"s3_key": "", "key": '), quoted, F.lit("}")))
        .when(shape == 4, F.concat(F.lit('{"s3_keys": ['), quoted, F.lit(', "extra/'), F.col("event_type"), F.lit('"]}')))
        .when(shape == 5, F.lit("{}"))
        .when(shape == 6, quoted)
        .when(shape == 7, F.col("user_id").cast("string"))
        .when(shape == 8, F.concat(F.lit('{"s3_key": 0, "s3Uri": "s3://store/'), key, F.lit('"}')))
        .when(shape == 9, F.concat(F.lit('{"s3_keys": [], "key": false, "s3_uri": '), quoted, F.lit("}")))
        .when(shape == 10, F.concat(F.lit('{"s3_key": '), F.col("user_id") + 1, F.lit("}")))
        .otherwise(F.col("props"))
    )
    count = F.when(
        F.col("event_type") != "signup",
        F.create_map(F.lit(C.RECEIVE_COUNT_ATTRIBUTE), (F.col("event_id") % 5 + 1).cast("string")),
    )
    return events.select(
        F.col("event_id").cast("string").alias("message_id"),
        body.alias("body"),
        count.alias("attributes"),
    )


EVENT_NAMES = {
    "signup": C.EVENT_REGISTERED,
    "view": C.EVENT_STARTED,
    "click": C.EVENT_PAGE,
    "purchase": C.EVENT_FINISHED,
    "error": C.EVENT_FAILED,
}
EVENT_STATUSES = {
    "signup": C.STATUS_ENQUEUED,
    "view": C.STATUS_PROCESSING,
    "purchase": C.STATUS_DONE,
    "error": C.STATUS_FAILED,
}


def state_log(events: DataFrame) -> DataFrame:
    """Events as a state log: a user is a key, an event type is a transition."""
    kind = F.col("event_type")

    def mapped(names: dict[str, str]) -> Column:
        pairs = [F.lit(x) for pair in names.items() for x in pair]
        return F.create_map(*pairs)[kind]

    return events.select(
        F.lit(C.STAGE_PAGES).alias("stage"),
        F.concat(F.lit("parquets/"), F.col("user_id"), F.lit(".parquet")).alias("s3_key"),
        mapped(EVENT_NAMES).alias("event"),
        mapped(EVENT_STATUSES).alias("status"),
        F.when(kind == "click", 1).otherwise(0).cast("long").alias("pages_inc"),
        F.when(kind == "error", 1).otherwise(0).cast("long").alias("attempt_inc"),
        F.when(kind == "purchase", F.get_json_object("props", "$.k").cast("long")).alias("total_pages"),
        F.when(kind == "error", F.substring(F.repeat("props", 120), 1, C.LAST_ERROR_CHARS)).alias("last_error"),
        clock.from_utc_text(F.col("ts")).alias("event_ts"),
        F.col("event_id").alias("seq"),
    )


def outcomes(events: DataFrame) -> DataFrame:
    """Events as message outcomes: the type is the queue, the value its seconds."""
    started = clock.from_utc_text(F.col("ts"))
    outcome = (
        F.when(F.col("event_id") % 7 == 0, C.OUTCOME_DEAD_LETTER)
        .when(F.col("event_id") % 11 == 0, C.OUTCOME_FAILED)
        .when(F.col("event_id") % 13 == 0, C.OUTCOME_WRITE_FAILED)
        .otherwise(C.OUTCOME_PROCESSED)
    )
    # Whole centiseconds keep sums exact; an unfinished message has no end yet.
    hundredths = F.round(F.col("value") * 100).cast("long")
    finished = F.timestamp_micros(F.unix_micros(started) + hundredths * 10_000_000)
    return events.select(
        F.col("event_type").alias("queue"),
        F.col("event_id").cast("string").alias("message_id"),
        outcome.alias("outcome"),
        started.alias("started_at"),
        F.when(F.col("event_id") % 17 != 0, finished).alias("finished_at"),
        (hundredths / 100).alias("seconds"),
    )


def registered_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels as registered documents: good ones are done, toxic ones failed, others wait."""
    labels = table(spark, sf_dir, "labels")
    status = (
        F.when(F.col("toxic") == 1, C.STATUS_FAILED)
        .when(F.col("quality") == 1, C.STATUS_DONE)
        .otherwise(C.STATUS_ENQUEUED)
    )
    event = (
        F.when(F.col("toxic") == 1, C.EVENT_FAILED)
        .when(F.col("quality") == 1, C.EVENT_FINISHED)
        .otherwise(C.EVENT_REGISTERED)
    )
    return labels.select(
        F.lit(C.STAGE_PAGES).alias("stage"),
        document_key().alias("s3_key"),
        event.alias("event"),
        status.alias("status"),
        F.lit(0).cast("long").alias("pages_inc"),
        F.col("toxic").cast("long").alias("attempt_inc"),
        F.lit(None).cast("long").alias("total_pages"),
        F.lit(None).cast("string").alias("last_error"),
        F.timestamp_seconds(F.col("doc_id")).alias("event_ts"),
        F.col("doc_id").alias("seq"),
    )


def document_key() -> Column:
    return F.concat(F.lit("docs/"), F.col("doc_id"), F.lit(".parquet"))


def document_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(document_key().alias("s3_key"))


def benchmark_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of the benchmark items, each an alias of the first item that holds it."""
    items = table(spark, sf_dir, "benchmark")
    words = items.select("item_id", F.explode(X.tokens(X.normalise(F.col("text")))).alias("alias"))
    return words.groupBy("alias").agg(F.min("item_id").alias("item_id")).select(
        "alias", F.concat(F.lit("item-"), F.col("item_id")).alias("canonical")
    )
