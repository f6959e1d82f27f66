"""Registered queries that run as streams over the given tables until they are used up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pagemill import constants as C
from pagemill.functions import bodies, clock, encoding
from pagemill.functions import keys as K
from pagemill.operators import inference, metrics, routing, state
from pagemill.plans import bulk
from pagemill.plans import queries as Q
from pagemill.plans import tables as D
from pagemill.session import working_folder
from pagemill.sources import messages as message_source
from pagemill.sources import pages as page_source
from pagemill.streaming import carry, stages
from pagemill.streaming.workspace import Workspace

# Files of a table in one micro-batch.
MAX_FILES = 64
# Rows that arrive at a time where a stream has an order, and how often rows arrive at least.
ARRIVING_ROWS = 1 << 20
LEAST_ARRIVALS = 3


def stream_table(spark: SparkSession, sf_dir: str, name: str, max_files: int = MAX_FILES) -> DataFrame:
    """A given table, one file or a folder of files, as a stream of ``max_files`` files at a time."""
    schema = D.table(spark, sf_dir, name).schema
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
    # A stream's path must be a folder; a pattern may find a file as well.
    return reader.parquet(f"{sf_dir}/{name}.parque[t]")


def _to_table(spark: SparkSession, stream: DataFrame, name: str) -> DataFrame:
    return _take(spark, stream, working_folder(spark, name))


def _take(spark: SparkSession, stream: DataFrame, root: str) -> DataFrame:
    """What the stream gives for all that has arrived, after what it gave before."""
    query = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
        .start(f"{root}/rows")
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{root}/rows")


def _ranges(rows: DataFrame, order: str) -> list[Column]:
    """Tests that cut ``rows`` by ``order`` into ranges of about ``ARRIVING_ROWS``, in order; nulls are last."""
    count = max(LEAST_ARRIVALS, -(-rows.count() // ARRIVING_ROWS))
    shares = [i / count for i in range(1, count)]
    bounds = rows.agg(F.percentile_approx(order, shares, 100 * count)).first()[0] or []
    at, ranges = None, []
    for bound in sorted(set(bounds)):
        ranges.append(F.col(order) <= bound if at is None else (F.col(order) > at) & (F.col(order) <= bound))
        at = bound
    rest = F.col(order).isNull()
    return [*ranges, F.lit(True) if at is None else rest | (F.col(order) > at)]


def stream_message_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages parsed as they arrive, written by an exactly-once file sink."""
    counted = routing.with_receive_count(D.as_messages(stream_table(spark, sf_dir, "events")))
    keyed = routing.message_keys(counted).select("message_id", "receive_count", "s3_key")
    return _to_table(spark, keyed, "stream-keys")


def stream_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State events appended micro-batch by micro-batch, then the current state."""
    ws = Workspace(working_folder(spark, "stream-state"))

    def append(rows: DataFrame, epoch: int) -> None:
        ws.append(rows, "state", C.STAGE_PAGES, epoch)

    log = D.state_log(stream_table(spark, sf_dir, "events"))
    stages.start(log, append, ws.path("checkpoint"), "state").awaitTermination()
    return Q.state_columns(state.current_state(ws.read(spark, "state")))


def stream_outcome_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters kept by a streaming aggregation; each micro-batch replaces the totals."""
    root = working_folder(spark, "stream-counts")
    counts = metrics.outcome_counts(D.outcomes(stream_table(spark, sf_dir, "events")))

    def replace(rows: DataFrame, epoch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{root}/totals")

    query = (
        counts.writeStream.outputMode("complete")
        .foreachBatch(replace)
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(counts.schema).parquet(f"{root}/totals")


def stream_carried_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document pages batched as they arrive, in the order of their ids, with the open batch kept as state.

    The files of a table have no order, so ranges of ids are appended one after another to a table of sizes, and
    each is one micro-batch, however many files the documents or the range are.
    """
    docs = D.table(spark, sf_dir, "documents")
    custom_id = K.page_id(D.page_key(), F.col("doc_id"))
    sizes = docs.select(
        D.page_key().alias("s3_key"),
        "doc_id",
        encoding.request_size(custom_id, F.octet_length("text").cast("long")).alias("size"),
    )
    root = working_folder(spark, "stream-carry")
    sizes.write.parquet(f"{root}/sizes")
    sizes = spark.read.schema(sizes.schema).parquet(f"{root}/sizes")
    # Without a limit on files, a micro-batch takes all that has arrived.
    stream = spark.readStream.schema(sizes.schema).parquet(f"{root}/arrive[d]")
    batched = carry.carry_batches(stream, "s3_key", "doc_id", "size", D.MAX_BYTES, D.MAX_PAGES)
    for within in _ranges(sizes, "doc_id"):
        sizes.where(within).write.mode("append").parquet(f"{root}/arrived")
        found = _take(spark, batched, root)
    return found


def stream_mixed_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches of the page stage that hold pages of several files and wait across micro-batches until they are full.

    Files arrive in the order of their keys, a share at a time, and are worked through in slices.
    """
    ws = Workspace(working_folder(spark, "stream-mixed"))
    page_source.write_page_table(D.document_pages(spark, sf_dir), ws.path("pages"), gathered=True)
    source = stages.PageTable(ws.path("pages"))
    limits = stages.Limits(max_bytes=D.MAX_BYTES, max_pages=D.MAX_PAGES, mixed=True, carry=True, slice_keys=10)
    keys = page_source.page_table_keys(spark, ws.path("pages"))
    share = F.ntile(LEAST_ARRIVALS).over(W.orderBy("s3_key"))
    listed = ws.path("keys")
    keys.withColumn("share", share).write.parquet(listed)
    arriving = spark.read.parquet(listed)
    for i in range(1, LEAST_ARRIVALS + 1):
        message_source.write_messages(bulk.key_messages(arriving.filter(F.col("share") == i)), f"{ws.path('messages')}/share-{i}")
        # One micro-batch, whatever the number of files the messages are written to.
        stages.run_page_stage(spark, ws, source, limits, max_files=1 << 30, flush=i == LEAST_ARRIVALS)
    manifest = ws.read(spark, "manifest")
    return manifest.groupBy("batch_key").agg(
        F.count("*").alias("n_pages"),
        F.sum("size").alias("n_bytes"),
        F.min_by("custom_id", "pos").alias("first_id"),
        F.max_by("custom_id", "pos").alias("last_id"),
    )


def _pipeline(spark: SparkSession, sf_dir: str) -> Workspace:
    """Page files and their messages from the documents, then the page stage over them."""
    ws = Workspace(working_folder(spark, "pipeline"))
    pages = D.pdf_pages(spark, sf_dir)
    events, announced = page_source.stage_pages(
        pages, ws.path("pages"), ws.read(spark, "state"), clock.from_utc_text(F.lit("2024-01-01")), gathered=True
    )
    ws.append(events, "state", "staging", 0)
    # Every file is announced twice, by its key and by a URI, and one key that does not exist is asked for.
    absent = announced.limit(1).select(
        F.lit("absent").alias("message_id"),
        bodies.announcement(F.lit("parquets/absent.parquet")).alias("body"),
        "attributes",
    )
    again = announced.withColumn("message_id", F.concat("message_id", F.lit("-again"))).withColumn(
        "body", F.replace("body", F.lit('{"s3_key":"'), F.lit('{"s3Uri":"s3://store/'))
    )
    every = announced.unionByName(again).unionByName(absent)
    message_source.write_messages(every, f"{ws.path('messages')}/all")
    limits = stages.Limits(max_bytes=D.MAX_BYTES, max_pages=D.MAX_PAGES)
    source = stages.PageTable(ws.path("pages"))
    stages.run_page_stage(spark, ws, source, limits, max_files=1)
    return ws


def stream_page_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page stage as a stream of messages: the batches it planned."""
    ws = _pipeline(spark, sf_dir)
    manifest = ws.read(spark, "manifest")
    return manifest.groupBy("batch_key").agg(
        F.count("*").alias("n_pages"),
        F.sum("size").alias("n_bytes"),
        F.min_by("custom_id", "pos").alias("first_id"),
        F.max_by("custom_id", "pos").alias("last_id"),
    )


def stream_ocr_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both stages chained: pages of the responses, matched to their page ids."""
    ws = _pipeline(spark, sf_dir)
    stages.run_ocr_stage(spark, ws, inference.text_provider)
    return ws.read(spark, "response_pages").select("batch_key", "index", "custom_id", "markdown")


def stream_job_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State of every file after the page stage, the absent one included."""
    ws = _pipeline(spark, sf_dir)
    log = ws.read(spark, "state").filter(F.col("stage") == C.STAGE_PAGES)
    return state.current_state(log).select(
        "s3_key", "status", "attempts", "pages_processed", "total_pages", "last_error"
    )


def stream_dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as messages through a stage whose files do not exist: every key fails."""
    ws = Workspace(working_folder(spark, "stream-letters"))
    page_source.write_page_table(D.document_pages(spark, sf_dir), ws.path("pages"), gathered=True)
    process = stages.page_stage(ws, stages.PageTable(ws.path("pages")), stages.Limits(max_attempts=1))
    incoming = D.as_messages(stream_table(spark, sf_dir, "events"))
    stages.start(incoming, process, ws.path("checkpoint"), "letters").awaitTermination()
    return ws.read(spark, "dead_letters").groupBy("body", "reason").agg(F.count("*").alias("n"))


STREAMS = {
    query.__name__: query
    for query in [
        stream_message_keys,
        stream_state,
        stream_outcome_counts,
        stream_carried_batches,
        stream_mixed_batches,
        stream_page_batches,
        stream_ocr_pages,
        stream_job_state,
        stream_dead_letters,
    ]
}
