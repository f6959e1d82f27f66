"""Both stages over a whole store of page files, without streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill import constants as C
from pagemill.functions import bodies
from pagemill.operators import inference, ordinals
from pagemill.streaming import stages
from pagemill.streaming.workspace import Workspace

# Where a bulk run keeps the keys it tries again: not where streams look for messages.
BULK = "bulk-retries"


def key_messages(keys: DataFrame) -> DataFrame:
    """One message per key."""
    return keys.select(
        F.sha2("s3_key", 256).alias("message_id"),
        bodies.announcement(F.col("s3_key")).alias("body"),
        F.lit(None).cast("map<string,string>").alias("attributes"),
    )


def announced(ws: Workspace, keys: DataFrame) -> DataFrame:
    """Batches that the page stage has announced so far; ``keys`` only gives the session."""
    rows = ws.read(keys.sparkSession, "announcements")
    return rows.filter(F.col("s3_key").startswith(f"{C.JSONL_PREFIX}/")).select("s3_key").distinct()


def run_pages(
    ws: Workspace,
    source: stages.PageFiles | stages.PageTable,
    keys: DataFrame,
    limits: stages.Limits = stages.Limits(),
    waves: int = 1,
) -> None:
    """Batch the pages of all ``keys``, in ``waves`` of about equal numbers of keys.

    A wave is one micro-batch: what it has done is kept if a later one fails, a second
    run skips it, and the number of objects one job commits stays moderate. Choose waves
    of some thousand batches each, and do not feed the same stage of the workspace by a
    stream, which numbers micro-batches itself.
    """
    _in_waves(ws, C.STAGE_PAGES, stages.page_stage(ws, source, limits, BULK), keys, waves)
    stages.flush_waiting(keys.sparkSession, ws, source, limits)


def run_inference(
    ws: Workspace,
    provider: inference.Provider,
    keys: DataFrame,
    limits: stages.Limits = stages.Limits(),
    waves: int = 1,
) -> None:
    """Run the provider over the batches named by ``keys`` (see :func:`announced`)."""
    _in_waves(ws, C.STAGE_OCR, stages.ocr_stage(ws, provider, limits, BULK), keys, waves)


def _in_waves(ws: Workspace, name: str, stage: stages.Stage, keys: DataFrame, waves: int) -> None:
    """All waves, then failed keys again until each is done or a dead letter."""
    spark = keys.sparkSession
    epoch = ws.next_epoch(spark, name)
    for wave in range(waves):
        stage(key_messages(keys.filter(ordinals.shard_of(F.col("s3_key"), waves) == wave)), epoch)
        epoch += 1
    while retries := stage.take_retries():
        for failed in retries:
            stage(stage.redelivered(spark, failed), epoch)
            epoch += 1
