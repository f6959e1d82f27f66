"""Job state: an append-only event log and the views over it.

Counters are sums over the log and the current status is its latest event, so there is
nothing to update in place. Both combine before the shuffle, which keeps a key with a
third of all events as cheap as any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill import constants as C
from pagemill import schemas
from pagemill.functions import bodies

KEY = ["stage", "s3_key"]

EVENT_STATUS = {
    C.EVENT_REGISTERED: C.STATUS_ENQUEUED,
    C.EVENT_STARTED: C.STATUS_PROCESSING,
    C.EVENT_PAGE: None,
    C.EVENT_FINISHED: C.STATUS_DONE,
    C.EVENT_FAILED: C.STATUS_FAILED,
}


def state_events(
    keys: DataFrame,
    stage: str,
    event: str,
    at: Column,
    seq: Column | int = 0,
    pages: Column | None = None,
    total_pages: Column | None = None,
    error: Column | None = None,
) -> DataFrame:
    """One log event for each ``s3_key``."""
    seq = seq if isinstance(seq, Column) else F.lit(seq)
    values = {
        "stage": F.lit(stage),
        "s3_key": F.col("s3_key"),
        "event": F.lit(event),
        "status": F.lit(EVENT_STATUS[event]),
        "pages_inc": pages if pages is not None else F.lit(0),
        "attempt_inc": F.lit(1 if event == C.EVENT_FAILED else 0),
        "total_pages": total_pages if total_pages is not None else F.lit(None),
        "last_error": bodies.last_error(error) if error is not None else F.lit(None),
        "event_ts": at,
        "seq": seq,
    }
    return keys.select(*[values[f.name].cast(f.dataType).alias(f.name) for f in schemas.STATE_EVENT])


def current_state(log: DataFrame) -> DataFrame:
    """One row per stage and key: latest status, latest details and all counters."""
    order = F.struct("event_ts", "seq")

    def latest(column: str, where: Column) -> Column:
        return F.max_by(F.when(where, F.col(column)), F.when(where, order))

    not_first = F.col("event") != C.EVENT_REGISTERED
    return log.groupBy(*KEY).agg(
        latest("status", F.col("status").isNotNull()).alias("status"),
        F.coalesce(F.sum("attempt_inc"), F.lit(0)).alias("attempts"),
        F.coalesce(F.sum("pages_inc"), F.lit(0)).alias("pages_processed"),
        latest("total_pages", F.col("total_pages").isNotNull()).alias("total_pages"),
        latest("last_error", F.col("last_error").isNotNull()).alias("last_error"),
        F.min(F.when(~not_first, F.col("event_ts"))).alias("enqueued_at"),
        F.max(F.when(not_first, F.col("event_ts"))).alias("last_updated"),
        F.max("seq").alias("seq"),
    )


def latest_status(log: DataFrame) -> DataFrame:
    """Only the status of each key: less to shuffle than the whole state."""
    known = log.filter(F.col("status").isNotNull())
    return known.groupBy(*KEY).agg(F.max_by("status", F.struct("event_ts", "seq")).alias("status"))


def counters(log: DataFrame) -> DataFrame:
    return log.groupBy(*KEY).agg(
        F.coalesce(F.sum("pages_inc"), F.lit(0)).alias("pages_processed"),
        F.coalesce(F.sum("attempt_inc"), F.lit(0)).alias("attempts"),
    )


def compact_log(log: DataFrame) -> DataFrame:
    """The log with every key folded into at most two events; the views stay the same."""
    now = current_state(log)

    def event(name: Column, **values: Column) -> DataFrame:
        columns = {"event": name, **values}
        return now.select(
            *[
                columns.get(f.name, F.col(f.name) if f.name in now.columns else F.lit(None))
                .cast(f.dataType)
                .alias(f.name)
                for f in schemas.STATE_EVENT
            ]
        )

    nothing = F.lit(None)
    registered = event(
        F.lit(C.EVENT_REGISTERED),
        status=F.when(F.col("last_updated").isNull(), F.col("status")),
        pages_inc=F.lit(0),
        attempt_inc=F.lit(0),
        total_pages=nothing,
        last_error=nothing,
        event_ts=F.col("enqueued_at"),
    )
    folded = event(
        F.lit(C.EVENT_SNAPSHOT),
        pages_inc=F.col("pages_processed"),
        attempt_inc=F.col("attempts"),
        event_ts=F.col("last_updated"),
    )
    return registered.filter(F.col("event_ts").isNotNull()).unionByName(
        folded.filter(F.col("event_ts").isNotNull())
    )


def about(log: DataFrame, keys: DataFrame) -> DataFrame:
    """The part of the log that speaks of ``keys``.

    A micro-batch names few keys. Sent to the log they leave little of it to group, and
    the log itself is not shuffled.
    """
    return log.join(keys.select("s3_key"), "s3_key", "left_semi").select(*schemas.STATE_EVENT.names)


def done_keys(log: DataFrame, stage: str) -> DataFrame:
    """Keys of the stage that are done."""
    status = latest_status(log.filter(F.col("stage") == stage))
    return status.filter(F.col("status") == C.STATUS_DONE).select("s3_key")


def skip_done(work: DataFrame, log: DataFrame, stage: str) -> DataFrame:
    """Work whose key is not done yet."""
    return work.join(done_keys(log, stage), "s3_key", "left_anti")


def skipped_results(work: DataFrame, log: DataFrame, stage: str) -> DataFrame:
    """A result row for every key that :func:`skip_done` leaves out."""
    return work.join(done_keys(log, stage), "s3_key", "left_semi").select(
        "s3_key",
        F.lit(C.RESULT_SKIPPED).alias("status"),
        F.lit(C.REASON_ALREADY_DONE).alias("reason"),
    )


def pending_keys(log: DataFrame, stage: str) -> DataFrame:
    """Keys that are enqueued or being processed."""
    status = latest_status(log.filter(F.col("stage") == stage))
    return status.filter(F.col("status").isin(*C.PENDING_STATUSES)).select("s3_key")


def absent_keys(keys: DataFrame, log: DataFrame, stage: str) -> DataFrame:
    """Distinct keys that have no event in the stage yet."""
    known = log.filter(F.col("stage") == stage).select("s3_key")
    return keys.select("s3_key").distinct().join(known, "s3_key", "left_anti")


def register_absent(keys: DataFrame, log: DataFrame, stage: str, at: Column) -> DataFrame:
    """Registration events for keys without any event; nothing for the others."""
    return state_events(absent_keys(keys, log, stage), stage, C.EVENT_REGISTERED, at)


def look_up(keys: DataFrame, log: DataFrame, stage: str) -> DataFrame:
    """Each key with its current state, NULL where it has none."""
    current = current_state(log.filter(F.col("stage") == stage)).drop("stage")
    return keys.join(current, "s3_key", "left")
