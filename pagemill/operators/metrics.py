"""Metric tables over message outcomes. All of them combine before they shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pagemill import constants as C

# Upper bounds in seconds of the processing-time buckets; a parameter.
DEFAULT_BOUNDS = [0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0, 30.0, 60.0]


def outcome_counts(outcomes: DataFrame) -> DataFrame:
    """Messages received, processed and failed, and failed writes, by queue."""
    outcome = F.col("outcome")
    failed = outcome.isin(C.OUTCOME_DEAD_LETTER, C.OUTCOME_FAILED, C.OUTCOME_WRITE_FAILED)
    return outcomes.groupBy("queue").agg(
        F.count("*").alias("received"),
        F.count_if(outcome == C.OUTCOME_PROCESSED).alias("processed"),
        F.count_if(failed).alias("failed"),
        F.count_if(outcome == C.OUTCOME_WRITE_FAILED).alias("write_failed"),
    )


def proc_time_histogram(outcomes: DataFrame, bounds: list[float] | None = None) -> DataFrame:
    """Cumulative buckets of processing seconds by queue, over processed messages only.

    Every message falls into one bucket and buckets are added up after the aggregation,
    so rows are not multiplied by the number of bounds. ``le`` is NULL for the last,
    unlimited bucket.
    """
    bounds = sorted(DEFAULT_BOUNDS if bounds is None else bounds)
    bucket = F.lit(len(bounds))
    for i in reversed(range(len(bounds))):
        bucket = F.when(F.col("seconds") <= bounds[i], F.lit(i)).otherwise(bucket)
    counts = (
        outcomes.filter(F.col("outcome") == C.OUTCOME_PROCESSED)
        .groupBy("queue", bucket.alias("bucket"))
        .agg(F.count("*").alias("n"))
    )
    # Buckets without a message still have a row.
    rows = (
        counts.groupBy("queue")
        .agg(F.map_from_entries(F.collect_list(F.struct("bucket", "n"))).alias("found"))
        .select(
            "queue",
            F.posexplode(F.array(*[F.lit(b) for b in bounds], F.lit(None).cast("double"))).alias("bucket", "le"),
            "found",
        )
    )
    upto = W.partitionBy("queue").orderBy("bucket").rowsBetween(W.unboundedPreceding, W.currentRow)
    n = F.coalesce(F.element_at("found", F.col("bucket")), F.lit(0))
    return rows.select("queue", "bucket", "le", F.sum(n).over(upto).alias("cumulative"))


def proc_time_totals(outcomes: DataFrame) -> DataFrame:
    """Count and sum of processing seconds by queue, over processed messages only."""
    return (
        outcomes.filter(F.col("outcome") == C.OUTCOME_PROCESSED)
        .groupBy("queue")
        .agg(F.count("*").alias("n"), F.sum("seconds").alias("total_seconds"))
    )


def in_flight(outcomes: DataFrame, at: Column) -> DataFrame:
    """Messages being processed at one instant."""
    started = F.col("started_at") <= at
    open_ = F.col("finished_at").isNull() | (F.col("finished_at") > at)
    return outcomes.agg(F.count_if(started & open_).alias("in_flight"))


def in_flight_series(outcomes: DataFrame, every: str = "hour") -> DataFrame:
    """Messages being processed at the end of each period in which the number changed.

    A message adds one in the period it starts and takes one away in the period it
    finishes, so the running total needs one row per period, never one per message.
    """
    changes = outcomes.select(
        F.explode(
            F.array(
                F.struct(F.date_trunc(every, "started_at").alias("period"), F.lit(1).alias("change")),
                F.struct(F.date_trunc(every, "finished_at").alias("period"), F.lit(-1).alias("change")),
            )
        ).alias("_c")
    ).select("_c.*")
    per_period = (
        changes.filter(F.col("period").isNotNull())
        .groupBy("period")
        .agg(F.sum("change").alias("change"))
    )
    upto = W.partitionBy(F.lit(0)).orderBy("period").rowsBetween(W.unboundedPreceding, W.currentRow)
    return per_period.select("period", F.sum("change").over(upto).alias("in_flight"))
