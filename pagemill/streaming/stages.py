"""The two chained stages as micro-batches: page files to batches, batches to responses.

A stage takes messages. What is the same for every stage is in :func:`run_stage`: poison
messages, key choice, skipping what is done, state events, dead letters, retries,
outcomes. What differs is its handler, any ``Callable`` from the keys to process to a
:class:`StageResult`.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pagemill import constants as C
from pagemill import schemas
from pagemill.functions import bodies
from pagemill.functions import keys as K
from pagemill.operators import inference, routing, state
from pagemill.operators import requests as R
from pagemill.operators.ordinals import shard_of
from pagemill.sources import containers, listing, messages
from pagemill.sources import pages as page_source
from pagemill.sources import responses as response_source
from pagemill.streaming.workspace import CHECKS, Workspace

NOT_FOUND = "object not found"
RETRY = "retry"
EVERY = "20 seconds"


@dataclass(frozen=True)
class StageResult:
    """Outcome of a handler: ``finished`` (s3_key, total_pages), ``failed`` (s3_key, error),
    and ``produced`` (s3_key), the objects written for ``next_stage``.

    ``timing`` (s3_key, seconds) says how long single keys took, where that is known.
    """

    finished: DataFrame
    failed: DataFrame
    produced: DataFrame
    next_stage: str
    timing: DataFrame | None = None


Handler = Callable[[SparkSession, DataFrame, int], StageResult]


def utc_now() -> datetime:
    return datetime.now(timezone.utc)


@dataclass(frozen=True)
class Limits:
    max_bytes: int = C.MAX_BATCH_BYTES
    max_pages: int = C.MAX_BATCH_PAGES
    # Batches may hold pages of several files. With ``carry`` one that is not full at the end of a micro-batch
    # waits for the next, at most ``flush_after`` if that is given; without, it is written as it is.
    mixed: bool = False
    carry: bool = False
    flush_after: timedelta | None = None
    shards: int = 1
    max_receive_count: int = C.MAX_RECEIVE_COUNT
    max_attempts: int = C.MAX_ATTEMPTS
    slice_keys: int = listing.SLICE_KEYS
    clock: Callable[[], datetime] = field(default=utc_now)


def run_stage(
    rows: DataFrame,
    epoch: int,
    ws: Workspace,
    stage: str,
    queue: str,
    handler: Handler,
    letters: Callable[[DataFrame, Column], DataFrame],
    redeliver: Callable[[DataFrame, int], None],
    limits: Limits,
) -> bool:
    """Process one micro-batch of messages; says whether failed keys were delivered again.

    The order of writes carries the guarantees: objects first, then state, announcements
    and dead letters that speak of them, outcomes last.
    """
    spark = rows.sparkSession
    began = limits.clock()
    at = F.lit(began)
    log = ws.read(spark, "state", before=(stage, epoch))
    counted = routing.with_receive_count(rows).persist()
    good, poison = routing.split_poison(counted, limits.max_receive_count)
    keyed = routing.message_keys(good).persist()
    work = keyed.filter(F.col("s3_key").isNotNull()).select("s3_key").distinct()
    known = state.about(log.filter(F.col("stage") == stage), work).persist()
    todo = state.skip_done(work, known, stage).persist()
    held = [counted, keyed, known, todo]
    try:
        started = state.state_events(todo, stage, C.EVENT_STARTED, at, epoch * 10)
        ws.append(started, "state", stage, epoch, "start")

        result = handler(spark, todo, epoch)

        past = state.counters(known).select("s3_key", "attempts")
        tried = result.failed.join(past, "s3_key", "left").withColumn(
            "attempts", F.coalesce("attempts", F.lit(0)) + 1
        )
        held.append(tried.persist())
        again, given_up = routing.split_retry(tried, limits.max_attempts)

        other = state.about(log.filter(F.col("stage") == result.next_stage), result.produced)
        ended = (
            state.state_events(
                result.finished,
                stage,
                C.EVENT_FINISHED,
                at,
                epoch * 10 + 2,
                pages=F.col("total_pages"),
                total_pages=F.col("total_pages"),
            )
            .unionByName(
                state.state_events(tried, stage, C.EVENT_FAILED, at, epoch * 10 + 2, error=F.col("error"))
            )
            .unionByName(state.register_absent(result.produced, other, result.next_stage, at))
        )
        ws.append(ended, "state", stage, epoch, "end")
        announced = result.produced.select("s3_key", bodies.announcement(F.col("s3_key")).alias("body"))
        ws.append(announced, "announcements", stage, epoch)
        unnamed = keyed.filter(F.col("s3_key").isNull()).select("message_id", "body").distinct()
        dead = (
            routing.raw_letters(poison, at)
            .unionByName(routing.raw_letters(unnamed, at))
            .unionByName(letters(given_up, at))
        )
        ws.append(dead, "dead_letters", stage, epoch)
        # Nothing is written without failures: an empty file would start a micro-batch.
        retried = not again.isEmpty()
        if retried:
            redeliver(again, epoch)
        ended_at = limits.clock()
        # A message took as long as its keys did; where that is not known, its share of the whole.
        seconds = (ended_at - began).total_seconds() / max(1, counted.count())
        outcomes = message_outcomes(poison, keyed, again, given_up, result.timing).select(
            F.lit(queue).alias("queue"),
            "message_id",
            "outcome",
            at.alias("started_at"),
            F.lit(ended_at).alias("finished_at"),
            F.coalesce("seconds", F.lit(seconds)).alias("seconds"),
        )
        ws.append(outcomes, "outcomes", stage, epoch)
        return retried
    finally:
        for cached in held:
            cached.unpersist()


def message_outcomes(
    poison: DataFrame,
    keyed: DataFrame,
    again: DataFrame,
    given_up: DataFrame,
    timing: DataFrame | None = None,
) -> DataFrame:
    """``message_id, outcome, seconds``: the worst of what happened to the message's keys, and their time."""
    routed = again.select("s3_key", F.lit(1).alias("_rank")).unionByName(
        given_up.select("s3_key", F.lit(2).alias("_rank"))
    )
    timed = keyed.withColumn("seconds", F.lit(None).cast("double"))
    if timing is not None:
        timed = keyed.join(timing, "s3_key", "left")
    ranked = timed.join(routed, "s3_key", "left").withColumn(
        "_rank", F.when(F.col("s3_key").isNull(), 2).otherwise(F.coalesce("_rank", F.lit(0)))
    )
    outcome = (
        F.when(F.col("_rank") == 2, C.OUTCOME_DEAD_LETTER)
        .when(F.col("_rank") == 1, C.OUTCOME_FAILED)
        .otherwise(C.OUTCOME_PROCESSED)
    )
    handled = ranked.groupBy("message_id").agg(F.max("_rank").alias("_rank"), F.sum("seconds").alias("seconds"))
    return handled.select("message_id", outcome.alias("outcome"), "seconds").unionByName(
        poison.select("message_id", F.lit(C.OUTCOME_DEAD_LETTER).alias("outcome"), F.lit(0.0).alias("seconds"))
    )


# --- page stage ---


@dataclass(frozen=True)
class PageTable:
    """Pages stored as a table with one folder per key."""

    root: str

    def known(self, spark: SparkSession) -> DataFrame | None:
        """``s3_key`` of all files, where they are known without being asked for by name."""
        return page_source.page_table_keys(spark, self.root)

    def existing(self, spark: SparkSession, names: list[str]) -> list[str]:
        found = page_source.page_table_keys(spark, self.root).filter(F.col("s3_key").isin(names))
        return sorted(row["s3_key"] for row in found.collect())

    def sizes(self, spark: SparkSession, names: list[str]) -> DataFrame:
        lengths = page_source.scan_page_lengths(spark, self.root)
        return R.page_sizes(lengths.filter(F.col("s3_key").isin(names)))

    def pages(self, spark: SparkSession, names: list[str]) -> DataFrame:
        return page_source.scan_page_table(spark, self.root).filter(F.col("s3_key").isin(names))

    def broken(self, spark: SparkSession, names: list[str]) -> dict[str, str]:
        """Nothing: the table is written by Spark, and one that cannot be read is nobody's file."""
        return {}


@dataclass(frozen=True)
class PageFiles:
    """Pages stored as one Parquet file per key below a bucket folder."""

    root: str

    def known(self, spark: SparkSession) -> DataFrame | None:
        """Nothing: a bucket is asked by names, and may hold very many others."""
        return None

    def existing(self, spark: SparkSession, names: list[str]) -> list[str]:
        return listing.existing(spark, self.root, names)

    def sizes(self, spark: SparkSession, names: list[str]) -> DataFrame:
        return R.page_sizes(self.pages(spark, names))

    def pages(self, spark: SparkSession, names: list[str]) -> DataFrame:
        if not names:
            return spark.createDataFrame([], "s3_key string, page_no long, page_bytes binary")
        pages = page_source.scan_pages(spark, self.root, listing.paths_of(self.root, names))
        return pages.filter(F.col("s3_key").isin(names)) if listing.has_patterns(names) else pages

    def broken(self, spark: SparkSession, names: list[str]) -> dict[str, str]:
        """Files of a slice that cannot be read; only asked for after a read failed."""
        found = page_source.broken_files(spark, self.root, listing.paths_of(self.root, names))
        return {row["s3_key"]: row["error"] for row in found.collect() if row["s3_key"] in names}


# What Spark says when a file, and not the cluster, is to blame.
FILE_PROBLEMS = ("FAILED_READ_FILE", "CANNOT_READ_FILE_FOOTER", "PARQUET_")


def is_file_problem(problem: Exception) -> bool:
    return any(mark in str(problem) for mark in FILE_PROBLEMS)


ENDED = "end"
ABSENT = "absent"
FLUSHED = "flushed"


def write_planned(
    spark: SparkSession, ws: Workspace, source: PageFiles | PageTable, names: list[str], epoch: int, step: str
) -> None:
    """Write the batches of a step's manifest, whose pages are in the files ``names``."""
    planned = ws.read(spark, "manifest", only=(C.STAGE_PAGES, epoch), step=step)
    ws.append(R.page_runs(planned), "runs", C.STAGE_PAGES, epoch, step)
    runs = ws.read(spark, "runs", only=(C.STAGE_PAGES, epoch), step=step)
    folder = ws.part("batches", C.STAGE_PAGES, epoch, step)
    containers.write(R.batched_pages(source.pages(spark, names), runs), folder)
    ws.append(containers.index(spark, ws.path("batches"), folder), "containers", C.STAGE_PAGES, epoch, step)


def close_waiting(
    spark: SparkSession, ws: Workspace, source: PageFiles | PageTable, rows: DataFrame, epoch: int, step: str
) -> None:
    """Write waiting batches as they are. They are at most one per shard, so their files can be named."""
    named = R.name_batches(rows.withColumn("batch_no", F.lit(0)), mixed=True)
    ws.append(named, "manifest", C.STAGE_PAGES, epoch, step)
    write_planned(spark, ws, source, keys_of(rows), epoch, step)


def checked(spark: SparkSession, checks: dict[str, str | None]) -> DataFrame:
    """``s3_key, error`` of a slice's keys, handed over as Arrow: no Python worker starts for it."""
    columns = {"s3_key": pa.array(checks.keys(), pa.string()), "error": pa.array(checks.values(), pa.string())}
    return spark.createDataFrame(pa.table(columns), CHECKS).coalesce(1)


def keys_of(rows: DataFrame) -> list[str]:
    return sorted(row["s3_key"] for row in rows.select("s3_key").distinct().collect())


def waiting_pages(spark: SparkSession, ws: Workspace, epoch: int) -> DataFrame:
    """Pages that waited when micro-batch ``epoch`` had ended and were not flushed afterwards."""
    me = (C.STAGE_PAGES, epoch)
    flushed = ws.read(spark, "manifest", only=me, step=FLUSHED).select("custom_id")
    return ws.read(spark, "waiting", only=me, step=ENDED).join(flushed, "custom_id", "left_anti")


def completed_files(written: DataFrame, files: DataFrame, before: DataFrame, waiting: DataFrame) -> DataFrame:
    """``s3_key, total_pages`` of files that have no page waiting any more.

    ``written`` are pages written now, ``files`` those read now, ``before`` and ``waiting`` pages that waited before
    and wait still.
    """
    earlier = before.groupBy("s3_key").agg(F.max("written").alias("_earlier"))
    now = page_source.pages_per_file(written)
    ended = files.select("s3_key").unionByName(earlier.select("s3_key")).distinct()
    ended = ended.join(waiting.select("s3_key"), "s3_key", "left_anti")
    total = F.coalesce("total_pages", F.lit(0)) + F.coalesce("_earlier", F.lit(0))
    return ended.join(now, "s3_key", "left").join(earlier, "s3_key", "left").select("s3_key", total.alias("total_pages"))


def page_handler(ws: Workspace, source: PageFiles | PageTable, limits: Limits) -> Handler:
    """Page files to request batches.

    Keys without an object are told apart first where the source knows its keys, however many they are. The others
    are worked through in order, in slices of bounded size, all in the same way: those without an object and
    those whose file cannot be read are told apart, the others are planned and written. A slice without any object
    plans and writes nothing. The plan (which page goes
    into which batch) is written first and read back, so that the batches, the state and the announcements all
    follow the same plan and nothing is planned twice.

    The pages of mixed batches that a slice leaves open go first in the next one, so slices do not show in the
    batches. What the last slice leaves waits for the next micro-batch or is written (see :class:`Limits`). A file
    with waiting pages is neither done nor started again, and a micro-batch that is run again finds what waited
    before it.
    """

    def plan(spark: SparkSession, names: list[str], epoch: int, step: str, waiting: DataFrame) -> None:
        sizes = source.sizes(spark, names)
        if not limits.mixed:
            members = R.batch_members(sizes, max_bytes=limits.max_bytes, max_pages=limits.max_pages)
            ws.append(R.name_batches(members), "manifest", C.STAGE_PAGES, epoch, step)
            return
        members = R.continued_members(sizes, waiting, limits.shards, limits.max_bytes, limits.max_pages)
        members = R.name_batches(members, mixed=True)
        known = waiting.select("custom_id", "since", "written")
        members = members.join(known, "custom_id", "left").withColumns(
            {
                "since": F.coalesce("since", F.lit(limits.clock())),
                "written": F.coalesce("written", F.lit(0).cast("long")),
            }
        )
        # Named where a batch's pages are together already; what is not full gets its name when it is closed.
        ws.append(members, "planned", C.STAGE_PAGES, epoch, step)
        planned = ws.read(spark, "planned", only=(C.STAGE_PAGES, epoch), step=step)
        ws.append(planned.filter("full"), "manifest", C.STAGE_PAGES, epoch, step)
        # At most one batch per shard; its pages are counted from 1 again.
        first = F.min("pos").over(W.partitionBy("shard"))
        rest = planned.filter("NOT full").withColumn("pos", F.col("pos") - first + 1)
        ws.append(rest, "waiting", C.STAGE_PAGES, epoch, step)

    def one_slice(
        spark: SparkSession, asked: list[str], there: bool, epoch: int, step: str, waiting: DataFrame
    ) -> tuple[str, DataFrame]:
        """The step that the slice was written as, and the pages that wait after it.

        ``there`` says that all of ``asked`` are known to have an object.
        """
        names = asked if there else source.existing(spark, asked)
        checks = {name: NOT_FOUND for name in asked} | dict.fromkeys(names)
        if not names:
            # Under another name, so that nothing of a run that broke off counts as this slice's.
            step = f"{ABSENT}-{step}"
            ws.append(checked(spark, checks), "checks", C.STAGE_PAGES, epoch, step)
            return step, waiting
        try:
            plan(spark, names, epoch, step, waiting)
        except Exception as problem:
            bad = source.broken(spark, names) if is_file_problem(problem) else {}
            if not bad:
                raise
            checks |= bad
            names = [name for name in names if name not in bad]
            plan(spark, names, epoch, step, waiting)
        ws.append(checked(spark, checks), "checks", C.STAGE_PAGES, epoch, step)
        write_planned(spark, ws, source, sorted({*names, *keys_of(waiting)}), epoch, step)
        return step, ws.read(spark, "waiting", only=(C.STAGE_PAGES, epoch), step=step)

    def handle(spark: SparkSession, todo: DataFrame, epoch: int) -> StageResult:
        me = (C.STAGE_PAGES, epoch)
        before = waiting_pages(spark, ws, epoch - 1)
        fresh = todo.join(before.select("s3_key"), "s3_key", "left_anti")
        waiting, steps = before, []
        known = None if fresh.isEmpty() else source.known(spark)
        if known is None:
            ws.append(listing.ranged_slices(fresh, limits.slice_keys), "slices", *me)
        else:
            # The source is asked once, for those that are there and those that are not.
            asked = fresh.join(known.withColumn("_there", F.lit(True)), "s3_key", "left").persist()
            try:
                missing = asked.filter("_there IS NULL").select("s3_key", F.lit(NOT_FOUND).alias("error"))
                ws.append(missing, "checks", *me, ABSENT)
                steps.append(ABSENT)
                ws.append(listing.ranged_slices(asked.filter("_there"), limits.slice_keys), "slices", *me)
            finally:
                asked.unpersist()
        cut = ws.read(spark, "slices", only=me)
        for (i,) in sorted(cut.select("slice").distinct().collect()):
            asked = keys_of(cut.filter(F.col("slice") == i))
            step, waiting = one_slice(spark, asked, known is not None, epoch, f"slice-{i}", waiting)
            steps.append(step)
        due = F.lit(not limits.carry)
        if limits.flush_after is not None:
            due = due | (F.col("since") <= F.lit(limits.clock() - limits.flush_after))
        # A batch waits since its first page was planned.
        opened = waiting.withColumn("since", F.min("since").over(W.partitionBy("shard")))
        late = opened.filter(due)
        steps.append("late")
        if not late.isEmpty():
            close_waiting(spark, ws, source, late, epoch, steps[-1])
        # Bounds of slices may differ from those of a run that broke off: nothing of it may stay.
        for table, step in ws.steps(spark, ["manifest", "runs", "containers", "checks"], me):
            if step not in {*steps, FLUSHED}:
                ws.append(ws.empty(spark, table), table, *me, step)
        written = ws.read_steps(spark, "manifest", me, steps)
        now = page_source.pages_per_file(written).withColumnRenamed("total_pages", "_now")
        still = opened.filter(~due).join(now, "s3_key", "left")
        still = still.withColumn("written", F.col("written") + F.coalesce("_now", F.lit(0)))
        ws.append(still, "waiting", *me, ENDED)

        checks = ws.read_steps(spark, "checks", me, steps)
        left = ws.read(spark, "waiting", only=me, step=ENDED)
        finished = completed_files(written, checks.filter("error IS NULL"), before, left)
        failed = checks.filter("error IS NOT NULL")
        produced = ws.read_steps(spark, "runs", me, steps).select(F.col("batch_key").alias("s3_key")).distinct()
        return StageResult(finished, failed, produced, C.STAGE_OCR)

    return handle


def flush_waiting(spark: SparkSession, ws: Workspace, source: PageFiles | PageTable, limits: Limits = Limits()) -> None:
    """Write the mixed batches that still wait, announce them, and end the files they complete.

    To be run between runs of the page stage: it adds to its last micro-batch. Run again, it replaces what it wrote.
    """
    epoch = ws.next_epoch(spark, C.STAGE_PAGES) - 1
    me = (C.STAGE_PAGES, epoch)
    waiting = ws.read(spark, "waiting", only=me, step=ENDED)
    if waiting.isEmpty():
        return
    at = F.lit(limits.clock())
    close_waiting(spark, ws, source, waiting, epoch, FLUSHED)
    written = ws.read(spark, "manifest", only=me, step=FLUSHED)
    ended = completed_files(written, waiting, waiting, waiting.limit(0))
    total = F.col("total_pages")
    finished = state.state_events(ended, C.STAGE_PAGES, C.EVENT_FINISHED, at, epoch * 10 + 5, pages=total, total_pages=total)
    produced = ws.read(spark, "runs", only=me, step=FLUSHED).select(F.col("batch_key").alias("s3_key")).distinct()
    log = ws.read(spark, "state").filter(F.col("stage") == C.STAGE_OCR)
    # Not absent because of an earlier run of this: the same event again counts as one.
    registered = state.register_absent(produced, state.about(log, produced).filter(F.col("event") != C.EVENT_REGISTERED), C.STAGE_OCR, at)
    ws.append(finished.unionByName(registered), "state", C.STAGE_PAGES, epoch, FLUSHED)
    announced = produced.select("s3_key", bodies.announcement(F.col("s3_key")).alias("body"))
    ws.append(announced, "announcements", C.STAGE_PAGES, epoch, FLUSHED)


# --- inference stage ---


def ocr_handler(ws: Workspace, provider: inference.Provider, limits: Limits) -> Handler:
    """Request batches to responses, in slices of a bounded number of objects.

    Every object is opened once, for all of its batches that are asked for. Responses are written before anything is
    derived from them: the provider is called once per batch and micro-batch, not once per output.
    """
    root = ws.path("batches")

    def handle(spark: SparkSession, todo: DataFrame, epoch: int) -> StageResult:
        me = (C.STAGE_OCR, epoch)
        # The index is read once for all slices.
        wanted = todo.select(F.col("s3_key").alias("batch_key"))
        found = ws.read(spark, "containers").join(wanted, "batch_key", "left_semi")
        ws.append(containers.located_once(spark, root, found, limits.slice_keys), "located", *me)
        located = ws.read(spark, "located", only=me)
        n = listing.slices(located.select("object").distinct(), limits.slice_keys)
        for i in range(n):
            mine = located.filter(shard_of(F.col("object"), n) == i)
            called = inference.run_provider(containers.as_lines(containers.read_located(spark, root, mine)), provider)
            ws.append(called, "responses", *me, f"slice-{i}")
        responses = ws.read_steps(spark, "responses", me, [f"slice-{i}" for i in range(n)])
        ws.append(inference.quarantined(responses), "quarantine", *me)
        answered, errors = inference.split_errors(responses)
        response_source.write_responses(answered, ws.part("documents", *me, ENDED))
        ws.append(inference.response_pages(answered), "response_pages", *me)

        finished = answered.select(
            F.col("batch_key").alias("s3_key"), F.size("custom_ids").cast("long").alias("total_pages")
        )
        absent = todo.join(responses.select(F.col("batch_key").alias("s3_key")), "s3_key", "left_anti")
        failed = errors.select(F.col("batch_key").alias("s3_key"), "error").unionByName(
            absent.select("s3_key", F.lit(NOT_FOUND).alias("error"))
        )
        produced = answered.select(K.response_key(F.col("batch_key")).alias("s3_key"))
        timing = responses.select(F.col("batch_key").alias("s3_key"), "seconds")
        return StageResult(finished, failed, produced, C.STAGE_RESPONSES, timing)

    return handle


# --- running them ---


@dataclass
class Stage:
    """A stage as a ``foreachBatch`` function.

    ``retries`` are the micro-batches since it was last asked whose failed keys were delivered
    again, and ``redelivered`` gives the messages of one of them.
    """

    process: Callable[[DataFrame, int], bool]
    redelivered: Callable[[SparkSession, int], DataFrame]
    retries: list[int] = field(default_factory=list)

    def __call__(self, rows: DataFrame, epoch: int) -> None:
        if self.process(rows, epoch):
            self.retries.append(epoch)

    def take_retries(self) -> list[int]:
        taken, self.retries = self.retries, []
        return taken


def start(
    stream: DataFrame,
    process: Callable[[DataFrame, int], None],
    checkpoint: str,
    name: str,
    every: str | None = None,
) -> StreamingQuery:
    """Start a stage: until stopped, or with ``every=None`` until the input that is there is used up."""
    writer = stream.writeStream.queryName(name).foreachBatch(process).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()


def page_stage(
    ws: Workspace, source: PageFiles | PageTable, limits: Limits = Limits(), retries: str = "messages"
) -> Stage:
    """The page stage. Failed keys come back as messages in the folder ``retries`` of the workspace."""
    handler = page_handler(ws, source, limits)

    def folder(epoch: int) -> str:
        return f"{ws.path(retries)}/retry-{epoch}"

    def redeliver(failed: DataFrame, epoch: int) -> None:
        again = failed.select(
            F.concat_ws("-", F.lit("retry"), F.lit(epoch), F.sha2("s3_key", 256)).alias("message_id"),
            bodies.announcement(F.col("s3_key")).alias("body"),
            F.lit(None).cast("map<string,string>").alias("attributes"),
        )
        messages.write_messages(again, folder(epoch))

    def process(rows: DataFrame, epoch: int) -> bool:
        return run_stage(
            rows, epoch, ws, C.STAGE_PAGES, "pages", handler, routing.failed_key_letters, redeliver, limits
        )

    return Stage(process, lambda spark, epoch: spark.read.schema(schemas.MESSAGE).json(folder(epoch)))


def ocr_stage(
    ws: Workspace, provider: inference.Provider, limits: Limits = Limits(), retries: str = RETRY
) -> Stage:
    """The inference stage. Failed keys are announced again by the writer ``retries``."""
    handler = ocr_handler(ws, provider, limits)

    def redeliver(failed: DataFrame, epoch: int) -> None:
        again = failed.select("s3_key", bodies.announcement(F.col("s3_key")).alias("body"))
        ws.append(again, "announcements", retries, epoch)

    def process(rows: DataFrame, epoch: int) -> bool:
        return run_stage(
            rows, epoch, ws, C.STAGE_OCR, "batches", handler, routing.failed_page_letters, redeliver, limits
        )

    def redelivered(spark: SparkSession, epoch: int) -> DataFrame:
        rows = ws.read(spark, "announcements", only=(retries, epoch))
        nothing = F.lit(None).cast("map<string,string>").alias("attributes")
        return rows.select(F.sha2(F.concat_ws("-", F.lit(epoch), "s3_key"), 256).alias("message_id"), "body", nothing)

    return Stage(process, redelivered)


def _page_stream(spark: SparkSession, ws: Workspace, max_files: int) -> DataFrame:
    return messages.message_stream(spark, ws.path("messages"), max_files)


def _batch_stream(spark: SparkSession, ws: Workspace, max_files: int) -> DataFrame:
    folders = f"{ws.path('announcements')}/{{writer={C.STAGE_PAGES},writer={RETRY}}}"
    return messages.announcement_stream(spark, folders, max_files)


def start_page_stage(
    spark: SparkSession,
    ws: Workspace,
    source: PageFiles | PageTable,
    limits: Limits = Limits(),
    every: str = EVERY,
    max_files: int = C.MAX_MESSAGES_PER_POLL,
) -> StreamingQuery:
    """Read messages from the workspace's landing folder and batch the pages they name, until stopped."""
    stream = _page_stream(spark, ws, max_files)
    return start(stream, page_stage(ws, source, limits), ws.path("checkpoints/pages"), "pages", every)


def start_ocr_stage(
    spark: SparkSession,
    ws: Workspace,
    provider: inference.Provider,
    limits: Limits = Limits(),
    every: str = EVERY,
    max_files: int = C.MAX_MESSAGES_PER_POLL,
) -> StreamingQuery:
    """Read the page stage's announcements and run the provider over the batches, until stopped."""
    stream = _batch_stream(spark, ws, max_files)
    return start(stream, ocr_stage(ws, provider, limits), ws.path("checkpoints/ocr"), "ocr", every)


def run_page_stage(
    spark: SparkSession,
    ws: Workspace,
    source: PageFiles | PageTable,
    limits: Limits = Limits(),
    max_files: int = C.MAX_MESSAGES_PER_POLL,
    flush: bool = True,
) -> None:
    """The page stage until its messages are used up, those of failed keys included.

    Each pass ends with the messages that were there when it began; keys that failed in it are
    in the next. So every key is done, or a dead letter, when this returns. Without ``flush``
    carried batches wait for a later run.
    """
    stage = page_stage(ws, source, limits)
    _until_settled(stage, lambda: start(_page_stream(spark, ws, max_files), stage, ws.path("checkpoints/pages"), "pages"))
    if flush:
        flush_waiting(spark, ws, source, limits)


def run_ocr_stage(
    spark: SparkSession,
    ws: Workspace,
    provider: inference.Provider,
    limits: Limits = Limits(),
    max_files: int = C.MAX_MESSAGES_PER_POLL,
) -> None:
    """The inference stage until its announcements are used up, those of failed batches included."""
    stage = ocr_stage(ws, provider, limits)
    _until_settled(stage, lambda: start(_batch_stream(spark, ws, max_files), stage, ws.path("checkpoints/ocr"), "ocr"))


def _until_settled(stage: Stage, one_pass: Callable[[], StreamingQuery]) -> None:
    one_pass().awaitTermination()
    while stage.take_retries():
        one_pass().awaitTermination()
