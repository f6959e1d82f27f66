"""Folders a running pipeline works in, and tables that a repeated micro-batch rewrites.

Every micro-batch writes its rows of a table to a folder named by the writing stage and
the micro-batch number. A micro-batch that is run again after a failure replaces its own
folders, so at-least-once execution leaves each row once. For the same reason it must not
see what its first run wrote: ``read(..., before=...)`` leaves that out.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagemill import schemas
from pagemill.operators import inference, state

WRITTEN_BY = [
    T.StructField("writer", T.StringType()),
    T.StructField("epoch", T.LongType()),
    T.StructField("step", T.StringType()),
]

MANIFEST = T.StructType(
    [
        T.StructField("batch_key", T.StringType()),
        T.StructField("pos", T.LongType()),
        T.StructField("s3_key", T.StringType()),
        T.StructField("page_no", T.LongType()),
        T.StructField("custom_id", T.StringType()),
        T.StructField("size", T.LongType()),
    ]
)
RUNS = T.StructType(
    [
        T.StructField("batch_key", T.StringType()),
        T.StructField("s3_key", T.StringType()),
        T.StructField("first_page", T.LongType()),
        T.StructField("last_page", T.LongType()),
        T.StructField("first_pos", T.LongType()),
    ]
)
CHECKS = T.StructType(
    [
        T.StructField("s3_key", T.StringType()),
        T.StructField("error", T.StringType()),
    ]
)
CONTAINERS = T.StructType(
    [
        T.StructField("batch_key", T.StringType()),
        T.StructField("object", T.StringType()),
        T.StructField("pages", T.LongType()),
    ]
)
LOCATED = T.StructType(CONTAINERS.fields[:2])
RESPONSE_PAGES = T.StructType(
    [
        T.StructField("batch_key", T.StringType()),
        T.StructField("index", T.IntegerType()),
        T.StructField("markdown", T.StringType()),
        T.StructField("n_images", T.LongType()),
        T.StructField("dpi", T.IntegerType()),
        T.StructField("height", T.IntegerType()),
        T.StructField("width", T.IntegerType()),
        T.StructField("model", T.StringType()),
        T.StructField("custom_id", T.StringType()),
    ]
)
QUARANTINE = T.StructType(
    [
        T.StructField("batch_key", T.StringType()),
        T.StructField("custom_id", T.StringType()),
    ]
)

# Keys of a micro-batch in the order they are worked through.
SLICES = T.StructType(
    [
        T.StructField("s3_key", T.StringType()),
        T.StructField("slice", T.IntegerType()),
    ]
)
# Pages of a mixed batch that is not full yet: where they are, not what they hold. ``since`` is when they were
# planned, ``written`` how many pages of the same file are in batches written before this micro-batch.
WAITING = T.StructType(
    [
        T.StructField("shard", T.IntegerType()),
        T.StructField("pos", T.LongType()),
        T.StructField("s3_key", T.StringType()),
        T.StructField("page_no", T.LongType()),
        T.StructField("custom_id", T.StringType()),
        T.StructField("size", T.LongType()),
        T.StructField("since", T.TimestampType()),
        T.StructField("written", T.LongType()),
    ]
)
PLANNED = T.StructType(
    [
        *WAITING.fields,
        T.StructField("batch_key", T.StringType()),
        T.StructField("batch_no", T.LongType()),
        T.StructField("full", T.BooleanType()),
    ]
)

FOLD = [
    T.StructField("writer", T.StringType()),
    T.StructField("epoch", T.LongType()),
    T.StructField("fold", T.LongType()),
]

TABLES = {
    "state": schemas.STATE_EVENT,
    "announcements": schemas.ANNOUNCEMENT,
    "dead_letters": schemas.DEAD_LETTER,
    "outcomes": schemas.OUTCOME,
    "checks": CHECKS,
    "slices": SLICES,
    "planned": PLANNED,
    "waiting": WAITING,
    "manifest": MANIFEST,
    "runs": RUNS,
    "containers": CONTAINERS,
    "located": LOCATED,
    "responses": inference.RESPONSES,
    "response_pages": RESPONSE_PAGES,
    "quarantine": QUARANTINE,
}


@dataclass(frozen=True)
class Workspace:
    """Paths below one shared folder."""

    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def part(self, name: str, writer: str, epoch: int, step: str) -> str:
        """Folder of what one step of a micro-batch writes."""
        return f"{self.path(name)}/writer={writer}/epoch={epoch}/step={step}"

    def append(self, df: DataFrame, table: str, writer: str, epoch: int, step: str = "end") -> None:
        """Write a micro-batch's rows; the same micro-batch again replaces them."""
        folder = self.part(table, writer, epoch, step)
        df.select(*TABLES[table].names).write.mode("overwrite").parquet(folder)

    def read(
        self,
        spark: SparkSession,
        table: str,
        before: tuple[str, int] | None = None,
        only: tuple[str, int] | None = None,
        step: str | None = None,
    ) -> DataFrame:
        """A table's rows: all, those from before a micro-batch ran, or only that one's.

        ``only`` (with ``step``, one step of it) reads just its folder; the other tests are on
        folder names, so folders that fail them are listed but not opened.
        """
        if only is not None:
            folder = f"{self.path(table)}/writer={only[0]}/epoch={only[1]}"
            folder = folder if step is None else f"{folder}/step={step}"
            return self._folder(spark, folder, TABLES[table])
        rows = self._stored(spark, table, [*TABLES[table].fields, *WRITTEN_BY])
        if table == "state":
            rows = self._with_folded(spark, rows)
        if before is not None:
            rows = rows.filter(~(_by(before[0]) & (F.col("epoch") >= before[1])))
        return rows.drop("writer", "epoch", "step")

    def read_steps(self, spark: SparkSession, table: str, only: tuple[str, int], steps: list[str]) -> DataFrame:
        """Rows that the named steps of a micro-batch wrote; steps that wrote nothing have none."""
        return self._by_step(spark, table, only).filter(F.col("step").isin(steps)).drop("step")

    def steps(self, spark: SparkSession, tables: list[str], only: tuple[str, int]) -> set[tuple[str, str]]:
        """``(table, step)`` for the steps of a micro-batch that have rows, found by one job."""
        found = [self._by_step(spark, table, only).select(F.lit(table).alias("table"), "step") for table in tables]
        every = functools.reduce(DataFrame.unionByName, found).distinct()
        return {(row["table"], row["step"]) for row in every.collect()}

    def empty(self, spark: SparkSession, table: str) -> DataFrame:
        return no_rows(spark, TABLES[table])

    def _by_step(self, spark: SparkSession, table: str, only: tuple[str, int]) -> DataFrame:
        folder = f"{self.path(table)}/writer={only[0]}/epoch={only[1]}"
        return self._folder(spark, folder, T.StructType([*TABLES[table].fields, WRITTEN_BY[2]]))

    def next_epoch(self, spark: SparkSession, writer: str) -> int:
        """Number after the last micro-batch that was completed: outcomes are written last.

        A micro-batch that broke off has this number too, and is replaced.
        """
        rows = self._stored(spark, "outcomes", [*TABLES["outcomes"].fields, *WRITTEN_BY])
        last = rows.filter(_by(writer)).agg(F.max("epoch")).first()[0]
        return 0 if last is None else last + 1

    def _stored(self, spark: SparkSession, name: str, fields: list[T.StructField]) -> DataFrame:
        return self._folder(spark, self.path(name), T.StructType(fields))

    def _folder(self, spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
        try:
            return spark.read.schema(schema).parquet(folder).select(*schema.names)
        except AnalysisException as problem:
            if "PATH_NOT_FOUND" not in str(problem):
                raise
            return no_rows(spark, schema)

    def _folds(self, spark: SparkSession) -> tuple[int, dict[str, int]]:
        """Number of the newest finished fold, and the last micro-batch of each writer in it."""
        rows = self._stored(spark, "state_folds", FOLD)
        newest = rows.agg(F.max("fold")).first()[0]
        if newest is None:
            return -1, {}
        covered = rows.filter(F.col("fold") == newest).collect()  # one row per writing stage
        return newest, {row["writer"]: row["epoch"] for row in covered}

    def _with_folded(self, spark: SparkSession, rows: DataFrame) -> DataFrame:
        """The newest fold of the state log and the log's rows that are not in it."""
        newest, covered = self._folds(spark)
        if newest < 0:
            return rows
        for writer, epoch in covered.items():
            rows = rows.filter(~(_by(writer) & (F.col("epoch") <= epoch)))
        folded = spark.read.schema(TABLES["state"]).parquet(f"{self.path('state_folded')}/fold={newest}")
        return rows.unionByName(folded, allowMissingColumns=True)

    def fold_state(self, spark: SparkSession) -> None:
        """Replace the state log, for its readers, by at most two events per key.

        To be run between runs of the stages. The last micro-batch of each stage is left
        out, because it may have to be run again and must not see itself. What is folded
        may then be deleted.
        """
        newest, covered = self._folds(spark)
        log = self._stored(spark, "state", [*TABLES["state"].fields, *WRITTEN_BY])
        last = {r["writer"]: r["epoch"] for r in log.groupBy("writer").agg(F.max("epoch").alias("epoch")).collect()}
        rows = self._with_folded(spark, log)
        for writer, epoch in last.items():
            rows = rows.filter(~(_by(writer) & (F.col("epoch") >= epoch)))
            covered[writer] = max(epoch - 1, covered.get(writer, -1))
        fold = newest + 1
        folded = state.compact_log(rows.select(*TABLES["state"].names))
        folded.write.mode("overwrite").parquet(f"{self.path('state_folded')}/fold={fold}")
        # Only this makes the fold count; a fold without it is never read.
        spark.createDataFrame(list(covered.items()), "writer string, epoch long").coalesce(1).write.mode(
            "overwrite"
        ).parquet(f"{self.path('state_folds')}/fold={fold}")


def no_rows(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """An empty table that the optimizer knows to be empty, so that nothing runs for it."""
    columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
    return spark.range(0).filter(F.lit(False)).select(*columns)


def _by(writer: str) -> Column:
    return F.coalesce(F.col("writer") == writer, F.lit(False))
