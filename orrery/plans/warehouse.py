"""Where a star lives: one folder per run, a run log, control values, and what is published."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orrery.plans.commits import CommitLog
from orrery.plans.control import STOP_REQUESTED, ControlTable
from orrery.plans.runlog import LogWriter
from orrery.schemas import DIMENSIONS, FACT_SALES, RUN_LOG, STAR, Table
from orrery.workspace import discard, read_or_empty, stored_names

_PUBLICATION = (
    T.StructType().add("run_id", "string").add("status", "string").add("rows", "long")
    .add("version", "long")
)
_PLAN = (
    T.StructType().add("chunk_size", "long").add("batches_a_block", "long").add("highest", "long")
    .add("lang", "string")
)
#: Entries that change a run: a batch or a block written anew, or lines that came after it.
_CHANGE = "kind string, attempt string, block long, chunk_no long, from_id long, highest long, rows long"
REPLAY, BLOCK, APPEND = "replay", "block", "append"
#: The attempt that a load itself writes.
BASE = "base"
COMPLETE = "DONE"


class MissingRun(LookupError):
    """A run, or a table of it, that should be stored is not there."""


@dataclass(frozen=True)
class BatchPlan:
    """How a run cut its source; stored with the run, so that a batch can be loaded again."""

    chunk_size: int
    batches_a_block: int
    highest: int
    lang: str = "en"

    @property
    def batches(self) -> int:
        return -(-self.highest // self.chunk_size)

    @property
    def blocks(self) -> int:
        return -(-self.batches // self.batches_a_block)

    def interval(self, chunk_no: int) -> tuple[int, int]:
        return (chunk_no - 1) * self.chunk_size, chunk_no * self.chunk_size

    def block_interval(self, block: int) -> tuple[int, int]:
        width = self.chunk_size * self.batches_a_block
        return (block - 1) * width, block * width

    def block_of(self, chunk_no: int) -> int:
        return (chunk_no - 1) // self.batches_a_block + 1


class Warehouse:
    """Paths and small state tables under one root folder.

    Facts lie in folders block/attempt. A load writes the attempt `BASE`. Loading a batch
    again writes an attempt of its own, and lines that came later lie in folders
    attempt/block. An entry of the run's commit log makes an attempt readable; the
    entry's number is its version.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.log = LogWriter(spark, f"{self.root}/etl_run_log")
        self.control = ControlTable(spark, f"{self.root}/etl_control")
        self._published = f"{self.root}/published"

    def create(self) -> Warehouse:
        """Make the state tables that do not exist yet."""
        self._empty(RUN_LOG).write.mode("ignore").parquet(self.log.path)
        self._publication("", "", 0).limit(0).write.mode("ignore").parquet(self._published)
        self.control.create()
        return self

    def _empty(self, table: Table) -> DataFrame:
        return self.spark.createDataFrame([], table.schema)

    def _row(self, schema: T.StructType, *values) -> DataFrame:
        """One row made by the executors; nothing is sent from the driver."""
        return self.spark.range(0, 1, 1, 1).select(
            *[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(values, schema.fields)]
        )

    def run_path(self, run_id: str) -> str:
        return f"{self.root}/runs/{run_id}"

    def table_path(self, run_id: str, table: str) -> str:
        return f"{self.run_path(run_id)}/{table}"

    def block_path(self, run_id: str, block: int, attempt: str) -> str:
        return f"{self.table_path(run_id, FACT_SALES.name)}/block={block}/attempt={attempt}"

    def added_path(self, run_id: str, table: str) -> str:
        """Rows that came after the load, by attempt: each writer has a folder of its own."""
        return f"{self.run_path(run_id)}/added/{table}"

    def changes(self, run_id: str) -> CommitLog:
        return CommitLog(self.spark, f"{self.run_path(run_id)}/commits", _CHANGE)

    # -- the plan of a run ---------------------------------------------------

    def store_plan(self, run_id: str, plan: BatchPlan) -> None:
        row = self._row(_PLAN, plan.chunk_size, plan.batches_a_block, plan.highest, plan.lang)
        row.write.mode("overwrite").parquet(self.table_path(run_id, "batch_plan"))

    def plan(self, run_id: str) -> BatchPlan:
        row = self._stored(_PLAN, run_id, "batch_plan").first()
        if row is None:
            raise MissingRun(f"{run_id} has no batch plan")
        later = self.changes(run_id).read().filter(F.col("kind") == APPEND)
        highest = max(row.highest, later.agg(F.max("highest")).first()[0] or 0)
        return BatchPlan(row.chunk_size, row.batches_a_block, highest, row.lang or "en")

    # -- tables of a run -----------------------------------------------------

    def _stored(self, schema, run_id: str, name: str, partial: bool = False) -> DataFrame:
        """A table of a run. Only a run that is still loading may lack one."""
        path = self.table_path(run_id, name)
        if partial:
            return read_or_empty(self.spark, schema, path)
        try:
            return self.spark.read.schema(schema).parquet(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            raise MissingRun(f"{name} of run {run_id} is not stored under {self.root}") from error

    def dimension(self, run_id: str, name: str, partial: bool = False) -> DataFrame:
        """The rows of the load, and those that later lines added."""
        table = DIMENSIONS[name]
        rows = self._stored(table.schema, run_id, name, partial)
        if "added" not in stored_names(self.spark, self.run_path(run_id)):
            return rows
        added = read_or_empty(
            self.spark, table.schema.add("attempt", "string"), self.added_path(run_id, name)
        )
        entered = self.changes(run_id).read().filter(F.col("kind") == APPEND).select("attempt")
        return rows.union(added.join(entered, "attempt", "left_semi").select(*table.names))

    def batches(self, run_id: str, partial: bool = False) -> DataFrame:
        """Fact rows with the number of the batch that loaded them."""
        return self._visible(run_id, partial).select(*FACT_SALES.names, "chunk_no")

    def _visible(self, run_id: str, partial: bool = False) -> DataFrame:
        """Rows of entered attempts that nothing entered later replaced."""
        kinds = (*FACT_SALES.schema.fields, T.StructField("chunk_no", T.LongType()),
                 T.StructField("block", T.LongType()), T.StructField("attempt", T.StringType()))
        schema = T.StructType(list(kinds))
        facts = self._stored(schema, run_id, FACT_SALES.name, partial)
        if "added" in stored_names(self.spark, self.run_path(run_id)):
            added = read_or_empty(self.spark, schema, self.added_path(run_id, FACT_SALES.name))
            facts = facts.unionByName(added)
        log = self.changes(run_id)
        if not log.last():
            return facts.filter(F.col("attempt") == BASE)
        entries = log.read()
        base = self.spark.range(0, 1, 1, 1).select(F.lit(BASE).alias("attempt"), F.col("id").alias("_version"))
        versions = entries.select("attempt", F.col("version").alias("_version")).union(base)

        def since(kind: str, column: str, name: str) -> DataFrame:
            """From which version on the rows of a batch or block count."""
            return (
                entries.filter(F.col("kind") == kind).groupBy(F.col(column).alias(f"_{column}"))
                .agg(F.max("version").alias(name))
            )

        batch, block = since(REPLAY, "chunk_no", "_batch_from"), since(BLOCK, "block", "_block_from")
        return (
            facts.join(versions, "attempt")
            .join(batch, F.col("chunk_no") == F.col("_chunk_no"), "left")
            .join(block, F.col("block") == F.col("_block"), "left")
            .filter(
                F.col("_version")
                >= F.greatest(F.coalesce("_batch_from", F.lit(0)), F.coalesce("_block_from", F.lit(0)))
            )
            .drop("_version", "_chunk_no", "_batch_from", "_block", "_block_from")
        )

    def block(self, run_id: str, block: int) -> DataFrame:
        return self._visible(run_id).filter(F.col("block") == block).select(*FACT_SALES.names, "chunk_no")

    def star(self, run_id: str | None = None, partial: bool = False) -> dict[str, DataFrame]:
        """The tables of a run, by default of the last complete one; without any, empty tables.

        A run that is named must be stored. `partial` is for a run that is still
        loading, whose missing tables are read as empty.
        """
        run = run_id or self.published_run()
        if run is None:
            return {table.name: self._empty(table) for table in STAR.values()}
        tables = {name: self.dimension(run, name, partial) for name in DIMENSIONS}
        tables[FACT_SALES.name] = self.batches(run, partial).select(*FACT_SALES.names)
        return tables

    # -- publication ---------------------------------------------------------

    def publish(self, run_id: str, status: str, rows: int) -> None:
        """Record a finished run. Readers open the last one whose status is DONE."""
        self._publication(run_id, status, rows).write.mode("append").parquet(self._published)

    def published_run(self) -> str | None:
        complete = self._publications().filter(F.col("status").isin(COMPLETE, ""))
        row = complete.agg(F.max_by("run_id", "version")).first()
        return row[0] or None

    def publications(self) -> DataFrame:
        """run_id, status and rows of the runs recorded since the last reset, oldest first."""
        every = self._publications()
        reset = F.coalesce(
            every.filter("status = ''").agg(F.max("version")).scalar(), F.lit(0).cast("long")
        )
        return every.filter(F.col("version") > reset).orderBy("version")

    def _publications(self) -> DataFrame:
        return read_or_empty(self.spark, _PUBLICATION, self._published)

    def _publication(self, run_id: str, status: str, rows: int) -> DataFrame:
        return self._row(_PUBLICATION, run_id, status, rows, time.time_ns())

    # -- storage -------------------------------------------------------------

    def stored_runs(self) -> list[str]:
        return stored_names(self.spark, f"{self.root}/runs")

    def drop_runs(self, keep: int = 1) -> list[str]:
        """Free all runs but the last `keep` complete ones; the dropped ones.

        A run that is still loading is the caller's to wait for.
        """
        if keep < 1:
            raise ValueError("at least the published run is kept")
        complete = self.publications().filter(F.col("status") == COMPLETE)
        newest = complete.orderBy(F.col("version").desc()).limit(keep).collect()
        kept = {row.run_id for row in newest}
        dropped = [run for run in self.stored_runs() if run not in kept]
        discard(self.spark, *[self.run_path(run) for run in dropped])
        return dropped

    def reset(self) -> None:
        """No star published or stored, log empty, stop flag down."""
        self.publish("", "", 0)
        discard(self.spark, *[self.run_path(run) for run in self.stored_runs()])
        self._empty(RUN_LOG).write.mode("overwrite").parquet(self.log.path)
        self.log = LogWriter(self.spark, self.log.path)
        self.control.set(STOP_REQUESTED, "false")


def open_star(spark: SparkSession, root: str, run_id: str | None = None) -> dict[str, DataFrame]:
    return Warehouse(spark, root).star(run_id)


def drop_runs(spark: SparkSession, root: str, keep: int = 1) -> list[str]:
    return Warehouse(spark, root).drop_runs(keep)
