"""Run log: append-only events, and the views that read them.

Files cannot be updated, so closing a step appends a second event; readers take the
latest event of each step.
"""

from __future__ import annotations

from concurrent.futures import Future, ThreadPoolExecutor
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.functions.display import clock
from orrery.schemas import RUN_LOG, assert_schema
from orrery.workspace import read_or_empty

_DETAILS = ("started_at", "ended_at", "row_count", "duration_ms", "status", "message")


class LogWriter:
    """Appends events with rising ids, one after the other, beside the work they report.

    One writer serves one run. Its single thread keeps the order of events and spares
    a step the wait for its own log row; `flush` waits for what is still to be written.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._next = None
        self._thread = ThreadPoolExecutor(1, thread_name_prefix="run-log")
        self._pending: list[Future] = []

    def read(self) -> DataFrame:
        return read_or_empty(self.spark, RUN_LOG.schema, self.path)

    def flush(self) -> None:
        pending, self._pending = self._pending, []
        for write in pending:
            write.result()

    def event(
        self,
        run_id: str,
        step: str,
        status: str,
        started_at: datetime,
        ended_at: datetime | None = None,
        row_count: int | None = None,
        message: str | None = None,
        duration_ms: int | None = None,
    ) -> None:
        values = (run_id, step, started_at, ended_at, row_count, duration_ms, status, message)
        columns = [c for c in RUN_LOG.columns if c.name != "log_id"]
        row = self.spark.range(0, 1, 1, 1).select(
            F.lit(1).alias("log_id"),
            *[F.lit(v).cast(c.dtype).alias(c.name) for v, c in zip(values, columns)],
        )
        self.events(row, 1)

    def events(self, rows: DataFrame, n: int) -> None:
        """Append n events whose log ids count from 1; they are moved past the stored ones."""
        self._pending.append(self._thread.submit(self._append, rows, n))

    def _append(self, rows: DataFrame, n: int) -> None:
        if self._next is None:
            self._next = (self.read().agg(F.max("log_id")).first()[0] or 0) + 1
        moved = rows.withColumn("log_id", (F.col("log_id") + (self._next - 1)).cast("long"))
        assert_schema(moved, RUN_LOG).coalesce(1).write.mode("append").parquet(self.path)
        self._next += n


def run_log_latest(log: DataFrame) -> DataFrame:
    """One row per run and step: the latest event, listed under the id of the first.

    `max_by` merges on the map side, so a run that owns most of the log is reduced
    where it lies instead of being sorted in one task.
    """
    latest = F.max_by(F.struct(*_DETAILS), F.col("log_id"))
    return (
        log.groupBy("run_id", "step_name")
        .agg(F.min("log_id").alias("log_id"), latest.alias("event"))
        .select("log_id", "run_id", "step_name", *[f"event.{name}" for name in _DETAILS])
    )


def _of_last_run(log: DataFrame) -> DataFrame:
    owner = log.agg(F.max_by("run_id", "log_id")).scalar()
    return log.filter(F.col("run_id") == owner)


def last_run(log: DataFrame) -> DataFrame:
    """All events of the run that owns the highest log id, in order."""
    return _of_last_run(log).orderBy("log_id")


def last_run_log(log: DataFrame) -> DataFrame:
    """Current state of each step of the last run, in order."""
    return run_log_latest(_of_last_run(log)).orderBy("log_id")


def run_log_display(rows: DataFrame) -> DataFrame:
    """Log rows with times of day, as shown to a reader."""
    return rows.select(
        "run_id",
        "step_name",
        clock(F.col("started_at")).alias("started_at"),
        clock(F.col("ended_at")).alias("ended_at"),
        "row_count",
        "duration_ms",
        "status",
        "message",
    )


def throughput(log: DataFrame, src_rows: Column) -> DataFrame:
    """Per run: rows loaded by its batches, elapsed time, rows per second, time remaining.

    Whole milliseconds and whole rows per second; remaining time is the time the
    missing rows would take at the rate so far.
    """
    batches = log.filter(F.col("step_name").startswith("FACT_CHUNK"))
    runs = batches.groupBy("run_id").agg(
        F.count("*").alias("batches"),
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("rows_loaded"),
        F.min("started_at").alias("first_start"),
        F.max("ended_at").alias("last_end"),
    )
    elapsed = F.timestamp_diff("MILLISECOND", F.col("first_start"), F.col("last_end"))
    missing = F.greatest(src_rows - F.col("rows_loaded"), F.lit(0))
    return runs.withColumn("elapsed_ms", elapsed).select(
        "run_id",
        "batches",
        "rows_loaded",
        "elapsed_ms",
        F.when(
            F.col("elapsed_ms") > 0,
            F.call_function("div", F.col("rows_loaded") * 1000, F.col("elapsed_ms")),
        ).alias("rows_per_second"),
        F.when(
            F.col("rows_loaded") > 0,
            F.call_function("div", missing * F.col("elapsed_ms"), F.col("rows_loaded")),
        ).alias("remaining_ms"),
    )
