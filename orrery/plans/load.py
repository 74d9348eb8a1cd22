"""The whole load: dimensions, calendar, facts by batch, checks, publication.

By default all facts are one Spark write. With `threads` set, they are written block
by block, one, two or four blocks at a time. Both give the same star. The stop flag ends
what is being written; blocks that are whole stay readable. A batch is a range of ids and a number in the column
`chunk_no`; a block of many batches is a folder, so small batches cost no folders.
"""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from contextlib import contextmanager
from dataclasses import dataclass, replace
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from orrery.operators.batches import (
    BATCHES_A_BLOCK,
    DEFAULT_CHUNK_SIZE,
    block_number,
    chunk_number,
    in_interval,
    require_chunk_size,
)
from orrery.operators.checks import IntegrityError, check_foreign_key, check_unique
from orrery.operators.dims import DIM_SPECS, build_dim_date, build_dimension, require_unique
from orrery.operators.fact import build_fact, dimensions_bounded
from orrery.operators.idsets import crowded, id_bitmaps, repeated_ids
from orrery.operators.totals import reconcile, reconcile_source
from orrery.plans.control import STOP_REQUESTED
from orrery.plans.runlog import last_run_log
from orrery.plans.commits import ConcurrentChange
from orrery.plans.warehouse import APPEND, BASE, BLOCK, REPLAY, BatchPlan, Warehouse
from orrery.schemas import DIM_DATE, FACT_SALES, Table
from orrery.workspace import (
    BROADCAST_LIMIT_BYTES,
    discard,
    observed,
    shuffles_dropped,
    tables_dropped,
)

#: Jobs of a load that is written block by block; with more blocks than that, a job writes several.
JOBS_A_LOAD = 16
RUNNING, DONE, STOPPED, FAILED = "RUNNING", "DONE", "STOPPED", "FAILED"
STEP_OF_TABLE = {
    "dim_date": "DIM_DATE",
    "dim_customer": "DIM_CUSTOMER",
    "dim_salesrep": "DIM_SALESREP",
    "dim_product": "DIM_PRODUCT",
}


@dataclass(frozen=True)
class LoadParams:
    chunk_size: int = DEFAULT_CHUNK_SIZE
    batches_a_block: int = BATCHES_A_BLOCK
    threads: int | None = None  # None: one write for all facts; else 1, 2 or 4 blocks at a time
    lang: str = "en"
    source_clustered: bool = False  # source files hold contiguous ids, as write_orders leaves them
    verify_ids: bool = True  # look for repeated line ids before loading
    broadcast_limit: int = BROADCAST_LIMIT_BYTES

    def __post_init__(self):
        if self.threads not in (None, 1, 2, 4):
            raise ValueError("threads must be 1, 2 or 4, or None for a single write")
        require_chunk_size(self.chunk_size)
        if self.batches_a_block < 1:
            raise ValueError("a block holds one batch at least")


@dataclass(frozen=True)
class LoadResult:
    run_id: str
    status: str
    total_rows: int
    duration_ms: int
    message: str | None = None

    def require_done(self) -> LoadResult:
        if self.status == FAILED:
            raise IntegrityError(self.message or "load failed")
        return self


class LoadAlreadyRunning(RuntimeError):
    pass


class StepFailed(RuntimeError):
    def __init__(self, step: str, cause: BaseException):
        super().__init__(f"{step}: {_reason(cause)}")


def _reason(error: BaseException) -> str:
    """The whole text of an error, led by the line that says what went wrong."""
    text = str(error) or type(error).__name__
    for line in text.splitlines():
        if "USER_RAISED_EXCEPTION" in line:
            told = line.split("USER_RAISED_EXCEPTION]", 1)[-1].split("SQLSTATE", 1)[0].strip()
            return f"{told}\n{text}"
    return text


def _now() -> datetime:
    return datetime.now(timezone.utc)


def _elapsed_ms(since_ns: int) -> int:
    return round((time.monotonic_ns() - since_ns) / 1_000_000)


@contextmanager
def _step(name: str) -> Iterator[None]:
    try:
        yield
    except StepFailed:
        raise
    except Exception as error:
        raise StepFailed(name, error) from error


def lookup_tables(warehouse: Warehouse, run_id: str) -> dict[str, DataFrame]:
    return {spec.table.name: warehouse.dimension(run_id, spec.table.name) for spec in DIM_SPECS}


def _facts(
    warehouse: Warehouse,
    run_id: str,
    src: DataFrame,
    plan: BatchPlan,
    from_id: int | None = None,
    to_id: int | None = None,
    dim_rows: dict[str, int] | None = None,
    broadcast_limit: int = BROADCAST_LIMIT_BYTES,
    by_block: bool = False,
) -> DataFrame:
    """Fact rows with their batch number, rebalanced by their block if asked."""
    dims = lookup_tables(warehouse, run_id)
    batch = chunk_number(F.col("order_line_id"), plan.chunk_size)
    spread = block_number(batch, plan.batches_a_block) if by_block else None
    facts = build_fact(src, dims, from_id, to_id, dim_rows, limit=broadcast_limit, spread=spread)
    return facts.withColumn("chunk_no", batch)


def write_block(
    warehouse: Warehouse,
    run_id: str,
    src: DataFrame,
    plan: BatchPlan,
    block: int,
    dim_rows: dict[str, int] | None = None,
    broadcast_limit: int = BROADCAST_LIMIT_BYTES,
    metrics: Observation | None = None,
) -> None:
    """Load the batches of one block in one job; running it again replaces the block only.

    `metrics` gets the rows and the amount written.
    """
    from_id, to_id = plan.block_interval(block)
    facts = _facts(warehouse, run_id, src, plan, from_id, to_id, dim_rows, broadcast_limit)
    if metrics is not None:
        facts = watched(facts, metrics)
    facts.write.mode("overwrite").parquet(warehouse.block_path(run_id, block, BASE))


def write_stretch(
    warehouse: Warehouse,
    run_id: str,
    src: DataFrame,
    plan: BatchPlan,
    interval: tuple[int, int],
    dim_rows: dict[str, int] | None = None,
    broadcast_limit: int = BROADCAST_LIMIT_BYTES,
    metrics: Observation | None = None,
) -> None:
    """Load the blocks of an interval of ids in one job; running it again replaces these only.

    Blocks appear when all of them are written. Such jobs may run side by side: each has
    a staging folder of its own.
    """
    facts = _facts(warehouse, run_id, src, plan, *interval, dim_rows, broadcast_limit)
    numbered = facts.withColumns(
        {
            "block": block_number(F.col("chunk_no"), plan.batches_a_block),
            "attempt": F.lit(BASE),
        }
    )
    if metrics is not None:
        numbered = watched(numbered, metrics)
    if dim_rows is None or not dimensions_bounded(dim_rows, broadcast_limit):
        numbered = numbered.hint("rebalance", "block")
    path = warehouse.table_path(run_id, FACT_SALES.name)
    out = numbered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    out.partitionBy("block", "attempt").parquet(path)


def watched(facts: DataFrame, metrics: Observation) -> DataFrame:
    """Facts whose write tells their rows and amount, each task's result counted once."""
    return facts.observe(metrics, F.count(F.lit(1)).alias("rows"), F.sum("amount").alias("amount"))


def check_block(src: DataFrame, facts: DataFrame, calendar: DataFrame) -> int:
    """Facts must be the lines of `src`, each once, with the same amount and a known date."""
    sides = {row.table_name: row for row in reconcile(src, facts).collect()}
    source, loaded = sides["staging_orders"], sides["fact_sales"]
    if (source.row_count, source.total_amount) != (loaded.row_count, loaded.total_amount):
        raise IntegrityError(
            f"reconciliation: {source.row_count} lines of {source.total_amount}, "
            f"{loaded.row_count} facts of {loaded.total_amount}"
        )
    repeated = check_unique(facts, "order_line_id").first()
    if repeated:
        raise IntegrityError(f"{FACT_SALES.name}: duplicate order_line_id (such as {repeated[0]})")
    days = facts.select("date_key").distinct()
    unknown = check_foreign_key(days, "date_key", calendar, "date_key").first()
    if unknown:
        raise IntegrityError(f"{FACT_SALES.name}: date_key {unknown[0]} is not in {DIM_DATE.name}")
    return loaded.row_count


class StopWatch:
    """Ends the running writes of a load when the stop flag is raised.

    Its signals are listed every `seconds`. Jobs that belong to the load carry its tag, in
    whichever thread they were started.
    """

    def __init__(self, warehouse: Warehouse, tag: str, seconds: float = 1.0):
        self.warehouse, self.tag, self.seconds = warehouse, tag, seconds
        self.raised, self._over = False, threading.Event()
        self._before = warehouse.control.signals().last()

    def __enter__(self) -> StopWatch:
        self._thread = threading.Thread(target=self._watch, daemon=True)
        self._thread.start()
        return self

    def __exit__(self, *_) -> None:
        self._over.set()
        self._thread.join()

    def _watch(self) -> None:
        context, signals = self.warehouse.spark.sparkContext, self.warehouse.control.signals()
        while not self._over.wait(self.seconds):
            self.raised = self.raised or signals.last() > self._before
            if self.raised:
                context.cancelJobsWithTag(self.tag)

    def ends(self, write: Callable[[], None]) -> bool:
        """Run a write; True if the flag ended it, and nothing of it is left."""
        context = self.warehouse.spark.sparkContext
        context.addJobTag(self.tag)
        try:
            write()
        except Exception:
            if not self.raised:
                raise
            return True
        finally:
            context.removeJobTag(self.tag)
        return False


class _Run:
    def __init__(self, src: DataFrame, warehouse: Warehouse, params: LoadParams):
        self.src, self.warehouse, self.params = src, warehouse, params
        self.run_id = self._new_run_id()
        self.dim_rows: dict[str, int] = {}
        self.plan: BatchPlan | None = None
        self.loaded: list[tuple[int, int]] | None = None  # intervals of ids; None = all
        self.written: list[Observation] = []

    def _new_run_id(self) -> str:
        base = _now().strftime("RUN-%Y%m%d-%H%M%S")
        log = self.warehouse.log.read()
        taken = log.filter(F.col("run_id").startswith(base)).select("run_id").distinct().count()
        return base if not taken else f"{base}-{taken + 1}"

    def log(self, step: str, started: datetime, since_ns: int, rows: int, message=None) -> None:
        self.warehouse.log.event(
            self.run_id, step, DONE, started, _now(), rows, message, _elapsed_ms(since_ns)
        )

    def timed(self, step: str, work: Callable[[], int]) -> tuple[str, datetime, int, int, int]:
        started, since = _now(), time.monotonic_ns()
        with _step(step):
            rows = work()
        return step, started, since, rows, _elapsed_ms(since)

    # -- steps ---------------------------------------------------------------

    def truncate(self) -> int:
        """A run starts in a folder of its own, where every table is still empty."""
        return 0

    def store_dimension(self, table: Table, build: Callable[[], DataFrame], unique: str) -> int:
        """Write a dimension; its generated keys are unique by construction, its codes are checked."""
        path = self.warehouse.table_path(self.run_id, table.name)
        with tables_dropped(self.warehouse.spark):
            build().write.mode("overwrite").parquet(path)
        stored = self.warehouse.dimension(self.run_id, table.name)
        self.dim_rows[table.name] = require_unique(stored, unique, table.name)
        return self.dim_rows[table.name]

    def prepare(self) -> None:
        """Dimensions, source check and batch plan: independent jobs over different columns."""
        work = [
            (DIM_DATE, "date_key", lambda: build_dim_date(self.src, lang=self.params.lang)),
            *[(s.table, s.code, lambda s=s: build_dimension(self.src, s)) for s in DIM_SPECS],
        ]
        with ThreadPoolExecutor(len(work) + 2) as pool:
            checked = pool.submit(self.check_source)
            plan = pool.submit(self.plan_batches)
            pending = [
                pool.submit(
                    self.timed,
                    STEP_OF_TABLE[table.name],
                    lambda table=table, unique=unique, build=build: self.store_dimension(
                        table, build, unique
                    ),
                )
                for table, unique, build in work
            ]
            for job in pending:
                step, started, since, rows, spent = job.result()
                self.warehouse.log.event(
                    self.run_id, step, DONE, started, _now(), rows, None, spent
                )
            with _step("SOURCE"):
                checked.result()
            with _step("BATCH_PLAN"):
                plan.result()

    def plan_batches(self) -> None:
        ids = F.col("order_line_id")
        least, highest = self.src.agg(F.min(ids), F.max(ids)).first()
        if least is not None and least < 1:
            raise IntegrityError(f"{FACT_SALES.name}: order_line_id {least} is below 1")
        params = self.params
        self.plan = BatchPlan(params.chunk_size, params.batches_a_block, highest or 0, params.lang)
        self.warehouse.store_plan(self.run_id, self.plan)

    def facts_in_one_write(self, watch: StopWatch) -> None:
        started, since = _now(), time.monotonic_ns()
        stopped = self.warehouse.control.stop_requested()
        with _step("FACT_CHUNK"):
            stopped = stopped or watch.ends(lambda: self._write_all(self.src))
            if stopped:  # nothing of the write is left: an empty table stands for it
                self.written.clear()
                self._write_all(self.src.limit(0))
        if stopped:
            self.loaded = []
        else:
            self.log_batches(1, self.plan.batches, started, since)

    def _write_all(self, src: DataFrame) -> None:
        limit, plan = self.params.broadcast_limit, self.plan
        stays_in_place = self.params.source_clustered and dimensions_bounded(self.dim_rows, limit)
        facts = _facts(
            self.warehouse, self.run_id, src, plan,
            dim_rows=self.dim_rows, broadcast_limit=limit, by_block=not stays_in_place,
        ).withColumns(
            {
                "block": block_number(F.col("chunk_no"), plan.batches_a_block),
                "attempt": F.lit(BASE),
            }
        )
        metrics = Observation()
        path = self.warehouse.table_path(self.run_id, FACT_SALES.name)
        facts = watched(facts, metrics)
        facts.write.mode("overwrite").partitionBy("block", "attempt").parquet(path)
        self.written.append(metrics)

    def facts_by_block(self, watch: StopWatch) -> None:
        """Blocks as separate jobs. They start in order, and none after a stop or failure.

        Every job reads the dimensions anew. So that their cost does not grow with the lines
        times the dimensions, there are `JOBS_A_LOAD` jobs at most; with more blocks a job
        writes a stretch of several. A stop ends the blocks that are being written; those
        that are whole stay. Only as many are held as run at a time.
        """
        plan, threads = self.plan, self.params.threads
        blocks_a_job = max(-(-plan.blocks // JOBS_A_LOAD), 1)
        jobs = replace(plan, batches_a_block=plan.batches_a_block * blocks_a_job)
        empty = _facts(self.warehouse, self.run_id, self.src.limit(0), plan).withColumns(
            {"block": F.lit(0).cast("long"), "attempt": F.lit(BASE)}
        )
        path = self.warehouse.table_path(self.run_id, FACT_SALES.name)
        empty.write.partitionBy("block", "attempt").parquet(path)

        def one(job: int) -> None:
            started, since = _now(), time.monotonic_ns()
            first = (job - 1) * jobs.batches_a_block + 1
            last = min(job * jobs.batches_a_block, plan.batches)
            blocks = range(plan.block_of(first), plan.block_of(last) + 1)
            name = f"FACT_CHUNK_{first}" if first == last else f"FACT_CHUNK_{first}-{last}"
            metrics = Observation()

            def write() -> None:
                write, what = write_block, blocks[0]
                if blocks_a_job > 1:
                    write, what = write_stretch, jobs.block_interval(job)
                write(
                    self.warehouse, self.run_id, self.src, plan, what,
                    self.dim_rows, self.params.broadcast_limit, metrics,
                )

            with _step(name):
                ended = watch.ends(write)
                if ended:
                    left = [self.warehouse.block_path(self.run_id, block, BASE) for block in blocks]
                    discard(self.warehouse.spark, *left)
            if ended:
                cut.append(job)
                return
            self.written.append(metrics)
            self.log_batches(first, last, started, since, blocks)

        cut: list[int] = []
        running: set[Future] = set()
        job = 1
        with ThreadPoolExecutor(threads) as pool:
            while job <= jobs.blocks and not cut and not self.warehouse.control.stop_requested():
                running.add(pool.submit(one, job))
                job += 1
                if len(running) == threads:
                    done, running = wait(running, return_when=FIRST_COMPLETED)
                    for future in done:
                        future.result()
            for future in running:
                future.result()
        if cut or job <= jobs.blocks:
            # all jobs that were started but those cut: one interval between any two of them
            ends = [0, *sorted(cut), job]
            spans = [(a + 1, b - 1) for a, b in zip(ends, ends[1:]) if a + 1 < b]
            self.loaded = [(jobs.block_interval(a)[0], jobs.block_interval(b)[1]) for a, b in spans]

    def log_batches(
        self, first: int, last: int, started: datetime, since_ns: int, blocks: range | None = None
    ) -> None:
        """One event for each of these batches; their rows are counted in one narrow column."""
        plan, (ended, spent) = self.plan, (_now(), _elapsed_ms(since_ns))
        stored = self.warehouse.table_path(self.run_id, FACT_SALES.name)
        facts = self.warehouse.spark.read.schema("chunk_no long, block long").parquet(stored)
        if blocks is not None:
            facts = facts.filter(F.col("block").between(blocks[0], blocks[-1]))
        counted = facts.groupBy("chunk_no").agg(F.count("*").alias("row_count"))
        numbers = self.warehouse.spark.range(first, last + 1).withColumnRenamed("id", "chunk_no")
        span = F.concat_ws(
            "-", (F.col("chunk_no") - 1) * plan.chunk_size, F.col("chunk_no") * plan.chunk_size
        )
        rows = numbers.join(counted, "chunk_no", "left").select(
            (F.col("chunk_no") - (first - 1)).alias("log_id"),
            F.lit(self.run_id).alias("run_id"),
            F.concat(F.lit("FACT_CHUNK_"), F.col("chunk_no").cast("string")).alias("step_name"),
            F.lit(started).alias("started_at"),
            F.lit(ended).alias("ended_at"),
            F.coalesce("row_count", F.lit(0)).cast("long").alias("row_count"),
            F.lit(spent).cast("long").alias("duration_ms"),
            F.lit(DONE).alias("status"),
            F.concat(F.lit("order_line_id "), span).alias("message"),
        )
        self.warehouse.log.events(rows, max(last - first + 1, 0))

    # -- checks --------------------------------------------------------------

    def check_source(self) -> None:
        # ids move only if some bucket shows that one repeats
        if self.params.verify_ids and not crowded(id_bitmaps(self.src, "order_line_id")).isEmpty():
            repeated = repeated_ids(self.src, "order_line_id").limit(1).collect()
            if repeated:
                raise IntegrityError(
                    f"{FACT_SALES.name}: duplicate order_line_id (such as {repeated[0][0]})"
                )

    def check_facts(self) -> int:
        """Facts must agree with the lines of the loaded batches, in rows and amount.

        Rows and amount of the facts come with their write; they are not read again.

        Line ids and codes are unique by now, so a lookup can only lose lines; equal
        counts mean that every code was found. The calendar is of the same source.
        """
        expected = self.src
        if self.loaded is not None:
            line, inside = F.col("order_line_id"), F.lit(False)
            for low, high in self.loaded:  # no more than blocks that ran at a time, and one
                inside = inside | ((line > low) & (line <= high))
            expected = expected.filter(inside)
        lines = reconcile_source(expected).first()
        rows = sum(observed(m, "rows") for m in self.written)
        amount = sum(observed(m, "amount") for m in self.written)
        if (lines.row_count, lines.total_amount or 0) != (rows, amount):
            raise IntegrityError(
                f"reconciliation: {lines.row_count} lines of {lines.total_amount}, "
                f"{rows} facts of {amount}"
            )
        return rows

    # -- the run -------------------------------------------------------------

    def run(self) -> LoadResult:
        started, since = _now(), time.monotonic_ns()
        params = self.params
        settings = (
            f"chunk={params.chunk_size} "
            f"threads={params.threads or 'all'} lang={params.lang}"
        )
        self.warehouse.log.event(self.run_id, "PIPELINE", RUNNING, started, message=settings)
        self.warehouse.log.flush()
        total, message = 0, None
        try:
            step, begun, mark, rows, _ = self.timed("TRUNCATE_STAR", self.truncate)
            self.log(step, begun, mark, rows)
            with shuffles_dropped(self.warehouse.spark):
                self.prepare()
                with StopWatch(self.warehouse, f"{self.run_id}-{uuid.uuid4().hex}") as watch:
                    if params.threads:
                        self.facts_by_block(watch)
                    else:
                        self.facts_in_one_write(watch)
                with _step("CHECKS"):
                    total = self.check_facts()
            status = DONE if self.loaded is None else STOPPED
            self.warehouse.publish(self.run_id, status, total)
        except Exception as error:
            status, message, total = FAILED, str(error), 0
        ended, spent = _now(), _elapsed_ms(since)
        for step in ("PIPELINE_END", "PIPELINE"):
            self.warehouse.log.event(
                self.run_id, step, status, started, ended, total, message, spent
            )
        self.warehouse.log.flush()
        return LoadResult(self.run_id, status, total, spent, message)


def load_star(src: DataFrame, root: str, params: LoadParams | None = None) -> LoadResult:
    """Full reload of the star under `root` from flat order lines.

    The new star replaces the published one only after all checks; a failed load is
    reported in the result and the log, and leaves the published star as it was.
    """
    warehouse = Warehouse(src.sparkSession, root).create()
    return _Run(src, warehouse, params or LoadParams()).run()


def start_load(src: DataFrame, root: str, params: LoadParams | None = None) -> LoadResult:
    """`load_star` behind the double-start guard, with the stop flag lowered first."""
    warehouse = Warehouse(src.sparkSession, root).create()
    first = last_run_log(warehouse.log.read()).select("status").first()
    if first is not None and first.status == RUNNING:
        raise LoadAlreadyRunning("a load is already running")
    warehouse.control.set(STOP_REQUESTED, "false")
    return _Run(src, warehouse, params or LoadParams()).run()


def request_stop(spark, root: str) -> None:
    """Ask a running load to end the batches being written and to skip those that remain."""
    Warehouse(spark, root).create().control.set(STOP_REQUESTED, "true")


def reset(spark, root: str) -> None:
    """Empty star, empty log, stop flag down."""
    Warehouse(spark, root).create().reset()


def replay_batch(
    src: DataFrame, root: str, chunk_no: int, chunk_size: int | None = None, run_id=None
) -> int:
    """Load one batch of a run again, by the plan stored with the run; its row count.

    Only the batch is written, beside what is read, checked against its lines in rows,
    amount, ids and dates, and then entered in the run's log, which puts it in the place
    of the batch's earlier rows. A failed check leaves the run as it was, and readers
    that opened it before keep what they opened. Replays may run at the same time, of
    one batch too: the one entered last counts. If lines were added to the batch
    meanwhile, the replay did not read them and is refused.
    """
    warehouse = Warehouse(src.sparkSession, root)
    run = run_id or warehouse.published_run()
    if run is None:
        raise ValueError("no star is published yet")
    changes = warehouse.changes(run)
    based_on, plan = changes.last(), warehouse.plan(run)
    if chunk_size is not None and chunk_size != plan.chunk_size:
        raise ValueError(f"{run} was loaded in batches of {plan.chunk_size}, not {chunk_size}")
    if not 1 <= chunk_no <= plan.batches:
        raise ValueError(f"{run} has batches 1 to {plan.batches}, not {chunk_no}")
    started, since = _now(), time.monotonic_ns()
    from_id, to_id = plan.interval(chunk_no)
    block, attempt = plan.block_of(chunk_no), uuid.uuid4().hex
    sizes = {spec.table.name: warehouse.dimension(run, spec.table.name).count() for spec in DIM_SPECS}
    path = warehouse.block_path(run, block, attempt)
    _facts(warehouse, run, src, plan, from_id, to_id, sizes).write.parquet(path)
    staged = warehouse.spark.read.schema(FACT_SALES.schema).parquet(path)

    def lines_were_added(entries: list) -> None:
        for entry in entries:
            if entry.kind == APPEND and entry.from_id < to_id and entry.highest > from_id:
                raise ConcurrentChange(f"batch {chunk_no} of {run} got lines meanwhile; replay it again")

    try:
        rows = check_block(
            in_interval(src, from_id, to_id), staged, warehouse.dimension(run, DIM_DATE.name)
        )
        entry = {"kind": REPLAY, "attempt": attempt, "block": block, "chunk_no": chunk_no, "rows": rows}
        changes.commit(entry, based_on, lines_were_added)
    except (IntegrityError, ConcurrentChange):
        discard(warehouse.spark, path)
        raise
    changes.tidy()
    warehouse.log.event(
        run, f"FACT_CHUNK_{chunk_no}", DONE, started, _now(), rows,
        f"order_line_id {from_id}-{to_id}", _elapsed_ms(since),
    )
    warehouse.log.flush()
    return rows


def merge_block(spark, root: str, block: int, run_id: str | None = None) -> int:
    """Write the rows of a block that are read into one attempt, after many replays; its rows.

    Refused if another writer changes the block meanwhile.
    """
    warehouse = Warehouse(spark, root)
    run = run_id or warehouse.published_run()
    if run is None:
        raise ValueError("no star is published yet")
    changes, attempt = warehouse.changes(run), uuid.uuid4().hex
    based_on, plan = changes.last(), warehouse.plan(run)
    if not 1 <= block <= plan.blocks:
        raise ValueError(f"{run} has blocks 1 to {plan.blocks}, not {block}")
    low, high = plan.block_interval(block)
    path, counted = warehouse.block_path(run, block, attempt), Observation()
    warehouse.block(run, block).observe(counted, F.count(F.lit(1)).alias("rows")).write.parquet(path)
    rows = observed(counted, "rows")

    def block_was_changed(entries: list) -> None:
        for entry in entries:
            added = entry.kind == APPEND and entry.from_id < high and entry.highest > low
            if added or entry.block == block:
                raise ConcurrentChange(f"block {block} of {run} was changed meanwhile")

    try:
        changes.commit({"kind": BLOCK, "attempt": attempt, "block": block, "rows": rows}, based_on, block_was_changed)
    except ConcurrentChange:
        discard(spark, path)
        raise
    return rows
