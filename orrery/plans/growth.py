"""Loading only what is new: later lines into a published star, whose keys stay as they are."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from orrery.operators.batches import block_number, chunk_number
from orrery.operators.checks import IntegrityError, check_foreign_key, enforce
from orrery.operators.dims import (
    DIM_SPECS,
    DimSpec,
    build_dim_date,
    extract_dimension,
    require_unique,
)
from orrery.operators.fact import build_fact
from orrery.operators.idsets import repeated_ids
from orrery.operators.keys import dense_key
from orrery.operators.totals import source_totals
from orrery.plans.commits import ConcurrentChange
from orrery.plans.load import DONE, LoadResult, _elapsed_ms, _now
from orrery.plans.warehouse import APPEND, Warehouse
from orrery.schemas import DIM_DATE, FACT_SALES
from orrery.workspace import discard, observed

#: How often a load starts anew because another one was entered before it.
TRIES = 5


def new_members(stored: DataFrame, src: DataFrame, spec: DimSpec) -> DataFrame:
    """Rows for the codes of `src` that are not in `stored`, with keys after its highest.

    Keys follow the order of the new codes, without gaps. A known code must still have
    the attributes it is stored with.
    """
    tuples = extract_dimension(src, spec)
    known = stored.select(
        F.col(spec.code).alias("_code"), F.struct(*[n for n, _ in spec.attributes]).alias("_stored")
    )
    told = F.struct(*[n for n, _ in spec.attributes])
    changed = (
        tuples.join(known, F.col(spec.code) == F.col("_code"))
        .filter(~told.eqNullSafe(F.col("_stored")))
        .select(spec.code).limit(3).collect()
    )
    if changed:
        codes = ", ".join(sorted({str(r[0]) for r in changed}))
        raise IntegrityError(f"{spec.table.name}: {spec.code} with other attributes (such as {codes})")
    highest = stored.agg(F.max(spec.key)).first()[0] or 0
    fresh = tuples.join(known.select("_code"), F.col(spec.code) == F.col("_code"), "left_anti")
    keyed = dense_key(fresh, [spec.code], spec.key, first=highest + 1)
    return enforce(keyed.withColumn(spec.key, F.col(spec.key).cast("int")), spec.table)


def new_dates(stored: DataFrame, src: DataFrame, lang: str) -> DataFrame:
    """Calendar rows for the dates of `src` that are not in `stored`."""
    return build_dim_date(src, lang=lang).join(stored.select("date_key"), "date_key", "left_anti")


def load_new_lines(src: DataFrame, root: str, run_id: str | None = None) -> LoadResult:
    """Add the lines of `src` with ids above the highest one loaded to a published run.

    Dimensions get the new codes and dates; stored rows and keys do not change, and no
    stored fact is read or written. New rows are written beside the stored ones, checked
    in rows, amount, ids and dates, and entered in the run's log all at once. Loads may
    run at the same time: one that finds another entered before it starts anew from
    there, and so loads no line twice.
    """
    warehouse = Warehouse(src.sparkSession, root)
    run = run_id or warehouse.published_run()
    if run is None:
        raise ValueError("no star is published yet")
    started, since = _now(), time.monotonic_ns()
    for _ in range(TRIES):
        try:
            rows, highest = _add(src, warehouse, run)
            break
        except ConcurrentChange as change:
            refused = change
    else:
        raise refused
    spent = _elapsed_ms(since)
    warehouse.log.event(
        run, f"NEW_LINES_{highest}", DONE, started, _now(), rows, f"order_line_id up to {highest}", spent
    )
    warehouse.log.flush()
    return LoadResult(run, DONE, rows, spent)


def _add(src: DataFrame, warehouse: Warehouse, run: str) -> tuple[int, int]:
    changes, attempt = warehouse.changes(run), uuid.uuid4().hex
    based_on, plan = changes.last(), warehouse.plan(run)
    new = src.filter(F.col("order_line_id") > plan.highest)
    highest = new.agg(F.max("order_line_id")).first()[0]
    if highest is None:
        return 0, plan.highest
    stored = {name: warehouse.dimension(run, name) for name in ("dim_date", *[s.table.name for s in DIM_SPECS])}
    written: list[str] = []
    try:
        dims, sizes = {}, {}
        for spec in DIM_SPECS:
            name = spec.table.name
            path = f"{warehouse.added_path(run, name)}/attempt={attempt}"
            written.append(path)
            new_members(stored[name], new, spec).write.parquet(path)
            added = warehouse.spark.read.schema(spec.table.schema).parquet(path)
            count = require_unique(added, spec.code, name)
            dims[name] = stored[name].union(added)
            sizes[name] = stored[name].count() + count
        path = f"{warehouse.added_path(run, DIM_DATE.name)}/attempt={attempt}"
        written.append(path)
        new_dates(stored[DIM_DATE.name], new, plan.lang).select(*DIM_DATE.names).write.parquet(path)
        calendar = stored[DIM_DATE.name].union(warehouse.spark.read.schema(DIM_DATE.schema).parquet(path))
        loaded = _write_facts(new, dims, sizes, plan, warehouse, run, attempt, written)
        _check(new, loaded, calendar)

        def no_other_lines(entries: list) -> None:
            if any(entry.kind == APPEND for entry in entries):
                raise ConcurrentChange(f"other lines were added to {run} meanwhile")

        rows = loaded["rows"]
        changes.commit(
            {"kind": APPEND, "attempt": attempt, "from_id": plan.highest, "highest": highest, "rows": rows},
            based_on,
            no_other_lines,
        )
    except Exception:
        discard(warehouse.spark, *written)
        raise
    changes.tidy()
    return rows, highest


def _write_facts(new, dims, sizes, plan, warehouse: Warehouse, run, attempt, written: list[str]) -> dict:
    """Write the facts into their blocks; rows, amount and dates come with the write."""
    metrics = Observation()
    facts = (
        build_fact(new, dims, dim_rows=sizes)
        .withColumn("chunk_no", chunk_number(F.col("order_line_id"), plan.chunk_size))
        .withColumn("block", block_number(F.col("chunk_no"), plan.batches_a_block))
        .hint("rebalance", "block")
        .observe(
            metrics,
            F.count(F.lit(1)).alias("rows"),
            F.sum("amount").alias("amount"),
        )
    )
    path = f"{warehouse.added_path(run, FACT_SALES.name)}/attempt={attempt}"
    written.append(path)
    facts.write.partitionBy("block").parquet(path)
    return {"rows": observed(metrics, "rows"), "amount": metrics.get.get("amount")}


def _check(new: DataFrame, loaded: dict, calendar: DataFrame) -> None:
    """The lines must be facts, each once, of the same amount and with a known date."""
    lines = source_totals(new).first()
    if (lines.src_rows, lines.src_amount) != (loaded["rows"], loaded["amount"]):
        raise IntegrityError(
            f"reconciliation: {lines.src_rows} lines of {lines.src_amount}, "
            f"{loaded['rows']} facts of {loaded['amount']}"
        )
    repeated = repeated_ids(new, "order_line_id").first()
    if repeated:
        raise IntegrityError(f"{FACT_SALES.name}: duplicate order_line_id (such as {repeated[0]})")
    days = new.select(F.date_format("order_date", "yyyyMMdd").cast("int").alias("date_key")).distinct()
    unknown = check_foreign_key(days, "date_key", calendar, "date_key").first()
    if unknown:
        raise IntegrityError(f"{FACT_SALES.name}: date_key {unknown[0]} is not in {DIM_DATE.name}")
