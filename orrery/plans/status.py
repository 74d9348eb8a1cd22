"""State of a load at a glance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.operators.previews import fact_preview, source_next
from orrery.operators.totals import star_counts
from orrery.plans.control import STOP_REQUESTED
from orrery.plans.runlog import last_run_log, run_log_display
from orrery.plans.warehouse import Warehouse
from orrery.workspace import stored_names


def status(
    src: DataFrame, root: str, run_id: str | None = None, src_folder: str | None = None
) -> dict[str, DataFrame]:
    """Counts, log of the last run, last facts and next source lines, each a lazy frame.

    By default of the run that owns the newest log row, also while it is loading; its
    tables grow from call to call. Sizes are told of the facts, and of the source if
    its folder is given.
    """
    warehouse = Warehouse(src.sparkSession, root)
    log = warehouse.log.read()
    if run_id is None:
        newest = log.agg(F.max_by("run_id", "log_id")).first()
        run_id = newest[0] or warehouse.published_run()
    star = warehouse.star(run_id, partial=True)
    folders = {"src": src_folder} if src_folder else {}
    if run_id and "fact_sales" in stored_names(src.sparkSession, warehouse.run_path(run_id)):
        folders["fact"] = warehouse.table_path(run_id, "fact_sales")
    return {
        "counts": star_counts(src, star, warehouse.control.value(STOP_REQUESTED), folders),
        "run_log": run_log_display(last_run_log(log)),
        "preview": fact_preview(star),
        "source_next": source_next(src, star["fact_sales"]),
    }
