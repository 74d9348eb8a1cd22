"""Where intermediate tables go, and how a side is judged small enough to broadcast."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_LIMIT_BYTES = 256 * 1024 * 1024
_ROW_OVERHEAD = 32
_BYTES_PER_CHARACTER = 4

_SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_local_root: dict[str, str] = {}
_stored: ContextVar[list[str] | None] = ContextVar("stored", default=None)
_dropping: dict[str, tuple[int, str]] = {}  # by session: steps that run inside, the setting before the first
_lock = threading.Lock()


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by `spark.checkpoint.dir`.

    Only a local session without that setting gets a temporary folder of its own;
    a cluster session without it is refused, because a machine-local folder would
    be lost with its machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.conf.get("spark.app.id", "local")
    if app not in _local_root:
        _local_root[app] = tempfile.mkdtemp(prefix="orrery-")
    return _local_root[app]


def new_folder(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that nothing has used before."""
    return f"{shared_root(spark)}/orrery/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once to the shared folder and read it back.

    Cuts the lineage in a way that survives the loss of executors, and keeps the
    data columnar, so later readers still prune columns.
    """
    path = new_folder(df.sparkSession, label)
    if (stored := _stored.get()) is not None:
        stored.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def tables_dropped(spark: SparkSession) -> Iterator[None]:
    """Tables that this thread stores inside by `materialise` go at the end, also of a step that fails.

    For steps whose results are stored elsewhere or collected.
    """
    token = _stored.set(paths := [])
    try:
        yield
    finally:
        _stored.reset(token)
        discard(spark, *paths)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the jobs run inside go as each ends, not when the driver next collects garbage.

    For steps whose results are stored or collected. It is a setting of the session, whatever the
    thread; the last of the steps that run side by side sets it back.
    """
    session = spark._jsparkSession.sessionUUID()
    with _lock:
        steps, before = _dropping.get(session) or (0, spark.conf.get(_SHUFFLES_GO))
        _dropping[session] = steps + 1, before
        spark.conf.set(_SHUFFLES_GO, "true")
    try:
        yield
    finally:
        with _lock:
            steps, before = _dropping.pop(session)
            if steps > 1:
                _dropping[session] = steps - 1, before
            else:
                spark.conf.set(_SHUFFLES_GO, before)


def observed(metrics: Observation, name: str) -> int:
    """A count or sum that came with a finished write; 0 if no row took part in it."""
    return metrics.get.get(name) or 0


def discard(spark: SparkSession, *paths: str) -> None:
    """Delete stored tables that nothing reads any more, on whatever store they are."""
    for path in paths:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def stored_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly under a folder; none if it does not exist."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(where):
        return []
    return sorted(status.getPath().getName() for status in files.listStatus(where))


def widest_row_bytes(schema: T.StructType, max_lengths: dict[str, int]) -> int | None:
    """Upper bound of one row in memory; None when a text column has no known limit."""
    total = _ROW_OVERHEAD
    for field in schema.fields:
        if isinstance(field.dataType, T.StringType):
            if field.name not in max_lengths:
                return None
            total += 8 + _BYTES_PER_CHARACTER * max_lengths[field.name]
        elif isinstance(field.dataType, T.DecimalType):
            total += 24
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType, T.BinaryType)):
            return None
        else:
            total += 8
    return total


def read_or_empty(spark: SparkSession, schema: T.StructType, path: str) -> DataFrame:
    """The stored table, or no rows if nothing has been written there yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def fits(schema: T.StructType, rows: int, max_lengths: dict[str, int], limit: int) -> bool:
    """Whether counted rows times the widest row stay under `limit`."""
    width = widest_row_bytes(schema, max_lengths)
    return width is not None and rows * width <= limit


def broadcast_if_bounded(
    df: DataFrame,
    rows: int,
    max_lengths: dict[str, int],
    limit: int = BROADCAST_LIMIT_BYTES,
) -> DataFrame:
    """Hint a broadcast only for a frame that `fits`.

    Beyond the limit the frame is returned without a hint: the join then shuffles
    both sides, and adaptive execution splits a partition swollen by a hot key.
    """
    return F.broadcast(df) if fits(df.schema, rows, max_lengths, limit) else df
