"""Streaming form of the fact load: new source files in, facts and monthly revenue out."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orrery.functions.calendar import year_month
from orrery.functions.money import line_amount
from orrery.operators.checks import IntegrityError, check_foreign_key
from orrery.operators.fact import build_fact
from orrery.operators.idsets import BITMAPS, bucket_of, crowded, id_bitmaps, shared_buckets
from orrery.plans.commits import CommitLog, ConcurrentChange
from orrery.schemas import FACT_SALES, STAGING_ORDERS, TOTAL
from orrery.workspace import discard, observed, read_or_empty, stored_names

_PUBLICATION = "publication string, stream string, batch long, rows long, arrived long, low long, high long"
#: What two deliveries of one line must agree in.
_TOLD = [name for name in FACT_SALES.names if name != "loaded_at"]


def orders_stream(spark: SparkSession, path: str, files_per_batch: int = 8) -> DataFrame:
    """Order lines of the files that appear under `path`."""
    return (
        spark.readStream.schema(STAGING_ORDERS.schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(path)
    )


class StreamFacts:
    """Facts under `out`, to which any number of streams add.

    A micro-batch writes its facts, and bitmaps of their ids, under a name of its own
    (`publication`). One entry of the log makes it readable; it names the stream, by the
    id that its checkpoint keeps, and the stream's batch, so that a batch that is run
    again after it was entered is left out. Ids are told apart by their bitmaps; only
    facts in buckets where two deliveries share an id are read to compare them.
    """

    def __init__(self, spark: SparkSession, out: str):
        self.spark, self.out = spark, out.rstrip("/")
        self.log = CommitLog(spark, f"{self.out}/commits", _PUBLICATION)

    def _stored(self, kind: str, schema: T.StructType) -> DataFrame:
        every = read_or_empty(self.spark, T.StructType([*schema.fields, T.StructField("publication", T.StringType())]), f"{self.out}/{kind}")
        return every.join(self.log.read().select("publication", "version"), "publication")

    def facts(self, after: int = 0) -> DataFrame:
        """The facts published so far, or those of entries after the number `after`."""
        stored = self._stored("facts", FACT_SALES.schema)
        return stored.filter(F.col("version") > after).select(*FACT_SALES.names)

    def bitmaps(self, after: int = 0) -> DataFrame:
        stored = self._stored("ids", T._parse_datatype_string(BITMAPS))
        return stored.filter(F.col("version") > after).select("bucket", "bitmap", "n")

    def _path(self, kind: str, publication: str) -> str:
        return f"{self.out}/{kind}/publication={publication}"

    def _read(self, kind: str, publication: str) -> DataFrame:
        schema = FACT_SALES.schema if kind == "facts" else T._parse_datatype_string(BITMAPS)
        return self.spark.read.schema(schema).parquet(self._path(kind, publication))

    def _drop(self, publication: str) -> None:
        discard(self.spark, *[self._path(kind, publication) for kind in ("facts", "ids")])

    def add(self, lines: DataFrame, stream: str, batch: int, dims: Mapping[str, DataFrame], dim_rows=None) -> None:
        """Publish the facts of one micro-batch, once."""
        entered = (F.col("stream") == stream) & (F.col("batch") == batch)
        while True:
            based_on = self.log.last()
            if not self.log.read().filter(entered).isEmpty():
                return
            publication, entry = self._stage(lines, batch, dims, dim_rows)
            if entry is None:
                return
            try:
                publication, rows = self._without_known(publication, batch)

                def others(entries: list) -> None:
                    if any(e.stream == stream and e.batch == batch for e in entries):
                        raise ConcurrentChange(f"batch {batch} was published meanwhile")
                    since = entries[0].version - 1
                    if not shared_buckets(self._read("ids", publication), self.bitmaps(since)).isEmpty():
                        raise ConcurrentChange("other streams published lines of this batch")

                self.log.commit(
                    {**entry, "publication": publication, "rows": rows, "stream": stream, "batch": batch},
                    based_on,
                    others,
                )
                self.log.tidy()
                return
            except ConcurrentChange:
                self._drop(publication)  # look again at what is published now
            except IntegrityError:
                self._drop(publication)
                raise

    def _stage(self, lines: DataFrame, batch: int, dims, dim_rows) -> tuple[str, dict | None]:
        """Write the facts of all lines delivered; checks come with the write."""
        publication = uuid.uuid4().hex
        arrived, made = lines.count(), Observation()
        if not arrived:
            return publication, None
        facts = build_fact(lines, dims, dim_rows=dim_rows).observe(
            made,
            F.count(F.lit(1)).alias("facts"),
            F.min("order_line_id").alias("low"),
            F.max("order_line_id").alias("high"),
        )
        facts.write.parquet(self._path("facts", publication))
        loaded, low, high = (observed(made, name) for name in ("facts", "low", "high"))
        try:
            if loaded != arrived:
                raise IntegrityError(f"batch {batch}: {arrived} lines, {loaded} facts")
            if low < 1:
                raise IntegrityError(f"batch {batch}: order_line_id {low} is below 1")
            days = self._read("facts", publication).select("date_key").distinct()
            unknown = check_foreign_key(days, "date_key", dims["dim_date"], "date_key").first()
            if unknown:
                raise IntegrityError(f"batch {batch}: date_key {unknown[0]} is not in the calendar")
        except IntegrityError:
            self._drop(publication)
            raise
        self._write_ids(publication)
        return publication, {"arrived": arrived, "low": low, "high": high}

    def _write_ids(self, publication: str) -> None:
        ids = self._read("facts", publication).select("order_line_id")
        id_bitmaps(ids, "order_line_id").write.parquet(self._path("ids", publication))

    def _without_known(self, publication: str, batch: int) -> tuple[str, int]:
        """Leave out lines that are there already, in this batch or published; they must be the same."""
        ids = self._read("ids", publication)
        low, high = ids.agg(F.min("bucket"), F.max("bucket")).first()
        known_ids = self.bitmaps().filter(F.col("bucket").between(low, high))
        again = shared_buckets(ids, known_ids)
        twice = crowded(ids)
        buckets = [r.bucket for r in twice.union(again).distinct().limit(2).collect()]
        if not buckets:
            return publication, ids.agg(F.sum("n")).first()[0]

        def within(rows: DataFrame, places: DataFrame) -> DataFrame:
            return rows.join(places, bucket_of(F.col("order_line_id")) == places["bucket"], "left_semi")

        staged = self._read("facts", publication)
        stored = within(self.facts(), again)
        delivered = within(staged, twice.union(again).distinct()).select(*_TOLD).union(stored.select(*_TOLD))
        different = (
            delivered.distinct().groupBy("order_line_id").agg(F.count("*").alias("n")).filter("n > 1")
        )
        changed = [str(r.order_line_id) for r in different.orderBy("order_line_id").limit(3).collect()]
        if changed:
            raise IntegrityError(
                f"batch {batch}: order_line_id {', '.join(changed)} delivered again with other values"
            )
        kept = uuid.uuid4().hex
        fresh = staged.join(stored.select("order_line_id"), "order_line_id", "left_anti")
        fresh.dropDuplicates(["order_line_id"]).select(*FACT_SALES.names).write.parquet(self._path("facts", kept))
        self._drop(publication)
        self._write_ids(kept)
        return kept, self._read("ids", kept).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a stream keeps in its checkpoint."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0])["id"]


def stream_fact_load(
    spark: SparkSession,
    path: str,
    dims: Mapping[str, DataFrame],
    out: str,
    checkpoint: str,
    dim_rows: Mapping[str, int] | None = None,
    files_per_batch: int = 8,
) -> DataFrame:
    """Load all files present under `path`, then stop; a later call takes the new ones.

    A line that is delivered again, with the id of a published fact, is left out if it is
    the same and fails its batch otherwise, which names such ids; so do two different
    lines of one id inside a batch, a code or a date that no dimension knows, and an id
    that is null or below 1. A batch that failed stays unread. Several streams, each with
    a checkpoint of its own, may load into `out` one after the other or at the same time.
    A path without files gives no facts.
    """
    target = StreamFacts(spark, out)
    if not stored_names(spark, path):
        return read_stream_facts(spark, out)

    def store(lines: DataFrame, batch: int) -> None:
        target.add(lines, stream_id(spark, checkpoint), batch, dims, dim_rows)

    query = (
        orders_stream(spark, path, files_per_batch)
        .writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return read_stream_facts(spark, out)


def read_stream_facts(spark: SparkSession, out: str) -> DataFrame:
    """The facts stored and checked so far."""
    return StreamFacts(spark, out).facts()


def stream_sales_by_month(
    spark: SparkSession,
    path: str,
    out: str,
    checkpoint: str,
    files_per_batch: int = 8,
    state_partitions: int = 8,
) -> DataFrame:
    """Revenue and lines per month, brought up to date with every micro-batch.

    Lines are summed in each task before the shuffle, so a busy month is no hot spot.
    The state holds one row per month and needs few partitions; the number is set in
    a session of the query's own, as a stream would otherwise keep one state file per
    shuffle partition of the whole application.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    months = (
        orders_stream(own, path, files_per_batch)
        .groupBy(year_month(F.col("order_date")).alias("year_month"))
        .agg(
            F.sum(line_amount(F.col("quantity"), F.col("unit_price"))).cast(TOTAL).alias("amount"),
            F.count("*").alias("lines"),
        )
    )

    def store(rows: DataFrame, batch: int) -> None:
        rows.coalesce(1).write.mode("overwrite").parquet(f"{out}/batch={batch}")

    query = (
        months.writeStream.outputMode("complete")
        .foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return latest_sales_by_month(spark, out)


def latest_sales_by_month(spark: SparkSession, out: str) -> DataFrame:
    """The result of the newest micro-batch."""
    schema = "year_month string, amount decimal(38,2), lines long, batch long"
    stored = spark.read.schema(schema).parquet(out)
    newest = stored.agg(F.max("batch")).scalar()
    return stored.filter(F.col("batch") == newest).select("year_month", "amount", "lines")
