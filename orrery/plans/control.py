"""Control values by key: seed if absent, set, read."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.plans.commits import CommitLog
from orrery.schemas import CONTROL
from orrery.workspace import read_or_empty

STOP_REQUESTED = "stop_requested"


def one_per_key(pairs: DataFrame) -> DataFrame:
    """One pair for each key: of repeated keys the one with the greatest value, NULL last."""
    return pairs.groupBy("ctl_key").agg(F.max("ctl_value").alias("ctl_value"))


def insert_if_absent(existing: DataFrame, seed: DataFrame) -> DataFrame:
    """Existing pairs, plus the seed pairs whose key is not there yet; one for each key."""
    missing = seed.join(existing.select("ctl_key"), "ctl_key", "left_anti")
    return one_per_key(existing).unionByName(one_per_key(missing))


def set_values(existing: DataFrame, updates: DataFrame) -> DataFrame:
    """Existing pairs with updated values; keys that do not exist are not created.

    A key updated several times gets the greatest of its new values.
    """
    new = one_per_key(updates).select(
        "ctl_key", F.col("ctl_value").alias("_new"), F.lit(True).alias("_hit")
    )
    value = F.when(F.col("_hit"), F.col("_new")).otherwise(F.col("ctl_value"))
    return existing.join(new, "ctl_key", "left").select("ctl_key", value.alias("ctl_value"))


class ControlTable:
    """Stored control values: every change is appended, the latest value of a key counts."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    _schema = CONTROL.schema.add("version", "long")

    def create(self) -> None:
        """Make the table with the stop flag down, unless it exists."""
        self._row(STOP_REQUESTED, "false").write.mode("ignore").parquet(self.path)

    def _stored(self) -> DataFrame:
        return read_or_empty(self.spark, self._schema, self.path)

    def read(self) -> DataFrame:
        return (
            self._stored()
            .groupBy("ctl_key")
            .agg(F.max_by("ctl_value", "version").alias("ctl_value"))
        )

    def value(self, key: str) -> DataFrame:
        """The value of one key, as a one-column frame."""
        return self.read().filter(F.col("ctl_key") == key).select("ctl_value")

    def signals(self) -> CommitLog:
        """One entry for each time the stop flag was raised; made and seen without a job.

        A job could wait behind the very write that it is to end.
        """
        return CommitLog(self.spark, f"{self.path}_signals", "raised_at long")

    def set(self, key: str, value: str) -> None:
        if (key, value) == (STOP_REQUESTED, "true"):
            self.signals().commit({"raised_at": time.time_ns()})
        self._row(key, value).write.mode("append").parquet(self.path)

    def stop_requested(self) -> bool:
        changes = self._stored().filter(F.col("ctl_key") == STOP_REQUESTED)
        newest = changes.orderBy(F.col("version").desc()).select("ctl_value").limit(1).collect()
        return bool(newest) and newest[0][0] == "true"

    def _row(self, key: str, value: str) -> DataFrame:
        return self.spark.range(0, 1, 1, 1).select(
            F.lit(key).alias("ctl_key"),
            F.lit(value).alias("ctl_value"),
            F.lit(time.time_ns()).cast("long").alias("version"),
        )
