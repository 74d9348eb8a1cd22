"""Readable forms of sizes and times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_UNITS = ("kB", "MB", "GB", "TB", "PB")


def pretty_size(size: Column) -> Column:
    """Bytes below 10 kB, then the first unit in which the rounded figure stays below 10240."""
    size = size.cast("long")
    text = F.when(size < 10240, F.concat(size.cast("string"), F.lit(" bytes")))
    for power, unit in enumerate(_UNITS, start=1):
        halves = F.shiftright(size, 10 * power - 1)  # whole half-units
        shown = F.concat(F.shiftright(halves + 1, 1).cast("string"), F.lit(f" {unit}"))
        text = text.otherwise(shown) if unit == _UNITS[-1] else text.when(halves < 20479, shown)
    return text


def clock(stamp: Column) -> Column:
    """Time of day with milliseconds."""
    return F.date_format(stamp, "HH:mm:ss.SSS")
