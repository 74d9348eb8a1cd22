"""Exact decimal money: nothing here passes through a floating-point number."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from orrery.schemas import AMOUNT, TOTAL


def line_amount(quantity: Column, unit_price: Column) -> Column:
    """quantity x unit price with two decimals; exact, as the price has two already."""
    return (quantity * unit_price).cast(AMOUNT)


def total(amount: Column) -> Column:
    return F.sum(amount).cast(TOTAL)


def mean_from_total(amount_sum: Column, n: Column) -> Column:
    """sum / n rounded half away from zero to two decimals, in whole cents.

    `avg` on decimals keeps only four more digits and then rounds a second time,
    which can move a cent; integer division of the cents rounds once.
    """
    cents = (F.abs(amount_sum) * 100).cast("decimal(38,0)")
    rounded = F.call_function("div", cents * 2 + n, n * 2)
    value = rounded.cast("decimal(18,0)") * F.lit(Decimal("0.01"))
    return F.when(amount_sum < 0, -value).otherwise(value).cast(AMOUNT)
