"""Repeatable pseudo-random draws from a row's own number.

A draw is eight hex digits of a digest of the number, so a row gets the same value on
any machine, in any partition and in any engine. `rand(seed)` would depend on how rows
are spread over partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DRAWS_PER_DIGEST = 4
BITS = 32


def with_draws(
    df: DataFrame, number: str, subject: str, names: Sequence[str], seed: int = 0
) -> DataFrame:
    """Add the named columns, each a whole number spread evenly over 0 .. 2^32-1.

    One digest serves four draws. It is a column of its own, so that it is computed
    once and not again inside each draw.
    """
    digests, values = {}, {}
    for place, name in enumerate(names):
        block, part = divmod(place, DRAWS_PER_DIGEST)
        digest = f"__digest_{block}"
        text = F.concat(F.lit(f"{subject}/{seed}/{block}/"), F.col(number).cast("string"))
        digests[digest] = F.md5(text)
        digits = F.substring(F.col(digest), 1 + 8 * part, 8)
        values[name] = F.conv(digits, 16, 10).cast("long")
    return df.withColumns(digests).withColumns(values).drop(*digests)


def pick(draw: Column | str, n: int | Column) -> Column:
    """0 .. n-1, from a drawn column."""
    draw = F.col(draw) if isinstance(draw, str) else draw
    size = n.cast("long") if isinstance(n, Column) else F.lit(n).cast("long")
    return F.shiftright(draw * size, BITS)


def product(a: str, b: str) -> Column:
    """The product of two draws, scaled back to the range of one draw."""
    return F.shiftright(
        F.shiftright(F.col(a), 1) * F.shiftright(F.col(b), 1), BITS - 2
    )


def scale_rounded(draw: str, n: Column) -> Column:
    """draw / 2^32 x n, rounded to a whole number."""
    return F.shiftright(F.col(draw) * n + (1 << (BITS - 1)), BITS)
