"""Row rules: defaults, value and expression branches, text templates, slices of text.

Every rule is a column expression, so a list of rules over a table stays one
projection inside generated code.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _as_column(value: Any) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def default_if_absent(column: Column, value: Any) -> Column:
    """Keep the value that is there, else take the default."""
    return F.coalesce(column, _as_column(value))


def branch_on_value(
    column: Column, cases: Mapping[Any, Any], default: Any = None, when_null: Any = None
) -> Column:
    """Pick a result by the value of one column; NULL is looked at before the cases."""
    result = F.when(column.isNull(), _as_column(when_null if when_null is not None else default))
    for value, outcome in cases.items():
        result = result.when(column == F.lit(value), _as_column(outcome))
    return result.otherwise(_as_column(default))


def branch_on_expressions(cases: Sequence[tuple[Column, Any]], default: Any = None) -> Column:
    """Pick the result of the first condition that holds."""
    if not cases:
        return _as_column(default)
    (first, outcome), *others = cases
    result = F.when(first, _as_column(outcome))
    for condition, outcome in others:
        result = result.when(condition, _as_column(outcome))
    return result.otherwise(_as_column(default))


def fill_template(template: str, **values: Column) -> Column:
    """Text with %name% places filled from columns: fill_template("%y%-Q%q%", y=..., q=...)."""
    pieces = []
    for position, piece in enumerate(re.split(r"%(\w+)%", template)):
        if position % 2:
            if piece not in values:
                raise ValueError(f"template names an unknown value {piece!r}")
            pieces.append(values[piece].cast("string"))
        elif piece:
            pieces.append(F.lit(piece))
    return F.concat(*pieces) if pieces else F.lit("")


def slice_text(column: Column, begin: int, end: int) -> Column:
    """Characters begin (0-based) up to, not including, end."""
    return F.substring(column, begin + 1, end - begin)


def stamp_text(stamp: Column) -> Column:
    """yyyy/MM/dd HH:mm:ss, whatever the session zone."""
    return F.translate(F.substring(stamp.cast("string"), 1, 19), "-", "/")


def project(df: DataFrame, mapping: Mapping[str, Column | str]) -> DataFrame:
    """Target column <- source column or rule; nothing else is kept."""
    return df.select(
        *[(F.col(src) if isinstance(src, str) else src).alias(dst) for dst, src in mapping.items()]
    )


def numbered_code(prefix: str, number: Column, digits: int) -> Column:
    """Prefix and number, padded to `digits`; a longer number is kept whole, not cut."""
    text = number.cast("string")
    return F.concat(F.lit(prefix), F.lpad(text, F.greatest(F.length(text), F.lit(digits)), F.lit("0")))
