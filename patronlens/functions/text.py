"""Report formatting (``1,234``, ``$1,234.00``, ``12.3%``) and numbers in SQL text."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def whole_text(value: Column) -> Column:
    return F.format_number(value, 0)


def dollar_text(value: Column) -> Column:
    return F.concat(F.lit("$"), F.format_number(value, 2))


def percent_text(value: Column) -> Column:
    return F.format_string("%.1f%%", value)


def sql_double(value: float) -> str:
    return f"{value!r}D" if math.isfinite(value) else f"double('{value}')"
