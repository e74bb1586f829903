"""Flat text rows to typed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.casts import lenient_date, lenient_double, lenient_integer
from starloom.schema import DATE_PATTERN, SALES_COLUMNS, SALES_TYPES


def _typed(name: str) -> Column:
    match SALES_TYPES.get(name):
        case "int" | "long" as whole:
            value = lenient_integer(name, whole)
        case "double":
            value = lenient_double(name)
        case "date":
            value = lenient_date(name, DATE_PATTERN)
        case _:
            value = F.col(name)
    return value.alias(name)


def typed_sales(raw: DataFrame) -> DataFrame:
    """All rows stay; a value that does not parse is null."""
    return raw.select(*[_typed(name) for name in SALES_COLUMNS])
