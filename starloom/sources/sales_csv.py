"""Flat sales rows from CSV files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from starloom.schema import RAW_SALES


def read_sales_csv(
    spark: SparkSession, paths: str | Sequence[str], multi_line: bool = False
) -> DataFrame:
    """All columns as text; an empty field is null, a quoted empty field is ''.

    Files are split over tasks unless `multi_line` is set, which is needed when a quoted
    field holds a line break and costs one task per file. Rows with a wrong number of
    fields stop the job in either case, so such a break never passes unnoticed; column
    pruning is off because it would skip that check.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    return (
        spark.read.schema(RAW_SALES)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("nullValue", "\u0000")
        .option("multiLine", multi_line)
        .option("mode", "FAILFAST")
        .option("columnPruning", False)
        .csv(paths)
    )
