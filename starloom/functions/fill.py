"""Replacement of missing values for stores that take none."""

from __future__ import annotations

from pyspark.sql import DataFrame


def fill_missing(rows: DataFrame) -> DataFrame:
    """Empty text for missing text, zero for missing numbers (NaN included)."""
    return rows.na.fill("").na.fill(0)
