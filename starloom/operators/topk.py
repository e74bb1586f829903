"""The head of an ordered table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_rows(rows: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """The first k rows; each task passes on its own first k, nothing else moves."""
    return rows.orderBy(*order).limit(k)


def top_rows_numbered(
    rows: DataFrame, order: Sequence[Column], k: int, output: str
) -> DataFrame:
    """The first k rows with their rank, without ranking the others."""
    head = top_rows(rows, order, k)
    return head.withColumn(output, F.row_number().over(Window.orderBy(*order)))


def place_among(
    head: DataFrame, rows: DataFrame, by: str, key: str, descending: bool, output: str
) -> DataFrame:
    """Give the few rows of `head` their row numbers among `rows` in another order.

    The order is by a column, nulls last, then by the key, nulls last. For each row of
    `head` the rows before it are counted, all in one aggregate and without a sort.
    """
    found = head.select(by, key).collect()
    schema = head.select(by, key).schema
    none = F.lit(None)

    def value(number, name: str) -> Column:
        return F.lit(number).cast(schema[name].dataType)

    def before(row) -> Column:
        column, own, key_column, own_key = F.col(by), value(row[0], by), F.col(key), value(row[1], key)
        if row[0] is None:
            ahead, same = column.isNotNull(), column.isNull()
        else:
            ahead = column > own if descending else column < own
            same = column == own
        earlier = key_column.isNotNull() if row[1] is None else key_column < own_key
        return F.coalesce(ahead | (same & earlier), F.lit(False))

    if not found:
        return head.withColumn(output, none.cast("int"))
    counts = rows.agg(*[F.count_if(before(row)) for row in found]).first()
    place = none.cast("int")
    for row, count in zip(found, counts, strict=True):
        here = F.col(key).eqNullSafe(value(row[1], key))
        place = F.when(here, F.lit(count + 1).cast("int")).otherwise(place)
    return head.withColumn(output, place)
