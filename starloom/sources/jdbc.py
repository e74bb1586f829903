"""Tables of a database, read in parallel."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from starloom.config import JdbcStore


@dataclass(frozen=True)
class RangeSplit:
    """Read in slices of a numeric or date column."""

    column: str
    partitions: int


@dataclass(frozen=True)
class BlockSplit:
    """Read in slices of consecutive disk blocks, of a store that can address them.

    For tables without a numeric column. PostgreSQL (from version 14) reads a range of
    row addresses without touching the other blocks, so all slices together scan the
    table once.
    """

    partitions: int


@dataclass(frozen=True)
class QuantileSplit:
    """Read in slices of equal numbers of rows, by the quantiles of a numeric or date column.

    For a sparse or skewed column, where equal widths would leave most rows to a few
    slices. The store sorts the column once to find its quantiles (an index spares that).
    Rows that share one value stay in one slice; for those, read by blocks.
    """

    column: str
    partitions: int


def quantile_conditions(column: str, quantiles: Sequence) -> list[str]:
    """Ranges between the quantiles that hold every row once, nulls in the first one.

    The quantiles are numbers, dates or timestamps, ascending.
    """
    bounds = [_literal(bound) for bound in dict.fromkeys(quantiles) if bound is not None]
    if not bounds:
        return ["1 = 1"]
    between = [
        f"{column} >= {low} AND {column} < {high}"
        for low, high in zip(bounds, bounds[1:], strict=False)
    ]
    return [f"{column} < {bounds[0]} OR {column} IS NULL", *between, f"{column} >= {bounds[-1]}"]


def _literal(value: object) -> str:
    if isinstance(value, (int, float, Decimal)) and not isinstance(value, bool):
        return str(value)
    return "'" + str(value).replace("'", "''") + "'"


def block_conditions(blocks: int, partitions: int) -> list[str]:
    """Ranges of row addresses that hold every row once; the last one has no end."""
    slices = max(1, min(partitions, blocks))
    starts = [blocks * n // slices for n in range(slices)]
    bounds = [f"ctid >= '({start},0)'::tid" for start in starts]
    ends = [f" AND ctid < '({start},0)'::tid" for start in starts[1:]]
    return [bound + end for bound, end in zip(bounds, [*ends, ""], strict=True)]


def read_table(
    spark: SparkSession,
    store: JdbcStore,
    table: str,
    split: RangeSplit | BlockSplit | QuantileSplit | None = None,
) -> DataFrame:
    """One task per slice; without a split, one task reads the table."""
    if isinstance(split, BlockSplit | QuantileSplit):
        if isinstance(split, BlockSplit):
            conditions = block_conditions(_blocks(spark, store, table), split.partitions)
        else:
            conditions = quantile_conditions(split.column, _quantiles(spark, store, table, split))
        return spark.read.jdbc(
            store.url, table, predicates=conditions, properties=store.properties()
        )
    reader = spark.read.format("jdbc").options(**store.options(table))
    if split is None:
        return reader.load()
    lowest, highest = _bounds(spark, store, table, split.column)
    if lowest is None:
        return reader.load()
    return reader.options(
        partitionColumn=split.column,
        lowerBound=str(lowest),
        upperBound=str(highest),
        numPartitions=str(split.partitions),
    ).load()


def _bounds(spark: SparkSession, store: JdbcStore, table: str, column: str) -> tuple:
    """Smallest and largest value, found by the database; they only shape the slices."""
    query = f"SELECT MIN({column}) AS lowest, MAX({column}) AS highest FROM {table}"
    row = spark.read.format("jdbc").options(**store.options(), query=query).load().first()
    return row[0], row[1]


def _quantiles(spark: SparkSession, store: JdbcStore, table: str, split: QuantileSplit) -> list:
    """The values that part the rows into slices, found by the database in one sort."""
    shares = ", ".join(str(n / split.partitions) for n in range(1, split.partitions))
    if not shares:
        return []
    query = (
        f"SELECT unnest(percentile_disc(ARRAY[{shares}]::float8[]) "
        f"WITHIN GROUP (ORDER BY {split.column})) AS bound FROM {table}"
    )
    found = spark.read.format("jdbc").options(**store.options(), query=query).load().collect()
    # the database gives them in order; the rows of a query have none
    return sorted(row[0] for row in found if row[0] is not None)


def _blocks(spark: SparkSession, store: JdbcStore, table: str) -> int:
    query = (
        f"SELECT pg_relation_size('{table}') / current_setting('block_size')::bigint AS blocks"
    )
    return spark.read.format("jdbc").options(**store.options(), query=query).load().first()[0]
