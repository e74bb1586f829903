"""Left joins that bring columns of a smaller table to a larger one."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from starloom.workspace import Workspace

BROADCAST_BYTES = 128 * 1024 * 1024
_ROW_OVERHEAD = 64
_COLUMN_OVERHEAD = 8


def _width(table: DataFrame) -> Column:
    """Bytes of a row once in memory."""
    width = F.lit(_ROW_OVERHEAD + _COLUMN_OVERHEAD * len(table.columns))
    for name, kind in table.dtypes:
        if kind == "string":
            width = width + F.coalesce(F.octet_length(name), F.lit(0))
    return width.cast("long")


def measured_bytes(table: DataFrame) -> int:
    """Size of the rows once in memory, by one aggregate over the table."""
    return table.agg(F.sum(_width(table))).first()[0] or 0


def save_measured(
    rows: DataFrame, label: str, workspace: Workspace
) -> tuple[DataFrame, int]:
    """Write rows and learn their size in memory on the way."""
    seen = Observation()
    saved = workspace.save(rows.observe(seen, F.sum(_width(rows)).alias("bytes")), label)
    return saved, seen.get["bytes"] or 0


def by_size(table: DataFrame, size: int, limit: int) -> DataFrame:
    """The side of a join that is broadcast if its measured size is within the limit, else never.

    Spark's own estimate is the size of files: columns of few values take a fraction there of
    what they take in memory.
    """
    return F.broadcast(table) if size <= limit else table.hint("merge")


def look_up(
    rows: DataFrame,
    table: DataFrame,
    on: Sequence[str],
    limit: int = BROADCAST_BYTES,
    size: int | None = None,
) -> DataFrame:
    """Left join on equal keys, where null matches nothing.

    A table measured to be within `limit` is sent to every executor, and the rows stay
    where they are. A larger one is joined by shuffle, whatever Spark makes of its files'
    size, and adaptive execution splits a key that holds a large share of the rows. `size`
    is given if it is known already.
    """
    known = measured_bytes(table) if size is None else size
    return rows.join(by_size(table, known, limit), list(on), "left")


_DIGEST = ("__digest_low", "__digest_high")


def text_digest(on: Sequence[str]) -> list[Column]:
    """128 bits over the columns, which are not null; their borders count."""
    return [F.xxhash64(*on), F.xxhash64(F.lit("high"), *on)]


def look_up_covered(
    rows: DataFrame,
    table: DataFrame,
    on: Sequence[str],
    limit: int = BROADCAST_BYTES,
    digest: Callable[[Sequence[str]], list[Column]] = text_digest,
) -> DataFrame:
    """As `look_up`, for a table that holds all values of `on` the rows have without nulls.

    Beyond `limit` the rows meet the table by a digest of the `on` columns, so only the
    digest and the columns that the reader goes on to use are shuffled. As the table covers
    the rows, a digest that one row of the table has stands for that row's values alone.
    This is verified by counting the digests of the table; where several rows of it share
    one, the rows with that digest are joined by the values themselves.
    """
    if measured_bytes(table) <= limit:
        return rows.join(F.broadcast(table), list(on), "left")
    whole = F.lit(True)
    for name in on:
        whole = whole & F.col(name).isNotNull()

    def digested(side: DataFrame) -> DataFrame:
        parts = zip(_DIGEST, digest(on), strict=True)
        return side.withColumns({name: F.when(whole, part) for name, part in parts})

    keyed, known = digested(rows), digested(table.where(whole))
    shared = known.groupBy(*_DIGEST).count().where("count > 1").select(*_DIGEST)
    values = [name for name in table.columns if name not in on]
    columns = [*on, *[name for name in rows.columns if name not in on], *values]

    def by_digest(left: DataFrame, right: DataFrame) -> DataFrame:
        return left.join(right.select(*_DIGEST, *values), list(_DIGEST), "left").select(*columns)

    if shared.isEmpty():
        return by_digest(keyed, known)
    if measured_bytes(shared) <= limit:
        shared = F.broadcast(shared)
    apart, together = list(_DIGEST), keyed.join(shared, list(_DIGEST), "left_semi")
    return by_digest(
        keyed.join(shared, apart, "left_anti"), known.join(shared, apart, "left_anti")
    ).unionByName(together.drop(*_DIGEST).join(table, list(on), "left").select(*columns))
