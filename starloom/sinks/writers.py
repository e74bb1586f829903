"""Writers that replace a table as a whole."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from starloom.config import CLICKHOUSE_TABLE_OPTIONS, JdbcStore
from starloom.functions.fill import fill_missing
from starloom.workspace import shuffles_freed

Writer = Callable[[DataFrame, str], None]


def warehouse_writer(store: JdbcStore, schema: str, truncate: bool = False) -> Writer:
    """Drop, create and fill a table of the star.

    With `truncate` the old table is emptied instead, and keeps its grants and indexes.
    Rows are dealt out to `store.connections` tasks anew, as merging the tasks before the
    write into so few would slow down their work too.
    """

    def write(rows: DataFrame, table: str) -> None:
        (
            rows.repartition(store.connections)
            .write.format("jdbc")
            .options(**store.options(f"{schema}.{table}"))
            .option("batchsize", store.batch_size)
            .option("truncate", str(truncate).lower())
            .mode("overwrite")
            .save()
        )

    return write


def column_store_writer(store: JdbcStore) -> Writer:
    """Reports for a store whose columns take no nulls."""

    def write(rows: DataFrame, table: str) -> None:
        (
            fill_missing(rows)
            .repartition(store.connections)
            .write.format("jdbc")
            .options(**store.options(table))
            .option("createTableOptions", CLICKHOUSE_TABLE_OPTIONS)
            .option("batchsize", store.batch_size)
            .mode("overwrite")
            .save()
        )

    return write


def document_writer(uri: str, database: str) -> Writer:
    """One collection per report, nulls kept."""

    def write(rows: DataFrame, collection: str) -> None:
        save_as(
            rows,
            "mongodb",
            **{"connection.uri": uri, "database": database, "collection": collection},
        )

    return write


def file_writer(kind: str, folder: str) -> Writer:
    """One folder per table, in any file format Spark writes."""

    def write(rows: DataFrame, table: str) -> None:
        save_as(rows, kind, path=f"{folder.rstrip('/')}/{table}")

    return write


# What a format needs to give back the same rows: nulls written as such, an empty text
# told from a missing one, padding kept.
_FAITHFUL = {
    "json": {"ignoreNullFields": "false"},
    "csv": {
        "header": "true",
        "escape": '"',
        "nullValue": "",
        "emptyValue": '""',
        "ignoreLeadingWhiteSpace": "false",
        "ignoreTrailingWhiteSpace": "false",
    },
}


def save_as(rows: DataFrame, kind: str, **options: str) -> None:
    """Replace whatever is at the target, by any format or connector Spark knows."""
    with shuffles_freed(rows.sparkSession):
        rows.write.format(kind).options(**{**_FAITHFUL.get(kind, {}), **options}).mode(
            "overwrite"
        ).save()
