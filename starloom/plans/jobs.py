"""The jobs: load the star from flat rows, publish the marts from a star."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from starloom.plans.marts import all_reports
from starloom.plans.star import Star
from starloom.plans.typed import typed_sales
from starloom.schema import STAR_TABLES
from starloom.sinks.writers import Writer
from starloom.workspace import Workspace


# star tables that other star tables read
LOOKED_UP = ("dim_supplier", "dim_store")


def load_star(raw: DataFrame, write: Writer, workspace: Workspace) -> None:
    """Type the rows once, then build and write the seven tables from the typed rows.

    The source may be a database or text files, where each table would mean another full
    read; the typed rows are columns on disk, of which each table reads its own. Of the
    star, only the tables that others look up are stored on the way; the rest, the fact
    above all, go straight to the target.
    """
    sales = workspace.save(typed_sales(raw), "sales")
    star = Star.from_sales(sales, workspace)
    for table in STAR_TABLES:
        write(star[table] if table in LOOKED_UP else star.unstored(table), table)


def publish_marts(
    read: Callable[[str], DataFrame], write: Writer, workspace: Workspace
) -> None:
    """Build the six reports from a stored star and write each to the target."""
    star = Star.from_store(read, workspace)
    for table, report in all_reports(star).items():
        write(report(), table)
