"""Totals of a coarser group, repeated on each row of it."""

from __future__ import annotations

from pyspark.sql import DataFrame

from starloom.operators.lookup import BROADCAST_BYTES, look_up, save_measured
from starloom.workspace import Workspace


def add_group_total(
    rows: DataFrame,
    totals: DataFrame,
    by: str,
    workspace: Workspace,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Bring the totals of the groups of a column to the rows by left join.

    A join on purpose, not a window: rows without a group get null although their group
    has a total, and no group has to fit into one task. The totals are written, so that
    they are measured without being computed twice: within `limit` they are broadcast, and
    the rows stay where they are.
    """
    written, size = save_measured(totals, f"totals-{by}", workspace)
    return look_up(rows, written, [by], limit, size)
