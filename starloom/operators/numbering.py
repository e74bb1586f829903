"""Row numbers over a whole table without passing it through one task.

A window without partitions moves every row to a single task. Here the rows are range
partitioned and sorted, each takes its place within its partition, and the sizes of the
earlier partitions are added. The sorted rows are written in between: a place and the
sizes must come from one and the same split, also when a task is run again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.operators.lookup import BROADCAST_BYTES, look_up, save_measured
from starloom.workspace import Workspace

# monotonically_increasing_id: partition number above 33 bits of place in the partition
_PLACE_BITS = 33
_PLACE_MASK = (1 << _PLACE_BITS) - 1


def number_rows(
    rows: DataFrame, order: Sequence[Column], output: str, workspace: Workspace
) -> DataFrame:
    """Add `output`, 1..n in the given order, which must tell all rows apart.

    As the whole order decides the range a row falls in, a value that many rows share is
    spread over several partitions by the columns that follow it.
    """
    sorted_rows = workspace.save(
        rows.orderBy(*order).withColumn("slot", F.monotonically_increasing_id()), output
    )
    part = F.shiftright("slot", _PLACE_BITS)
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per sorted partition, whatever the number of rows
    offsets = (
        sorted_rows.groupBy(part.alias("part"))
        .agg(F.count("*").alias("size"))
        .select("part", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("before"))
    )
    place = F.col("slot").bitwiseAND(F.lit(_PLACE_MASK))
    # every part has its offset; as a left join it is left out where the number is not read
    return (
        sorted_rows.withColumn("part", part)
        .join(F.broadcast(offsets), "part", "left")
        .select(*rows.columns, (F.col("before") + place + 1).cast("int").alias(output))
    )


def mirror_numbers(
    rows: DataFrame,
    by: str,
    numbers: str,
    output: str,
    workspace: Workspace,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Numbers in the opposite order of `by`, from those in one order, without a second sort.

    In both orders rows without a value come last and ties go the same way. A row keeps its
    place within its value; the rows before its value in one order, and as many as share it,
    tell how many come before it in the other. One small row per value is written, measured
    and joined.
    """
    valued = rows.where(F.col(by).isNotNull()).groupBy(by)
    ends = valued.agg((F.min(numbers) - 1).alias("before"), F.count("*").alias("same"))
    values, size = save_measured(ends, f"values-{by}", workspace)
    total = values.agg(F.sum("same")).scalar()
    behind = total - F.col("before") - F.col("same")
    number = F.coalesce(behind + F.col(numbers) - F.col("before"), F.col(numbers))
    return look_up(rows, values, [by], limit, size).select(
        *rows.columns, number.cast("int").alias(output)
    )
