"""Pearson correlation with the same bits for any order and any partitions of the rows.

Co-moments of doubles change in their last digits with the order of rows. Here each row's
deviations from the means and their products are doubles of a fixed size, cut into whole
numbers of 24 bits, and the whole numbers are summed. What is added to a sum depends on the
row alone, and sums of longs do not depend on the order.

Three passes over two columns: the extremes, which give the scale; the means; the products
of deviations, scaled to at most 4 by the largest deviation. A product is cut at 2^-72, the
largest one is at least 1, so the cut is far below a double's own rounding.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# a sum of longs holds 1e11 chunks of 24 bits and their sign
_CHUNK = float(1 << 24)
_CHUNKS = 3


def _order_free_sum(value: Column) -> Column:
    """Sum of doubles of at most 4 in size, by whole numbers."""
    chunks = []
    for _ in range(_CHUNKS):
        value = value * _CHUNK
        whole = F.rint(value)
        chunks.append(F.sum(whole.cast("long")).cast("double"))
        # exact, as both are multiples of the value's last bit
        value = value - whole
    total = F.lit(0.0)
    for chunk in reversed(chunks):
        total = (total + chunk) / _CHUNK
    return total


def _power_below(size: Column) -> Column:
    """A power of two by which division is exact and gives less than 2."""
    return F.coalesce(F.pow(F.lit(2.0), F.floor(F.log2(size))), F.lit(1.0))


def correlation(rows: DataFrame, left: str, right: str, output: str) -> DataFrame:
    """One row, one column: the correlation of two columns over their complete pairs.

    Null where a side does not vary or no pair is complete, NaN where a value of a complete
    pair is no finite number. Beyond 1e11 pairs the job stops.
    """
    pairs = rows.select(
        F.col(left).cast("double").alias("x"), F.col(right).cast("double").alias("y")
    ).where("x is not null and y is not null")
    is_finite = F.expr("abs(x) < double('Infinity') and abs(y) < double('Infinity')")
    extremes = pairs.agg(
        F.struct(
            F.coalesce(F.bool_or(~is_finite), F.lit(False)).alias("strange"),
            *[
                pick(F.when(is_finite, F.col(side))).alias(f"{name}_{side}")
                for side in ("x", "y")
                for name, pick in (("low", F.min), ("high", F.max))
            ],
        ).alias("extremes")
    ).scalar()
    known = pairs.where(is_finite).withColumn("e", extremes)

    def scaled(side: str) -> Column:
        return _power_below(F.greatest(F.abs(f"e.low_{side}"), F.abs(f"e.high_{side}")))

    means = known.agg(
        F.struct(
            *[
                F.try_divide(
                    _order_free_sum(F.col(side) / scaled(side)), F.count("*").cast("double")
                ).alias(side)
                for side in ("x", "y")
            ]
        ).alias("means")
    ).scalar()
    known = known.withColumn("m", means)

    def deviation(side: str) -> Column:
        # halves, as the distance of two doubles may be none
        middle = F.col(f"m.{side}") * (scaled(side) / 2)
        low, high = F.col(f"e.low_{side}") / 2, F.col(f"e.high_{side}") / 2
        reach = F.greatest(high - middle, middle - low)
        return (F.col(side) / 2 - middle) / _power_below(reach)

    away = known.select("e", deviation("x").alias("x"), deviation("y").alias("y"))
    count, x, y = F.count("*").cast("double"), F.col("x"), F.col("y")
    sums = away.agg(
        count.alias("n"),
        *[
            _order_free_sum(value).alias(name)
            for name, value in {"x": x, "y": y, "xx": x * x, "yy": y * y, "xy": x * y}.items()
        ],
    ).withColumn("e", extremes)

    def moment(product: str, a: str, b: str) -> Column:
        # the means are rounded, so deviations do not add up to zero
        return F.col(product) - F.try_divide(F.col(a) * F.col(b), F.col("n"))

    spread = F.sqrt(moment("xx", "x", "x")) * F.sqrt(moment("yy", "y", "y"))
    figure = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.try_divide(moment("xy", "x", "y"), spread)))
    varies = F.expr("e.low_x < e.high_x and e.low_y < e.high_y")
    return sums.select(
        F.when(F.col("e.strange"), F.lit(float("nan"))).when(varies, figure).alias(output)
    )
