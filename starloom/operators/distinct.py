"""Distinct whole numbers per group, counted in bitmaps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# numbers that a bitmap of 4096 bytes must hold on average to be smaller than rows of them
LEAST_NUMBERS = 128


def count_distinct_numbers(
    rows: DataFrame,
    by: Sequence[str],
    number: str,
    output: str,
    least_numbers: int = LEAST_NUMBERS,
) -> DataFrame:
    """How many different values of a long column each group has; nulls are not counted.

    Numbers are put into buckets of 32768, each a bitmap. Tasks fill bitmaps per group and
    bucket, so the shuffle carries bitmaps, whose bits are united and counted: exact for all
    longs, and a group or a number that many rows share costs no more than others. Numbers
    that lie too far apart for that, by an estimate over the same columns, are shuffled as
    rows without repeats; the result is the same.
    """
    bucket, bit = F.expr(f"bitmap_bucket_number({number})"), F.expr(f"bitmap_bit_position({number})")
    numbers, bitmaps = rows.agg(
        F.approx_count_distinct(F.struct(*by, number)),
        F.approx_count_distinct(F.struct(*by, bucket)),
    ).first()
    if numbers < least_numbers * bitmaps:
        return rows.groupBy(*by).agg(F.count_distinct(number).alias(output))
    filled = rows.groupBy(*by, bucket.alias("bucket")).agg(
        F.bitmap_construct_agg(bit).alias("bits"), F.count(number).alias("present")
    )
    # without any number a bucket is null and has no bit
    size = F.when(F.col("present") > 0, F.bitmap_count("bits")).otherwise(0)
    return filled.groupBy(*by).agg(F.sum(size).alias(output))
