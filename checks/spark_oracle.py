"""The check SQL as a Spark query: the plain form the jobs are measured against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from checks.fixture import SOURCE_TABLES
from checks.oracles import oracles
from starloom.config import prepared

# the few functions that the two engines name differently
_DIALECT = (
    ("regexp_matches(", "regexp_like("),
    ("cast(try_strptime(", "cast(try_to_timestamp("),
    ("'%m/%d/%Y'", "'M/d/yyyy'"),
    ("strftime(", "date_format("),
    ("'%Y%m%d'", "'yyyyMMdd'"),
    ("cast(trunc(try_cast(", "cast((try_cast("),
    (r"'^\s*[+-]?[0-9]+([.][0-9]*)?\s*$'", r"r'^\s*[+-]?[0-9]+([.][0-9]*)?\s*$'"),
)


def plain_query(name: str) -> Callable[[SparkSession, str], DataFrame] | None:
    text = oracles().get(name)
    if text is None or name.endswith("_round_trip"):
        return None
    for theirs, ours in _DIALECT:
        text = text.replace(theirs, ours)

    def run(spark: SparkSession, folder: str) -> DataFrame:
        prepared(spark)
        for table in SOURCE_TABLES:
            spark.read.parquet(f"{folder}/{table}.parquet").createOrReplaceTempView(table)
        return spark.sql(text)

    return run
