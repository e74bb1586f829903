"""Helpers the text operators share: session settings, text rules, row identities."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.operators.lookup import by_size, measured_bytes
from starloom.workspace import Workspace

# white space of the word rule: blank and the controls 9 to 13
SPACES = r"[\x20\x09-\x0D]+"
WORDS = r"[^\x20\x09-\x0D]+"

# a table beyond this size is joined by shuffle instead of being sent to every executor
BROADCAST_BYTES = 32 * 1024 * 1024

# a batch handed to Python ends at either limit, so long texts make short batches
ARROW_SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 * 1024 * 1024),
}

# vectored reads of Parquet go through threads that each keep a direct buffer as large as the
# longest column chunk they read: beside texts, that is memory the workers need
READ_SETTINGS = {"parquet.hadoop.vectored.io.enabled": "false"}

_KEY_LOW, _KEY_HIGH = "__row_key_low", "__row_key_high"
ROW_KEY = (_KEY_LOW, _KEY_HIGH)


def text_session(spark: SparkSession) -> SparkSession:
    for name, value in (ARROW_SETTINGS | READ_SETTINGS).items():
        spark.conf.set(name, value)
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return text_session(spark).read.parquet(f"{folder}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """Lower case for A-Z alone; every other letter stays as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    """The words as an array; splitting leaves an empty string at either end at most."""
    return F.array_remove(F.split(text, SPACES), "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _named(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _hashes(kind: T.DataType) -> bool:
    """Whether Spark hashes the type; it does not hash maps and variants."""
    if isinstance(kind, T.ArrayType):
        return _hashes(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_hashes(field.dataType) for field in kind.fields)
    return not isinstance(kind, (T.MapType, T.VariantType))


def row_key(rows: DataFrame) -> list[Column]:
    """128 bits over all columns: equal for rows equal in every column, else different.

    Unlike a row number it is the same in every job that reads the rows. All columns are read
    and hashed; those that hold a map or a variant by their JSON text, so maps with the same
    entries in another order differ.
    """
    columns = [
        _named(field.name) if _hashes(field.dataType) else F.to_json(F.struct(_named(field.name)))
        for field in rows.schema.fields
    ]
    # a null adds nothing to a hash, so the hash also takes which columns are null
    gaps = F.concat(*[F.when(_named(c).isNull(), "1").otherwise("0") for c in rows.columns])
    return [
        F.xxhash64(gaps, *columns).alias(_KEY_LOW),
        F.xxhash64(*columns, gaps, F.lit("high")).alias(_KEY_HIGH),
    ]


def keep_rows(docs: DataFrame, winners: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """The rows of `docs` whose key is in `winners` (the key and `copies`), each key once.

    `copies` counts the rows that are equal in every column; where it is above one,
    one of these rows stays. Winners measured to be small are broadcast, others joined by
    shuffle.
    """
    # a row travels as one column, so its names cannot meet those of the key
    rows = docs.select(F.struct(*[_named(name) for name in docs.columns]).alias("row"), *row_key(docs))

    def among(keys: DataFrame) -> DataFrame:
        keys = keys.select(*ROW_KEY)
        keys = by_size(keys, measured_bytes(keys), limit)
        return rows.join(keys, list(ROW_KEY), "left_semi")

    columns = [F.col("row").getField(name).alias(name) for name in docs.columns]
    single = among(winners.filter("copies = 1")).select(*columns)
    repeated = winners.filter("copies > 1")
    if repeated.isEmpty():
        return single
    once = among(repeated).dropDuplicates(list(ROW_KEY)).select(*columns)
    return single.unionByName(once)


def stored(rows: DataFrame, label: str, workspace: Workspace | None = None) -> DataFrame:
    """Write rows to the shared folder once and go on from the files."""
    return (workspace or Workspace(rows.sparkSession)).save(rows, label)
