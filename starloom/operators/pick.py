"""One row per key, always the same one."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.operators.lookup import BROADCAST_BYTES, by_size, measured_bytes, save_measured
from starloom.workspace import Workspace


_KEPT = "kept_for_"

# the table of bits by which most rows are sorted out: bits a pair, its least and greatest size
_BITS_A_PAIR = 16
_LEAST_BITS, _MOST_BITS = 1 << 12, 1 << 28
# longs in a row of the table
_WORDS = 512


def _nulls_last(name: str) -> list[Column]:
    return [F.col(name).isNull().alias(f"no_{name}"), F.col(name)]


def lowest_row_per_key(
    rows: DataFrame,
    key: str,
    order: str,
    attributes: Sequence[str],
    workspace: Workspace,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """The row with the lowest `order` value per key, ties settled by the attributes.

    Nulls sort last, and a null key is a key like any other. The lowest `order` value per
    key is found first, by a hash aggregate over two columns, in which a key that holds a
    large share of all rows sends one row per task. Then only the rows that carry these
    pairs go on: by broadcast where the pairs are measured to be within `limit`, else by a
    semi join on key and value, whose keys no longer repeat, so that no task gets a hot one.
    Before it a table of bits, 32 MB at most, keeps most other rows out of its shuffle. The
    wide rows are never aggregated as a whole: what is left is one row per key, or a few
    that tie.
    """
    lowest, size = save_measured(
        rows.groupBy(F.col(key).alias("lowest_key")).agg(F.min(order).alias("lowest")),
        f"lowest-{key}",
        workspace,
    )
    return _settled(_carrying(rows, key, order, lowest, size, workspace, limit), key, order, attributes)


def _carrying(
    rows: DataFrame, key: str, order: str, lowest: DataFrame, size: int, workspace: Workspace, limit: int
) -> DataFrame:
    """The rows with a pair of `lowest` (lowest_key, lowest)."""
    if size > limit:
        rows = _likely(rows, [key, order], lowest, ["lowest_key", "lowest"], workspace)
    same_row = F.col(key).eqNullSafe(F.col("lowest_key")) & F.col(order).eqNullSafe(F.col("lowest"))
    return rows.join(by_size(lowest, size, limit), same_row, "left_semi")


def _likely(
    rows: DataFrame, on: Sequence[str], pairs: DataFrame, names: Sequence[str], workspace: Workspace
) -> DataFrame:
    """The rows whose values of `on` are among the pairs, and up to a sixteenth of the others.

    Each pair sets one bit of a table that is broadcast, at 16 bits a pair or more; a row whose
    bit is not set carries no pair. Where the table is at its greatest size, more others stay.
    """
    wanted = _BITS_A_PAIR * pairs.count()
    bits = min(max(1 << max(wanted - 1, 0).bit_length(), _LEAST_BITS), _MOST_BITS)
    words = min(_WORDS, bits // 64)

    kinds = [pairs.schema[name].dataType for name in names]

    def place(columns: Sequence[str]) -> Column:
        # nulls add nothing to a hash, so it also takes which values are null
        values = [F.col(name).cast(kind) for name, kind in zip(columns, kinds, strict=True)]
        return F.xxhash64(*values, *[value.isNull() for value in values]).bitwiseAND(F.lit(bits - 1))

    word = F.shiftright("place", 6).alias("word")
    one = F.lit(1).cast("long")
    shift = F.col("place").bitwiseAND(F.lit(63)).cast("int")
    seen = pairs.select(place(names).alias("place")).select(
        word, F.call_function("shiftleft", one, shift).alias("bits")
    )
    # words without a bit stand in their places too
    none = rows.sparkSession.range(bits // 64).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("bits"))
    table = (
        seen.unionByName(none)
        .groupBy("word")
        .agg(F.bit_or("bits").alias("bits"))
        .groupBy(F.shiftright("word", words.bit_length() - 1).alias("__bit_row"))
        .agg(F.array_sort(F.collect_list(F.struct("word", "bits")))["bits"].alias("__bit_words"))
    )
    table = F.broadcast(workspace.save(table, "bits"))
    row = F.shiftright("__bit", 6 + words.bit_length() - 1)
    inside = F.shiftright("__bit", 6).bitwiseAND(F.lit(words - 1)).cast("int")
    bit = F.getbit(F.get("__bit_words", inside), F.col("__bit").bitwiseAND(F.lit(63)).cast("int"))
    # below an inner join Spark would put the semi join that follows before this one
    same = (row == F.col("__bit_row")) & (bit == 1)
    return rows.withColumn("__bit", place(on)).join(table, same, "left_semi").drop("__bit")


def _settled(rows: DataFrame, key: str, order: str, attributes: Sequence[str]) -> DataFrame:
    candidate = F.struct(*[part for name in (order, *attributes) for part in _nulls_last(name)])
    return (
        rows.groupBy(key)
        .agg(F.min(candidate).alias("kept"))
        .select(key, *[F.col(f"kept.{name}").alias(name) for name in attributes])
    )


def lowest_rows_per_keys(
    rows: DataFrame,
    attributes: Mapping[str, Sequence[str]],
    order: str,
    workspace: Workspace,
    limit: int = BROADCAST_BYTES,
) -> dict[str, DataFrame]:
    """`lowest_row_per_key` for several keys of one type: key to the attributes it decides.

    The lowest `order` value of every key of every kind comes from one aggregate over the keys
    side by side, and one scan of the rows marks those that carry such a pair, if the pairs
    are measured to be within `limit`. The marked rows, a few per key, are written for all
    kinds. Above the limit each kind has a scan and a semi join of its own, with its pairs.
    """
    kinds = list(attributes)
    sides = [F.struct(F.lit(k).alias("kind"), F.col(key).alias("value")) for k, key in enumerate(kinds)]
    lowest, size = save_measured(
        rows.select(F.col(order).alias("lowest"), F.inline(F.array(*sides)))
        .groupBy("kind", "value")
        .agg(F.min("lowest").alias("lowest")),
        "lowest-keys",
        workspace,
    )
    if size > limit:
        pairs = {
            key: lowest.where(F.col("kind") == k).select(F.col("value").alias("lowest_key"), "lowest")
            for k, key in enumerate(kinds)
        }
        return {
            key: _settled(
                _carrying(rows, key, order, pairs[key], measured_bytes(pairs[key]), workspace, limit),
                key,
                order,
                own,
            )
            for key, own in attributes.items()
        }
    columns = list(dict.fromkeys([order, *kinds, *(name for own in attributes.values() for name in own)]))
    marked = rows.select(*columns)
    for k, key in enumerate(kinds):
        pairs = lowest.where(F.col("kind") == k).select(
            F.col("value").alias(f"value{k}"), F.col("lowest").alias(f"lowest{k}"), F.lit(True).alias(f"{_KEPT}{k}")
        )
        same = F.col(key).eqNullSafe(F.col(f"value{k}")) & F.col(order).eqNullSafe(F.col(f"lowest{k}"))
        marked = marked.join(F.broadcast(pairs), same, "left").drop(f"value{k}", f"lowest{k}")
    marks = [F.col(f"{_KEPT}{k}") for k in range(len(kinds))]
    few = workspace.save(marked.where(F.coalesce(*marks, F.lit(False))), "lowest-rows")
    return {
        key: _settled(few.where(f"{_KEPT}{k}"), key, order, attributes[key])
        for k, key in enumerate(kinds)
    }
