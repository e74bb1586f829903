"""Exact duplicates: heavy digests apart from the rest.

A text's digest is the SHA-256 of its UTF-8 bytes after A-Z became a-z. The digests are
written once; no later step touches the texts.

1. Misra-Gries: a frequent-items sketch (`approx_top_k`, a mergeable Misra-Gries summary)
   is built in every task, merged in two levels, and names the digests that may be
   frequent. Its size is bounded, and it misses no digest with more than 1/512 of the rows.
2. Verification: those digests, at most `CANDIDATES`, are counted exactly. Their winners
   are a table of at most `CANDIDATES` rows, which is broadcast.
3. Heavy rows find their winner on the map side and are never shuffled. The remaining
   digests, each with less than 1/512 of the rows, go through an ordinary shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import (
    ROW_KEY,
    keep_rows,
    lower_ascii,
    row_key,
    table,
    text_or_empty,
)
from starloom.workspace import Workspace

# counters of a sketch, and how many of the most frequent are verified: an estimate is
# too high by at most 3.5/8192 of the rows, so fewer than 1024 digests can rank above one
# that holds 1/512
COUNTERS = 8192
CANDIDATES = 1024
_MERGERS = 64


def digests(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(
        F.col(id_col).alias("doc_id"),
        F.unhex(F.sha2(lower_ascii(text_or_empty(text_col)), 256)).alias("digest"),
        *row_key(docs),
    )


def _winner() -> list:
    # a null id is the lowest; equal ids are told apart by the row key
    return [
        F.max(F.struct("doc_id", *ROW_KEY)).alias("winner"),
        F.count("*").alias("group_size"),
    ]


def heavy_winners(rows: DataFrame) -> DataFrame:
    """Digest, winner and exact size of the frequent groups, at most `CANDIDATES` rows."""
    part = (F.spark_partition_id() % _MERGERS).alias("part")
    sketch = (
        rows.select(part, F.xxhash64("digest").alias("item"))
        .groupBy("part")
        .agg(F.expr(f"approx_top_k_accumulate(item, {COUNTERS})").alias("sketch"))
        # by a constant: without a key, tasks without rows would add sketches without a type
        .groupBy(F.lit("all").alias("all"))
        .agg(F.expr(f"approx_top_k_combine(sketch, {COUNTERS})").alias("sketch"))
        .select(F.explode(F.expr(f"approx_top_k_estimate(sketch, {CANDIDATES})")).alias("top"))
        .filter("top.count > 1")
        .select(F.col("top.item").alias("item"))
    )
    return (
        rows.withColumn("item", F.xxhash64("digest"))
        .join(F.broadcast(sketch), "item", "left_semi")
        .groupBy("digest")
        .agg(*_winner())
        .filter("group_size > 1")
    )


def _decided(docs: DataFrame, id_col: str, text_col: str, workspace: Workspace) -> DataFrame:
    rows = workspace.save(digests(docs, id_col, text_col), "digests")
    heavy = F.broadcast(workspace.save(heavy_winners(rows), "heavy"))
    rest = rows.join(heavy.select("digest"), "digest", "left_anti")
    # totals and a join, as a group need not fit into one task
    rest = rest.join(rest.groupBy("digest").agg(*_winner()), "digest")
    return rows.join(heavy, "digest").unionByName(rest)


def _wins():
    same = [F.col(name).eqNullSafe(F.col(f"winner.{name}")) for name in ("doc_id", *ROW_KEY)]
    return same[0] & same[1] & same[2]


def exact_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    workspace: Workspace | None = None,
) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical after A-Z became a-z; of equal texts the row
    with the largest id stays. A null text counts as empty, a null id as the lowest. Rows
    with the same id and text but other columns that differ: the one with the largest hash
    of all columns stays. Rows equal in every column are all marked kept, as nothing tells
    them apart; `drop_exact_duplicates` leaves one of them. An empty table gives an empty
    result. Other columns, whatever their names and types, are read for that hash alone.
    """
    workspace = workspace or Workspace(docs.sparkSession)
    return _decided(docs, id_col, text_col, workspace).select(
        "doc_id",
        F.col("winner.doc_id").alias("keep_id"),
        "group_size",
        _wins().alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_exact_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    workspace: Workspace | None = None,
) -> DataFrame:
    """The rows of `docs`, with all their columns, that `exact_duplicates` keeps."""
    workspace = workspace or Workspace(docs.sparkSession)
    winners = (
        _decided(docs, id_col, text_col, workspace)
        .filter(_wins())
        .groupBy(*ROW_KEY)
        .agg(F.count("*").alias("copies"))
    )
    return keep_rows(docs, workspace.save(winners, "winners"))


def op2_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_duplicates(table(spark, folder, "documents"))


ORACLE = """
WITH digests AS (
    SELECT doc_id,
           sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
    FROM documents
)
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY text_sha256) AS kept,
       text_sha256
FROM digests
"""
