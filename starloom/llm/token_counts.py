"""Token counts: Arrow functions that encode and return lengths only."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import table, text_or_empty, text_session
from starloom.llm.tokens import WORD_VOCABULARY, WordCoder

LIMIT = 2048


def _counts(vocabulary: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = WordCoder.loaded(vocabulary)
        for batch in batches:
            counts = coder.count(batch.column(2))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(counts, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"],
            )

    return run


def token_counts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str = WORD_VOCABULARY,
    limit: int = LIMIT,
) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit.

    `vocabulary` is a tokenizers file whose tokens do not cross white space, by name or
    path. Batches reach Python with at most 16 MB; texts are split into words, and the
    library is called with the words not seen before, about equal bytes a call. Nothing is
    shuffled and only lengths return.

    A null text counts as empty and has no tokens. Null and repeated ids pass through; each
    row is counted on its own. An empty table gives an empty result; other columns are not
    read.
    """
    text_session(docs.sparkSession)
    text = text_or_empty(text_col)
    slim = docs.select(
        F.col(id_col).alias("doc_id"),
        F.octet_length(text).cast("long").alias("n_bytes"),
        text.alias("text"),
    )
    kind = dict(slim.dtypes)["doc_id"]
    counted = slim.mapInArrow(_counts(vocabulary), f"doc_id {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def op3_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts(table(spark, folder, "documents"))
