"""Documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and returns
a DataFrame, which is written as Parquet and read again as the next one's docs. All but
the last return the columns of documents; the last returns the pieces of the sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starloom.llm.common import table
from starloom.llm.exact_dedup import drop_exact_duplicates
from starloom.llm.mixing import mix
from starloom.llm.packing import pack_documents
from starloom.llm.quality import drop_low_quality
from starloom.llm.simhash import drop_near_duplicates
from starloom.workspace import Workspace


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go; a null text is rejected.

    A document of a language without a reference is compared with the nearest one.
    """
    return drop_low_quality(docs, nearest=True)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id stays."""
    return drop_exact_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints the document with the smallest id stays."""
    return drop_near_duplicates(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target takes it: not at all, once or twice."""
    return mix(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the sequences with their token ids; a repeated row is packed each time."""
    return pack_documents(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_dedup),
    ("SimHash near-dedup", near_dedup),
    ("mixing sources to target weights", source_mix),
    ("packing", packing),
]

# SQL has neither the fingerprints nor the token ids
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    workspace = Workspace(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = workspace.save(stage(spark, docs, sf_dir), name.split()[0].lower())
    return STAGES[-1][1](spark, docs, sf_dir)
