import hashlib

import duckdb
import pytest
from pyspark.sql import functions as F

from starloom.llm import exact_dedup
from starloom.llm.common import keep_rows, row_key, table
from starloom.llm.exact_dedup import drop_exact_duplicates, exact_duplicates

SMALL = "/root/testdata/sf0.001"
COLUMNS = "doc_id long, text string, winner string, kept int, __row_key int"


def brute(rows):
    """Per digest: largest id (null lowest) and size."""
    groups = {}
    for doc_id, text in rows:
        plain = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        groups.setdefault(hashlib.sha256(plain.encode()).hexdigest(), []).append(doc_id)
    return {
        digest: (max((i for i in ids if i is not None), default=None), len(ids))
        for digest, ids in groups.items()
    }


def test_oracle(spark):
    ours = exact_dedup.op2_exact_dedup(spark, SMALL)
    check = duckdb.sql(
        exact_dedup.ORACLE.replace("FROM documents", f"FROM '{SMALL}/documents.parquet'")
    )
    columns = sorted(ours.columns)
    assert sorted(check.columns) == columns
    assert sorted(tuple(r[c] for c in columns) for r in ours.collect()) == sorted(
        check.project(", ".join(columns)).fetchall()
    )


@pytest.mark.parametrize("partitions", [1, 37])
def test_a_third_of_the_rows_are_copies(spark, set_conf, partitions):
    set_conf("spark.sql.shuffle.partitions", str(partitions))
    set_conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rows = [(i, "HOT text" if i % 3 == 0 else f"text {i // 2}") for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(13)
    heavy = exact_dedup.heavy_winners(exact_dedup.digests(docs, "doc_id", "text"))
    assert 1 <= heavy.count() <= exact_dedup.CANDIDATES
    assert heavy.agg({"group_size": "max"}).first()[0] == 2000
    expected = brute(rows)
    for row in exact_duplicates(docs).collect():
        keep, size = expected[row.text_sha256]
        assert (row.keep_id, row.group_size, row.kept) == (keep, size, row.doc_id == keep)


def test_only_a_to_z_lose_their_case(spark):
    docs = spark.createDataFrame([(1, "É"), (2, "é"), (3, "AZ"), (4, "az")], "doc_id long, text string")
    assert {r.doc_id for r in exact_duplicates(docs).collect() if r.kept} == {1, 2, 4}


def test_nulls_ties_repeats_and_other_columns(spark):
    rows = [
        (None, None, "w", 1, 1),
        (1, "", "w", 1, 1),
        (2, "a", "w", 1, 1),
        (2, "a", "w", 1, 1),
        (2, "A", "v", None, 1),
        (None, "b", None, 0, 1),
        (3, "x" * 300_000, "w", 1, 1),
    ]
    docs = spark.createDataFrame(rows, COLUMNS)
    report = exact_duplicates(docs).collect()
    assert len(report) == 7
    assert sorted((r.keep_id is None, r.group_size) for r in report) == [
        (False, 1), (False, 2), (False, 2), (False, 3), (False, 3), (False, 3), (True, 1)
    ]
    kept = drop_exact_duplicates(docs)
    assert kept.columns == docs.columns
    ids = sorted(((r.doc_id, len(r.text)) for r in kept.collect()), key=str)
    assert ids == [(1, 0), (2, 1), (3, 300_000), (None, 1)]


def test_rows_equal_in_every_column_leave_one(spark):
    docs = spark.createDataFrame([(2, "a"), (2, "a"), (1, "a")], "doc_id long, text string")
    assert [tuple(r) for r in drop_exact_duplicates(docs).collect()] == [(2, "a")]


def test_empty(spark):
    docs = spark.createDataFrame([], COLUMNS)
    assert exact_duplicates(docs).count() == drop_exact_duplicates(docs).count() == 0


AWKWARD = """doc_id long, text string, attributes map<string,int>, nested array<struct<m:map<int,string>>>,
    __row_key_low int, __row_key_high int, `a``b` int, row string, copies int, digest string"""


def test_columns_of_any_type_and_name(spark):
    from starloom.llm.simhash import drop_near_duplicates, simhash_groups

    text = "the same words in the same order here"
    rows = [
        (1, text, {"a": 1}, [({1: "x"},)], 1, 1, 1, "r", 1, "d"),
        (2, text.upper(), {"a": 2}, None, 1, 1, 1, "r", 1, "d"),
        (2, text, None, [], None, None, None, None, None, None),
        (2, text, None, [], None, None, None, None, None, None),
        (None, "other", {}, [(None,)], 1, 1, 1, "r", 1, "d"),
    ]
    docs = spark.createDataFrame(rows, AWKWARD).selectExpr("*", "parse_json('{\"v\": [1, 2]}') as v")
    assert sorted(r.group_size for r in exact_duplicates(docs).collect()) == [1, 4, 4, 4, 4]
    kept = drop_exact_duplicates(docs)
    assert kept.columns == docs.columns and kept.count() == 2
    assert len({r.fingerprint for r in simhash_groups(docs).collect()}) == 2
    near = drop_near_duplicates(docs)
    assert near.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in near.collect()) == [0, 1]


def test_work_folders_are_released(spark, tmp_path):
    import os

    from starloom.llm.simhash import simhash_groups
    from starloom.workspace import Workspace

    workspace = Workspace(spark, str(tmp_path))
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    simhash_groups(docs, workspace=workspace)
    left = sorted(name.rsplit("-", 1)[0] for name in os.listdir(workspace.root))
    # the rows and their groups are read by the result, the others by nothing any more
    assert left == ["fingerprints", "members"]


def test_kept_rows_beyond_the_limit_are_met_by_shuffle(spark, set_conf):
    set_conf("spark.sql.autoBroadcastJoinThreshold", "10m")
    docs = spark.createDataFrame([(1, "a"), (2, "b"), (None, None)], "doc_id long, text string")
    winners = docs.limit(2).select(*row_key(docs), F.lit(1).alias("copies"))
    kept = keep_rows(docs, winners, limit=0)
    assert "BroadcastHashJoin" not in kept._jdf.queryExecution().executedPlan().toString()
    assert kept.count() == 2
