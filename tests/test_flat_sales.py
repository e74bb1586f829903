"""The flat sales rows: those of their SQL, by joins that neither sort nor spill the lines."""

from __future__ import annotations

import re
import time
from pathlib import Path

from pyspark.sql import functions as F

from checks.fixture import FLAT_SQL, SOURCE_TABLES, flat_sales
from starloom.sinks.writers import save_as

TABLES = {
    "nation": ("n_nationkey int, n_name string", [(1, "NORTH"), (2, "SOUTH")]),
    "customer": (
        "c_custkey long, c_name string, c_nationkey int, c_mktsegment string",
        [(k, f"Customer#{k:09d}", 1 + k % 2, "TOYS") for k in range(1, 6)]
        + [(3, "Customer#twice", 1, "TOYS"), (None, "Customer#none", 1, "TOYS")],
    ),
    "supplier": (
        "s_suppkey long, s_name string, s_nationkey int",
        [(k, f"Supplier#{k}", 1 + k % 2) for k in range(1, 4)] + [(9, "Supplier#nowhere", None)],
    ),
    "part": (
        "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
        [(k, f"part {k}", "Brand", "TYPE", k, 1.5 * k) for k in range(1, 8)],
    ),
    "orders": (
        "o_orderkey long, o_custkey long, o_orderdate date",
        None,
    ),
    "lineitem": (
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
        "l_extendedprice double",
        [(k % 13, k % 9, k % 5, k % 8, float(k), 2.5 * k) for k in range(60)]
        + [(None, 1, 1, 1, 1.0, 1.0), (1, None, 1, 1, 1.0, 1.0), (1, 1, 9, 1, 1.0, 1.0)],
    ),
}


def _tables(spark, folder: str) -> None:
    import datetime

    for name in SOURCE_TABLES:
        schema, rows = TABLES[name]
        if name == "orders":
            day = datetime.date(2020, 1, 31)
            rows = [(k, k % 7 or None, day + datetime.timedelta(k)) for k in range(1, 12)]
            rows.append((4, 4, day))
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")


def test_the_rows_are_those_of_the_sql(spark, tmp_path):
    _tables(spark, str(tmp_path))
    for name in SOURCE_TABLES:
        spark.read.parquet(f"{tmp_path}/{name}.parquet").createOrReplaceTempView(name)
    expected = spark.sql(FLAT_SQL)
    found = flat_sales(spark, str(tmp_path))
    assert found.columns == expected.columns
    rows = sorted(map(repr, found.collect()))
    assert rows and rows == sorted(map(repr, expected.collect()))


def test_lines_are_joined_by_hash_and_the_orders_bring_their_customers(spark, tmp_path):
    _tables(spark, str(tmp_path))
    plan = flat_sales(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan
    joins = re.findall(r"(ShuffledHashJoin|BroadcastHashJoin) \[(\w+)#", plan)
    assert ("ShuffledHashJoin", "l_orderkey") in joins
    assert ("ShuffledHashJoin", "l_partkey") in joins
    # the last join stands first: parts meet the lines after the orders
    keys = [key for _, key in joins]
    assert keys.index("l_partkey") < keys.index("l_orderkey") < keys.index("o_custkey")


def test_csv_round_trips_write_compressed_files(spark, tmp_path, workspace, monkeypatch):
    import __spark_entry__ as entry

    tables = f"{tmp_path}/tables"
    _tables(spark, tables)
    expected = sorted(map(repr, flat_sales(spark, tables).collect()))
    monkeypatch.setattr(entry, "Workspace", lambda spark: workspace)
    found = entry.queries()["csv_round_trip"](spark, tables)
    assert sorted(map(repr, found.collect())) == expected
    split = entry.queries()["split_csv_round_trip"](spark, tables)
    assert split.count() == len(expected)
    written = {path.suffix for path in Path(workspace.root).rglob("part-*") if "csv" in path.name}
    # the second query's files must stay readable by several tasks each
    assert written == {".gz", ".bz2"}


def test_rows_of_a_part_follow_each_other_and_equal_columns_are_shuffled_once(spark, tmp_path, set_conf):
    _tables(spark, str(tmp_path))
    set_conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    rows = flat_sales(spark, str(tmp_path))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    # the customer's key went with the orders; suppliers are measured, not estimated
    assert len(re.findall(r"Exchange hashpartitioning\(l_partkey", plan)) == 1
    assert re.findall(r"(\w+) \[l_suppkey", plan) == ["BroadcastHashJoin"]
    for part in rows.select("sale_product_id").rdd.glom().collect():
        parts = [row.sale_product_id for row in part]
        assert parts == sorted(parts, key=int)


def test_written_rows_leave_no_shuffle_files(spark, tmp_path, workspace):
    def names():
        disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        blocks = disk.getAllBlocks()
        return {blocks.apply(place).name() for place in range(blocks.size())}

    def left(write):
        rows = spark.range(1000).repartition(8).groupBy(F.col("id") % 7).count()
        before = names()
        write(rows)
        for _ in range(50):
            new = [n for n in names() - before if n.startswith("shuffle_")]
            if not new:
                break
            time.sleep(0.1)
        return new

    assert left(lambda rows: rows.write.parquet(f"{tmp_path}/plain"))
    assert not left(lambda rows: workspace.save(rows, "saved"))
    assert not left(lambda rows: save_as(rows, "csv", path=f"{tmp_path}/csv"))
