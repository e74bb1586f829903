import json
import re
from unittest.mock import MagicMock

import pytest

from starloom.config import JdbcStore, settings
from starloom.functions.fill import fill_missing
from starloom.schema import SALES_COLUMNS
from starloom.sinks.writers import (
    column_store_writer,
    document_writer,
    file_writer,
    save_as,
    warehouse_writer,
)
from starloom.sources.jdbc import (
    BlockSplit,
    QuantileSplit,
    RangeSplit,
    block_conditions,
    quantile_conditions,
    read_table,
)
from starloom.sources.sales_csv import read_sales_csv
from starloom.workspace import Workspace, shared_folder

STORE = JdbcStore(url="jdbc:x://host/db", user="me", password="secret", driver="a.B")


def csv_line(**values):
    return ",".join(values.get(name, "") for name in SALES_COLUMNS) + "\n"


HEADER = ",".join(SALES_COLUMNS) + "\n"


def test_csv_fields(spark, tmp_path):
    (tmp_path / "SALES (1).csv").write_text(
        HEADER
        + csv_line(id="1", customer_first_name='"a, b"', customer_last_name='"say ""hi"""')
        + csv_line(id='"2"', customer_first_name='""', customer_last_name=" x ")
    )
    (tmp_path / "SALES (2).csv").write_text(HEADER + csv_line(id="3", customer_first_name="null"))
    rows = {row.id: row for row in read_sales_csv(spark, f"{tmp_path}/SALES*.csv").collect()}
    assert set(rows) == {"1", "2", "3"}
    assert (rows["1"].customer_first_name, rows["1"].customer_last_name) == ("a, b", 'say "hi"')
    assert (rows["2"].customer_first_name, rows["2"].customer_last_name) == ("", " x ")
    assert (rows["3"].customer_first_name, rows["3"].customer_last_name) == ("null", None)


def test_one_csv_file_by_name(spark, tmp_path):
    path = tmp_path / "SALES (1).csv"
    path.write_text(HEADER + csv_line(id="1"))
    assert read_sales_csv(spark, str(path)).count() == 1


def test_csv_line_breaks_need_the_option_and_never_pass_unnoticed(spark, tmp_path):
    path = tmp_path / "sales.csv"
    path.write_text(HEADER + csv_line(id="1", product_description='"two\nlines"') + csv_line(id="2"))
    rows = read_sales_csv(spark, str(path), multi_line=True)
    assert {row.id: row.product_description for row in rows.collect()} == {"1": "two\nlines", "2": None}
    broken = read_sales_csv(spark, str(path))
    for narrowed in (broken, broken.select("id"), broken.groupBy().count()):
        with pytest.raises(Exception, match="MALFORMED|Malformed"):
            narrowed.collect()


def test_csv_is_split_over_tasks_unless_fields_hold_line_breaks(spark, tmp_path, set_conf):
    path = tmp_path / "sales.csv"
    path.write_text(HEADER + csv_line(id="1", product_description="d" * 100) * 2000)
    set_conf("spark.sql.files.maxPartitionBytes", "64KB")
    assert read_sales_csv(spark, str(path)).rdd.getNumPartitions() > 1
    assert read_sales_csv(spark, str(path), multi_line=True).rdd.getNumPartitions() == 1
    assert read_sales_csv(spark, str(path)).count() == 2000


ROWS = [("a", 1, 1.5), ("", None, None), (None, 0, float("nan")), ('q"\\,', -1, 0.0), (" pad ", 2, 2.0)]


@pytest.mark.parametrize("kind", ["csv", "json", "parquet", "orc"])
def test_files_give_back_the_same_rows_and_replace_what_was_there(spark, tmp_path, kind):
    rows = spark.createDataFrame(ROWS, "t string, n int, x double")
    write = file_writer(kind, str(tmp_path))
    write(rows.limit(1), "report")
    write(rows, "report")
    reader = spark.read.schema(rows.schema)
    if kind == "csv":
        reader = reader.options(header=True, escape='"', nullValue="\u0000")
    got = reader.format(kind).load(f"{tmp_path}/report").collect()
    assert sorted(map(repr, got)) == sorted(map(repr, rows.collect()))


def test_documents_keep_missing_fields(spark, tmp_path):
    save_as(spark.createDataFrame([(None, 1)], "t string, n int"), "json", path=f"{tmp_path}/d")
    (text,) = [line.value for line in spark.read.text(f"{tmp_path}/d").collect()]
    assert json.loads(text) == {"t": None, "n": 1}


def test_fill(spark):
    schema = "t string, i int, l long, x double, b boolean, d date"
    rows = spark.createDataFrame(
        [(None, None, None, None, None, None), ("a", 1, 2, float("nan"), True, None)], schema
    )
    assert [tuple(row) for row in fill_missing(rows).collect()] == [
        ("", 0, 0, 0.0, None, None),
        ("a", 1, 2, 0.0, True, None),
    ]


def test_settings_come_from_the_environment():
    found = settings({"POSTGRES_USER": "u", "CLICKHOUSE_HOST": "h", "MONGODB_URI": "mongodb://secret@m"})
    assert found.warehouse.user == "u"
    assert found.warehouse.url == "jdbc:postgresql://postgres:5432/bigdata"
    assert found.warehouse.password == ""
    assert found.reports.url == "jdbc:clickhouse:http://h:8123/default"
    assert (found.source_table, found.target_schema) == ("mock_data", "star")
    assert (found.slices, found.warehouse.connections) == (64, 64)
    assert settings({"JDBC_SLICES": "7", "JDBC_CONNECTIONS": "3"}).reports.connections == 3
    assert "secret" not in repr(STORE) and "secret" not in repr(found)


@pytest.mark.parametrize(("blocks", "partitions"), [(0, 4), (1, 4), (7, 3), (100, 64), (64, 64)])
def test_block_conditions_hold_every_row_once(spark, blocks, partitions):
    conditions = block_conditions(blocks, partitions)
    assert len(conditions) == max(1, min(blocks, partitions))
    # a row address as a number; blocks may be added while the table is read
    rows = spark.createDataFrame([(block * 1000 + 1,) for block in range(blocks + 3)], "place long")
    numbers = [re.sub(r"'\((\d+),0\)'::tid", r"\g<1>000", c).replace("ctid", "place") for c in conditions]
    matched = [row.place for condition in numbers for row in rows.where(condition).collect()]
    assert sorted(matched) == [row.place for row in rows.collect()]
    sizes = [rows.where(condition).count() for condition in numbers[:-1]]
    assert not sizes or max(sizes) - min(sizes) <= 1


@pytest.mark.parametrize("kind", ["long", "decimal(20,0)", "date", "timestamp"])
def test_quantile_conditions_hold_every_row_once(spark, kind):
    # sparse and skewed: squares of squares, a third of the rows share one value, some have none
    numbers = [n**4 for n in range(60)] + [81] * 30 + [None] * 5
    rows = spark.createDataFrame([(n,) for n in numbers], "n long")
    values = {"date": "date_add(date'1970-01-01', cast(n div 1000 as int))", "timestamp": "timestamp_seconds(n)"}
    rows = rows.selectExpr(f"{values.get(kind, f'cast(n as {kind})')} as k").cache()
    ordered = sorted(row.k for row in rows.collect() if row.k is not None)
    bounds = [ordered[len(ordered) * n // 8] for n in range(1, 8)]
    conditions = quantile_conditions("k", bounds)
    parts = [rows.where(condition).collect() for condition in conditions]
    assert sorted(map(repr, sum(parts, []))) == sorted(map(repr, rows.collect()))
    # a slice holds its share, beside the rows of one value
    common = max(ordered.count(bound) for bound in bounds)
    assert max(map(len, parts)) <= len(numbers) // 8 + common + 5
    rows.unpersist()


def test_quantile_conditions_without_bounds(spark):
    assert quantile_conditions("k", []) == ["1 = 1"] == quantile_conditions("k", [None])
    assert quantile_conditions("k", [4, 4]) == ["k < 4 OR k IS NULL", "k >= 4"]


def test_a_table_is_read_by_quantiles():
    spark, seen = recorded_reader(None)
    found = spark.read.format.return_value.load.return_value.collect
    found.return_value = [(30,), (10,), (None,)]
    read_table(spark, STORE, "star.fact_sales", QuantileSplit("sale_id", 4))
    assert seen[0]["query"] == (
        "SELECT unnest(percentile_disc(ARRAY[0.25, 0.5, 0.75]::float8[]) "
        "WITHIN GROUP (ORDER BY sale_id)) AS bound FROM star.fact_sales"
    )
    (url, table), named = spark.read.jdbc.call_args
    assert (url, table) == (STORE.url, "star.fact_sales")
    assert named["predicates"] == [
        "sale_id < 10 OR sale_id IS NULL",
        "sale_id >= 10 AND sale_id < 30",
        "sale_id >= 30",
    ]


def recorded_reader(bounds):
    """A session whose reader notes its options; there is no database to read from."""
    spark, seen = MagicMock(), []
    reader = spark.read.format.return_value

    def options(**given):
        seen.append(given)
        return reader

    reader.options.side_effect = options
    reader.load.return_value.first.return_value = bounds
    return spark, seen


def test_a_table_is_read_in_slices_between_its_own_bounds():
    spark, seen = recorded_reader((3, 900))
    read_table(spark, STORE, "star.fact_sales", split=RangeSplit("sale_id", 16))
    assert seen[0]["dbtable"] == "star.fact_sales"
    assert seen[1]["query"] == "SELECT MIN(sale_id) AS lowest, MAX(sale_id) AS highest FROM star.fact_sales"
    assert "dbtable" not in seen[1]
    assert seen[2] == {
        "partitionColumn": "sale_id",
        "lowerBound": "3",
        "upperBound": "900",
        "numPartitions": "16",
    }


def test_an_empty_table_is_read_without_slices():
    spark, seen = recorded_reader((None, None))
    read_table(spark, STORE, "t", split=RangeSplit("k", 8))
    assert all("partitionColumn" not in given for given in seen)


def test_a_table_is_read_by_blocks():
    spark, seen = recorded_reader((10,))
    read_table(spark, STORE, "mock_data", BlockSplit(2))
    assert "pg_relation_size('mock_data')" in seen[0]["query"]
    (url, table), named = spark.read.jdbc.call_args
    assert (url, table) == (STORE.url, "mock_data")
    assert named["predicates"] == [
        "ctid >= '(0,0)'::tid AND ctid < '(5,0)'::tid",
        "ctid >= '(5,0)'::tid",
    ]
    assert named["properties"]["user"] == "me"


def recorded_writer():
    rows, seen = MagicMock(), {}
    rows.na.fill.return_value = rows
    rows.repartition.side_effect = lambda n: (seen.update(tasks=n), rows)[1]
    writer = rows.write.format.return_value
    writer.options.side_effect = lambda **given: (seen.update(given), writer)[1]
    writer.option.side_effect = lambda name, value: (seen.update({name: value}), writer)[1]
    writer.mode.side_effect = lambda mode: (seen.update(mode=mode), writer)[1]
    return rows, seen


def test_a_star_table_replaces_the_old_one():
    rows, seen = recorded_writer()
    warehouse_writer(STORE, "star")(rows, "dim_date")
    rows.write.format.assert_called_once_with("jdbc")
    assert (seen["dbtable"], seen["mode"], seen["url"]) == ("star.dim_date", "overwrite", STORE.url)
    assert (seen["truncate"], seen["tasks"]) == ("false", STORE.connections)
    rows.na.fill.assert_not_called()


def test_a_star_table_can_be_emptied_instead():
    rows, seen = recorded_writer()
    warehouse_writer(STORE, "star", truncate=True)(rows, "dim_date")
    assert (seen["truncate"], seen["mode"]) == ("true", "overwrite")


def test_a_column_store_gets_filled_rows_and_its_table_options():
    rows, seen = recorded_writer()
    column_store_writer(STORE)(rows, "report_quality")
    assert [call.args[0] for call in rows.na.fill.call_args_list] == ["", 0]
    assert seen["createTableOptions"] == "ENGINE = MergeTree() ORDER BY tuple()"
    assert (seen["dbtable"], seen["mode"]) == ("report_quality", "overwrite")


def test_a_document_store_gets_one_collection_per_report():
    rows, seen = recorded_writer()
    document_writer("mongodb://m", "reports")(rows, "report_quality")
    rows.write.format.assert_called_once_with("mongodb")
    assert seen == {
        "connection.uri": "mongodb://m",
        "database": "reports",
        "collection": "report_quality",
        "mode": "overwrite",
    }
    rows.na.fill.assert_not_called()


def test_workspace_uses_the_shared_folder_of_the_session(spark, tmp_path):
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        assert shared_folder(spark) == folder
    workspace = Workspace(spark, str(tmp_path))
    saved = workspace.save(spark.range(3), "numbers")
    assert saved.count() == 3 and saved.inputFiles()[0].startswith(f"file://{workspace.root}")
    workspace.discard()
    assert not list(tmp_path.iterdir())


def test_a_cluster_without_a_shared_folder_is_refused():
    spark = MagicMock()
    spark.conf.get.return_value = None
    spark.sparkContext.getCheckpointDir.return_value = None
    spark.sparkContext.master = "spark://host:7077"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(spark)
