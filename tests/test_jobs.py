"""The two jobs from text files to report files, by their command line."""

import pytest
from pyspark.sql import functions as F

from checks.fixture import flat_sales
from starloom.__main__ import SPLIT_COLUMNS, main
from starloom.plans.jobs import LOOKED_UP, load_star
from starloom.plans.marts import TIME_REPORT, all_reports, build, PRODUCT_SALES
from starloom.plans.star import Star
from starloom.plans.typed import typed_sales
from starloom.schema import STAR_TABLES
from starloom.sinks.writers import save_as

DATA = "/root/testdata/sf0.001"
REPORTS = {
    "report_product_sales",
    "report_customer_sales",
    "report_time_sales",
    "report_store_sales",
    "report_supplier_sales",
    "report_quality",
}


def test_jobs_from_csv_to_reports(spark, workspace, tmp_path):
    flat = flat_sales(spark, DATA)
    save_as(flat, "csv", path=f"{tmp_path}/csv")
    main(["star", "--csv", f"{tmp_path}/csv", "--to", f"parquet:{tmp_path}/star"])
    assert set(STAR_TABLES) <= {path.name for path in (tmp_path / "star").iterdir()}
    assert spark.read.parquet(f"{tmp_path}/star/fact_sales").count() == flat.count()

    for kind in ("json", "parquet"):
        main(["marts", "--star", f"{tmp_path}/star", "--to", f"{kind}:{tmp_path}/{kind}"])
        assert {path.name for path in (tmp_path / kind).iterdir()} == REPORTS

    expected = build(PRODUCT_SALES, Star.from_sales(typed_sales(flat), workspace))
    got = spark.read.parquet(f"{tmp_path}/parquet/report_product_sales")
    assert sorted(map(repr, got.collect())) == sorted(map(repr, expected.collect()))
    documents = spark.read.schema(got.schema).json(f"{tmp_path}/json/report_product_sales")
    assert sorted(map(repr, documents.collect())) == sorted(map(repr, got.collect()))


def test_the_star_from_csv_with_line_breaks(spark, tmp_path):
    lines = F.concat("product_description", F.lit("\n"), "product_name")
    flat = flat_sales(spark, DATA).withColumn("product_description", lines)
    save_as(flat, "csv", path=f"{tmp_path}/csv")
    for option in ("--multi-line", "--split-multi-line"):
        target = f"{tmp_path}/star{option}"
        main(["star", "--csv", f"{tmp_path}/csv", option, "--to", f"parquet:{target}"])
    for table in STAR_TABLES:
        left, right = (
            sorted(map(repr, spark.read.parquet(f"{tmp_path}/star{option}/{table}").collect()))
            for option in ("--multi-line", "--split-multi-line")
        )
        assert left == right and left


def test_each_star_table_is_written_once(spark, workspace, tmp_path, monkeypatch):
    """To the workspace if another table looks it up, and to the target."""
    saved, written = [], []
    save = workspace.save
    monkeypatch.setattr(workspace, "save", lambda rows, label: (saved.append(label), save(rows, label))[1])

    def write(rows, table):
        written.append(table)
        rows.write.parquet(f"{tmp_path}/out/{table}")

    load_star(flat_sales(spark, DATA), write, workspace)
    assert written == list(STAR_TABLES)
    assert sorted(label for label in saved if label in STAR_TABLES) == sorted(LOOKED_UP)


def test_every_star_table_has_a_column_to_be_read_by(spark, workspace):
    star = Star.from_sales(typed_sales(flat_sales(spark, DATA)), workspace)
    assert set(SPLIT_COLUMNS) == set(STAR_TABLES)
    for table, column in SPLIT_COLUMNS.items():
        assert dict(star[table].dtypes)[column] in ("int", "bigint")


def test_every_report_has_a_name(spark, workspace):
    star = Star.from_sales(typed_sales(flat_sales(spark, DATA)), workspace)
    assert set(all_reports(star)) == REPORTS and TIME_REPORT in REPORTS


def test_an_unknown_target_is_refused():
    with pytest.raises(SystemExit):
        main(["marts", "--to", "nowhere"])
