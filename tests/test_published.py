"""Tables that replace the older ones together."""

import json

import pytest

from checks.fixture import flat_sales
from starloom.__main__ import main
from starloom.plans.jobs import load_star
from starloom.schema import STAR_TABLES
from starloom.sinks.published import MANIFEST, PublishedReader, PublishedTables, is_published
from starloom.sinks.writers import save_as

DATA = "/root/testdata/sf0.001"


def publish(spark, folder, value, kind="parquet", tables=("a", "b")):
    with PublishedTables(spark, kind, str(folder)) as write:
        for table in tables:
            write(spark.createDataFrame([(table, value)], "t string, n int"), table)


def found(reader):
    return {table: [row.n for row in reader(table).collect()] for table in reader.tables}


@pytest.mark.parametrize("kind", ["parquet", "orc"])
def test_all_tables_are_of_one_job(spark, tmp_path, kind):
    assert not is_published(spark, str(tmp_path))
    with pytest.raises(FileNotFoundError):
        PublishedReader(spark, str(tmp_path))
    publish(spark, tmp_path, 1, kind)
    first = PublishedReader(spark, str(tmp_path))
    assert found(first) == {"a": [1], "b": [1]} and first.format == kind

    publish(spark, tmp_path, 2, kind)
    assert found(PublishedReader(spark, str(tmp_path))) == {"a": [2], "b": [2]}
    # who began before goes on with the older tables
    assert found(first) == {"a": [1], "b": [1]}


def test_only_the_last_two_jobs_keep_their_files(spark, tmp_path):
    for value in range(4):
        publish(spark, tmp_path, value)
    folders = [path for path in tmp_path.iterdir() if path.is_dir()]
    assert len(folders) == 2
    manifest = json.loads((tmp_path / MANIFEST).read_text())
    assert {path.name for path in folders} == {manifest["version"], manifest["last"]}
    assert not [path for path in tmp_path.iterdir() if path.name.startswith(f"{MANIFEST}-")]


def test_tables_that_a_job_no_longer_writes_are_gone(spark, tmp_path):
    publish(spark, tmp_path, 1, tables=("a", "b"))
    publish(spark, tmp_path, 2, tables=("a",))
    reader = PublishedReader(spark, str(tmp_path))
    assert found(reader) == {"a": [2]}
    with pytest.raises(KeyError):
        reader("b")


def test_during_a_job_readers_see_the_tables_before(spark, tmp_path):
    publish(spark, tmp_path, 1)
    with PublishedTables(spark, "parquet", str(tmp_path)) as write:
        write(spark.createDataFrame([("a", 2)], "t string, n int"), "a")
        assert found(PublishedReader(spark, str(tmp_path))) == {"a": [1], "b": [1]}
        write(spark.createDataFrame([("b", 2)], "t string, n int"), "b")
    assert found(PublishedReader(spark, str(tmp_path))) == {"a": [2], "b": [2]}


@pytest.mark.parametrize("stopped_at", [0, 3, 6])
def test_a_job_stopped_midway_leaves_the_old_star(spark, workspace, tmp_path, stopped_at):
    publish(spark, tmp_path / "star", 7, tables=STAR_TABLES)
    before = sorted(path.name for path in (tmp_path / "star").iterdir())
    raw = workspace.save(flat_sales(spark, DATA).limit(50), "raw")
    tables = PublishedTables(spark, "parquet", str(tmp_path / "star"))

    def write(rows, table):
        if table == STAR_TABLES[stopped_at]:
            raise RuntimeError("stopped")
        tables(rows, table)

    with pytest.raises(RuntimeError, match="stopped"), tables:
        load_star(raw, write, workspace)
    assert found(PublishedReader(spark, str(tmp_path / "star"))) == {t: [7] for t in STAR_TABLES}
    assert sorted(path.name for path in (tmp_path / "star").iterdir()) == before


def test_jobs_by_the_command_line(spark, tmp_path):
    save_as(flat_sales(spark, DATA), "csv", path=f"{tmp_path}/csv")
    for _ in range(2):
        main(["star", "--csv", f"{tmp_path}/csv", "--together", "--to", f"parquet:{tmp_path}/star"])
    reader = PublishedReader(spark, f"{tmp_path}/star")
    assert set(reader.tables) == set(STAR_TABLES)
    main(["marts", "--star", f"{tmp_path}/star", "--together", "--to", f"json:{tmp_path}/marts"])
    assert len(PublishedReader(spark, f"{tmp_path}/marts").tables) == 6
    with pytest.raises(SystemExit):
        main(["marts", "--star", f"{tmp_path}/star", "--together", "--to", "documents"])
