"""Command line of the two jobs: `star` loads the star, `marts` publishes the reports."""

from __future__ import annotations

import argparse
from contextlib import nullcontext

from starloom.config import Settings, open_session, settings
from starloom.plans.jobs import load_star, publish_marts
from starloom.schema import RAW_SALES
from starloom.sinks.published import PublishedReader, PublishedTables, is_published
from starloom.sinks.writers import (
    Writer,
    column_store_writer,
    document_writer,
    file_writer,
    warehouse_writer,
)
from starloom.sources.jdbc import BlockSplit, QuantileSplit, RangeSplit, read_table
from starloom.sources.sales_csv import read_sales_csv
from starloom.sources.split_csv import read_split_csv
from starloom.workspace import Workspace

# the key each star table is read by in slices
SPLIT_COLUMNS = {
    "dim_customer": "customer_id",
    "dim_seller": "seller_id",
    "dim_supplier": "supplier_id",
    "dim_product": "product_id",
    "dim_store": "store_id",
    "dim_date": "date_id",
    "fact_sales": "sale_id",
}


def _writer(target: str, options: Settings, truncate: bool = False) -> Writer:
    match target:
        case "warehouse":
            return warehouse_writer(options.warehouse, options.target_schema, truncate)
        case "column-store":
            return column_store_writer(options.reports)
        case "documents":
            return document_writer(options.documents_uri, options.documents_database)
    kind, _, folder = target.partition(":")
    if not folder:
        raise SystemExit(f"unknown target {target}")
    return file_writer(kind, folder)


def _file_target(target: str) -> tuple[str, str]:
    kind, _, folder = target.partition(":")
    if not folder or target in ("warehouse", "column-store", "documents"):
        raise SystemExit(f"only files can be replaced together, not {target}")
    return kind, folder


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="starloom")
    jobs = parser.add_subparsers(dest="job", required=True)
    star = jobs.add_parser("star", help="flat sales rows to star tables")
    star.add_argument("--csv", nargs="+", help="read these files instead of the source table")
    star.add_argument("--multi-line", action="store_true", help="fields hold line breaks")
    star.add_argument(
        "--split-multi-line", action="store_true", help="the same, with several tasks a file"
    )
    star.add_argument("--to", default="warehouse")
    star.add_argument("--truncate", action="store_true", help="empty the old tables, keep them")
    star.add_argument(
        "--slice-quantiles", action="store_true", help="slices of equal rows, not equal width"
    )
    star.add_argument("--slice-column", help="numeric or date column to read the source by")
    marts = jobs.add_parser("marts", help="star tables to reports")
    marts.add_argument("--star", help="folder of Parquet star tables instead of the database")
    marts.add_argument("--to", required=True)
    for job in (star, marts):
        job.add_argument(
            "--together", action="store_true", help="file tables replace the old ones all at once"
        )
        job.add_argument("--slices", type=int, help="tasks per database table (JDBC_SLICES)")
    chosen = parser.parse_args(arguments)

    options = settings()
    slices = chosen.slices or options.slices
    spark = open_session(f"starloom-{chosen.job}")
    workspace = Workspace(spark)
    if chosen.together:
        target = PublishedTables(spark, *_file_target(chosen.to))
    else:
        target = nullcontext(_writer(chosen.to, options, getattr(chosen, "truncate", False)))
    published = None
    if getattr(chosen, "star", None) and is_published(spark, chosen.star):
        published = PublishedReader(spark, chosen.star)

    def star_table(name: str):
        if published:
            return published(name)
        if chosen.star:
            return spark.read.parquet(f"{chosen.star.rstrip('/')}/{name}")
        # several marts read each table: it leaves the database once
        table = read_table(
            spark,
            options.warehouse,
            f"{options.source_schema}.{name}",
            split=RangeSplit(SPLIT_COLUMNS[name], slices),
        )
        return workspace.save(table, name)

    try:
        if chosen.job == "star":
            if chosen.csv and chosen.split_multi_line:
                raw = read_split_csv(spark, chosen.csv, RAW_SALES, workspace)
            elif chosen.csv:
                raw = read_sales_csv(spark, chosen.csv, chosen.multi_line)
            else:
                # the source has text only: by default its slices are disk blocks
                column = chosen.slice_column
                by_column = QuantileSplit if chosen.slice_quantiles else RangeSplit
                split = by_column(column, slices) if column else BlockSplit(slices)
                raw = read_table(spark, options.warehouse, options.source_table, split)
            with target as write:
                load_star(raw, write, workspace)
        else:
            with target as write:
                publish_marts(star_table, write, workspace)
    finally:
        workspace.discard()


if __name__ == "__main__":
    main()
