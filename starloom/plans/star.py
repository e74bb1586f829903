"""The star: six dimensions and the sales fact, from typed sales rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.casts import date_key
from starloom.operators.lookup import look_up_covered
from starloom.operators.numbering import number_rows
from starloom.operators.pick import lowest_row_per_key, lowest_rows_per_keys
from starloom.operators.totals import exact_totals
from starloom.schema import (
    CUSTOMER,
    PRODUCT,
    SELLER,
    STORE,
    SUPPLIER,
    KeyedDimension,
    NumberedDimension,
)
from starloom.workspace import Workspace


def keyed_dimension(
    sales: DataFrame, layout: KeyedDimension, workspace: Workspace
) -> DataFrame:
    """One row per key: that of the sale with the lowest id."""
    rows = sales.withColumn(layout.key, F.col(layout.source_key))
    return lowest_row_per_key(rows, layout.key, "id", layout.attributes, workspace)


# products also carry the columns by which their supplier is found
_PRODUCT_WITH_SUPPLIER = KeyedDimension(
    PRODUCT.key, PRODUCT.source_key, PRODUCT.attributes + SUPPLIER.columns
)


def keyed_dimensions(sales: DataFrame, workspace: Workspace) -> dict[str, DataFrame]:
    """Customers, sellers and products (with their supplier's columns) from the same scans."""
    layouts = (CUSTOMER, SELLER, _PRODUCT_WITH_SUPPLIER)
    kept = lowest_rows_per_keys(
        sales, {layout.source_key: layout.attributes for layout in layouts}, "id", workspace
    )
    return {
        layout.key: kept[layout.source_key].withColumnRenamed(layout.source_key, layout.key)
        for layout in layouts
    }


def numbered_dimension(
    sales: DataFrame, layout: NumberedDimension, workspace: Workspace
) -> DataFrame:
    """Distinct rows, numbered in the order of their columns."""
    distinct = sales.select(*layout.columns).distinct()
    order = [F.col(name).asc_nulls_last() for name in layout.columns]
    return number_rows(distinct, order, layout.key, workspace)


def product_dimension(
    sales: DataFrame, suppliers: DataFrame, workspace: Workspace
) -> DataFrame:
    """Products with the id of the supplier on the row that was kept.

    `suppliers` holds all that the sales name. A supplier with a missing column is found by no product: the join is not null-safe.
    """
    return with_supplier(keyed_dimension(sales, _PRODUCT_WITH_SUPPLIER, workspace), suppliers)


def with_supplier(products: DataFrame, suppliers: DataFrame) -> DataFrame:
    return look_up_covered(products, suppliers, SUPPLIER.columns).select(
        PRODUCT.key, *PRODUCT.attributes, SUPPLIER.key
    )


def date_dimension(sales: DataFrame) -> DataFrame:
    day = F.col("sale_date")
    return (
        sales.select("sale_date")
        .where(day.isNotNull())
        .distinct()
        .select(
            "sale_date",
            date_key(day).alias("date_id"),
            F.year(day).alias("year"),
            F.month(day).alias("month"),
            F.dayofmonth(day).alias("day"),
            F.quarter(day).alias("quarter"),
        )
    )


def sales_fact(sales: DataFrame, stores: DataFrame) -> DataFrame:
    """One row per sale. The date key is computed, so the dates need no join.

    `stores` holds all that the sales name.
    """
    return look_up_covered(sales, stores, STORE.columns).select(
        F.col("id").alias("sale_id"),
        date_key(F.col("sale_date")).alias("sale_date_id"),
        F.col("sale_customer_id").alias("customer_id"),
        F.col("sale_seller_id").alias("seller_id"),
        F.col("sale_product_id").alias("product_id"),
        STORE.key,
        "sale_quantity",
        "sale_total_price",
    )


class Star:
    """The seven tables by name, and what several marts derive from them.

    Each table is loaded at its first use and then kept, so that a job touches only the
    tables it needs and every later reader gets the stored one. `unstored` gives a table
    for a reader that is its only one.
    """

    def __init__(
        self,
        load: Callable[[Star, str], DataFrame],
        workspace: Workspace,
        unstored: Callable[[Star, str], DataFrame] | None = None,
    ):
        self._load = load
        self._unstored = unstored or load
        self._tables: dict[str, DataFrame] = {}
        self.workspace = workspace

    @classmethod
    def from_sales(cls, sales: DataFrame, workspace: Workspace) -> Star:
        keyed: dict[str, DataFrame] = {}

        def by_key(key: str) -> DataFrame:
            if not keyed:
                keyed.update(keyed_dimensions(sales, workspace))
            return keyed[key]

        def build(star: Star, name: str) -> DataFrame:
            match name:
                case "dim_customer":
                    table = by_key(CUSTOMER.key)
                case "dim_seller":
                    table = by_key(SELLER.key)
                case "dim_supplier":
                    table = numbered_dimension(sales, SUPPLIER, workspace)
                case "dim_store":
                    table = numbered_dimension(sales, STORE, workspace)
                case "dim_product":
                    table = product_dimension(sales, star["dim_supplier"], workspace)
                case "dim_date":
                    table = date_dimension(sales)
                case "fact_sales":
                    table = sales_fact(sales, star["dim_store"])
                case _:
                    raise KeyError(name)
            return table

        return cls(lambda star, name: workspace.save(build(star, name), name), workspace, build)

    @classmethod
    def from_store(cls, read: Callable[[str], DataFrame], workspace: Workspace) -> Star:
        """A star that was loaded before; each table is asked for once."""
        return cls(lambda _, name: read(name), workspace)

    def unstored(self, name: str) -> DataFrame:
        """The table as it was stored, if it was, else computed where it is read."""
        return self._tables[name] if name in self._tables else self._unstored(self, name)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self._load(self, name)
        return self._tables[name]

    @property
    def product_totals(self) -> DataFrame:
        """Quantity, revenue and number of sales per product; three marts start here."""
        if "product_totals" not in self._tables:
            totals = exact_totals(
                self["fact_sales"],
                ["product_id"],
                {"total_revenue": "sale_total_price"},
                {"total_sales_qty": "sale_quantity", "sales": "1"},
            )
            self._tables["product_totals"] = self.workspace.save(totals, "product_totals")
        return self._tables["product_totals"]
