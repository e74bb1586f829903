from datetime import date

import pytest

from starloom.plans.star import Star, keyed_dimension
from starloom.plans.typed import typed_sales
from starloom.schema import SALES_COLUMNS, SALES_TYPES, SELLER, STAR_TABLES, STORE, SUPPLIER


def store(n, **changes):
    return {name: f"{name}{n}" for name in STORE.columns} | changes


def supplier(n, **changes):
    return {name: f"{name}{n}" for name in SUPPLIER.columns} | changes


@pytest.fixture
def small_star(raw_sales, workspace):
    rows = [
        dict(id="2", sale_product_id="1", sale_customer_id="7", sale_date="5/9/2021",
             product_name="late", customer_first_name="B", **store(2), **supplier(1)),
        dict(id="1", sale_product_id="1", sale_customer_id="7", sale_date="05/09/2021",
             product_name="early", customer_first_name="A", **store(1), **supplier(2)),
        dict(id="3", sale_product_id="2", sale_customer_id=None, sale_date="13/45/2020",
             product_name="p2", customer_first_name="nobody",
             **store(1, store_state=None), **supplier(1, supplier_phone=None)),
        dict(id="4", sale_product_id="x", sale_customer_id="8", sale_date=None,
             product_name="no key", **store(1), **supplier(1)),
    ]
    return Star.from_sales(typed_sales(raw_sales(*rows)), workspace)


def test_typed_rows_keep_every_column_and_row(spark, raw_sales):
    typed = typed_sales(raw_sales({"id": "x"}, {}, {"id": "3"}))
    assert typed.columns == list(SALES_COLUMNS)
    kinds = {name: kind.replace("bigint", "long") for name, kind in typed.dtypes}
    assert kinds == {name: SALES_TYPES.get(name, "string") for name in SALES_COLUMNS}
    assert typed.count() == 3


def test_the_row_with_the_lowest_id_makes_the_dimension_row(small_star):
    customers = {row.customer_id: row.customer_first_name for row in small_star["dim_customer"].collect()}
    assert customers == {7: "A", None: "nobody", 8: None}
    products = {row.product_id: row for row in small_star["dim_product"].collect()}
    assert {key: row.product_name for key, row in products.items()} == {
        1: "early",
        2: "p2",
        None: "no key",
    }


def test_numbers_follow_the_columns_with_nulls_last(small_star):
    numbers = {
        (row.supplier_name, row.supplier_phone): row.supplier_id
        for row in small_star["dim_supplier"].collect()
    }
    assert numbers == {
        ("supplier_name1", "supplier_phone1"): 1,
        ("supplier_name1", None): 2,
        ("supplier_name2", "supplier_phone2"): 3,
    }


def test_a_key_with_a_missing_part_is_not_found(small_star):
    """The supplier and the store exist, but the join on their columns passes over nulls."""
    suppliers = {row.product_id: row.supplier_id for row in small_star["dim_product"].collect()}
    assert suppliers == {1: 3, 2: None, None: 1}
    stores = {row.sale_id: row.store_id for row in small_star["fact_sales"].collect()}
    assert small_star["dim_store"].count() == 3
    assert stores == {1: 1, 2: 3, 3: None, 4: 1}


def test_dates(small_star):
    assert [tuple(row) for row in small_star["dim_date"].collect()] == [
        (date(2021, 5, 9), 20210509, 2021, 5, 9, 2)
    ]
    keys = {row.sale_id: row.sale_date_id for row in small_star["fact_sales"].collect()}
    assert keys == {1: 20210509, 2: 20210509, 3: None, 4: None}


def test_layout(small_star):
    assert small_star["dim_customer"].columns[0] == "customer_id"
    assert small_star["dim_customer"].columns[-1] == "pet_category"
    assert small_star["dim_supplier"].columns == [*SUPPLIER.columns, "supplier_id"]
    assert small_star["dim_store"].columns == [*STORE.columns, "store_id"]
    assert small_star["dim_product"].columns[-1] == "supplier_id"
    assert dict(small_star["fact_sales"].dtypes) == {
        "sale_id": "bigint",
        "sale_date_id": "int",
        "customer_id": "bigint",
        "seller_id": "bigint",
        "product_id": "bigint",
        "store_id": "int",
        "sale_quantity": "int",
        "sale_total_price": "double",
    }


def test_each_table_is_built_once(small_star):
    for table in STAR_TABLES:
        assert small_star[table] is small_star[table]
    with pytest.raises(KeyError):
        small_star["dim_moon"]


def test_wide_rows_are_not_generated_beyond_what_the_jvm_compiles(spark):
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"


def test_dimensions_read_only_their_columns(spark, workspace, raw_sales):
    rows = workspace.save(typed_sales(raw_sales({"id": "1"})), "sales")
    plan = keyed_dimension(rows, SELLER, workspace)._jdf.queryExecution().executedPlan().toString()
    read = plan[plan.index("ReadSchema") :]
    assert "seller_email" in read and "product_name" not in read
