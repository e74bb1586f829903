"""Every registered query against its check SQL, and the figures of the check data."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from checks.fixture import SOURCE_TABLES
from starloom.schema import STAR_TABLES

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "date": "DATE"}


@pytest.fixture(scope="module")
def duck():
    return connected(SMALL)


def connected(folder):
    connection = duckdb.connect()
    for table in SOURCE_TABLES:
        connection.execute(f"create view {table} as select * from '{folder}/{table}.parquet'")
    return connection


def values(rows, columns):
    places = [columns.index(name) for name in sorted(columns)]
    return sorted(tuple(repr(row[place]) for place in places) for row in rows)


# the text queries have tests of their own
QUERIES = sorted(set(registry.queries()) - set(registry.TEXT_QUERIES))


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_check(spark, duck, name):
    ours = registry.queries()[name](spark, SMALL)
    sql = registry.oracle_sql()[name]
    described = duck.execute(f"describe {sql}").fetchall()
    assert {row[0]: row[1] for row in described} == {n: TYPES[kind] for n, kind in ours.dtypes}
    check = duck.execute(sql)
    columns = [column[0] for column in check.description]
    assert values(ours.collect(), ours.columns) == values(check.fetchall(), columns)


@pytest.fixture(scope="module")
def medium_duck():
    return connected(MEDIUM)


REPORTS = sorted(name.removesuffix("_filled") for name in QUERIES if name.endswith("_filled"))


@pytest.mark.parametrize("name", [*REPORTS, "period_changes"])
def test_report_equals_its_check_with_more_sales(spark, medium_duck, name):
    ours = registry.queries()[name](spark, MEDIUM)
    check = medium_duck.execute(registry.oracle_sql()[name])
    columns = [column[0] for column in check.description]
    assert values(ours.collect(), ours.columns) == values(check.fetchall(), columns)


def test_every_query_has_a_check():
    assert set(QUERIES) == set(registry.oracle_sql()) - set(registry.TEXT_ORACLES)


def test_a_changed_table_is_read_anew(spark, tmp_path):
    for table in SOURCE_TABLES:
        spark.read.parquet(f"{SMALL}/{table}.parquet").write.parquet(f"{tmp_path}/{table}.parquet")

    def seen():
        total = registry.queries()["time_sales"](spark, str(tmp_path)).agg(F.sum("orders")).first()[0]
        return registry.queries()["fact_sales"](spark, str(tmp_path)).count(), total

    before = seen()
    assert before == seen()
    stored = registry.star(spark, str(tmp_path))
    assert registry.star(spark, str(tmp_path)) is stored
    fewer = spark.read.parquet(f"{SMALL}/lineitem.parquet").where("l_orderkey % 10 = 0")
    fewer.write.mode("overwrite").parquet(f"{tmp_path}/lineitem.parquet")
    after = seen()
    assert after[0] == fewer.count() < before[0] and after[1] < before[1]


def test_entry(spark):
    assert registry.entry(spark).count() == 200


@pytest.fixture(scope="module")
def star(spark):
    return registry.star(spark, MEDIUM)


def test_row_counts(star):
    counts = {table: star[table].count() for table in STAR_TABLES}
    assert counts == {
        "dim_customer": 1501,
        "dim_seller": 100,
        "dim_supplier": 100,
        "dim_product": 2000,
        "dim_store": 40,
        "dim_date": 2398,
        "fact_sales": 60000,
    }


def test_missing_values(spark, star):
    def missing(rows, name):
        return rows.where(F.col(name).isNull()).count()

    sales = registry.sales(spark, MEDIUM)
    assert {
        name: missing(sales, name)
        for name in (
            "customer_age",
            "sale_date",
            "sale_customer_id",
            "product_rating",
            "sale_quantity",
            "product_category",
            "customer_country",
        )
    } == {
        "customer_age": 1468,
        "sale_date": 1169,
        "sale_customer_id": 118,
        "product_rating": 1719,
        "sale_quantity": 0,
        "product_category": 1460,
        "customer_country": 1848,
    }
    fact = star["fact_sales"]
    assert [missing(fact, name) for name in ("sale_date_id", "customer_id", "store_id")] == [1169, 118, 5914]
    products = star["dim_product"]
    assert [missing(products, name) for name in ("supplier_id", "product_category")] == [116, 47]


def test_every_key_of_the_fact_is_found_once(star):
    for table, key, name in (
        ("dim_customer", "customer_id", "customer_id"),
        ("dim_seller", "seller_id", "seller_id"),
        ("dim_product", "product_id", "product_id"),
        ("dim_store", "store_id", "store_id"),
        ("dim_date", "date_id", "sale_date_id"),
    ):
        dimension = star[table].select(F.col(key).alias(name))
        assert dimension.count() == dimension.distinct().count()
        keys = star["fact_sales"].where(F.col(name).isNotNull())
        assert keys.join(dimension, name, "left_anti").count() == 0


def test_totals_add_up(spark):
    def query(name):
        return registry.queries()[name](spark, MEDIUM)

    quantity, revenue = query("product_sales").agg(
        F.sum("total_sales_qty"), F.sum(F.col("total_revenue").cast("decimal(18,2)"))
    ).first()
    assert (quantity, str(revenue)) == (1524135, "3183256271.63")
    for name, measure in (
        ("category_revenue", "category_revenue"),
        ("customer_sales", "total_spent"),
        ("time_sales", "total_revenue"),
        ("city_sales", "city_total_revenue"),
        ("store_country_sales", "country_total_revenue"),
        ("supplier_country_sales", "country_total_revenue"),
    ):
        total = query(name).agg(F.sum(F.col(measure).cast("decimal(18,2)"))).first()[0]
        assert str(total) == "3183256271.63", name
    counts = {
        name: query(name).count()
        for name in ("product_sales", "customer_sales", "time_sales", "store_sales", "supplier_sales")
    }
    assert list(counts.values()) == [2000, 1501, 81, 37, 95]
    assert query("rating_correlation").first()[0] == -0.01864273


def test_ranks_have_no_gaps(spark):
    for name, ranks in (
        ("customer_sales", ["customer_rank"]),
        ("product_quality", ["rating_rank_desc", "rating_rank_asc"]),
    ):
        rows = registry.queries()[name](spark, MEDIUM).select(ranks).collect()
        for rank in ranks:
            assert sorted(row[rank] for row in rows) == list(range(1, len(rows) + 1))
