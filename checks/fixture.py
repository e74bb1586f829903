"""Flat sales rows derived from the given tables.

One SQL expression per column, which Spark and DuckDB both take as it stands. The given
tables hold no nulls, so missing and malformed values are put in by remainders; every
null rule of the star and the marts is met by some rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators.lookup import BROADCAST_BYTES, measured_bytes

SOURCE_TABLES = ("lineitem", "orders", "customer", "part", "supplier", "nation")

EXPRESSIONS = {
    "id": "cast(l_orderkey as string)",
    "customer_first_name": "substr(c_name, 1, 8)",
    "customer_last_name": "substr(c_name, 10)",
    "customer_age": "case when c_custkey % 41 = 0 then '' else cast(18 + c_custkey % 60 as string) end",
    "customer_email": "'c' || cast(c_custkey as string) || '@example.com'",
    "customer_country": "case when c_custkey % 31 = 0 then null else cn.n_name end",
    "customer_postal_code": "cast(10000 + c_custkey as string)",
    "customer_pet_type": "case c_custkey % 3 when 0 then 'cat' when 1 then 'dog' else 'bird' end",
    "customer_pet_name": "'Pet_' || cast(c_custkey % 100 as string)",
    "customer_pet_breed": "'Breed_' || cast(c_custkey % 12 as string)",
    "seller_first_name": "'Seller'",
    "seller_last_name": "cast(l_suppkey as string)",
    "seller_email": "'s' || cast(l_suppkey as string) || '@example.com'",
    "seller_country": "sn.n_name",
    "seller_postal_code": "cast(20000 + l_suppkey as string)",
    "product_name": "p_name",
    "product_category": "case when p_partkey % 43 = 0 then null else p_type end",
    "product_price": "cast(cast(p_retailprice as decimal(18,2)) as string)",
    "product_quantity": "case when p_partkey % 29 = 0 then cast(p_size as string) || '.7' else cast(p_size as string) end",
    "sale_date": (
        "case when l_orderkey % 97 = 0 then null when l_orderkey % 101 = 0 then '13/45/2020' "
        "else cast(month(o_orderdate) as string) || '/' || cast(day(o_orderdate) as string) "
        "|| '/' || cast(year(o_orderdate) as string) end"
    ),
    "sale_customer_id": "case when l_orderkey % 503 = 0 then null else cast(o_custkey as string) end",
    "sale_seller_id": "cast(l_suppkey as string)",
    "sale_product_id": "cast(l_partkey as string)",
    "sale_quantity": (
        "case when l_linenumber = 7 then ' ' || cast(cast(l_quantity as int) as string) || ' ' "
        "else cast(cast(l_quantity as int) as string) end"
    ),
    "sale_total_price": "cast(cast(l_extendedprice as decimal(18,2)) as string)",
    "store_name": "'Store_' || cast(l_orderkey % 40 as string)",
    "store_location": "'Loc_' || cast(l_orderkey % 40 % 7 as string)",
    "store_city": "'CITY_' || cast(l_orderkey % 40 % 10 as string)",
    "store_state": "case when l_orderkey % 40 % 13 = 0 then null else 'ST_' || cast(l_orderkey % 40 % 6 as string) end",
    "store_country": "'NATION_' || cast(l_orderkey % 40 % 25 as string)",
    "store_phone": "'556-' || cast(l_orderkey % 40 as string)",
    "store_email": "'st' || cast(l_orderkey % 40 as string) || '@example.com'",
    "pet_category": "c_mktsegment",
    "product_weight": "cast(p_size as string) || '.5'",
    "product_color": "'Color_' || cast(p_partkey % 9 as string)",
    "product_size": "cast(p_size as string)",
    "product_brand": "p_brand",
    "product_material": "'Mat_' || cast(p_partkey % 6 as string)",
    "product_description": "p_name || ' ' || p_type",
    "product_rating": (
        "case when p_partkey % 37 = 0 then 'N/A' "
        "else cast(cast((10 + p_partkey % 41) * 0.1 as decimal(3,1)) as string) end"
    ),
    "product_reviews": "cast(p_partkey * 7 % 1000 as string)",
    "product_release_date": (
        "cast(1 + p_partkey % 12 as string) || '/' || cast(1 + p_partkey % 28 as string) "
        "|| '/' || cast(2010 + p_partkey % 10 as string)"
    ),
    "product_expiry_date": (
        "cast(1 + p_partkey % 12 as string) || '/' || cast(1 + p_partkey % 28 as string) "
        "|| '/' || cast(2022 + p_partkey % 5 as string)"
    ),
    "supplier_name": "s_name",
    "supplier_contact": "'Contact_' || cast(s_suppkey as string)",
    "supplier_email": "'sup' || cast(s_suppkey as string) || '@example.com'",
    "supplier_phone": "case when s_suppkey % 17 = 0 then null else '555-' || cast(s_suppkey as string) end",
    "supplier_address": "'Addr_' || cast(s_suppkey as string)",
    "supplier_city": "'CITY_' || cast(s_suppkey % 10 as string)",
    "supplier_country": "sn.n_name",
}

FLAT_SQL = (
    "SELECT "
    + ",\n       ".join(f"{expression} AS {name}" for name, expression in EXPRESSIONS.items())
    + """
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
              JOIN customer ON o_custkey = c_custkey
              JOIN nation cn ON c_nationkey = cn.n_nationkey
              JOIN part ON l_partkey = p_partkey
              JOIN supplier ON l_suppkey = s_suppkey
              JOIN nation sn ON s_nationkey = sn.n_nationkey"""
)


def flat_sales(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of `FLAT_SQL`, joined so that few and narrow columns are shuffled.

    Orders take their customer's columns while they are fewer than the lines; the lines meet
    these, then the parts, both by shuffle at any size, so that what is moved grows with the
    rows, and by hash, so that no line is sorted for it. The suppliers, the fewest, and the
    nations come last, by broadcast where the suppliers are measured to be small. A task's
    rows are then put in the order of their parts, before they are widened to text: a third
    of the columns are the part's, so rows that follow each other are alike and the files
    they are written to compress better.
    """

    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{folder}/{name}.parquet")

    def lines() -> DataFrame:
        """A small file is one split: its rows are spread by the key they are joined on."""
        rows = table("lineitem")
        cores = spark.sparkContext.defaultParallelism
        return rows.repartition(cores, "l_orderkey") if rows.rdd.getNumPartitions() < cores else rows

    def same(left: str, right: str):
        return F.col(left) == F.col(right)

    orders = table("orders").join(table("customer"), same("o_custkey", "c_custkey"))
    orders = orders.drop("o_custkey")
    suppliers = table("supplier")
    size = measured_bytes(suppliers.select("s_suppkey", "s_name", "s_nationkey"))
    small = size <= BROADCAST_BYTES
    rows = (
        lines()
        .join(orders.hint("shuffle_hash"), same("l_orderkey", "o_orderkey"))
        .join(table("part").hint("shuffle_hash"), same("l_partkey", "p_partkey"))
        .join(suppliers.hint("broadcast" if small else "shuffle_hash"), same("l_suppkey", "s_suppkey"))
        .join(table("nation").alias("cn"), same("c_nationkey", "cn.n_nationkey"))
        .join(table("nation").alias("sn"), same("s_nationkey", "sn.n_nationkey"))
        .sortWithinPartitions("l_partkey")
        # of two equal columns one was shuffled
        .withColumn("o_custkey", F.col("c_custkey"))
    )
    return rows.selectExpr(*[f"{expr} as {name}" for name, expr in EXPRESSIONS.items()])
