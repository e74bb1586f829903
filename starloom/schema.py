"""Column layouts of the flat sales rows and of the star tables built from them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# The columns of the flat sales table, in file order.
SALES_COLUMNS = (
    "id",
    "customer_first_name",
    "customer_last_name",
    "customer_age",
    "customer_email",
    "customer_country",
    "customer_postal_code",
    "customer_pet_type",
    "customer_pet_name",
    "customer_pet_breed",
    "seller_first_name",
    "seller_last_name",
    "seller_email",
    "seller_country",
    "seller_postal_code",
    "product_name",
    "product_category",
    "product_price",
    "product_quantity",
    "sale_date",
    "sale_customer_id",
    "sale_seller_id",
    "sale_product_id",
    "sale_quantity",
    "sale_total_price",
    "store_name",
    "store_location",
    "store_city",
    "store_state",
    "store_country",
    "store_phone",
    "store_email",
    "pet_category",
    "product_weight",
    "product_color",
    "product_size",
    "product_brand",
    "product_material",
    "product_description",
    "product_rating",
    "product_reviews",
    "product_release_date",
    "product_expiry_date",
    "supplier_name",
    "supplier_contact",
    "supplier_email",
    "supplier_phone",
    "supplier_address",
    "supplier_city",
    "supplier_country",
)

# The columns that are not text once the rows are typed.
SALES_TYPES = {
    "id": "long",
    "customer_age": "int",
    "product_price": "double",
    "product_quantity": "int",
    "sale_date": "date",
    "sale_customer_id": "long",
    "sale_seller_id": "long",
    "sale_product_id": "long",
    "sale_quantity": "int",
    "sale_total_price": "double",
    "product_weight": "double",
    "product_rating": "double",
    "product_reviews": "int",
    "product_release_date": "date",
    "product_expiry_date": "date",
}

# Fixed value: how dates are written in the flat rows.
DATE_PATTERN = "M/d/yyyy"

RAW_SALES = T.StructType([T.StructField(name, T.StringType()) for name in SALES_COLUMNS])


@dataclass(frozen=True)
class KeyedDimension:
    """A dimension whose key comes with the sale; one source row is kept per key."""

    key: str
    source_key: str
    attributes: tuple[str, ...]


@dataclass(frozen=True)
class NumberedDimension:
    """A dimension without a key of its own; its distinct rows are numbered from 1."""

    key: str
    columns: tuple[str, ...]


# The columns of each dimension, in table order.
SUPPLIER = NumberedDimension(
    key="supplier_id",
    columns=(
        "supplier_name",
        "supplier_contact",
        "supplier_email",
        "supplier_phone",
        "supplier_address",
        "supplier_city",
        "supplier_country",
    ),
)

STORE = NumberedDimension(
    key="store_id",
    columns=(
        "store_name",
        "store_location",
        "store_city",
        "store_state",
        "store_country",
        "store_phone",
        "store_email",
    ),
)

CUSTOMER = KeyedDimension(
    key="customer_id",
    source_key="sale_customer_id",
    attributes=(
        "customer_first_name",
        "customer_last_name",
        "customer_age",
        "customer_email",
        "customer_country",
        "customer_postal_code",
        "customer_pet_type",
        "customer_pet_name",
        "customer_pet_breed",
        "pet_category",
    ),
)

SELLER = KeyedDimension(
    key="seller_id",
    source_key="sale_seller_id",
    attributes=(
        "seller_first_name",
        "seller_last_name",
        "seller_email",
        "seller_country",
        "seller_postal_code",
    ),
)

PRODUCT = KeyedDimension(
    key="product_id",
    source_key="sale_product_id",
    attributes=(
        "product_name",
        "product_category",
        "product_price",
        "product_quantity",
        "product_weight",
        "product_color",
        "product_size",
        "product_brand",
        "product_material",
        "product_description",
        "product_rating",
        "product_reviews",
        "product_release_date",
        "product_expiry_date",
    ),
)

STAR_TABLES = (
    "dim_customer",
    "dim_seller",
    "dim_supplier",
    "dim_product",
    "dim_store",
    "dim_date",
    "fact_sales",
)
