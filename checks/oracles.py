"""The check queries, one SQL text per registered query.

They are written join-first and with plain windows, the direct reading of what a report
means, so that they share no plan with the jobs: those total first, rank over sorted
partitions and sum in whole numbers.
"""

from __future__ import annotations

from checks.fixture import FLAT_SQL
from starloom.schema import (
    CUSTOMER,
    DATE_PATTERN,
    PRODUCT,
    SALES_COLUMNS,
    SALES_TYPES,
    SELLER,
    STORE,
    SUPPLIER,
)

_DUCKDB_DATE = {"M/d/yyyy": "%m/%d/%Y"}[DATE_PATTERN]
_NUMBER = r"^\s*[+-]?[0-9]+([.][0-9]*)?\s*$"


def _typed_column(name: str) -> str:
    kind = SALES_TYPES.get(name)
    if kind in ("int", "long"):
        sql_type = {"int": "integer", "long": "bigint"}[kind]
        return (
            f"case when regexp_matches({name}, '{_NUMBER}') "
            f"then cast(trunc(try_cast({name} as double)) as {sql_type}) end as {name}"
        )
    if kind == "double":
        return f"try_cast({name} as double) as {name}"
    if kind == "date":
        return f"cast(try_strptime({name}, '{_DUCKDB_DATE}') as date) as {name}"
    return name


def _listed(columns, prefix: str = "") -> str:
    return ", ".join(f"{prefix}{name}" for name in columns)


def _ordered(columns) -> str:
    return ", ".join(f"{name} nulls last" for name in columns)


def _equal(columns, left: str, right: str) -> str:
    return " and ".join(f"{left}.{name} = {right}.{name}" for name in columns)


def _kept(source_key: str, key: str, attributes) -> str:
    return (
        f"select {source_key} as {key}, {_listed(attributes)} from ("
        f"select {source_key}, {_listed(attributes)}, row_number() over ("
        f"partition by {source_key} order by {_ordered(('id', *attributes))}) as pick "
        "from clean_sales) where pick = 1"
    )


def _numbered(columns, key: str) -> str:
    return (
        f"select {_listed(columns)}, cast(row_number() over (order by {_ordered(columns)}) "
        f"as integer) as {key} from (select distinct {_listed(columns)} from clean_sales)"
    )


def _sum(amount: str) -> str:
    return f"cast(sum(cast({amount} as decimal(18,2))) as double)"


def _mean(amount: str) -> str:
    return f"{_sum(amount)} / count({amount})"


def _rank(by: str, key: str, direction: str = "desc") -> str:
    return (
        f"cast(row_number() over (order by {by} {direction} nulls last, "
        f"{key} nulls last) as integer)"
    )


# Each entry may use the ones above it by name.
_TABLES = {
    "flat_sales": FLAT_SQL,
    "clean_sales": "select "
    + ", ".join(_typed_column(name) for name in SALES_COLUMNS)
    + " from flat_sales",
    "dim_customer": _kept(CUSTOMER.source_key, CUSTOMER.key, CUSTOMER.attributes),
    "dim_seller": _kept(SELLER.source_key, SELLER.key, SELLER.attributes),
    "dim_supplier": _numbered(SUPPLIER.columns, SUPPLIER.key),
    "kept_product": _kept(
        PRODUCT.source_key, PRODUCT.key, PRODUCT.attributes + SUPPLIER.columns
    ),
    "dim_product": (
        f"select {_listed((PRODUCT.key, *PRODUCT.attributes), 'p.')}, s.supplier_id "
        f"from kept_product p left join dim_supplier s on {_equal(SUPPLIER.columns, 'p', 's')}"
    ),
    "dim_store": _numbered(STORE.columns, STORE.key),
    "dim_date": (
        "select sale_date, cast(strftime(sale_date, '%Y%m%d') as integer) as date_id, "
        "cast(year(sale_date) as integer) as year, cast(month(sale_date) as integer) as month, "
        "cast(day(sale_date) as integer) as day, cast(quarter(sale_date) as integer) as quarter "
        "from (select distinct sale_date from clean_sales where sale_date is not null)"
    ),
    "fact_sales": (
        "select c.id as sale_id, d.date_id as sale_date_id, c.sale_customer_id as customer_id, "
        "c.sale_seller_id as seller_id, c.sale_product_id as product_id, s.store_id, "
        "c.sale_quantity, c.sale_total_price from clean_sales c "
        f"left join dim_store s on {_equal(STORE.columns, 'c', 's')} "
        "left join dim_date d on c.sale_date = d.sale_date"
    ),
    "product_base": (
        "select f.product_id, product_name, product_category, "
        "cast(sum(sale_quantity) as bigint) as total_sales_qty, "
        f"{_sum('sale_total_price')} as total_revenue, "
        "round(avg(product_rating), 6) as avg_rating, "
        "cast(sum(product_reviews) as bigint) as total_reviews "
        "from fact_sales f left join dim_product p on f.product_id = p.product_id "
        "group by f.product_id, product_name, product_category"
    ),
    "category_revenue": (
        f"select product_category, {_sum('total_revenue')} as category_revenue "
        "from product_base group by product_category"
    ),
    "product_sales": (
        "select b.*, r.category_revenue, "
        f"{_rank('b.total_sales_qty', 'b.product_id')} as product_rank from product_base b "
        "left join category_revenue r on b.product_category = r.product_category"
    ),
    "customer_base": (
        "select f.customer_id, customer_first_name, customer_last_name, customer_email, "
        f"customer_country, {_sum('sale_total_price')} as total_spent, "
        f"{_mean('sale_total_price')} as avg_check "
        "from fact_sales f left join dim_customer d on f.customer_id = d.customer_id "
        "group by f.customer_id, customer_first_name, customer_last_name, customer_email, "
        "customer_country"
    ),
    "customers_by_country": (
        "select customer_country, count(distinct customer_id) as country_customer_count "
        "from dim_customer group by customer_country"
    ),
    "customer_sales": (
        "select b.*, r.country_customer_count, "
        f"{_rank('b.total_spent', 'b.customer_id')} as customer_rank from customer_base b "
        "left join customers_by_country r on b.customer_country = r.customer_country"
    ),
    "month_base": (
        f"select year, month, {_sum('sale_total_price')} as total_revenue, "
        f"count(distinct sale_id) as orders, {_mean('sale_total_price')} as avg_order_value "
        "from fact_sales f left join dim_date d on f.sale_date_id = d.date_id "
        "group by year, month"
    ),
    "time_sales": (
        "select *, cast(sum(cast(total_revenue as decimal(18,2))) over (partition by year) "
        "as double) as year_total_revenue from month_base"
    ),
    "period_changes": (
        "select m.year, m.month, m.total_revenue, p.total_revenue as previous_month_revenue, "
        "round(m.total_revenue - p.total_revenue, 2) as revenue_change, "
        "round(case when p.total_revenue <> 0 then (m.total_revenue - p.total_revenue) "
        "/ abs(p.total_revenue) end, 8) as revenue_growth, "
        "y.total_revenue as previous_year_revenue, "
        "round(m.total_revenue - y.total_revenue, 2) as year_revenue_change "
        "from month_base m left join month_base p "
        "on p.year * 12 + p.month = m.year * 12 + m.month - 1 "
        "left join month_base y on y.year = m.year - 1 and y.month = m.month "
        "where m.year is not null"
    ),
    "store_base": (
        "select f.store_id, store_name, store_city, store_country, "
        f"{_sum('sale_total_price')} as total_revenue, {_mean('sale_total_price')} as avg_check "
        "from fact_sales f left join dim_store s on f.store_id = s.store_id "
        "group by f.store_id, store_name, store_city, store_country"
    ),
    "city_sales": (
        f"select store_city, {_sum('total_revenue')} as city_total_revenue "
        "from store_base group by store_city"
    ),
    "store_country_sales": (
        f"select store_country, {_sum('total_revenue')} as country_total_revenue "
        "from store_base group by store_country"
    ),
    "store_sales": (
        "select b.*, c.city_total_revenue, n.country_total_revenue, "
        f"{_rank('b.total_revenue', 'b.store_id')} as store_rank from store_base b "
        "left join city_sales c on b.store_city = c.store_city "
        "left join store_country_sales n on b.store_country = n.store_country"
    ),
    "supplier_base": (
        "select p.supplier_id, supplier_name, supplier_country, "
        f"{_sum('sale_total_price')} as total_revenue, "
        f"{_mean('product_price')} as avg_product_price "
        "from fact_sales f left join dim_product p on f.product_id = p.product_id "
        "left join dim_supplier s on p.supplier_id = s.supplier_id "
        "group by p.supplier_id, supplier_name, supplier_country"
    ),
    "supplier_country_sales": (
        f"select supplier_country, {_sum('total_revenue')} as country_total_revenue "
        "from supplier_base group by supplier_country"
    ),
    "supplier_sales": (
        "select b.*, n.country_total_revenue, "
        f"{_rank('b.total_revenue', 'b.supplier_id')} as supplier_rank from supplier_base b "
        "left join supplier_country_sales n on b.supplier_country = n.supplier_country"
    ),
    "quality_base": (
        "select f.product_id, product_name, product_rating, product_reviews, "
        "cast(sum(sale_quantity) as bigint) as total_sales_qty, "
        f"{_sum('sale_total_price')} as total_revenue "
        "from fact_sales f left join dim_product p on f.product_id = p.product_id "
        "group by f.product_id, product_name, product_rating, product_reviews"
    ),
    "rating_correlation": (
        "select round(corr(product_rating, total_sales_qty), 8) as rating_sales_corr "
        "from quality_base"
    ),
    "product_quality": (
        f"select b.*, {_rank('product_rating', 'product_id')} as rating_rank_desc, "
        f"{_rank('product_rating', 'product_id', 'asc')} as rating_rank_asc, "
        "rating_sales_corr from quality_base b cross join rating_correlation"
    ),
}

_TEXT_COLUMNS = {
    "product_sales": ("product_category", "product_name"),
    "customer_sales": (
        "customer_country",
        "customer_first_name",
        "customer_last_name",
        "customer_email",
    ),
    "time_sales": (),
    "store_sales": ("store_country", "store_city", "store_name"),
    "supplier_sales": ("supplier_country", "supplier_name"),
    "product_quality": ("product_name",),
}

_NUMBER_COLUMNS = {
    "product_sales": (
        "product_id",
        "total_sales_qty",
        "total_revenue",
        "avg_rating",
        "total_reviews",
        "category_revenue",
        "product_rank",
    ),
    "customer_sales": (
        "customer_id",
        "total_spent",
        "avg_check",
        "country_customer_count",
        "customer_rank",
    ),
    "time_sales": (
        "year",
        "month",
        "total_revenue",
        "orders",
        "avg_order_value",
        "year_total_revenue",
    ),
    "store_sales": (
        "store_id",
        "total_revenue",
        "avg_check",
        "city_total_revenue",
        "country_total_revenue",
        "store_rank",
    ),
    "supplier_sales": (
        "supplier_id",
        "total_revenue",
        "avg_product_price",
        "country_total_revenue",
        "supplier_rank",
    ),
    "product_quality": (
        "product_id",
        "product_rating",
        "product_reviews",
        "total_sales_qty",
        "total_revenue",
        "rating_rank_desc",
        "rating_rank_asc",
        "rating_sales_corr",
    ),
}


def _filled(report: str) -> str:
    text = [f"coalesce({name}, '') as {name}" for name in _TEXT_COLUMNS[report]]
    numbers = [f"coalesce({name}, 0) as {name}" for name in _NUMBER_COLUMNS[report]]
    return f"select {', '.join(text + numbers)} from {report}"


def _first(report: str, order: str, k: int) -> str:
    return f"select * from {report} order by {order} limit {k}"


_QUERIES = {
    **{
        name: f"select * from {name}"
        for name in (
            "clean_sales",
            "dim_customer",
            "dim_seller",
            "dim_supplier",
            "dim_product",
            "dim_store",
            "dim_date",
            "fact_sales",
            "product_sales",
            "category_revenue",
            "customer_sales",
            "customers_by_country",
            "time_sales",
            "period_changes",
            "store_sales",
            "city_sales",
            "store_country_sales",
            "supplier_sales",
            "supplier_country_sales",
            "product_quality",
            "rating_correlation",
        )
    },
    "top_products": _first("product_sales", "product_rank", 10),
    "top_customers": _first("customer_sales", "customer_rank", 10),
    "top_stores": _first("store_sales", "store_rank", 5),
    "top_suppliers": _first("supplier_sales", "supplier_rank", 5),
    "best_rated": _first("product_quality", "rating_rank_desc", 10),
    "worst_rated": _first("product_quality", "rating_rank_asc", 10),
    "most_reviewed": _first(
        "quality_base", "product_reviews desc nulls last, product_id nulls last", 10
    ),
    **{f"{report}_filled": _filled(report) for report in _TEXT_COLUMNS},
    "csv_round_trip": "select * from flat_sales",
    "split_csv_round_trip": (
        f"select {_listed(name for name in SALES_COLUMNS if name != 'product_description')}, "
        "product_description || chr(10) || '\"' || product_name || '\"' as product_description "
        "from flat_sales"
    ),
    "json_round_trip": "select * from product_sales",
    "first_documents": _first("product_sales", "product_rank", 5),
    "parquet_round_trip": "select * from fact_sales",
    "published_star": "select * from fact_sales",
}


def oracle(name: str) -> str:
    tables = ",\n".join(f"{table} as ({sql})" for table, sql in _TABLES.items())
    return f"with {tables}\n{_QUERIES[name]}"


def oracles() -> dict[str, str]:
    return {name: oracle(name) for name in _QUERIES}
