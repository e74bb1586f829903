"""The six report marts over a star.

Each mart totals the fact by one key first and joins the dimension to the totals, so the
join sees one row per key instead of one per sale. The result is that of joining first,
because every dimension has one row per key.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.operators.correlation import correlation
from starloom.operators.distinct import count_distinct_numbers
from starloom.operators.lookup import look_up, measured_bytes
from starloom.operators.numbering import mirror_numbers, number_rows
from starloom.operators.rollup import add_group_total
from starloom.operators.topk import place_among, top_rows, top_rows_numbered
from starloom.operators.totals import Weighted, exact_totals
from starloom.plans.star import Star


@dataclass(frozen=True)
class Rank:
    """Row number by one column, nulls last; ties go by the mart's key."""

    output: str
    by: str
    descending: bool = True
    # a rank by the same column in the opposite order, from which this one is derived
    mirrors: str | None = None


@dataclass(frozen=True)
class Rollup:
    """Total per value of `by`, over the mart's own rows or over a star table.

    Either the sum of an amount, or the number of rows that have a value of `counted`.
    """

    by: str
    output: str
    amount: str | None = None
    counted: str | None = None
    table: str | None = None


@dataclass(frozen=True)
class Mart:
    table: str
    key: str
    base: Callable[[Star], DataFrame]
    columns: tuple[str, ...]
    ranks: tuple[Rank, ...] = ()
    rollups: tuple[Rollup, ...] = ()
    # a figure over all rows: a table of one row and the column named first
    overall: tuple[tuple[str, Callable[[DataFrame, str], DataFrame]], ...] = ()


def _sums_and_means(rows: DataFrame, by: list[str], amount: str, total: str, mean: str) -> DataFrame:
    present = f"cast({amount} is not null as bigint)"
    totals = exact_totals(rows, by, {total: amount}, {"present": present})
    share = F.try_divide(F.col(total), F.col("present").cast("double"))
    return totals.select(*by, total, share.alias(mean))


def _product_sales(star: Star) -> DataFrame:
    """A product's rating and reviews count once per sale: the mean of its rating over
    its sales is the rating, the sum of its reviews is reviews times sales."""
    products = star["dim_product"].select(
        "product_id", "product_name", "product_category", "product_rating", "product_reviews"
    )
    return star.product_totals.join(products, "product_id", "left").select(
        "product_category",
        "product_id",
        "product_name",
        "total_sales_qty",
        "total_revenue",
        F.col("product_rating").alias("avg_rating"),
        (F.col("product_reviews").cast("long") * F.col("sales")).alias("total_reviews"),
    )


def _customer_sales(star: Star) -> DataFrame:
    totals = _sums_and_means(
        star["fact_sales"], ["customer_id"], "sale_total_price", "total_spent", "avg_check"
    )
    customers = star["dim_customer"].select(
        "customer_id",
        "customer_first_name",
        "customer_last_name",
        "customer_email",
        "customer_country",
    )
    return totals.join(customers, "customer_id", "left")


def _store_sales(star: Star) -> DataFrame:
    totals = _sums_and_means(
        star["fact_sales"], ["store_id"], "sale_total_price", "total_revenue", "avg_check"
    )
    stores = star["dim_store"].select("store_id", "store_name", "store_city", "store_country")
    return totals.join(stores, "store_id", "left")


def _supplier_sales(star: Star) -> DataFrame:
    """Sales go to the supplier that the product dimension kept; the mean price weighs
    each product by its sales."""
    products = star["dim_product"].select("product_id", "supplier_id", "product_price")
    suppliers = star["dim_supplier"].select("supplier_id", "supplier_name", "supplier_country")
    totals = exact_totals(
        star.product_totals.join(products, "product_id", "left"),
        ["supplier_id"],
        {"total_revenue": "total_revenue", "price_of_sales": Weighted("product_price", "sales")},
        {"priced_sales": "case when product_price is not null then sales end"},
    ).select(
        "supplier_id",
        "total_revenue",
        F.try_divide("price_of_sales", F.col("priced_sales").cast("double")).alias(
            "avg_product_price"
        ),
    )
    return totals.join(suppliers, "supplier_id", "left")


def _product_quality(star: Star) -> DataFrame:
    products = star["dim_product"].select(
        "product_id", "product_name", "product_rating", "product_reviews"
    )
    return star.product_totals.join(products, "product_id", "left").select(
        "product_id",
        "product_name",
        "product_rating",
        "product_reviews",
        "total_sales_qty",
        "total_revenue",
    )


# Names and columns are fixed values: those of the published report tables.
PRODUCT_SALES = Mart(
    table="report_product_sales",
    key="product_id",
    base=_product_sales,
    columns=(
        "product_category",
        "product_id",
        "product_name",
        "total_sales_qty",
        "total_revenue",
        "avg_rating",
        "total_reviews",
        "category_revenue",
        "product_rank",
    ),
    ranks=(Rank("product_rank", by="total_sales_qty"),),
    rollups=(Rollup("product_category", "category_revenue", amount="total_revenue"),),
)

CUSTOMER_SALES = Mart(
    table="report_customer_sales",
    key="customer_id",
    base=_customer_sales,
    columns=(
        "customer_country",
        "customer_id",
        "customer_first_name",
        "customer_last_name",
        "customer_email",
        "total_spent",
        "avg_check",
        "country_customer_count",
        "customer_rank",
    ),
    ranks=(Rank("customer_rank", by="total_spent"),),
    rollups=(
        # the key is unique in the dimension, so counting it counts distinct customers
        Rollup(
            "customer_country",
            "country_customer_count",
            counted="customer_id",
            table="dim_customer",
        ),
    ),
)

STORE_SALES = Mart(
    table="report_store_sales",
    key="store_id",
    base=_store_sales,
    columns=(
        "store_country",
        "store_city",
        "store_id",
        "store_name",
        "total_revenue",
        "avg_check",
        "city_total_revenue",
        "country_total_revenue",
        "store_rank",
    ),
    ranks=(Rank("store_rank", by="total_revenue"),),
    rollups=(
        Rollup("store_city", "city_total_revenue", amount="total_revenue"),
        Rollup("store_country", "country_total_revenue", amount="total_revenue"),
    ),
)

SUPPLIER_SALES = Mart(
    table="report_supplier_sales",
    key="supplier_id",
    base=_supplier_sales,
    columns=(
        "supplier_country",
        "supplier_id",
        "supplier_name",
        "total_revenue",
        "avg_product_price",
        "country_total_revenue",
        "supplier_rank",
    ),
    ranks=(Rank("supplier_rank", by="total_revenue"),),
    rollups=(Rollup("supplier_country", "country_total_revenue", amount="total_revenue"),),
)

PRODUCT_QUALITY = Mart(
    table="report_quality",
    key="product_id",
    base=_product_quality,
    columns=(
        "product_id",
        "product_name",
        "product_rating",
        "product_reviews",
        "total_sales_qty",
        "total_revenue",
        "rating_rank_desc",
        "rating_rank_asc",
        "rating_sales_corr",
    ),
    ranks=(
        Rank("rating_rank_desc", by="product_rating"),
        Rank("rating_rank_asc", by="product_rating", descending=False, mirrors="rating_rank_desc"),
    ),
    overall=(
        (
            "rating_sales_corr",
            lambda rows, output: correlation(rows, "product_rating", "total_sales_qty", output),
        ),
    ),
)

RANKED_MARTS = (PRODUCT_SALES, CUSTOMER_SALES, STORE_SALES, SUPPLIER_SALES, PRODUCT_QUALITY)
TIME_REPORT = "report_time_sales"


def _order(mart: Mart, rank: Rank) -> list[Column]:
    by = F.col(rank.by)
    return [
        by.desc_nulls_last() if rank.descending else by.asc_nulls_last(),
        F.col(mart.key).asc_nulls_last(),
    ]


def _group_total(source: DataFrame, rollup: Rollup) -> DataFrame:
    if rollup.counted:
        return source.groupBy(rollup.by).agg(F.count(rollup.counted).alias(rollup.output))
    return exact_totals(source, [rollup.by], {rollup.output: rollup.amount})


def _with_totals(rows: DataFrame, mart: Mart, source: DataFrame, star: Star) -> DataFrame:
    """Rollups and overall figures of `source`, next to rows that may be part of it."""
    for rollup in mart.rollups:
        over = source if rollup.table is None else star[rollup.table]
        rows = add_group_total(rows, _group_total(over, rollup), rollup.by, star.workspace)
    for output, figure in mart.overall:
        # a table of one value is put into the plan as a scalar subquery
        rows = rows.withColumn(output, figure(source, output).scalar())
    return rows.select(*mart.columns)


def build(mart: Mart, star: Star) -> DataFrame:
    """All rows of the mart with their ranks and totals.

    Ranking writes the rows, so everything after it starts from the written ones.
    """
    rows = mart.base(star)
    for rank in mart.ranks:
        if rank.mirrors:
            rows = mirror_numbers(rows, rank.by, rank.mirrors, rank.output, star.workspace)
        else:
            rows = number_rows(rows, _order(mart, rank), rank.output, star.workspace)
    return _with_totals(rows, mart, rows, star)


def build_top(mart: Mart, star: Star, k: int, by: str | None = None) -> DataFrame:
    """The first k rows of a mart by one of its ranks, the others left unranked.

    The k rows get their places in the other ranks by counting the rows before them.
    """
    (rank,) = [r for r in mart.ranks if by in (None, r.output)]
    rows = star.workspace.save(mart.base(star), mart.table)
    head = top_rows_numbered(rows, _order(mart, rank), k, rank.output)
    for other in mart.ranks:
        if other is not rank:
            head = place_among(
                head, rows, other.by, mart.key, other.descending, other.output
            )
    return _with_totals(head, mart, rows, star)


def top_of(report: DataFrame, rank: str, k: int) -> DataFrame:
    """The first k rows of a finished report by one of its ranks."""
    return top_rows(report, [F.col(rank).asc()], k)


def most_reviewed(star: Star, k: int) -> DataFrame:
    order = [F.col("product_reviews").desc_nulls_last(), F.col("product_id").asc_nulls_last()]
    return top_rows(_product_quality(star), order, k)


def rollup_alone(mart: Mart, output: str, star: Star) -> DataFrame:
    """One rollup of a mart as a table of its own."""
    (rollup,) = [r for r in mart.rollups if r.output == output]
    source = mart.base(star) if rollup.table is None else star[rollup.table]
    return _group_total(source, rollup)


def overall_alone(mart: Mart, output: str, star: Star) -> DataFrame:
    """One figure over all rows of a mart; they are written, as it reads them several times."""
    (figure,) = [f for name, f in mart.overall if name == output]
    return figure(star.workspace.save(mart.base(star), mart.table), output)


def time_sales(star: Star) -> DataFrame:
    """Months with their sales and the total of their year, in order.

    The amounts are totalled by day before they meet the dates. Distinct sales are counted
    apart from them, in bitmaps where the ids lie close enough.
    Months are few, and years fewer: their totals are joined to the months, where the sales
    without a date form a year of their own.
    """
    days = star["dim_date"].select(F.col("date_id").alias("sale_date_id"), "year", "month")
    size = measured_bytes(days)
    fact = star["fact_sales"]
    present = "cast(sale_total_price is not null as bigint)"
    by_day = exact_totals(
        fact, ["sale_date_id"], {"day_revenue": "sale_total_price"}, {"day_present": present}
    )
    amounts = exact_totals(
        look_up(by_day, days, ["sale_date_id"], size=size),
        ["year", "month"],
        {"total_revenue": "day_revenue"},
        {"present": "day_present"},
    ).withColumn("avg_order_value", F.try_divide("total_revenue", F.col("present").cast("double")))
    dated = look_up(fact.select("sale_date_id", "sale_id"), days, ["sale_date_id"], size=size)
    orders = count_distinct_numbers(dated, ["year", "month"], "sale_id", "orders")
    same_month = F.col("a.year").eqNullSafe(F.col("o.year")) & F.col("a.month").eqNullSafe(
        F.col("o.month")
    )
    # the totals by day are shuffled once for both
    years = exact_totals(amounts, ["year"], {"year_total_revenue": "total_revenue"})
    same_year = F.col("a.year").eqNullSafe(F.col("y.year"))
    return (
        amounts.alias("a")
        .join(orders.alias("o"), same_month)
        .join(F.broadcast(years).alias("y"), same_year)
        .select("a.year", "a.month", "total_revenue", "orders", "avg_order_value", "year_total_revenue")
        .orderBy(F.col("year").asc_nulls_first(), F.col("month").asc_nulls_first())
    )


def period_changes(star: Star) -> DataFrame:
    """Months beside the month before and the same month of the year before, in order.

    The calendar decides what the month before is: a month without sales leaves the next one
    without a change, as does a missing revenue. Sales without a date have no period and no
    row here. `revenue_growth` is the change over the size of the earlier revenue, null where
    that is zero. The mart is written first: its rows are months, so the joins are small.
    """
    period = F.col("year") * 12 + F.col("month")
    sold = star.workspace.save(
        time_sales(star)
        .where(F.col("year").isNotNull())
        .select("year", "month", period.alias("period"), "total_revenue"),
        "months",
    )

    def earlier(months: int, output: str) -> DataFrame:
        return sold.select(
            (F.col("period") + months).alias("period"), F.col("total_revenue").alias(output)
        )

    before, year_before = F.col("previous_month_revenue"), F.col("previous_year_revenue")
    change = F.col("total_revenue") - before
    size = measured_bytes(sold)
    rows = look_up(sold, earlier(1, "previous_month_revenue"), ["period"], size=size)
    rows = look_up(rows, earlier(12, "previous_year_revenue"), ["period"], size=size)
    return rows.select(
        "year",
        "month",
        "total_revenue",
        before,
        F.round(change, 2).alias("revenue_change"),
        F.round(F.try_divide(change, F.abs(before)), 8).alias("revenue_growth"),
        year_before,
        F.round(F.col("total_revenue") - year_before, 2).alias("year_revenue_change"),
    ).orderBy("year", "month")


def all_reports(star: Star) -> dict[str, Callable[[], DataFrame]]:
    """Every report by its published name, built when asked for."""
    reports: dict[str, Callable[[], DataFrame]] = {
        mart.table: lambda mart=mart: build(mart, star) for mart in RANKED_MARTS
    }
    reports[TIME_REPORT] = lambda: time_sales(star)
    return reports
