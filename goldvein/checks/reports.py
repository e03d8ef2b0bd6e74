"""The wide view and the dashboard's figures."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldvein.checks import standin as s
from goldvein.checks.commerce import fact, product_dim
from goldvein.checks.registry import checked
from goldvein.operators.dates import date_dimension_of
from goldvein.operators.measures import (
    TOTAL_GROSS,
    TOTAL_SALES,
    TOTAL_SALES_EUR,
    Dimension,
    Star,
)
from goldvein.plans import gold, reports
from goldvein.sources.lookups import rates_lookup

DAYS = ["Saturday", "Sunday"]
YEARS = [1997, 1998]
CATEGORY = "Economy"


def _products(spark: SparkSession, sf_dir: str) -> Dimension:
    dim, size = product_dim(spark, sf_dir)
    return reports.products_of(dim, size=size)


def _dates(spark: SparkSession, sf_dir: str) -> Dimension:
    return reports.dates_of(date_dimension_of(s.given(spark, sf_dir, "orders"), "o_orderdate"))


DIMENSIONS = {"products": _products, "dates": _dates}


def star(spark: SparkSession, sf_dir: str, *dimensions: str) -> Star:
    """The fact with the dimensions that a figure needs."""
    built = [DIMENSIONS[d](spark, sf_dir) for d in dimensions]
    lines = gold.fact_names(s.plain_items(spark, sf_dir))
    heads = s.head_columns("transaction_id")
    derived = {gold.FACT_NAMES.get(c, c): head for c, head in heads.items()}
    return reports.sales_star(
        lines,
        *built,
        rates=rates_lookup(spark, s.RATES),
        derived=derived | gold.amount_columns(day=derived["transaction_date"]),
    )


_WIDE = s.wide_sql()


def grouped_sql(
    by: str, aggregates: str = "CAST(sum(net_amount) AS BIGINT) AS total_sales", where: str = ""
) -> str:
    where = f"WHERE {where}" if where else ""
    return f"SELECT {by}, {aggregates} FROM ({_WIDE}) AS w {where} GROUP BY {by}"


_SALES = "CAST(sum(net_amount) AS BIGINT) AS total_sales"
_MONTHS = f"{_SALES}, CAST(sum(month) AS BIGINT) AS sum_month"


def report(name: str, sql: str, build: Callable[[Star], DataFrame], *parts: str) -> None:
    """Register a report on a star of the given fact and dimensions."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(star(spark, sf_dir, *parts))

    query.__doc__ = build.__doc__
    checked(sql, name)(query)


@checked(_WIDE)
def wide_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return s.without_zone(reports.wide_view(star(spark, sf_dir, "products", "dates")))


report("sales_trend", grouped_sql("month_name", _MONTHS), reports.sales_trend, "dates")
report(
    "sales_by_category",
    grouped_sql("category_name"),
    reports.sales_by_category,
    "products",
)
report(
    "sales_heatmap",
    grouped_sql("hour_of_day, day_name"),
    reports.sales_heatmap,
    "dates",
)
report("sales_by_channel", grouped_sql("channel"), reports.sales_by_channel)
report("weekend_sales", grouped_sql("is_weekend"), reports.weekend_sales, "dates")
report(
    "channel_by_category",
    grouped_sql("channel, category_name"),
    reports.channel_by_category,
    "products",
)


def _cube_sql(first: str) -> str:
    return f"""
SELECT {first}, month_name, CAST(grouping_id({first}, month_name) AS BIGINT) AS grouping_id,
  {_MONTHS}
FROM ({_WIDE}) AS w GROUP BY CUBE ({first}, month_name)"""


report("coupon_by_month", _cube_sql("coupon_flag"), reports.coupon_by_month, "dates")
report("channel_by_month", _cube_sql("channel"), reports.channel_by_month, "dates")
report(
    "total_sales",
    f"""SELECT {_SALES}, CAST(sum(gross_amount) AS BIGINT) AS total_gross
FROM ({s.amounts_sql(s.LINES_SQL)}) AS a""",
    reports.grand_total,
)
report(
    "total_sales_eur",
    f"""SELECT currency_known, CAST(sum(net_amount_eur) AS BIGINT) AS total_sales_eur
FROM (SELECT *, unit_price_currency <> 'XXX' AS currency_known FROM ({s.fact_sql()}) AS f) AS k
GROUP BY currency_known""",
    lambda star: star.aggregate(["unit_price_currency"], [TOTAL_SALES_EUR])
    .groupBy((F.col("unit_price_currency") != "XXX").alias("currency_known"))
    .agg(F.sum("total_sales_eur").alias("total_sales_eur")),
)
report(
    "filtered_sales",
    grouped_sql(
        "channel",
        f"{_SALES}, CAST(sum(gross_amount) AS BIGINT) AS total_gross",
        f"category_name = '{CATEGORY}' AND day_name IN ('Saturday', 'Sunday')"
        " AND year IN (1997, 1998)",
    ),
    lambda star: star.aggregate(
        ["channel"],
        [TOTAL_SALES, TOTAL_GROSS],
        {"category_name": CATEGORY, "day_name": DAYS, "year": YEARS, "month": None, "quarter": []},
    ),
    "products",
    "dates",
)

_FILTERS = {"category_name": CATEGORY, "day_name": DAYS, "year": YEARS}
_TESTS = {
    "category_name": f"category_name = '{CATEGORY}'",
    "day_name": "day_name IN ('Saturday', 'Sunday')",
    "year": "year IN (1997, 1998)",
}


def _filter_values(column: str) -> None:
    holds = " AND ".join(test for other, test in _TESTS.items() if other != column)
    sql = grouped_sql(
        column, f"CAST(count(*) FILTER (WHERE {holds}) AS BIGINT) AS {column}_associativity"
    )
    report(
        f"filter_values_{column.split('_')[0]}",
        sql,
        lambda star: star.filter_values(column, _FILTERS),
        "products",
        "dates",
    )


for _column in _FILTERS:
    _filter_values(_column)

report(
    "order_count",
    "SELECT count(DISTINCT l_orderkey) AS n_orders FROM lineitem",
    reports.order_count,
)
report(
    "quantity_by_product",
    f"""SELECT product_id, CAST(sum(quantity) AS BIGINT) AS total_quantity, count(*) AS n_lines
FROM ({s.LINES_SQL}) AS l GROUP BY product_id""",
    reports.quantity_by_product,
)
for _column, _name in (("category_name", "top_categories"), ("brand_name", "top_brands")):
    report(
        _name,
        f"{grouped_sql(_column)} ORDER BY total_sales DESC, {_column} LIMIT 5",
        lambda star, column=_column: reports.top_values(star, column, 5),
        "products",
    )
report(
    "filtered_top_brands",
    f"{grouped_sql('brand_name', where=' AND '.join(_TESTS.values()))} ORDER BY total_sales DESC, brand_name LIMIT 5",
    lambda star: reports.top_values(star, "brand_name", 5, filters=_FILTERS),
    "products",
    "dates",
)
report(
    "filtered_order_count",
    f"SELECT count(DISTINCT transaction_id) AS n_orders FROM ({_WIDE}) AS w WHERE {' AND '.join(_TESTS.values())}",
    lambda star: reports.order_count(star, _FILTERS),
    "products",
    "dates",
)
report(
    "average_basket",
    f"""SELECT {_SALES}, count(DISTINCT transaction_id) AS n_orders,
  CAST(sum(net_amount) AS DOUBLE) / count(DISTINCT transaction_id) AS average_basket
FROM ({s.fact_sql()}) AS f""",
    reports.average_basket,
)
report(
    "customer_recurrence",
    f"""SELECT n_orders, count(*) AS n_customers FROM (
  SELECT customer_id, count(DISTINCT transaction_id) AS n_orders
  FROM ({s.fact_sql()}) AS f GROUP BY customer_id) AS c GROUP BY n_orders""",
    reports.customer_recurrence,
)
report(
    "orders_per_customer",
    f"""SELECT customer_id, count(DISTINCT transaction_id) AS n_orders
FROM ({s.fact_sql()}) AS f GROUP BY customer_id""",
    reports.orders_per_customer,
)
for _period, _by, _parts in (
    ("day", "transaction_date", []),
    ("month", "year, month", ["dates"]),
    ("year", "year", ["dates"]),
):
    report(
        f"sales_by_{_period}",
        grouped_sql(_by, f"{_SALES}, count(*) AS n_lines"),
        lambda star, period=_period: reports.sales_by_period(star, period),
        *_parts,
    )


@checked("""
SELECT count(*) AS n_silver, count(*) AS n_gold
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.row_counts(s.order_items(spark, sf_dir), fact(spark, sf_dir))
