"""Dimensions, the order-line fact and the wide reporting view."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldvein.functions import amounts
from goldvein.functions.cleaning import leading_columns
from goldvein.operators.dates import DATE_COLUMNS
from goldvein.operators.sizes import broadcast_if, counted_small
from goldvein.sources.tables import Table

# Stand-ins for unmatched rows, and the columns of the published tables.
UNKNOWN = "Not Available"
OTHER_REGION = "Other"

PRODUCT_COLUMNS = (
    "product_id", "sku", "category_code", "category_name", "brand_code", "brand_name", "color",
    "size", "material", "weight_grams", "length_cm", "width_cm", "height_cm", "rating_count",
    "_source_file", "date_creation", "date_modification",
)
CUSTOMER_FIRST = (
    "customer_id", "phone", "country", "country_code", "state", "region", "date_creation",
    "date_modification",
)
FACT_COLUMNS = (
    "date_id", "customer_id", "product_id", "transaction_id", "transaction_date",
    "transaction_ts", "seq_no", "channel", "coupon_code", "coupon_flag", "unit_price_currency",
    "quantity", "unit_price", "gross_amount", "discount_percent", "discount_amount",
    "tax_amount", "net_amount", "net_amount_eur", "date_creation", "date_modification",
    "_source_file",
)
FACT_NAMES = {
    "order_id": "transaction_id",
    "dt": "transaction_date",
    "order_ts": "transaction_ts",
    "item_seq": "seq_no",
    "discount_pct": "discount_percent",
}
VIEW_PRODUCT_COLUMNS = (
    "category_code", "category_name", "brand_code", "brand_name", "color", "size", "material",
    "rating_count",
)
VIEW_DATE_COLUMNS = tuple(c for c in DATE_COLUMNS if c != "date_key")


def brand_categories(brands: DataFrame, categories: DataFrame) -> DataFrame:
    """Brands with the name of their category; brands of unknown categories drop out."""
    names = categories.select("category_code", "category_name")
    return brands.select("brand_code", "brand_name", "category_code").join(
        names, "category_code", "inner"
    )


def product_dimension(
    products: DataFrame, brands: DataFrame, categories: DataFrame, small: bool | None = None
) -> DataFrame:
    """Products with brand and category names.

    A brand may hold a large share of the products, so brands counted to be few
    are broadcast; otherwise Spark joins by shuffle and splits such a brand.
    """
    if small is None:
        small = counted_small(brands.select("brand_code", "brand_name"))
    named = brand_categories(brands, categories).select(
        "brand_code", "brand_name", "category_name"
    )
    joined = products.join(broadcast_if(named, small), "brand_code", "left")
    return joined.withColumns(
        {
            "category_name": F.coalesce("category_name", F.lit(UNKNOWN)),
            "brand_name": F.coalesce("brand_name", F.lit(UNKNOWN)),
        }
    ).select(*PRODUCT_COLUMNS)


def customer_dimension(customers: DataFrame, regions: DataFrame) -> DataFrame:
    """Customers with their region.  State codes repeat between countries."""
    joined = customers.join(regions, ["country", "state"], "left").fillna({"region": OTHER_REGION})
    return leading_columns(joined, CUSTOMER_FIRST)


def line_amounts(
    items: DataFrame, *, coupon_when_empty: int = 1, exact_discount: bool = False
) -> DataFrame:
    """Gross, discount and net amount, date key and coupon flag of each order line."""
    lines = items.withColumn("gross_amount", amounts.gross(F.col("quantity"), F.col("unit_price")))
    lines = lines.withColumn(
        "discount_amount",
        amounts.discount(F.col("gross_amount"), F.col("discount_pct"), exact_discount),
    )
    return lines.withColumns(
        {
            "net_amount": amounts.net(
                F.col("gross_amount"), F.col("discount_amount"), F.col("tax_amount")
            ),
            "date_id": amounts.date_key(F.col("dt")),
            "coupon_flag": amounts.coupon_flag(F.col("coupon_code"), coupon_when_empty),
        }
    )


def with_converted_amount(
    lines: DataFrame, rates: DataFrame, direction: str = "multiply"
) -> DataFrame:
    """Net amount by the rate of the line's currency; unknown currencies give null."""
    joined = lines.join(rates, "unit_price_currency", "left")
    amount = amounts.converted(F.col("net_amount"), F.col("rate_eur"), direction)
    return joined.withColumn("net_amount_eur", amount)


def fact_names(lines: DataFrame) -> DataFrame:
    """Order-line columns under the names the fact gives them."""
    return lines.withColumnsRenamed(FACT_NAMES)


def amount_columns(
    *, coupon_when_empty: int = 1, exact_discount: bool = False, day: Column | None = None
) -> dict[str, Column]:
    """What ``line_amounts`` adds, as expressions over the fact's other columns.

    ``day`` stands for the transaction date if that is an expression itself.
    """
    gross = amounts.gross(F.col("quantity"), F.col("unit_price"))
    discount = amounts.discount(gross, F.col("discount_percent"), exact_discount)
    return {
        "gross_amount": gross,
        "discount_amount": discount,
        "net_amount": amounts.net(gross, discount, F.col("tax_amount")),
        "date_id": amounts.date_key(F.col("transaction_date") if day is None else day),
        "coupon_flag": amounts.coupon_flag(F.col("coupon_code"), coupon_when_empty),
    }


def order_line_fact(
    items: DataFrame,
    rates: DataFrame | None,
    *,
    direction: str = "multiply",
    coupon_when_empty: int = 1,
    exact_discount: bool = False,
) -> DataFrame:
    """The fact; without ``rates`` it has no ``net_amount_eur``."""
    lines = fact_names(
        line_amounts(items, coupon_when_empty=coupon_when_empty, exact_discount=exact_discount)
    )
    if rates is None:
        return lines.select(*[c for c in FACT_COLUMNS if c != "net_amount_eur"])
    return with_converted_amount(lines, rates, direction).select(*FACT_COLUMNS)


def wide_view_sql(fact: Table, products: Table, dates: Table, fact_month: str, day_month: str) -> str:
    """The reporting view: every fact column, then product and date attributes.

    Days are joined by their month as well, the fact's partition column, so a filter
    on the calendar prunes the fact's partitions while the query runs.
    """
    columns = [f"fact.`{c}`" for c in FACT_COLUMNS]
    columns.append("hour(fact.transaction_ts) AS hour_of_day")
    columns += [f"product.`{c}`" for c in VIEW_PRODUCT_COLUMNS]
    columns += [f"day.`{c}`" for c in VIEW_DATE_COLUMNS]
    return (
        f"SELECT {', '.join(columns)} FROM {fact.sql_name} AS fact"
        f" LEFT JOIN {products.sql_name} AS product ON fact.product_id = product.product_id"
        f" LEFT JOIN {dates.sql_name} AS day ON fact.date_id = day.date_key"
        f" AND fact.`{fact_month}` = day.`{day_month}`"
    )
