"""The dashboard's figures as plain functions on a star."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldvein.operators.dates import weekday_position
from goldvein.operators.measures import (
    LINES,
    QUANTITY,
    SUM_MONTH,
    TOTAL_GROSS,
    TOTAL_SALES,
    Dimension,
    Measure,
    Star,
    dimension,
)
from goldvein.operators.quantiles import with_ntile
from goldvein.plans.gold import (
    FACT_COLUMNS,
    VIEW_DATE_COLUMNS,
    VIEW_PRODUCT_COLUMNS,
    with_converted_amount,
)
from goldvein.session import scratch_path

Filters = Mapping[str, object] | None


def _in_years(column: str, first: int, last: int, scale: int) -> Callable[[object], Column]:
    """A filter on years as ranges of a numeric day or month key of the fact."""

    def test(wanted) -> Column:
        years = wanted if isinstance(wanted, (list, tuple, set, frozenset)) else [wanted]
        spans = [F.col(column).between(y * scale + first, y * scale + last) for y in years]
        return reduce(lambda a, b: a | b, spans)

    return test


def products_of(
    products: DataFrame, small: bool | None = None, size: tuple[int, int] | None = None
) -> Dimension:
    return dimension(products, "product_id", "product_id", VIEW_PRODUCT_COLUMNS, small=small, size=size)


def dates_of(
    dates: DataFrame, month_column: str | None = None, small: bool | None = None
) -> Dimension:
    """The calendar, counted like any other dimension: a stray date may make it long.

    A filter on years also reaches the fact: as a range of its date key, by which
    the scan skips row groups, or of ``month_column`` if the fact is partitioned by
    that, so that other months are not even listed.
    """
    in_years = (
        _in_years(month_column, 1, 12, 100)
        if month_column
        else _in_years("date_id", 101, 1231, 10000)
    )
    return dimension(
        dates, "date_id", "date_key", VIEW_DATE_COLUMNS, small=small, implied={"year": in_years}
    )


def sales_star(
    fact: DataFrame,
    *dimensions: Dimension,
    rates: DataFrame | None = None,
    direction: str = "multiply",
    derived: Mapping[str, Column] | None = None,
) -> Star:
    """A star of a fact; if ``rates`` are given, the fact comes without converted amounts
    and meets them only for figures in that currency.  ``derived`` are columns that the
    fact does not hold but its rows can tell."""
    widened = rates is not None and {
        "net_amount_eur": lambda lines: with_converted_amount(lines, rates, direction)
    }
    derived = derived or {}
    own = {"hour_of_day": F.hour(derived.get("transaction_ts", F.col("transaction_ts"))), **derived}
    return Star(fact, dimensions, own, widened or None)


def wide_view(star: Star) -> DataFrame:
    return star.wide([*FACT_COLUMNS, "hour_of_day", *VIEW_PRODUCT_COLUMNS, *VIEW_DATE_COLUMNS])


def sales_trend(star: Star, measure: Measure = TOTAL_SALES, filters: Filters = None) -> DataFrame:
    """By month name, ordered by the sum of the month number."""
    return star.aggregate(["month_name"], [measure, SUM_MONTH], filters).orderBy("sum_month")


def sales_by_category(
    star: Star, measure: Measure = TOTAL_SALES, filters: Filters = None
) -> DataFrame:
    return star.aggregate(["category_name"], [measure], filters).orderBy(
        F.desc(measure.name), "category_name"
    )


def sales_heatmap(star: Star, measure: Measure = TOTAL_SALES, filters: Filters = None) -> DataFrame:
    """By hour and weekday, Monday first."""
    by_hour = star.aggregate(["hour_of_day", "day_name"], [measure], filters)
    return by_hour.orderBy(weekday_position(F.col("day_name")), "hour_of_day")


def coupon_by_month(
    star: Star, measure: Measure = TOTAL_SALES, filters: Filters = None
) -> DataFrame:
    cubed = star.cube(["coupon_flag", "month_name"], [measure, SUM_MONTH], filters)
    return cubed.orderBy("sum_month")


def sales_by_channel(
    star: Star, measure: Measure = TOTAL_SALES, filters: Filters = None
) -> DataFrame:
    return star.aggregate(["channel"], [measure], filters)


def channel_by_month(
    star: Star, measure: Measure = TOTAL_SALES, filters: Filters = None
) -> DataFrame:
    cubed = star.cube(["channel", "month_name"], [measure, SUM_MONTH], filters)
    return cubed.orderBy("sum_month")


def weekend_sales(star: Star, measure: Measure = TOTAL_SALES, filters: Filters = None) -> DataFrame:
    return star.aggregate(["is_weekend"], [measure], filters).orderBy(F.desc("is_weekend"))


def channel_by_category(
    star: Star, measure: Measure = TOTAL_SALES, filters: Filters = None
) -> DataFrame:
    by_pair = star.aggregate(["channel", "category_name"], [measure], filters)
    return by_pair.orderBy(F.desc(measure.name), "channel", "category_name")


#: the dashboard's figures and the columns each is by; a cube is all of its subsets
WIDGETS: dict[str, tuple[tuple[str, ...], ...]] = {
    "sales_trend": (("month_name",),),
    "sales_by_category": (("category_name",),),
    "sales_heatmap": (("hour_of_day", "day_name"),),
    "coupon_by_month": (("coupon_flag", "month_name"), ("coupon_flag",), ("month_name",), ()),
    "sales_by_channel": (("channel",),),
    "channel_by_month": (("channel", "month_name"), ("channel",), ("month_name",), ()),
    "weekend_sales": (("is_weekend",),),
    "channel_by_category": (("channel", "category_name"),),
    "grand_total": ((),),
}
WIDGET_SETS = tuple(dict.fromkeys(s for sets in WIDGETS.values() for s in sets))


def all_widgets(star: Star, measure: Measure = TOTAL_SALES, filters: Filters = None) -> DataFrame:
    """Every figure of the dashboard from one look at the fact; `widget` picks one of them.

    A dashboard that shows several writes this down, or caches it: its size depends on the
    values of the columns, not on the fact.
    """
    return star.grouping_sets(WIDGET_SETS, [measure, SUM_MONTH], filters)


def widget(figures: DataFrame, name: str, measure: Measure = TOTAL_SALES) -> DataFrame:
    """The rows of one figure: its columns, the measure, and the sum of months that sorts some."""
    sets = WIDGETS[name]
    numbers = [WIDGET_SETS.index(s) for s in sets]
    columns = list(dict.fromkeys(c for s in sets for c in s))
    return figures.where(F.col("set_number").isin(numbers)).select(*columns, measure.name, SUM_MONTH.name)


def customer_segments(star: Star, parts: int = 5, filters: Filters = None) -> DataFrame:
    """Customers in parts of equal size by recency, frequency and amount; part 1 is the best.

    Recency is the days between a customer's last order and the last order of all,
    frequency the number of orders, amount the sales.  Equal customers are told apart by id.
    """
    orders = star.wide(["customer_id", "transaction_id", "transaction_date", "net_amount"], filters)
    orders = orders.groupBy("customer_id", "transaction_id").agg(
        F.max("transaction_date").alias("day"), F.sum("net_amount").alias("amount")
    )
    per = orders.groupBy("customer_id").agg(
        F.max("day").alias("last_day"), F.count("*").alias("n_orders"), F.sum("amount").alias("total_sales")
    )
    path = scratch_path(per.sparkSession, "customers")
    per.write.parquet(path)
    per = per.sparkSession.read.schema(per.schema).parquet(path)
    last = per.agg(F.max("last_day")).first()[0]
    found = per.select(
        "customer_id",
        F.datediff(F.lit(last), "last_day").alias("recency_days"),
        "n_orders",
        "total_sales",
        (-F.col("n_orders")).alias("_rare"),
        (-F.col("total_sales")).alias("_cheap"),
    )
    for by, name in (("recency_days", "recency"), ("_rare", "frequency"), ("_cheap", "amount")):
        found = with_ntile(found, parts, [by, "customer_id"], name)
    return found.drop("_rare", "_cheap")


def grand_total(
    star: Star, measures: tuple[Measure, ...] = (TOTAL_SALES, TOTAL_GROSS), filters: Filters = None
) -> DataFrame:
    return star.aggregate([], measures, filters)


def order_count(star: Star, filters: Filters = None) -> DataFrame:
    return star.wide(["transaction_id"], filters).agg(
        F.count_distinct("transaction_id").alias("n_orders")
    )


def quantity_by_product(star: Star, filters: Filters = None) -> DataFrame:
    return star.aggregate(["product_id"], [QUANTITY, LINES], filters)


def top_values(
    star: Star, column: str, k: int, measure: Measure = TOTAL_SALES, filters: Filters = None
) -> DataFrame:
    """The k best values of a column; equal sales are ordered by name."""
    ranked = star.aggregate([column], [measure], filters).orderBy(F.desc(measure.name), column)
    return ranked.limit(k)


def average_basket(star: Star, filters: Filters = None) -> DataFrame:
    """Sales per order over all orders.

    Lines are summed per order first, so no distinct count over raw lines is needed.
    """
    orders = star.aggregate(["transaction_id"], [TOTAL_SALES], filters)
    return orders.agg(
        F.sum("total_sales").alias("total_sales"),
        F.count("transaction_id").alias("n_orders"),
    ).withColumn("average_basket", F.col("total_sales") / F.col("n_orders"))


def orders_per_customer(star: Star, filters: Filters = None) -> DataFrame:
    """Orders of each customer; pairs are made distinct before customers are counted."""
    pairs = star.wide(["customer_id", "transaction_id"], filters)
    return pairs.groupBy("customer_id").agg(
        F.count_distinct("transaction_id").alias("n_orders")
    )


def customer_recurrence(star: Star, filters: Filters = None) -> DataFrame:
    """How many customers placed how many orders."""
    return (
        orders_per_customer(star, filters)
        .groupBy("n_orders")
        .agg(F.count("*").alias("n_customers"))
        .orderBy("n_orders")
    )


def sales_by_period(star: Star, period: str, filters: Filters = None) -> DataFrame:
    """By ``day``, ``month`` or ``year``."""
    by = {
        "day": ["transaction_date"],
        "month": ["year", "month"],
        "year": ["year"],
    }[period]
    return star.aggregate(by, [TOTAL_SALES, LINES], filters).orderBy(*by)


def row_counts(silver: DataFrame, gold: DataFrame) -> DataFrame:
    """Rows of the cleaned order lines and of the fact, side by side."""
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    tagged = silver.select(one.alias("n_silver"), none.alias("n_gold")).unionByName(
        gold.select(none.alias("n_silver"), one.alias("n_gold"))
    )
    zero = F.lit(0).cast("bigint")
    return tagged.agg(
        *[F.coalesce(F.sum(c), zero).alias(c) for c in ("n_silver", "n_gold")]
    )


def reconcile(silver: DataFrame, gold: DataFrame) -> int:
    """Fail unless the fact has exactly one row per cleaned order line."""
    counts = row_counts(silver, gold).first()
    if counts.n_silver != counts.n_gold:
        raise ValueError(f"{counts.n_silver} cleaned order lines but {counts.n_gold} fact rows")
    return counts.n_gold
