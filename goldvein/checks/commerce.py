"""Order-line amounts, the fact and the dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldvein.checks import standin as s
from goldvein.checks.registry import checked
from goldvein.functions import amounts
from goldvein.operators.dates import date_dimension_of
from goldvein.operators.sizes import counted_size, is_small
from goldvein.plans import gold
from goldvein.sources.lookups import rates_lookup, region_lookup
from goldvein.sources.tables import register_views

LINE_KEY = ("order_id", "item_seq", "product_id")
LINE_KEY_SQL = ", ".join(LINE_KEY)


@checked(f"""
SELECT {LINE_KEY_SQL}, gross_amount, discount_amount, tax_amount, net_amount
FROM ({s.amounts_sql(s.LINES_SQL)}) AS a""")
def fact_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = s.lines(spark, sf_dir).withColumn("dt", F.lit(None).cast("date"))
    return gold.line_amounts(items).select(
        *LINE_KEY, "gross_amount", "discount_amount", "tax_amount", "net_amount"
    )


@checked(f"""
SELECT {LINE_KEY_SQL},
  CAST((gross * discount_pct + 99) // 100 AS BIGINT) AS discount_amount
FROM (SELECT *, CAST(quantity AS BIGINT) * unit_price AS gross FROM ({s.LINES_SQL}) AS l) AS g""")
def exact_discount(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = s.lines(spark, sf_dir).withColumn("dt", F.lit(None).cast("date"))
    return gold.line_amounts(items, exact_discount=True).select(*LINE_KEY, "discount_amount")


@checked("""
SELECT o_orderkey AS order_id, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_id
FROM orders""")
def date_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = s.given(spark, sf_dir, "orders")
    day = F.col("o_orderdate").cast("date")
    return orders.select(
        F.col("o_orderkey").alias("order_id"), amounts.date_key(day).alias("date_id")
    )


@checked(f"""
SELECT {LINE_KEY_SQL}, CASE WHEN coupon_code = '' THEN 1 ELSE 0 END AS coupon_flag,
  CASE WHEN coupon_code = '' THEN 0 ELSE 1 END AS has_coupon
FROM ({s.LINES_SQL}) AS l""")
def coupon_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.col("coupon_code")
    return s.lines(spark, sf_dir).select(
        *LINE_KEY,
        amounts.coupon_flag(code).alias("coupon_flag"),
        amounts.coupon_flag(code, when_empty=0).alias("has_coupon"),
    )


def fact(spark: SparkSession, sf_dir: str, direction: str = "multiply") -> DataFrame:
    rates = rates_lookup(spark, s.RATES)
    return gold.order_line_fact(s.order_items(spark, sf_dir), rates, direction=direction)


@checked(s.fact_sql())
def fact_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return s.without_zone(fact(spark, sf_dir))


def _fx_sql(operator: str) -> str:
    return f"""
SELECT transaction_id, seq_no, product_id, unit_price_currency, net_amount, net_amount_eur
FROM ({s.fact_sql(operator=operator)}) AS f"""


_FX_COLUMNS = (
    "transaction_id", "seq_no", "product_id", "unit_price_currency", "net_amount",
    "net_amount_eur",
)


@checked(_fx_sql("*"))
def fx_convert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact(spark, sf_dir).select(*_FX_COLUMNS)


@checked(_fx_sql("/"))
def fx_convert_divide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact(spark, sf_dir, direction="divide").select(*_FX_COLUMNS)


@checked(f"""
SELECT i.unit_price_currency, count(*) AS n_lines, count(rate_eur) AS n_with_rate
FROM ({s.ITEMS_SQL}) AS i LEFT JOIN (
  SELECT 'C' || CAST(n_nationkey AS VARCHAR) AS unit_price_currency,
    CAST(n_nationkey AS DOUBLE) AS rate_eur FROM nation
  UNION ALL SELECT 'EUR', 1.0 UNION ALL SELECT 'AED', 4.34
) AS r ON i.unit_price_currency = r.unit_price_currency
GROUP BY i.unit_price_currency""")
def fx_rates_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates that come as a table, with the overrides added."""
    quoted = s.given(spark, sf_dir, "nation").select(
        F.concat(F.lit("C"), F.col("n_nationkey").cast("string")).alias("unit_price_currency"),
        F.col("n_nationkey").cast("double").alias("rate_eur"),
    )
    items = s.order_items(spark, sf_dir)
    joined = items.join(rates_lookup(spark, quoted), "unit_price_currency", "left")
    return joined.groupBy("unit_price_currency").agg(
        F.count("*").alias("n_lines"), F.count("rate_eur").alias("n_with_rate")
    )


@checked(f"""
SELECT b.brand_code, b.brand_name, c.category_code, c.category_name
FROM ({s.BRANDS_SQL}) AS b JOIN ({s.CATEGORIES_SQL}) AS c ON b.category_code = c.category_code""")
def brand_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.brand_categories(s.brands(spark, sf_dir), s.categories(spark, sf_dir))


def product_dim(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, tuple[int, int]]:
    """The product dimension, and the size of what it is made from; it has no more brands than parts."""
    size = counted_size(s.given(spark, sf_dir, "part"))
    dim = gold.product_dimension(
        s.products(spark, sf_dir),
        s.brands(spark, sf_dir),
        s.categories(spark, sf_dir),
        is_small(size) or None,
    )
    return dim, size


@checked(s.PRODUCT_DIM_SQL)
def dim_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim, _ = product_dim(spark, sf_dir)
    return s.without_zone(dim)


@checked(f"""
SELECT c.category_name, count(*) AS n_brands
FROM ({s.BRANDS_SQL}) AS b JOIN ({s.CATEGORIES_SQL}) AS c ON b.category_code = c.category_code
GROUP BY c.category_name""")
def temp_view_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames named for SQL."""
    register_views(v_brands=s.brands(spark, sf_dir), v_category=s.categories(spark, sf_dir))
    return spark.sql(
        "SELECT c.category_name, count(*) AS n_brands FROM v_brands AS b"
        " JOIN v_category AS c ON b.category_code = c.category_code GROUP BY c.category_name"
    )


@checked(f"""
SELECT c.customer_id, c.phone, c.country, c.country_code, c.state,
  COALESCE(r.region, 'Other') AS region, c.date_creation, c.date_modification, c._source_file
FROM ({s.CUSTOMERS_SQL}) AS c LEFT JOIN ({s.REGIONS_SQL}) AS r
  ON c.country = r.country AND c.state = r.state""")
def dim_customers_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    regions = region_lookup(spark)
    return s.without_zone(gold.customer_dimension(s.customers(spark, sf_dir), regions))


@checked(s.DATE_DIM_SQL)
def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return date_dimension_of(s.given(spark, sf_dir, "orders"), "o_orderdate")


@checked("""
SELECT year, count(*) AS n_days, min(date_key) AS first_key, max(date_key) AS last_key FROM (
  SELECT CAST(year(d) AS INTEGER) AS year,
    CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS date_key
  FROM (SELECT unnest(range(DATE '0204-01-06', max(o_orderdate)::DATE + 1, INTERVAL 1 DAY)) AS d FROM orders))
GROUP BY year""")
def dim_date_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mistyped year makes a calendar of many centuries, not a failed run."""
    orders = s.given(spark, sf_dir, "orders").select("o_orderdate")
    stray = orders.agg(F.lit("0204-01-06").cast("date").alias("o_orderdate"), F.count("*").alias("n"))
    days = date_dimension_of(orders.withColumn("o_orderdate", F.col("o_orderdate").cast("date")).unionByName(stray.drop("n")), "o_orderdate")
    return days.groupBy("year").agg(
        F.count("*").alias("n_days"), F.min("date_key").alias("first_key"), F.max("date_key").alias("last_key")
    )


@checked("SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour_of_day FROM events")
def hour_of_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = s.given(spark, sf_dir, "events")
    return events.select("event_id", F.hour("ts").alias("hour_of_day"))
