"""The given tables dressed as the commerce feeds.

Order lines come from ``lineitem`` and ``orders``, products, brands and
categories from ``part``, customers from ``customer``.  Each mapping exists
twice: as a DataFrame, and as SQL for the other side of a check.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql import functions as F

from goldvein.operators.sizes import counted_size, hash_if
from goldvein.sources.lookups import region_rows

# Fixed values of the stand-in.
CURRENCIES = ("EUR", "USD", "INR", "AED", "XXX")
RATES = {"USD": 1.0875, "INR": 90.5, "GBP": 0.8523}
LOADED = "2024-01-01 06:00:00"
UNKNOWN_PLACES = (("India", "ZZ"), ("Canada", "MH"), ("Atlantis", "SK"))
SECONDS_STEP = 7919


@cache
def _schema(path: str) -> T.StructType:
    """Read from a file footer once, not by a job for every use of the table."""
    return SparkSession.active().read.parquet(path).schema


def given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    return spark.read.schema(_schema(path)).parquet(path)


def _audit(df: DataFrame, source: str) -> DataFrame:
    return df.withColumns(
        {
            "_source_file": F.lit(source),
            "date_creation": F.lit(LOADED).cast("timestamp"),
            "date_modification": F.lit(LOADED).cast("timestamp"),
        }
    )


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part of an order line that ``lineitem`` alone can tell.

    Small numbers stand side by side, and no text between them: so rows take less room in a shuffle.
    """
    price, quantity = F.col("l_extendedprice"), F.col("l_quantity")
    coupon = F.when(F.col("l_returnflag") == "N", F.lit("")).otherwise(F.col("l_returnflag"))
    return given(spark, sf_dir, "lineitem").select(
        coupon.alias("coupon_code"),
        F.col("l_linenumber").alias("item_seq"),
        F.round(F.col("l_discount") * 100).cast("int").alias("discount_pct"),
        quantity.cast("int").alias("quantity"),
        F.floor(price * F.col("l_tax")).cast("int").alias("tax_amount"),
        F.floor(price / quantity).cast("int").alias("unit_price"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_orderkey").alias("order_id"),
    )


def head_columns(order_id: str = "order_id") -> dict[str, Column]:
    """What the head of an order tells, as expressions over the columns of ``_plain_heads``."""
    currency = F.element_at(
        F.array(*[F.lit(c) for c in CURRENCIES]),
        (F.col("o_custkey") % len(CURRENCIES) + 1).cast("int"),
    )
    second = (F.col(order_id) * SECONDS_STEP % 86400).cast("int")
    return {
        "dt": F.col("o_orderdate").cast("date"),
        "order_ts": F.timestamp_add("SECOND", second, F.col("o_orderdate")).cast("timestamp"),
        "customer_id": F.col("o_custkey").cast("string"),
        "unit_price_currency": currency,
    }


def _plain_heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return given(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        "o_orderdate",
        "o_custkey",
        F.col("o_orderpriority").alias("channel"),
    )


def order_heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    heads = _plain_heads(spark, sf_dir).withColumns(head_columns())
    return heads.select("order_id", *head_columns(), "channel")


ITEM_COLUMNS = (
    "dt", "order_ts", "customer_id", "order_id", "item_seq", "product_id", "quantity",
    "unit_price_currency", "unit_price", "discount_pct", "tax_amount", "channel", "coupon_code",
)

PLAIN_COLUMNS = (
    "item_seq", "quantity", "discount_pct", "unit_price", "tax_amount", "product_id", "o_custkey",
    "order_id", "o_orderdate", "channel", "coupon_code",
)


def plain_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with the plain columns of their heads, which take less room in a shuffle
    than what ``head_columns`` makes of them; in an order like that of ``lines``."""
    heads = _plain_heads(spark, sf_dir)
    heads = hash_if(heads, counted_size(heads), key="order_id")
    joined = lines(spark, sf_dir).join(heads, "order_id")
    return _audit(joined.select(*PLAIN_COLUMNS), "lineitem.parquet")


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    dressed = plain_items(spark, sf_dir).withColumns(head_columns())
    return dressed.select(*ITEM_COLUMNS, "_source_file", "date_creation", "date_modification")


def brand_code(name) -> F.Column:
    return F.upper(F.translate(name, "#", ""))


def brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A brand belongs to the category most of its parts are of."""
    per_type = given(spark, sf_dir, "part").groupBy("p_brand", "p_type").agg(
        F.count("*").alias("n")
    )
    main = per_type.groupBy("p_brand").agg(F.max(F.struct("n", "p_type")).alias("top"))
    return main.select(
        brand_code(F.col("p_brand")).alias("brand_code"),
        F.translate("p_brand", "#", "").alias("brand_name"),
        F.upper("top.p_type").alias("category_code"),
    )


def categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    types = given(spark, sf_dir, "part").select("p_type").distinct()
    return types.select(
        F.upper("p_type").alias("category_code"), F.initcap("p_type").alias("category_name")
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as products; the largest ones carry a brand no brand table knows."""
    words = F.split("p_name", " ")
    brand = F.when(F.col("p_size") > 45, F.lit("NOBRAND")).otherwise(brand_code(F.col("p_brand")))
    mapped = given(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.concat(F.lit("SKU-"), F.col("p_partkey").cast("string")).alias("sku"),
        F.upper("p_type").alias("category_code"),
        brand.alias("brand_code"),
        words[0].alias("color"),
        F.col("p_size").cast("string").alias("size"),
        words[1].alias("material"),
        (F.col("p_size") * 10).alias("weight_grams"),
        (F.col("p_size") / 2).alias("length_cm"),
        (F.col("p_size") / 4).alias("width_cm"),
        (F.col("p_size") / 8).alias("height_cm"),
        (F.col("p_partkey") % 1000).cast("int").alias("rating_count"),
    )
    return _audit(mapped, "part.parquet")


def places() -> list[tuple[str, str]]:
    return [(country, state) for country, state, _ in region_rows()] + list(UNKNOWN_PLACES)


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers spread over all known places and a few unknown ones."""
    pairs = F.array(*[F.struct(F.lit(c).alias("country"), F.lit(s).alias("state"))
                      for c, s in places()])
    place = F.element_at(pairs, (F.col("c_custkey") % len(places()) + 1).cast("int"))
    mapped = given(spark, sf_dir, "customer").withColumn("place", place).select(
        F.col("c_custkey").cast("string").alias("customer_id"),
        (F.lit(9000000000) + F.col("c_custkey")).cast("string").alias("phone"),
        F.upper(F.substring("place.country", 1, 2)).alias("country_code"),
        F.col("place.country").alias("country"),
        F.col("place.state").alias("state"),
    )
    return _audit(mapped, "customer.parquet")


# --- the same feeds as raw text, with the faults the cleaning is for ---------


def raw_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    quantity = F.col("quantity").cast("string")
    return order_items(spark, sf_dir).select(
        F.date_format("dt", "yyyy-MM-dd").alias("dt"),
        F.date_format("order_ts", "yyyy-MM-dd HH:mm:ss").alias("order_ts"),
        "customer_id",
        F.col("order_id").cast("string").alias("order_id"),
        F.col("item_seq").cast("string").alias("item_seq"),
        F.col("product_id").cast("string").alias("product_id"),
        F.when(F.col("quantity") == 2, F.lit("Two")).otherwise(quantity).alias("quantity"),
        "unit_price_currency",
        F.concat(F.lit("$"), F.col("unit_price").cast("string")).alias("unit_price"),
        F.concat(F.col("discount_pct").cast("string"), F.lit("%")).alias("discount_pct"),
        F.col("tax_amount").cast("string").alias("tax_amount"),
        "channel",
        F.nullif(F.col("coupon_code"), F.lit("")).alias("coupon_code"),
    )


def _comma(column: str) -> F.Column:
    return F.translate(F.col(column).cast("string"), ".", ",").alias(column)


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return products(spark, sf_dir).select(
        "product_id",
        "sku",
        F.lower("category_code").alias("category_code"),
        F.lower("brand_code").alias("brand_code"),
        "color",
        "size",
        "material",
        F.concat(F.col("weight_grams").cast("string"), F.lit("g")).alias("weight_grams"),
        _comma("length_cm"),
        _comma("width_cm"),
        _comma("height_cm"),
        "rating_count",
    )


def raw_brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brands(spark, sf_dir).select(
        F.concat(F.lit("#"), F.col("brand_code"), F.lit("*")).alias("brand_code"),
        F.concat(F.lit(" "), F.col("brand_name"), F.lit("! ")).alias("brand_name"),
        F.lower("category_code").alias("category_code"),
    )


def raw_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return categories(spark, sf_dir).select(
        F.lower("category_code").alias("category_code"), "category_name"
    )


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customers(spark, sf_dir).select(
        "customer_id",
        F.concat("phone", F.lit(".0")).alias("phone"),
        "country_code",
        "country",
        "state",
    )


# --- SQL -----------------------------------------------------------------------

_CURRENCY_SQL = " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(CURRENCIES))

LINES_SQL = """
SELECT l_orderkey AS order_id, l_linenumber AS item_seq, l_partkey AS product_id,
  CAST(l_quantity AS INTEGER) AS quantity,
  CAST(floor(l_extendedprice / l_quantity) AS INTEGER) AS unit_price,
  CAST(round(l_discount * 100) AS INTEGER) AS discount_pct,
  CAST(floor(l_extendedprice * l_tax) AS INTEGER) AS tax_amount,
  CASE WHEN l_returnflag = 'N' THEN '' ELSE l_returnflag END AS coupon_code
FROM lineitem"""

ITEMS_SQL = f"""
SELECT CAST(o_orderdate AS DATE) AS dt,
  o_orderdate + to_seconds((o_orderkey * {SECONDS_STEP}) % 86400) AS order_ts,
  CAST(o_custkey AS VARCHAR) AS customer_id, order_id, item_seq, product_id, quantity,
  CASE o_custkey % {len(CURRENCIES)} {_CURRENCY_SQL} END AS unit_price_currency,
  unit_price, discount_pct, tax_amount, o_orderpriority AS channel, coupon_code,
  'lineitem.parquet' AS _source_file,
  TIMESTAMP '{LOADED}' AS date_creation, TIMESTAMP '{LOADED}' AS date_modification
FROM ({LINES_SQL}) AS li JOIN orders ON order_id = o_orderkey"""

BRANDS_SQL = """
SELECT upper(replace(p_brand, '#', '')) AS brand_code, replace(p_brand, '#', '') AS brand_name,
  upper(p_type) AS category_code
FROM (SELECT p_brand, p_type,
        row_number() OVER (PARTITION BY p_brand ORDER BY count(*) DESC, p_type DESC) AS rn
      FROM part GROUP BY p_brand, p_type) AS ranked
WHERE rn = 1"""

CATEGORIES_SQL = """
SELECT DISTINCT upper(p_type) AS category_code,
  upper(substr(p_type, 1, 1)) || lower(substr(p_type, 2)) AS category_name
FROM part"""

PRODUCTS_SQL = f"""
SELECT p_partkey AS product_id, 'SKU-' || CAST(p_partkey AS VARCHAR) AS sku,
  upper(p_type) AS category_code,
  CASE WHEN p_size > 45 THEN 'NOBRAND' ELSE upper(replace(p_brand, '#', '')) END AS brand_code,
  split_part(p_name, ' ', 1) AS color, CAST(p_size AS VARCHAR) AS size,
  split_part(p_name, ' ', 2) AS material, p_size * 10 AS weight_grams,
  CAST(p_size AS DOUBLE) / 2 AS length_cm, CAST(p_size AS DOUBLE) / 4 AS width_cm,
  CAST(p_size AS DOUBLE) / 8 AS height_cm, CAST(p_partkey % 1000 AS INTEGER) AS rating_count,
  'part.parquet' AS _source_file,
  TIMESTAMP '{LOADED}' AS date_creation, TIMESTAMP '{LOADED}' AS date_modification
FROM part"""

_PLACES_SQL = ", ".join(f"({i}, '{c}', '{s}')" for i, (c, s) in enumerate(places()))
REGIONS_SQL = "SELECT * FROM (VALUES {}) AS r(country, state, region)".format(
    ", ".join(f"('{c}', '{s}', '{r}')" for c, s, r in region_rows())
)

CUSTOMERS_SQL = f"""
SELECT CAST(c_custkey AS VARCHAR) AS customer_id,
  CAST(9000000000 + c_custkey AS VARCHAR) AS phone,
  upper(substr(country, 1, 2)) AS country_code, country, state,
  'customer.parquet' AS _source_file,
  TIMESTAMP '{LOADED}' AS date_creation, TIMESTAMP '{LOADED}' AS date_modification
FROM customer JOIN (VALUES {_PLACES_SQL}) AS places(i, country, state)
  ON c_custkey % {len(places())} = i"""

PRODUCT_DIM_SQL = f"""
SELECT product_id, sku, product.category_code,
  CASE WHEN named.brand_code IS NULL THEN 'Not Available' ELSE category_name END AS category_name,
  product.brand_code,
  CASE WHEN named.brand_code IS NULL THEN 'Not Available' ELSE brand_name END AS brand_name,
  color, size, material, weight_grams, length_cm, width_cm, height_cm, rating_count,
  _source_file, date_creation, date_modification
FROM ({PRODUCTS_SQL}) AS product
LEFT JOIN (
  SELECT brand_code, brand_name, category_name
  FROM ({BRANDS_SQL}) AS brand JOIN ({CATEGORIES_SQL}) AS category USING (category_code)
) AS named ON product.brand_code = named.brand_code"""

DATE_DIM_SQL = """
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS DATE) AS date,
  CAST(year(d) AS INTEGER) AS year, isodow(d) >= 6 AS is_weekend,
  CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name, dayname(d) AS day_name,
  CAST(quarter(d) AS INTEGER) AS quarter
FROM (SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS d
      FROM orders) AS days"""

ALL_RATES = {**RATES, "EUR": 1.0, "AED": 4.34}
RATES_SQL = "SELECT * FROM (VALUES {}) AS r(unit_price_currency, rate_eur)".format(
    ", ".join(f"('{c}', CAST({r} AS DOUBLE))" for c, r in ALL_RATES.items())
)


def amounts_sql(items: str) -> str:
    """Order lines with their amounts, key and flag."""
    return f"""
SELECT *, CAST(gross_amount - discount_amount + tax_amount AS BIGINT) AS net_amount
FROM (SELECT *,
        CAST(ceil(gross_amount * (discount_pct / CAST(100 AS DOUBLE))) AS BIGINT)
          AS discount_amount,
        CASE WHEN coupon_code = '' THEN 1 ELSE 0 END AS coupon_flag
      FROM (SELECT *, CAST(quantity AS BIGINT) * unit_price AS gross_amount
            FROM ({items}) AS i) AS g) AS d"""


def fact_sql(items: str = ITEMS_SQL, operator: str = "*") -> str:
    return f"""
SELECT CAST(strftime(dt, '%Y%m%d') AS INTEGER) AS date_id, customer_id, product_id,
  order_id AS transaction_id, dt AS transaction_date, order_ts AS transaction_ts,
  item_seq AS seq_no, channel, coupon_code, coupon_flag, a.unit_price_currency, quantity,
  unit_price, gross_amount, discount_pct AS discount_percent, discount_amount, tax_amount,
  net_amount, CAST(ceil(net_amount {operator} rate_eur) AS BIGINT) AS net_amount_eur,
  date_creation, date_modification, _source_file
FROM ({amounts_sql(items)}) AS a
LEFT JOIN ({RATES_SQL}) AS r ON a.unit_price_currency = r.unit_price_currency"""


def wide_sql(items: str = ITEMS_SQL) -> str:
    return f"""
SELECT fact.*, CAST(hour(transaction_ts) AS INTEGER) AS hour_of_day,
  category_code, category_name, brand_code, brand_name, color, size, material, rating_count,
  day.* EXCLUDE (date_key)
FROM ({fact_sql(items)}) AS fact
LEFT JOIN ({PRODUCT_DIM_SQL}) AS product ON fact.product_id = product.product_id
LEFT JOIN ({DATE_DIM_SQL}) AS day ON date_id = date_key"""


def without_zone(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, as the SQL side has them."""
    stamps = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp"]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in stamps})
