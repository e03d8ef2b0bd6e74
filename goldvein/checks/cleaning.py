"""Cleaning and casting, on whole texts and on columns dirtied by expression."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldvein.checks import standin as s
from goldvein.checks.registry import checked
from goldvein.functions import amounts, casting, cleaning
from goldvein.plans import medallion, silver

_DROPPED = r"[^a-zA-Z0-9&:\-, ]"
_DROPPED_KEEP_POINT = r"[^a-zA-Z0-9&:\-,. ]"


@checked(f"""
SELECT doc_id, regexp_replace(trim(coalesce(text, ''), ' '), '{_DROPPED}', '', 'g') AS text,
  regexp_replace(trim(coalesce(lang, ''), ' '), '{_DROPPED}', '', 'g') AS lang,
  regexp_replace(trim(coalesce(source, ''), ' '), '{_DROPPED}', '', 'g') AS source, n_chars
FROM documents""")
def normalize_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_frame(s.given(spark, sf_dir, "documents"))


@checked(f"""
SELECT page_id, regexp_replace(trim(url, ' '), '{_DROPPED_KEEP_POINT}', '', 'g') AS url,
  regexp_replace(trim(html, ' '), '{_DROPPED}', '', 'g') AS html
FROM pages""")
def normalize_keep_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Another character set for one column."""
    pages = s.given(spark, sf_dir, "pages")
    return cleaning.clean_frame(pages, not_kept={"url": cleaning.NOT_KEPT_WITH_POINT})


def _with_nulls(events: DataFrame) -> DataFrame:
    clicked, viewed = F.col("event_type") == "click", F.col("event_type") == "view"
    return events.select(
        "event_id",
        F.when(~clicked, F.col("user_id")).alias("user_id"),
        F.when(~viewed, F.col("value")).alias("value"),
        F.when(~clicked, F.col("ts").cast("date")).alias("day"),
        F.when(~viewed, F.col("ts")).alias("ts"),
        F.when(~clicked, F.col("ts").cast("timestamp")).alias("zoned_ts"),
        F.when(~viewed, F.col("props")).alias("props"),
        F.when(~clicked, F.col("value") > 10).alias("is_large"),
    )


@checked(r"""
SELECT event_id, CASE WHEN event_type = 'click' THEN 0 ELSE user_id END AS user_id,
  CASE WHEN event_type = 'view' THEN CAST(0 AS DOUBLE) ELSE value END AS value,
  CASE WHEN event_type = 'click' THEN DATE '1900-01-01' ELSE CAST(ts AS DATE) END AS day,
  CASE WHEN event_type = 'view' THEN TIMESTAMP '1900-01-01 00:00:00' ELSE ts END AS ts,
  CASE WHEN event_type = 'click' THEN TIMESTAMP '1900-01-01 00:00:00' ELSE ts END AS zoned_ts,
  CASE WHEN event_type = 'view' THEN ''
    ELSE regexp_replace(trim(props, ' '), '[^a-zA-Z0-9&:\-, ]', '', 'g') END AS props,
  CASE WHEN event_type = 'click' THEN NULL ELSE value > 10 END AS is_large
FROM events""")
def null_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = cleaning.clean_frame(_with_nulls(s.given(spark, sf_dir, "events")))
    return s.without_zone(cleaned)


@checked("""
SELECT p_partkey, upper(p_name) AS p_name, upper(p_brand) AS p_brand, lower(p_type) AS p_type
FROM part""")
def upper_lower(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = s.given(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    return cleaning.lower_columns(cleaning.upper_columns(part, ["p_name", "p_brand"]), ["p_type"])


@checked(f"""
SELECT customer_id, phone FROM ({s.CUSTOMERS_SQL}) AS c""")
def phone_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = s.raw_customers(spark, sf_dir)
    return cleaning.phone_columns(raw, ["phone"]).select("customer_id", "phone")


@checked("SELECT p_partkey AS product_id, CAST(p_size * 10 AS VARCHAR) AS weight_grams FROM part")
def strip_unit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return s.raw_products(spark, sf_dir).select(
        "product_id", cleaning.digits_only(F.col("weight_grams")).alias("weight_grams")
    )


@checked("""
SELECT p_partkey AS product_id, CAST(p_size AS DOUBLE) / 2 AS length_cm,
  CAST(p_size AS DOUBLE) / 8 AS height_cm FROM part""")
def decimal_comma(spark: SparkSession, sf_dir: str) -> DataFrame:
    return s.raw_products(spark, sf_dir).select(
        "product_id",
        *[
            cleaning.decimal_point(F.col(c)).cast("double").alias(c)
            for c in ("length_cm", "height_cm")
        ],
    )


@checked(f"""
SELECT order_id, item_seq, product_id, CAST(quantity AS VARCHAR) AS quantity
FROM ({s.LINES_SQL}) AS l""")
def value_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    quantity = F.col("quantity").cast("string")
    worded = s.lines(spark, sf_dir).select(
        "order_id",
        "item_seq",
        "product_id",
        F.when(F.col("quantity") == 2, F.lit("Two")).otherwise(quantity).alias("quantity"),
    )
    return cleaning.replace_values(worded, "quantity", silver.QUANTITY_WORDS)


@checked("""
SELECT n_nationkey, CASE WHEN n_regionkey = 2 THEN 'Other' ELSE n_name END AS n_name
FROM nation""")
def null_default_by_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = s.given(spark, sf_dir, "nation")
    named = F.when(F.col("n_regionkey") != 2, F.col("n_name")).alias("n_name")
    return nation.select("n_nationkey", named).fillna({"n_name": "Other"})


@checked(f"""
SELECT i.* EXCLUDE (_source_file, date_creation, date_modification),
  CAST(year(dt) * 100 + month(dt) AS INTEGER) AS order_month
FROM ({s.ITEMS_SQL}) AS i""")
def cast_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw text order lines through cleaning and the whole cast map, with the month they lie by."""
    cleaned = silver.clean_order_items(s.raw_order_items(spark, sf_dir))
    month = amounts.month_key(F.col(silver.ORDER_ITEMS.month_of))
    return s.without_zone(cleaned.withColumn(medallion.ITEM_MONTH, month))


@checked(f"""
SELECT p.* EXCLUDE (_source_file, date_creation, date_modification) FROM ({s.PRODUCTS_SQL}) AS p""")
def cast_map_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.clean_products(s.raw_products(spark, sf_dir))


@checked("""
SELECT 'orders_total' AS column_name,
  count(*) FILTER (WHERE o_orderpriority <> '5-LOW') AS failed FROM orders
UNION ALL
SELECT 'order_day', count(*) FILTER (WHERE o_orderstatus = 'F') FROM orders
UNION ALL
SELECT 'order_id', 0 FROM orders WHERE false
UNION ALL
SELECT 'order_id', 0""")
def cast_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many values each lenient cast loses."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    text = s.given(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit("5"))
        .otherwise(F.col("o_orderpriority"))
        .alias("orders_total"),
        F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("on "), day))
        .otherwise(day)
        .alias("order_day"),
    )
    types = {"order_id": "long", "orders_total": "integer", "order_day": "date"}
    return casting.cast_failures(text, types)


@checked("SELECT doc_id, strip_accents(text) AS text FROM documents")
def fold_accents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text with its accented letters as plain ones."""
    docs = s.given(spark, sf_dir, "documents")
    return docs.select("doc_id", cleaning.fold_accents(F.col("text")).alias("text"))
