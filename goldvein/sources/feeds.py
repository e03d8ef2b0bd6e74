"""The five CSV feeds: declared schemas and the scan that adds provenance."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Feed:
    """Where a feed lies under the landing root, and what its columns are (as DDL)."""

    name: str
    folder: str
    schema: str
    separator: str = ","


# Folder, columns and types of each feed.
BRANDS = Feed(
    "ecommerce_brands",
    "brands",
    "brand_code STRING, brand_name STRING, category_code STRING",
)
# Width and height are read as text: a decimal comma would be lost in a double.
PRODUCTS = Feed(
    "ecommerce_products",
    "products",
    (
        "product_id BIGINT, sku STRING, category_code STRING, brand_code STRING, color STRING,"
        " size STRING, material STRING, weight_grams STRING, length_cm STRING,"
        " width_cm STRING, height_cm STRING, rating_count INT"
    ),
)
CATEGORIES = Feed(
    "ecommerce_categories",
    "category",
    "category_code STRING, category_name STRING",
)
CUSTOMERS = Feed(
    "ecommerce_customers",
    "customers",
    (
        "customer_id STRING, phone STRING, country_code STRING, country STRING, state STRING"
    ),
)
ORDER_ITEMS = Feed(
    "ecommerce_order_items",
    "order_items/landing",
    (
        "dt STRING, order_ts STRING, customer_id STRING, order_id STRING, item_seq STRING,"
        " product_id STRING, quantity STRING, unit_price_currency STRING, unit_price STRING,"
        " discount_pct STRING, tax_amount STRING, channel STRING, coupon_code STRING"
    ),
)

FEEDS = (BRANDS, PRODUCTS, CATEGORIES, CUSTOMERS, ORDER_ITEMS)


def with_provenance(df: DataFrame, batch_time: Column | None = None) -> DataFrame:
    """Add the file each row came from and the time of the load.

    ``batch_time`` makes a load repeatable; without it the query's own start
    time is used, the same for every row.
    """
    loaded = F.current_timestamp() if batch_time is None else batch_time
    return df.withColumns(
        {"_source_file": F.col("_metadata.file_path"), "_ingested_at": loaded}
    )


def scan_csv(
    spark: SparkSession,
    path: str,
    schema: str | T.StructType,
    separator: str = ",",
    batch_time: Column | None = None,
) -> DataFrame:
    """Scan CSV files (glob allowed) with a header row and a declared schema."""
    raw = spark.read.csv(path, header=True, schema=schema, sep=separator)
    return with_provenance(raw, batch_time)


def scan_feed(
    spark: SparkSession, root: str, feed: Feed, batch_time: Column | None = None
) -> DataFrame:
    path = f"{root.rstrip('/')}/{feed.folder}/*.csv"
    return scan_csv(spark, path, feed.schema, feed.separator, batch_time)
