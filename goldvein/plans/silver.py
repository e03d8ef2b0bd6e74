"""Raw feeds to cleaned, typed feeds."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from goldvein.functions.casting import cast_and_observe, cast_columns
from goldvein.functions.cleaning import (
    clean_frame,
    decimal_point,
    digits_only,
    phone_columns,
    replace_values,
    upper_columns,
    without_thousands,
)

# The type of every cleaned column.
PRODUCT_TYPES = {
    "product_id": "long",
    "sku": "string",
    "category_code": "string",
    "brand_code": "string",
    "color": "string",
    "size": "string",
    "material": "string",
    "weight_grams": "integer",
    "length_cm": "double",
    "width_cm": "double",
    "height_cm": "double",
    "rating_count": "integer",
}
ORDER_ITEM_TYPES = {
    "dt": "date",
    "order_ts": "timestamp",
    "customer_id": "string",
    "order_id": "long",
    "item_seq": "integer",
    "product_id": "long",
    "quantity": "integer",
    "unit_price_currency": "string",
    "unit_price": "integer",
    "discount_pct": "integer",
    "tax_amount": "integer",
    "channel": "string",
    "coupon_code": "string",
}
QUANTITY_WORDS = {"Two": "2"}


@dataclass(frozen=True)
class SilverTable:
    """Name and key of a cleaned table, and the order among equally new rows."""

    name: str
    keys: tuple[str, ...]
    tie_breakers: tuple[str, ...] = ()
    #: a key column whose month the table is partitioned by, as ``order_month``
    month_of: str | None = None


# Table names and keys.
BRANDS = SilverTable("slv_ecommerce_brands", ("brand_code",))
PRODUCTS = SilverTable("slv_ecommerce_products", ("product_id",))
CATEGORIES = SilverTable("slv_ecommerce_categories", ("category_code",))
CUSTOMERS = SilverTable("slv_ecommerce_customers", ("customer_id",))
# Two lines of one product in an order share this key; give ``item_seq`` as a
# further key column to keep both.
ORDER_ITEMS = SilverTable(
    "slv_ecommerce_order_items",
    ("dt", "customer_id", "order_id", "product_id"),
    tie_breakers=("item_seq",),
    month_of="dt",
)


def clean_brands(raw: DataFrame) -> DataFrame:
    return upper_columns(clean_frame(raw), ["category_code"])


def clean_categories(raw: DataFrame) -> DataFrame:
    return upper_columns(clean_frame(raw), ["category_code"])


def clean_customers(raw: DataFrame) -> DataFrame:
    return clean_frame(phone_columns(raw, ["phone"]))


def clean_products(
    raw: DataFrame, lost: Observation | None = None, strict: bool = False
) -> DataFrame:
    """Units and decimal commas go, codes are upper case; texts stay as they came."""
    measured = raw.withColumns(
        {
            "weight_grams": digits_only(F.col("weight_grams")),
            "length_cm": decimal_point(F.col("length_cm")),
            "width_cm": decimal_point(F.col("width_cm")),
            "height_cm": decimal_point(F.col("height_cm")),
        }
    )
    return _typed(upper_columns(measured, ["category_code", "brand_code"]), PRODUCT_TYPES, lost, strict)


def _typed(
    df: DataFrame, types: dict[str, str], lost: Observation | None, strict: bool
) -> DataFrame:
    """Cast by the map; count what is lost, or fail on it if ``strict``."""
    if lost:
        return cast_and_observe(df, types, lost, strict=strict)
    return cast_columns(df, types, strict=strict)


def clean_order_items(
    raw: DataFrame,
    *,
    types: dict[str, str] | None = None,
    not_kept: dict[str, str] | None = None,
    thousands: Iterable[str] = (),
    lost: Observation | None = None,
    strict: bool = False,
) -> DataFrame:
    """Clean and type order lines.

    To keep fractions of an amount, pass a decimal type in ``types`` and a
    character set with the point in ``not_kept`` for that column.  ``thousands``
    names columns whose numbers may be grouped by commas.
    """
    cleaned = replace_values(clean_frame(raw, not_kept=not_kept), "quantity", QUANTITY_WORDS)
    cleaned = cleaned.withColumns({c: without_thousands(F.col(c)) for c in thousands})
    return _typed(cleaned, {**ORDER_ITEM_TYPES, **(types or {})}, lost, strict)
