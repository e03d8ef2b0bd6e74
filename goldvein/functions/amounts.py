"""Amounts, keys and flags of an order line."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def gross(quantity: Column, unit_price: Column) -> Column:
    """Widened to bigint first, so large lines cannot overflow an int."""
    return quantity.cast("bigint") * unit_price


def discount(gross_amount: Column, percent: Column, exact: bool = False) -> Column:
    """Rounded up to a whole unit.

    The default divides the percentage as a double, so 7 % of 100 is 8; ``exact``
    stays in integers and gives 7.
    """
    if exact:
        hundredfold = (gross_amount.cast("bigint") * percent).cast("decimal(20,0)")
        return F.ceil(hundredfold / F.lit(100).cast("decimal(3,0)")).cast("bigint")
    return F.ceil(gross_amount * (percent / F.lit(100.0)))


def net(gross_amount: Column, discount_amount: Column, tax_amount: Column) -> Column:
    return gross_amount - discount_amount + tax_amount


def date_key(day: Column) -> Column:
    """2024-03-05 -> 20240305."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def month_key(day: Column) -> Column:
    """2024-03-05 -> 202403."""
    return (F.year(day) * 100 + F.month(day)).cast("int")


def coupon_flag(code: Column, when_empty: int = 1) -> Column:
    """``when_empty`` for an empty code, the other of 0/1 for the rest, null included."""
    return F.when(code == "", F.lit(when_empty)).otherwise(F.lit(1 - when_empty))


def converted(amount: Column, rate: Column, direction: str = "multiply") -> Column:
    """Amount in the other currency, rounded up; null where there is no rate."""
    if direction == "multiply":
        return F.ceil(amount * rate)
    if direction == "divide":
        return F.ceil(amount / rate)
    raise ValueError(f"direction must be multiply or divide, not {direction!r}")
