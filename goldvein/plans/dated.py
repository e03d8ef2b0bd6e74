"""Facts as they were: product attributes and rates that held on the day of an order line."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldvein.functions import amounts
from goldvein.operators.history import FROM, TO
from goldvein.operators.ordered import MONTH, as_of, beside
from goldvein.operators.sizes import SMALL_ROWS
from goldvein.plans.gold import UNKNOWN, fact_names, line_amounts

CURRENCY, RATE, QUOTED = "unit_price_currency", "rate_eur", "quoted_on"


def daily_rates(quotes: DataFrame, last_day) -> DataFrame:
    """Every day's rate: a quote holds until the day before the next one, the last until ``last_day``."""
    once = quotes.groupBy(CURRENCY, QUOTED).agg(F.max(RATE).alias(RATE))
    following = beside(once, [CURRENCY], QUOTED, F.struct(QUOTED), "_next", following=True)
    end = F.greatest(F.col(QUOTED), F.coalesce(F.date_sub(F.col(f"_next.{QUOTED}"), 1), F.lit(last_day)))
    return following.select(CURRENCY, F.explode(F.sequence(QUOTED, end)).alias("_day"), RATE)


def _rated_days(quotes: DataFrame, last_day) -> int:
    """How many rows `daily_rates` would have at most, without making them."""
    span = quotes.agg(F.count_distinct(CURRENCY).alias("n"), F.min(QUOTED).alias("first"), F.max(QUOTED).alias("last")).first()
    if span["first"] is None:
        return 0
    return span["n"] * ((max(span["last"], last_day) - span["first"]).days + 1)


def with_dated_rate(lines: DataFrame, quotes: DataFrame, day: str = "transaction_date", size: str = MONTH) -> DataFrame:
    """Lines with the rate of their currency on their day; null before the first quote.

    ``quotes``: (`unit_price_currency`, `quoted_on` date, `rate_eur`).  A currency may hold
    most of the lines, so where currencies times days are few, every day's rate is
    broadcast and the lines stay where they are; else both sides are merged by time.
    """
    last_day = lines.agg(F.max(day).cast("date")).first()[0]
    if last_day is not None and _rated_days(quotes, last_day) <= SMALL_ROWS:
        rates = F.broadcast(daily_rates(quotes, last_day))
        meet = (lines[CURRENCY] == rates[CURRENCY]) & (lines[day] == rates["_day"])
        return lines.join(rates, meet, "left").drop(rates[CURRENCY], rates["_day"])
    return as_of(lines, quotes, [CURRENCY], day, QUOTED, [RATE], size=size)


def order_lines_as_of(
    items: DataFrame,
    product_history: DataFrame,
    quotes: DataFrame,
    columns: Sequence[str],
    *,
    direction: str = "multiply",
    coupon_when_empty: int = 1,
    exact_discount: bool = False,
    size: str = MONTH,
) -> DataFrame:
    """Order lines with columns of the product version and the rate that held on their day.

    ``product_history``: product_id, ``columns``, valid_from, valid_to.  Where no version
    holds, texts among ``columns`` are `gold.UNKNOWN`.
    """
    lines = fact_names(
        line_amounts(items, coupon_when_empty=coupon_when_empty, exact_discount=exact_discount)
    )
    texts = [c for c in columns if product_history.schema[c].dataType.typeName() == "string"]
    versions = product_history.select("product_id", *columns, FROM, TO)
    lines = as_of(lines, versions, ["product_id"], "transaction_date", FROM, columns, until=TO, size=size)
    lines = lines.withColumns({c: F.coalesce(c, F.lit(UNKNOWN)) for c in texts})
    rated = with_dated_rate(lines, quotes, size=size)
    return rated.withColumn("net_amount_eur", amounts.converted(F.col("net_amount"), F.col(RATE), direction))
