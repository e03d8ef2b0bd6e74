"""The date dimension: one row per calendar day."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from goldvein.functions.amounts import date_key

# The order of a week in reports.
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")

DATE_COLUMNS = (
    "date_key", "date", "year", "is_weekend", "month", "month_name", "day_name", "quarter",
)


def weekday_position(day_name: Column) -> Column:
    """1 for Monday to 7 for Sunday, for ordering by weekday name."""
    return F.array_position(F.array(*[F.lit(d) for d in WEEKDAYS]), day_name)


def _calendar(bounds: DataFrame) -> DataFrame:
    day = F.col("date")
    # a year at a time, so that no array holds a long calendar
    years = F.explode(F.sequence(F.year("first"), F.year("last")))
    begin = F.greatest("first", F.make_date("year", F.lit(1), F.lit(1)))
    end = F.least("last", F.make_date("year", F.lit(12), F.lit(31)))
    days = bounds.where("first IS NOT NULL").select("first", "last", years.alias("year"))
    return days.select(F.explode(F.sequence(begin, end)).alias("date")).select(
        date_key(day).alias("date_key"),
        day,
        F.year(day).alias("year"),
        (F.weekday(day) >= 5).alias("is_weekend"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.quarter(day).alias("quarter"),
    )


def date_dimension(spark: SparkSession, first: date, last: date) -> DataFrame:
    first, last = (F.lit(d.isoformat()).cast("date") for d in (first, last))
    bounds = spark.range(1).select(first.alias("first"), last.alias("last"))
    return _calendar(bounds)


def date_dimension_of(df: DataFrame, column: str) -> DataFrame:
    """All days between the first and the last of a column, gaps included."""
    day = F.col(column).cast("date")
    return _calendar(df.agg(F.min(day).alias("first"), F.max(day).alias("last")))
