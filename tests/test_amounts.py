from datetime import date

import pytest
from pyspark.sql import functions as F

from goldvein.functions import amounts


def value(spark, column):
    return spark.range(1).select(column).first()[0]


def test_discount_rounds_up_in_doubles(spark):
    assert value(spark, amounts.discount(F.lit(100), F.lit(7))) == 8
    assert value(spark, amounts.discount(F.lit(100), F.lit(7), exact=True)) == 7
    assert value(spark, amounts.discount(F.lit(99), F.lit(10), exact=True)) == 10
    assert value(spark, amounts.discount(F.lit(-99), F.lit(10), exact=True)) == -9
    assert value(spark, amounts.discount(F.lit(None).cast("long"), F.lit(10))) is None


def test_gross_does_not_overflow(spark):
    column = amounts.gross(F.lit(100_000), F.lit(100_000))
    assert value(spark, column) == 10_000_000_000


def test_keys(spark):
    day = F.lit(date(2024, 3, 5))
    assert value(spark, amounts.date_key(day)) == 20240305
    assert value(spark, amounts.month_key(day)) == 202403
    assert value(spark, amounts.date_key(F.lit(None).cast("date"))) is None


@pytest.mark.parametrize("code, flag", [("", 1), ("SAVE", 0), (None, 0)])
def test_coupon_flag(spark, code, flag):
    column = F.lit(code).cast("string")
    assert value(spark, amounts.coupon_flag(column)) == flag
    assert value(spark, amounts.coupon_flag(column, when_empty=0)) == 1 - flag


def test_conversion(spark):
    assert value(spark, amounts.converted(F.lit(10), F.lit(1.25))) == 13
    assert value(spark, amounts.converted(F.lit(10), F.lit(1.25), "divide")) == 8
    assert value(spark, amounts.converted(F.lit(10), F.lit(None).cast("double"))) is None
    with pytest.raises(ValueError):
        amounts.converted(F.lit(10), F.lit(1.0), "sideways")
