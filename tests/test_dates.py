from datetime import date

from pyspark.sql import functions as F

from goldvein.operators import dates


def test_calendar(spark):
    rows = dates.date_dimension(spark, date(2024, 2, 28), date(2024, 3, 2)).orderBy("date").collect()
    assert [r.date_key for r in rows] == [20240228, 20240229, 20240301, 20240302]
    assert [r.day_name for r in rows] == ["Wednesday", "Thursday", "Friday", "Saturday"]
    assert [r.is_weekend for r in rows] == [False, False, False, True]
    assert (rows[0].month_name, rows[0].quarter, rows[2].month, rows[0].year) == (
        "February", 1, 3, 2024,
    )
    assert tuple(rows[0].asDict()) == dates.DATE_COLUMNS


def test_of_a_column_without_gaps(frame):
    df = frame([(date(2024, 1, 1),), (date(2024, 1, 4),), (None,)], "d date")
    assert dates.date_dimension_of(df, "d").count() == 4
    assert dates.date_dimension_of(df.where("d IS NULL"), "d").count() == 0


def test_all_days_there_are(spark, frame):
    ends = [date(1, 1, 1), date(9999, 12, 31)]
    days = dates.date_dimension_of(frame([(d,) for d in ends], "d date"), "d")
    assert days.count() == 3_652_059
    assert dates.date_dimension(spark, *ends).agg(F.count_distinct("date_key")).first()[0] == 3_652_059


def test_weekday_order(frame):
    df = frame([("Sunday",), ("Monday",), ("Friday",)], "d string")
    ordered = df.orderBy(dates.weekday_position(F.col("d")))
    assert [r.d for r in ordered.collect()] == ["Monday", "Friday", "Sunday"]
