from datetime import date, datetime

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldvein.functions import casting


def test_lenient_cast(frame):
    rows = [("",), (" 12 ",), ("12.5",), ("1,000",), ("Two",), ("7",), (None,)]
    df = frame(rows, "v string")
    cast = casting.cast_columns(df, {"v": "integer", "absent": "long"})
    assert [r.v for r in cast.collect()] == [None, 12, None, None, None, 7, None]
    failed = casting.cast_failures(df, {"v": "integer"}).first()
    assert (failed.column_name, failed.failed) == ("v", 3)


def test_strict_cast_raises(frame):
    df = frame([("Two",)], "v string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        casting.cast_columns(df, {"v": "integer"}, strict=True).collect()


@pytest.mark.parametrize("strict", [True, False])
def test_formats_for_type_objects(frame, strict):
    df = frame([("05/03/2024", "05/03/2024 10.20")], "d string, t string")
    row = casting.cast_columns(
        df,
        {"d": T.DateType(), "t": T.TimestampType()},
        date_format="dd/MM/yyyy",
        timestamp_format="dd/MM/yyyy HH.mm",
        strict=strict,
    ).first()
    assert row.d == date(2024, 3, 5) and row.t == datetime(2024, 3, 5, 10, 20)


def test_type_names_use_plain_casts(frame):
    df = frame([("2024-03-05", "bad")], "d string, e string")
    row = casting.cast_columns(df, {"d": "date", "e": "date"}).first()
    assert row.d == date(2024, 3, 5) and row.e is None


def test_cast_map_tells_the_month_lines_lie_by(spark, tmp_path):
    from goldvein.checks import QUERIES

    spark.sql("""
        SELECT col1 AS l_orderkey, 1 AS l_linenumber, 5L AS l_partkey, 2.0D AS l_quantity, 30.0D AS l_extendedprice,
          0.07D AS l_discount, 0.1D AS l_tax, 'A' AS l_returnflag FROM VALUES (1L), (2L), (3L)
    """).write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.sql("""
        SELECT col1 AS o_orderkey, 7L AS o_custkey, CAST(col2 AS TIMESTAMP_NTZ) AS o_orderdate, '5-LOW' AS o_orderpriority
        FROM VALUES (1L, '1997-12-31'), (2L, '1998-01-01'), (3L, NULL)
    """).write.parquet(str(tmp_path / "orders.parquet"))
    rows = QUERIES["cast_map"](spark, str(tmp_path)).collect()
    assert {r.order_id: r.order_month for r in rows} == {1: 199712, 2: 199801, 3: None}


TEXTS = [
    "", " 12 ", "\t7\n", "+5", "-0", "007", "00000000000012", "12.5", "12.", "1,000", "Two", "2147483647", "2147483648",
    "-2147483649", "9223372036854775808", "127", "128", "1e3", "1E400", "inf", "-Infinity", "NaN", "0x1p3", "1f", ".5", "-", "+ 5",
    " 5", "٣", "5\u0000", "2024-03-05", "2024-3-5 x", "2024", "2024-02", "2024-02-30", "20240305", "05/03/2024",
    "+12024-01-01", " 2024-01-01T10", "2024 ", "\u00852024-01-01", None,
]


@pytest.mark.parametrize("dtype", ["byte", "short", "integer", "long", "float", "double", "decimal(10, 2)", "date", T.LongType()])
def test_only_texts_that_cannot_be_read_are_kept_from_the_cast(frame, dtype):
    df = frame([(i, v) for i, v in enumerate(TEXTS)], "i int, v string")
    plain = df.select("i", casting.cast_value(F.col("v"), dtype).cast("string").alias("v"))
    cast = casting.cast_columns(df, {"v": dtype}).select("i", F.col("v").cast("string").alias("v"))
    assert sorted(map(tuple, cast.collect())) == sorted(map(tuple, plain.collect()))


def test_observed_losses_come_from_the_one_cast(frame):
    df = frame([(v, n) for n, v in enumerate(TEXTS)], "v string, n int")
    lost = Observation()
    cast = casting.cast_and_observe(df, {"v": "integer", "n": "long", "absent": "date"}, lost)
    plan = cast._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("cast(v#") <= 2  # the cast and its text for the count, if that
    assert plan.count("RLIKE") == 1 and cast.columns == ["v", "n"]
    cast.collect()
    failed = {r.column_name: r.failed for r in casting.cast_failures(df, {"v": "integer", "n": "long"}).collect()}
    assert lost.get == failed == {"v": sum(1 for v in TEXTS if v) - cast.where("v IS NOT NULL").count(), "n": 0}
