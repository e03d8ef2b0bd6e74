"""Upserts of orders: closed and partly closed ones are there, partly closed and
open ones come in, and the urgent ones among the former have a new price."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldvein.checks import standin as s
from goldvein.checks.registry import checked
from goldvein.operators import upsert
from goldvein.operators.sizes import counted_small

KEYS = ("o_orderkey",)
FIRST, SECOND, NOW = "2024-01-01 06:00:00", "2024-01-02 06:00:00", "2024-01-02 07:00:00"


def _stamp(text: str) -> F.Column:
    return F.lit(text).cast("timestamp")


def target(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = s.given(spark, sf_dir, "orders").where("o_orderstatus <> 'O'")
    return orders.withColumns(
        {
            "_source_file": F.lit("day1.csv"),
            "date_creation": _stamp(FIRST),
            "date_modification": _stamp(FIRST),
        }
    )


def batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = s.given(spark, sf_dir, "orders").where("o_orderstatus <> 'F'")
    urgent = (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "1-URGENT")
    price = F.when(urgent, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    return orders.withColumns(
        {
            "o_totalprice": price,
            "_source_file": F.lit("day2.csv"),
            "_ingested_at": _stamp(SECOND),
        }
    )


def merged(spark: SparkSession, sf_dir: str, small_batch: bool = False) -> DataFrame:
    return upsert.merge_batch(
        target(spark, sf_dir), batch(spark, sf_dir), KEYS, _stamp(NOW), small_batch=small_batch
    )


_CLASSED = """
SELECT *, CASE WHEN o_orderstatus = 'O' THEN 'insert' WHEN o_orderstatus = 'F' THEN 'kept'
  WHEN o_orderpriority = '1-URGENT' THEN 'update' ELSE 'unchanged' END AS _change
FROM orders"""
_MERGED = f"""
SELECT o_orderkey, o_custkey, o_orderstatus,
  CASE WHEN _change = 'update' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
  o_orderdate, o_orderpriority,
  CASE WHEN _change IN ('insert', 'update') THEN 'day2.csv' ELSE 'day1.csv' END AS _source_file,
  CASE WHEN _change = 'insert' THEN TIMESTAMP '{SECOND}' ELSE TIMESTAMP '{FIRST}' END
    AS date_creation,
  CASE WHEN _change IN ('insert', 'update') THEN TIMESTAMP '{NOW}' ELSE TIMESTAMP '{FIRST}' END
    AS date_modification,
  _change
FROM ({_CLASSED}) AS c"""


@checked(_MERGED)
def upsert_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    return s.without_zone(merged(spark, sf_dir))


@checked(_MERGED)
def upsert_small_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plan that broadcasts a batch counted to be small; else the general one."""
    small = counted_small(batch(spark, sf_dir), upsert.SMALL_BATCH_ROWS)
    return s.without_zone(merged(spark, sf_dir, small))


@checked(f"SELECT _change, count(*) AS n_rows FROM ({_CLASSED}) AS c GROUP BY _change")
def upsert_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert.change_counts(merged(spark, sf_dir))


@checked(f"""
SELECT * EXCLUDE (_change),
  CASE _change WHEN 'kept' THEN 'kept' ELSE 'unchanged' END AS _change
FROM ({_MERGED}) AS m""")
def upsert_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same batch once more: nothing is inserted or updated."""
    state = upsert.without_change(merged(spark, sf_dir))
    again = batch(spark, sf_dir)
    later = _stamp("2024-01-03 07:00:00")
    return s.without_zone(upsert.merge_batch(state, again, KEYS, later))


@checked(f"""
SELECT orders.*, TIMESTAMP '{SECOND}' AS date_creation,
  TIMESTAMP '{NOW}' AS date_modification, 'insert' AS _change
FROM orders""")
def upsert_first_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = s.given(spark, sf_dir, "orders")
    loaded = orders.withColumn("_ingested_at", _stamp(SECOND))
    return s.without_zone(upsert.first_load(loaded, KEYS, _stamp(NOW)))
