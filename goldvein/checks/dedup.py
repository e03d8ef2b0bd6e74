"""Deduplication of order lines by order and product."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldvein.checks import standin as s
from goldvein.checks.registry import checked
from goldvein.operators import dedup
from goldvein.sources.rejects import with_reason

KEYS = ("l_orderkey", "l_partkey")
_COLUMNS = (
    "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount,"
    " l_tax, l_returnflag, l_linestatus, l_shipdate"
)
_RANKED = f"""
SELECT {_COLUMNS}, row_number() OVER (
  PARTITION BY l_orderkey, l_partkey
  ORDER BY l_shipdate DESC, l_linenumber, l_suppkey, l_quantity, l_extendedprice, l_discount,
    l_tax, l_returnflag, l_linestatus) AS rn
FROM lineitem"""


def _options() -> dict:
    return {"loaded_at": "l_shipdate", "tie_breakers": ["l_linenumber"]}


@checked(f"SELECT {_COLUMNS} FROM ({_RANKED}) AS r WHERE rn = 1")
def latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.latest_per_key(s.given(spark, sf_dir, "lineitem"), KEYS, **_options())


@checked(f"SELECT {_COLUMNS} FROM ({_RANKED}) AS r WHERE rn > 1")
def duplicate_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.duplicate_rows(s.given(spark, sf_dir, "lineitem"), KEYS, **_options())


# (supplier, flag) has few values, so every key holds a large share of the rows.
_FEW = ("l_returnflag", "l_linestatus")


@checked(f"""
SELECT {_COLUMNS} FROM (
  SELECT {_COLUMNS}, row_number() OVER (
    PARTITION BY l_returnflag, l_linestatus
    ORDER BY l_shipdate DESC, l_linenumber, l_orderkey, l_partkey, l_suppkey, l_quantity,
      l_extendedprice, l_discount, l_tax) AS rn
  FROM lineitem) AS r WHERE rn > 1""")
def duplicate_rejects_hot_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with keys that each hold a large share of all rows."""
    return dedup.duplicate_rows(s.given(spark, sf_dir, "lineitem"), _FEW, **_options())


def _some_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey"))
    return s.given(spark, sf_dir, "orders").withColumn("o_orderkey", key)


@checked("""
SELECT CAST(NULL AS BIGINT) AS o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
  o_orderpriority, 'null_key' AS _reject_reason
FROM orders WHERE o_orderstatus = 'P'""")
def null_key_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _some_null_keys(spark, sf_dir)
    return with_reason(dedup.null_key_rows(orders, ["o_orderkey"]), "null_key")


@checked(f"""
SELECT EXISTS (SELECT 1 FROM ({_RANKED}) AS r WHERE rn > 1) AS has_rejects""")
def dedup_has_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    repeated = dedup.repeated_keys(s.given(spark, sf_dir, "lineitem"), KEYS)
    return repeated.limit(1).agg((F.count("*") > 0).alias("has_rejects"))


@checked("""
SELECT o_orderkey, o_orderdate, o_totalprice FROM orders
ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""")
def preview_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = s.given(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    return orders.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(10)
