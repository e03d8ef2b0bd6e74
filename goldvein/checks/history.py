"""Histories, as-of joins and surrogate keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldvein.checks import standin as s
from goldvein.checks.registry import checked
from goldvein.checks.storage import _zone
from goldvein.operators.history import CONFIRMED, CURRENT, ENDED, FROM, TO, Historized, load_history
from goldvein.operators.surrogate import number_keys, with_numbers
from goldvein.plans.dated import order_lines_as_of
from goldvein.sources.tables import read_table

CUSTOMER_HISTORY = Historized(("customer_id",), "changed_at", ("segment", "nation"), "_ingested_at")

# Moment, segment of a customer, and which customers come in each of the three batches, as
# they arrive; the last one tells of a moment between the first two.
_BATCHES = (
    ("2024-01-01 00:00:00", "c_mktsegment", "true"),
    ("2024-03-01 12:00:00", "CASE WHEN c_nationkey < 10 THEN 'MOVED' ELSE c_mktsegment END", "c_nationkey <> 3"),
    ("2024-02-10 00:00:00", "CASE WHEN c_nationkey % 2 = 0 THEN 'LATE' ELSE c_mktsegment END", "c_nationkey > 5"),
)


def _told(n: int, text: str) -> str:
    at, segment, which = _BATCHES[n]
    return (
        f"SELECT CAST(c_custkey AS {text}) AS customer_id, {segment} AS segment, CAST(c_nationkey AS BIGINT) AS nation,"
        f" TIMESTAMP '{at}' AS changed_at, TIMESTAMP '2024-04-0{n + 1} 00:00:00' AS _ingested_at FROM customer WHERE {which}"
    )


_ALL_TOLD = " UNION ALL ".join(_told(n, "VARCHAR") for n in range(3))
_CUSTOMER_VERSIONS = f"""
SELECT customer_id, segment, nation, valid_from, lead(valid_from) OVER (PARTITION BY customer_id ORDER BY valid_from) AS valid_to,
  lead(valid_from) OVER (PARTITION BY customer_id ORDER BY valid_from) IS NULL AS is_current, confirmed
FROM (
  SELECT customer_id, segment, nation, min(changed_at) AS valid_from, CAST(count(*) - 1 AS INTEGER) AS confirmed
  FROM (
    SELECT *, sum(fresh) OVER (PARTITION BY customer_id ORDER BY changed_at) AS version FROM (
      SELECT *, CASE WHEN segment IS NOT DISTINCT FROM lag(segment) OVER w AND nation IS NOT DISTINCT FROM lag(nation) OVER w
          AND row_number() OVER w > 1 THEN 0 ELSE 1 END AS fresh
      FROM ({_ALL_TOLD}) AS told WINDOW w AS (PARTITION BY customer_id ORDER BY changed_at)) AS marked) AS numbered
  GROUP BY customer_id, segment, nation, version) AS begun"""


@checked(_CUSTOMER_VERSIONS)
def scd2_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches into a table of versions, one of them late; the second comes twice."""
    table = _zone(spark).table("customer_history")
    s.given(spark, sf_dir, "customer").createOrReplaceTempView("customer")
    for n in (0, 1, 1, 2):
        load_history(spark.sql(_told(n, "STRING")), table, CUSTOMER_HISTORY)
    rows = read_table(spark, table).drop(ENDED).withColumn(CONFIRMED, F.size(CONFIRMED))
    return s.without_zone(rows.select("customer_id", "segment", "nation", FROM, TO, CURRENT, CONFIRMED))


# Versions of a product: up to three, 400 days apart, the last of some of them at an end.
_VERSIONS = """
SELECT p_partkey AS product_id, CONCAT(p_type, ' v', CAST(k AS {text})) AS category_name, p_brand AS brand_name,
  {day} AS valid_from, CASE WHEN k < 2 OR p_size < 10 THEN {next_day} END AS valid_to
FROM part, (SELECT * FROM (VALUES (0), (1), (2)) AS n(k)) AS versions WHERE k <= p_partkey % 3"""
_VERSIONS_SQL = _VERSIONS.format(
    text="VARCHAR",
    day="DATE '1995-06-01' + CAST(p_partkey % 300 + 400 * k AS INTEGER)",
    next_day="DATE '1995-06-01' + CAST(p_partkey % 300 + 400 * (k + 1) AS INTEGER)",
)
_QUOTES_SQL = f"""
SELECT {{currency}} AS unit_price_currency, CAST(o_orderdate AS DATE) AS quoted_on,
  max(1 + CAST(o_custkey % 1000 AS DOUBLE) / 1000) AS rate_eur
FROM orders WHERE day(o_orderdate) IN (3, 14, 25) AND o_custkey % {len(s.CURRENCIES)} <> 4
GROUP BY {{currency}}, CAST(o_orderdate AS DATE)"""
_CURRENCY_SQL = " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(s.CURRENCIES))
_CURRENCY = f"CASE o_custkey % {len(s.CURRENCIES)} {_CURRENCY_SQL} END"
_AS_OF_COLUMNS = ("category_name", "brand_name")


def product_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = s.given(spark, sf_dir, "part")
    versions = part.withColumn("k", F.explode(F.sequence(F.lit(0), (F.col("p_partkey") % 3).cast("int"))))
    start = F.lit("1995-06-01").cast("date")

    def day(plus: int):
        return F.date_add(start, (F.col("p_partkey") % 300 + 400 * (F.col("k") + plus)).cast("int"))

    ended = (F.col("k") < 2) | (F.col("p_size") < 10)
    return versions.select(
        F.col("p_partkey").alias("product_id"),
        F.concat("p_type", F.lit(" v"), F.col("k").cast("string")).alias("category_name"),
        F.col("p_brand").alias("brand_name"),
        day(0).alias(FROM),
        F.when(ended, day(1)).alias(TO),
    )


def quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    s.given(spark, sf_dir, "orders").createOrReplaceTempView("orders")
    return spark.sql(_QUOTES_SQL.format(currency=_CURRENCY))


@checked(f"""
SELECT transaction_id, seq_no, f.product_id, transaction_date,
  CASE WHEN v.product_id IS NULL OR transaction_date >= valid_to THEN 'Not Available' ELSE category_name END AS category_name,
  CASE WHEN v.product_id IS NULL OR transaction_date >= valid_to THEN 'Not Available' ELSE brand_name END AS brand_name,
  f.unit_price_currency, rate_eur, CAST(ceil(net_amount * rate_eur) AS BIGINT) AS net_amount_eur
FROM (SELECT * EXCLUDE (net_amount_eur) FROM ({s.fact_sql()}) AS x) AS f
ASOF LEFT JOIN ({_VERSIONS_SQL}) AS v ON f.product_id = v.product_id AND f.transaction_date >= v.valid_from
ASOF LEFT JOIN ({_QUOTES_SQL.format(currency=_CURRENCY)}) AS q
  ON f.unit_price_currency = q.unit_price_currency AND f.transaction_date >= q.quoted_on""")
def fact_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with the product version and the rate of their day."""
    lines = order_lines_as_of(
        s.order_items(spark, sf_dir), product_versions(spark, sf_dir), quotes(spark, sf_dir), _AS_OF_COLUMNS
    )
    return lines.select(
        "transaction_id", "seq_no", "product_id", "transaction_date", *_AS_OF_COLUMNS, "unit_price_currency", "rate_eur", "net_amount_eur"
    )


@checked("""
SELECT customer_id, customer_sk, n_orders FROM (
  SELECT o_custkey AS customer_id, count(*) AS n_orders,
    CASE WHEN bool_or(o_orderstatus = 'F') THEN 1 ELSE 2 END AS load FROM orders GROUP BY o_custkey) AS c
JOIN (
  SELECT o_custkey, row_number() OVER (ORDER BY load, o_custkey) AS customer_sk
  FROM (SELECT o_custkey, CASE WHEN bool_or(o_orderstatus = 'F') THEN 1 ELSE 2 END AS load FROM orders GROUP BY o_custkey) AS l
) AS k ON customer_id = o_custkey""")
def surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers from a load of some orders, from one of all of them, and from the same again."""
    orders = s.given(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "customer_id")
    table = _zone(spark).table("customer_keys")
    for rows in (orders.where("o_orderstatus = 'F'"), orders, orders):
        known = number_keys(rows, table, ["customer_id"], "customer_sk")
    per_customer = orders.groupBy("customer_id").agg(F.count("*").alias("n_orders"))
    return with_numbers(per_customer, known, ["customer_id"], "customer_sk")
