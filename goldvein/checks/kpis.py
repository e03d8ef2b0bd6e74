"""Figures that add up, come from one scan, or are kept up to date."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldvein.checks import standin as s
from goldvein.checks import upsert as upsert_checks
from goldvein.checks.registry import checked
from goldvein.checks.reports import _FILTERS, _TESTS, _WIDE, star
from goldvein.checks.storage import _zone
from goldvein.operators.bitmaps import distinct_bitmaps, distinct_counts
from goldvein.operators.layout import clustered
from goldvein.operators.maintained import ROWS, SIGN, images, load_report
from goldvein.operators.surrogate import number_keys, with_numbers
from goldvein.plans import reports
from goldvein.session import scratch_path
from goldvein.sources.tables import overwrite_table, read_table

_SET_COLUMNS = list(dict.fromkeys(c for group in reports.WIDGET_SETS for c in group))
_SETS_SQL = " UNION ALL ".join(
    f"SELECT {', '.join(c if c in group else f'NULL AS {c}' for c in _SET_COLUMNS)}, CAST({i} AS INTEGER) AS set_number,"
    " CAST(sum(net_amount) AS BIGINT) AS total_sales, CAST(sum(month) AS BIGINT) AS sum_month"
    f" FROM w {'GROUP BY ' + ', '.join(group) if group else ''}"
    for i, group in enumerate(reports.WIDGET_SETS)
)


@checked(f"WITH w AS ({_WIDE}) {_SETS_SQL}")
def dashboard_one_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All figures of the dashboard from one aggregation of the fact."""
    return reports.all_widgets(star(spark, sf_dir, "products", "dates"))


def _list_sql(column: str) -> str:
    others = " AND ".join(t for c, t in _TESTS.items() if c != column)
    return (
        f"SELECT '{column}' AS \"column\", CAST({column} AS VARCHAR) AS value,"
        f" CAST(count(*) FILTER (WHERE {others}) AS BIGINT) AS n_rows FROM w GROUP BY {column}"
    )


@checked(f"WITH w AS ({_WIDE}) " + " UNION ALL ".join(_list_sql(c) for c in _FILTERS))
def filter_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three filter lists from one aggregation."""
    return star(spark, sf_dir, "products", "dates").filter_lists(list(_FILTERS), _FILTERS)


@checked(f"""
WITH c AS (
  SELECT customer_id, max(transaction_date) AS last_day, count(DISTINCT transaction_id) AS n_orders,
    CAST(sum(net_amount) AS BIGINT) AS total_sales
  FROM ({s.fact_sql()}) AS f GROUP BY customer_id),
d AS (SELECT *, CAST((SELECT max(last_day) FROM c) - last_day AS INTEGER) AS recency_days FROM c)
SELECT customer_id, recency_days, n_orders, total_sales,
  CAST(ntile(5) OVER (ORDER BY recency_days, customer_id) AS INTEGER) AS recency,
  CAST(ntile(5) OVER (ORDER BY n_orders DESC, customer_id) AS INTEGER) AS frequency,
  CAST(ntile(5) OVER (ORDER BY total_sales DESC, customer_id) AS INTEGER) AS amount
FROM d""")
def customer_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fifths of customers by recency, frequency and amount."""
    return reports.customer_segments(star(spark, sf_dir))


@checked(f"""
WITH w AS ({_WIDE})
SELECT 'category' AS kind, category_name AS value, count(DISTINCT transaction_id) AS n_orders
FROM w WHERE year = 1997 GROUP BY category_name
UNION ALL SELECT 'month', CAST(year * 100 + month AS VARCHAR), count(DISTINCT transaction_id) FROM w GROUP BY year, month
UNION ALL SELECT 'all', '', count(DISTINCT transaction_id) FROM w""")
def order_count_bitmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by category under a filter, by month and in all, from one stored table of bitmaps."""
    zone = _zone(spark)
    built = star(spark, sf_dir, "products", "dates")
    lines = built.wide(["transaction_id", "category_name", "year", "month"])
    orders = number_keys(s.order_heads(spark, sf_dir).withColumnRenamed("order_id", "transaction_id"), zone.table("order_keys"), ["transaction_id"], "order_no")
    by = ["year", "month", "category_name"]
    numbered = with_numbers(lines, orders, ["transaction_id"], "order_no")
    table = zone.table("order_bitmaps")
    overwrite_table(distinct_bitmaps(numbered, by, "order_no"), table)
    stored = read_table(spark, table)

    def told(kind: str, counted: DataFrame, value) -> DataFrame:
        return counted.select(F.lit(kind).alias("kind"), value.cast("string").alias("value"), "n_orders")

    category = distinct_counts(stored.where("year = 1997"), ["category_name"], "n_orders")
    month = distinct_counts(stored, ["year", "month"], "n_orders")
    return (
        told("category", category, F.col("category_name"))
        .unionByName(told("month", month, F.col("year") * 100 + F.col("month")))
        .unionByName(told("all", distinct_counts(stored, [], "n_orders"), F.lit("")))
    )


_CENTS = "CAST(round(o_totalprice * 100) AS BIGINT)"


@checked(f"""
SELECT o_orderpriority, CAST(year(o_orderdate) AS INTEGER) AS order_year, CAST(sum({_CENTS}) AS BIGINT) AS cents,
  count(*) AS n_orders
FROM (SELECT * REPLACE (CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN o_totalprice + 1
        ELSE o_totalprice END AS o_totalprice) FROM orders) AS o
GROUP BY ALL""")
def maintained_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums by priority and year from a first load, and brought up to date by what a second one changed."""
    table = _zone(spark).table("orders_by_priority")
    by, sums = ["o_orderpriority", "order_year"], {"cents": F.expr(_CENTS)}

    def dated(rows: DataFrame) -> DataFrame:
        return rows.withColumn("order_year", F.year("o_orderdate"))

    target, batch = upsert_checks.target(spark, sf_dir), upsert_checks.batch(spark, sf_dir)
    load_report(dated(target).withColumn(SIGN, F.lit(1)), table, by, sums, ["order_year"])
    changes = images(target, batch, upsert_checks.KEYS, F.lit(upsert_checks.NOW).cast("timestamp"))
    load_report(dated(changes), table, by, sums, ["order_year"])
    return read_table(spark, table).select(*by, "cents", F.col(ROWS).alias("n_orders"))


@checked("""
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem
WHERE l_partkey BETWEEN 100 AND 180 AND CAST(l_shipdate AS DATE) BETWEEN DATE '1996-03-01' AND DATE '1996-09-30'""")
def clustered_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A filter on two columns over files that are clustered by both."""
    path = scratch_path(spark, "clustered")
    clustered(s.given(spark, sf_dir, "lineitem"), ["l_partkey", "l_shipdate"], files=32).write.parquet(path)
    days = F.col("l_shipdate").between(F.lit("1996-03-01").cast("timestamp_ntz"), F.lit("1996-09-30 23:59:59.999999").cast("timestamp_ntz"))
    return spark.read.parquet(path).where(F.col("l_partkey").between(100, 180) & days).select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
