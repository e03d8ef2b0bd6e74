"""The order lines of the checks, on rows of their own."""

from dataclasses import replace
from datetime import date, datetime

import pytest

from goldvein.checks import reports as report_checks
from goldvein.checks import standin as s
from goldvein.operators import sizes
from goldvein.plans import reports

TABLES = {
    "lineitem": (
        "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_extendedprice double,"
        " l_discount double, l_tax double, l_returnflag string",
        [
            (1, 10, 1, 2.0, 200.0, 0.05, 0.02, "N"), (1, 11, 2, 1.0, 50.0, 0.0, 0.0, "R"),
            (2, 10, 1, 4.0, 80.0, 0.1, 0.08, None), (3, None, 1, 1.0, 9.0, 0.0, 0.0, "A"),
            (None, 10, 1, 1.0, 9.0, 0.0, 0.0, "A"), (7, 10, 1, 1.0, 9.0, 0.0, 0.0, "A"),
        ],
    ),
    "orders": (
        "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz, o_orderpriority string",
        [
            (1, 4, datetime(1997, 3, 1), "1-URGENT"), (2, 5, datetime(1997, 3, 2, 23, 30), None),
            (2, 6, datetime(1998, 1, 1), "5-LOW"), (3, None, datetime(1998, 1, 3), "5-LOW"),
            (None, 4, datetime(1998, 1, 1), "5-LOW"),
        ],
    ),
    "part": (
        "p_partkey long, p_name string, p_brand string, p_type string, p_size int",
        [(10, "red steel", "Brand#1", "ECONOMY", 5), (11, "blue tin", "Brand#2", "STANDARD", 50)],
    ),
}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    at = tmp_path_factory.mktemp("tables")
    for name, (schema, rows) in TABLES.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{at}/{name}.parquet")
    return str(at)


def told(df):
    return sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=repr)


def test_a_line_tells_what_its_head_tells(spark, folder):
    """Lines dressed after the join are lines joined with dressed heads."""
    items = s.order_items(spark, folder)
    assert items.columns == [*s.ITEM_COLUMNS, "_source_file", "date_creation", "date_modification"]
    joined = s.lines(spark, folder).join(s.order_heads(spark, folder), "order_id").select(*s.ITEM_COLUMNS)
    assert told(items.select(*s.ITEM_COLUMNS)) == told(joined)
    late = items.where("order_id = 2 AND customer_id = '5'").first()
    assert (late.dt, late.order_ts, late.unit_price_currency) == (date(1997, 3, 2), datetime(1997, 3, 3, 3, 53, 58), "EUR")
    assert items.count() == 5


def test_rows_that_meet_a_large_dimension_are_plain(spark, folder):
    star = report_checks.star(spark, folder, "products", "dates")
    small = reports.wide_view(star)
    large = reports.wide_view(replace(star, dimensions=tuple(replace(d, small="year" in d.columns) for d in star.dimensions)))
    assert told(small) == told(large)
    plan = large._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("Join LeftOuter, (product_id"):]
    assert "o_custkey" in below and "customer_id" not in below and "transaction_ts" not in below
    sums = told(star.aggregate(["customer_id", "transaction_date", "unit_price_currency"]))
    assert sums == told(small.groupBy("customer_id", "transaction_date", "unit_price_currency").agg({"net_amount": "sum"}).withColumnRenamed("sum(net_amount)", "total_sales"))


def test_heads_counted_to_fit_are_hashed(spark, folder, monkeypatch):
    monkeypatch.setattr(sizes, "SMALL_ROWS", 2)
    plan = s.order_items(spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan and "BroadcastHashJoin" not in plan
