"""Every registered query against its SQL, and the plans of some of them."""

import math

import duckdb
import pytest

import __spark_entry__ as contract
from goldvein.checks import ORACLE_SQL as ORACLE
from goldvein.checks import QUERIES

SF_DIR = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def comparable(table, columns):
    def plain(value):
        if isinstance(value, float):
            return "nan" if math.isnan(value) else round(value, 9)
        return value

    return sorted((tuple(plain(r[c]) for c in columns) for r in table.to_pylist()), key=repr)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLE) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    got = QUERIES[name](spark, SF_DIR).toArrow()
    wanted = duck.sql(ORACLE[name]).to_arrow_table()
    columns = sorted(got.column_names)
    assert columns == sorted(wanted.column_names)
    assert comparable(got, columns) == comparable(wanted, columns)


def test_entry(spark):
    assert contract.entry(spark).columns == ["category_name", "total_sales"]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# these write tables before they give a plan
WRITERS = ("csv_scan", "medallion", "rejects_sink", "table_append", "upsert_table", "view_create",
           "blank_key", "load_cast", "landing", "csv_quarantine", "scd2", "surrogate", "customer_segments",
           "order_count_bitmap", "maintained", "clustered", "zones_listed", "load_result")


@pytest.mark.parametrize("name", [n for n in sorted(QUERIES) if not n.startswith(WRITERS)])
def test_no_plan_pairs_rows_without_a_key(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_scans_read_only_their_columns(spark):
    """Lines meet their orders, and nothing else unless a column of it is asked for."""
    plan = plan_of(QUERIES["total_sales"](spark, SF_DIR))
    schema = plan[plan.index("ReadSchema"):]
    assert "l_quantity" in schema and "l_shipdate" not in schema and "o_custkey" not in schema
    assert plan.count("Join ") == 1 and "LocalTableScan" not in plan
    converted = plan_of(QUERIES["total_sales_eur"](spark, SF_DIR))
    assert converted.count("Join ") == 2


def ordered(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.collect()]


def test_reports_come_in_their_order(spark, duck):
    """Rows as they come, against SQL that sorts."""
    trend = duck.sql(f"SELECT month_name FROM ({ORACLE['sales_trend']}) ORDER BY sum_month").fetchall()
    assert ordered(QUERIES["sales_trend"](spark, SF_DIR), "month_name") == trend
    best = duck.sql(f"SELECT category_name FROM ({ORACLE['sales_by_category']}) ORDER BY total_sales DESC, 1").fetchall()
    assert ordered(QUERIES["sales_by_category"](spark, SF_DIR), "category_name") == best
    week = "['Monday', 'Tuesday', 'Wednesday', 'Thursday', 'Friday', 'Saturday', 'Sunday']"
    heat = duck.sql(
        f"SELECT day_name, hour_of_day FROM ({ORACLE['sales_heatmap']}) ORDER BY list_position({week}, day_name), 2"
    ).fetchall()
    assert ordered(QUERIES["sales_heatmap"](spark, SF_DIR), "day_name", "hour_of_day") == heat
