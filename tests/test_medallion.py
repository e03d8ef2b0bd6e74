from datetime import date, timedelta

import pytest

from conftest import DAY_ONE, DAY_TWO
from goldvein.functions.cleaning import NOT_KEPT_WITH_POINT
from goldvein.plans import gold, medallion, reports, silver
from goldvein.sources.feeds import ORDER_ITEMS
from goldvein.sources.rejects import read_rejects
from goldvein.sources.tables import read_table

FILES = {
    "brands": """brand_code,brand_name,category_code
ACM#,  Acme ,toy
ZED,Zed!,gone
""",
    "category": """category_code,category_name
toy,Toys
""",
    "products": """product_id,sku,category_code,brand_code,color,size,material,weight_grams,length_cm,width_cm,height_cm,rating_count
1,S-1,toy,acm,red,M,wood,250g,"12,5","3,5",4,10
2,S-2,toy,zed,blue,L,iron,1000g,"1,0",2,3,
""",
    "customers": """customer_id,phone,country_code,country,state
C1,9876543210.0,IN,India,SK
C2,,CA,Canada,SK
C3,123.0,CA,Canada,??
""",
    "order_items/landing": """dt,order_ts,customer_id,order_id,item_seq,product_id,quantity,unit_price_currency,unit_price,discount_pct,tax_amount,channel,coupon_code
2024-01-06,2024-01-06 10:15:00,C1,100,1,1,Two,EUR,$100,7%,5,web,
2024-01-06,2024-01-06 10:15:00,C1,100,2,1,5,EUR,$100,0%,0,web,
2024-02-05,2024-02-05 23:00:00,C2,101,1,2,1,XXX,$50,0%,1,app,SAVE
bad,2024-02-05 23:00:00,C2,102,1,2,1,EUR,$50,0%,1,app,SAVE
""",
}


def write_feeds(house, files):
    from pathlib import Path

    for folder, text in files.items():
        target = Path(house.landing) / folder
        target.mkdir(parents=True, exist_ok=True)
        (target / "part.csv").write_text(text, encoding="utf-8")


@pytest.fixture
def house(tmp_path):
    tag = tmp_path.name.replace("-", "_")
    return medallion.Lakehouse(str(tmp_path), f"b_{tag}", f"s_{tag}", f"g_{tag}")


def test_full_run_and_second_day(spark, house):
    write_feeds(house, FILES)
    results = medallion.run(spark, house, {"USD": 1.1}, DAY_ONE)
    inserted = {k: r.inserted for k, r in results.items()}
    assert inserted == {
        "slv_ecommerce_brands": 2, "slv_ecommerce_products": 2, "slv_ecommerce_categories": 1,
        "slv_ecommerce_customers": 3, "slv_ecommerce_order_items": 2,
    }
    folder = results["slv_ecommerce_order_items"].rejects_folder
    reasons = sorted(r._reject_reason for r in read_rejects(spark, folder).collect())
    assert reasons == ["duplicate_key", "null_key"]

    products = {r.product_id: r for r in read_table(spark, house.products).collect()}
    assert tuple(products[1].asDict()) == gold.PRODUCT_COLUMNS
    assert (products[1].brand_name, products[1].category_name) == ("Acme", "Toys")
    assert (products[2].brand_name, products[2].category_name) == (gold.UNKNOWN, gold.UNKNOWN)
    assert (products[1].weight_grams, products[1].length_cm, products[1].width_cm) == (
        250, 12.5, 3.5,
    )
    assert products[2].rating_count is None

    customers = {r.customer_id: r for r in read_table(spark, house.customers).collect()}
    assert [customers[c].region for c in ("C1", "C2", "C3")] == ["Northeast", "West", "Other"]
    assert (customers["C1"].phone, customers["C2"].phone) == ("9876543210", "")

    fact = {r.transaction_id: r for r in read_table(spark, house.fact).collect()}
    line = fact[100]
    assert (line.quantity, line.gross_amount, line.discount_amount) == (2, 200, 15)
    assert (line.net_amount, line.net_amount_eur, line.coupon_flag) == (190, 190, 1)
    assert (line.date_id, line.transaction_date) == (20240106, date(2024, 1, 6))
    assert (fact[101].net_amount, fact[101].net_amount_eur) == (51, None)
    assert fact[101].coupon_flag == 0

    view = read_table(spark, house.view)
    expected = [*gold.FACT_COLUMNS, "hour_of_day", *gold.VIEW_PRODUCT_COLUMNS,
                *gold.VIEW_DATE_COLUMNS]
    assert view.columns == expected
    wide = {r.transaction_id: r for r in view.collect()}
    assert (wide[100].hour_of_day, wide[100].day_name, wide[100].is_weekend) == (
        10, "Saturday", True,
    )

    star = medallion.star(spark, house)
    sales = {r.category_name: r.total_sales for r in reports.sales_by_category(star).collect()}
    assert sales == {"Toys": 190, gold.UNKNOWN: 51}

    by_channel = reports.sales_by_channel(star, filters={"year": [2023, 2024]})
    assert {r.channel: r.total_sales for r in by_channel.collect()} == {"web": 190, "app": 51}
    plan = by_channel._jdf.queryExecution().executedPlan().toString()
    pruned = plan[plan.index("PartitionFilters"):]
    assert "202401" in pruned and "202312" in pruned

    # the same files again, under another name and a day later: nothing changes
    again = medallion.run(spark, house, {"USD": 1.1}, DAY_TWO)
    assert {(r.inserted, r.updated) for r in again.values()} == {(0, 0)}

    # a filter on the calendar prunes the fact behind the view
    scan = view.where("year = 2024").groupBy("channel").sum("net_amount")
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan

    # one changed line, one new month
    lines = FILES["order_items/landing"].splitlines()
    changed = lines[1].replace("$100", "$110")
    fresh = "2024-03-01,2024-03-01 01:00:00,C3,103,1,1,1,AED,$10,0%,0,web,"
    text = "\n".join([lines[0], changed, fresh]) + "\n"
    write_feeds(house, {"order_items/landing": text})
    third = medallion.run(spark, house, {"USD": 1.1}, DAY_TWO + timedelta(days=1))
    items = third["slv_ecommerce_order_items"]
    assert (items.inserted, items.updated, items.unchanged) == (1, 1, 0)
    fact = {r.transaction_id: r for r in read_table(spark, house.fact).collect()}
    assert set(fact) == {100, 101, 103}
    assert fact[100].date_creation == DAY_ONE
    assert fact[100].date_modification == DAY_TWO + timedelta(days=1)
    assert fact[103].net_amount_eur == 44


def test_reconcile_fails_on_lost_rows(frame):
    with pytest.raises(ValueError, match="2 cleaned order lines but 1"):
        reports.reconcile(frame([(1,), (2,)], "i int"), frame([(1,)], "i int"))


def test_amounts_with_fractions(frame):
    raw = frame(
        [("2024-01-06", "2024-01-06 10:00:00", "C", "1", "1", "1", "3", "EUR", "$10.25", "10%",
          "0.50", "web", "")],
        ORDER_ITEMS.schema,
    )
    points = {"unit_price": NOT_KEPT_WITH_POINT, "tax_amount": NOT_KEPT_WITH_POINT}
    types = {"unit_price": "decimal(12,2)", "tax_amount": "decimal(12,2)"}
    line = gold.line_amounts(silver.clean_order_items(raw, types=types, not_kept=points)).first()
    assert str(line.gross_amount) == "30.75"
    assert line.discount_amount == 4
    assert str(line.net_amount) == "27.25"
    whole = gold.line_amounts(silver.clean_order_items(raw)).first()
    assert (whole.unit_price, whole.gross_amount) == (1025, 3075)


def fact_files(spark, house):
    rows = read_table(spark, house.fact).select("date_month", "_metadata.file_path").distinct()
    return {r.date_month: r.file_path for r in rows.collect()}


def test_incremental_days_and_settings(spark, house):
    """A second day rewrites only the fact months it touches; a mistyped year is published."""
    settings = medallion.Settings(
        item_keys=("dt", "order_id", "item_seq"), item_partition="day", thousands=("unit_price",),
        not_kept={"unit_price": r"[^0-9,]"}, coupon_when_empty=0, direction="divide",
    )
    write_feeds(house, FILES)
    first = medallion.run(spark, house, {"USD": 2.0}, DAY_ONE, settings, incremental=True)
    lost = first["slv_ecommerce_order_items"].lost_in_casts
    assert lost["dt"] == 1 and lost["unit_price"] == 0 and lost["quantity"] == 0
    assert first["slv_ecommerce_order_items"].inserted == 3  # both lines of order 100
    before = fact_files(spark, house)
    head = FILES["order_items/landing"].splitlines()[0]
    text = "\n".join(
        [head, "2024-01-07,2024-01-07 01:00:00,C3,103,1,1,1,USD,\"$1,234\",0%,0,web,",
         "0204-01-06,2024-01-06 01:00:00,C3,104,1,1,1,EUR,$10,0%,0,web,X"]
    )
    write_feeds(house, {"order_items/landing": text + "\n"})
    medallion.run(spark, house, {"USD": 2.0}, DAY_TWO, settings, incremental=True)
    after = fact_files(spark, house)
    assert set(after) == {20401, 202401, 202402} and after[202402] == before[202402]
    assert after[202401] != before[202401]
    wide = {(r.transaction_id, r.seq_no): r for r in read_table(spark, house.view).collect()}
    assert len(wide) == 5 and wide[104, 1].year == 204
    line = wide[103, 1]
    assert (line.unit_price, line.net_amount_eur, line.coupon_flag) == (1234, 617, 0)


def test_strict_casts_fail(spark, house):
    write_feeds(house, FILES)
    with pytest.raises(Exception, match="bad"):
        medallion.run(spark, house, {}, DAY_ONE, medallion.Settings(strict=True))
