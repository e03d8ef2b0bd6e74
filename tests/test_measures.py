import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from goldvein.checks import standin
from goldvein.operators import sizes
from goldvein.operators.measures import LINES, Measure, Star, dimension
from goldvein.plans import reports

FACT = [
    # product, day, channel, amount
    (1, 20240101, "web", 10),
    (1, 20240106, "web", 5),
    (1, 20250101, "app", 7),
    (2, 20240101, "app", 1),
    (3, 20240106, "web", 2),
    (9, 20240106, "web", 100),
    (None, 20240101, None, 50),
]
PRODUCTS = {1: ("A", 3), 2: ("B", 4), 3: ("A", 5)}
DAYS = {20240101: (2024, 1), 20240106: (2024, 6), 20250101: (2025, 1)}
SALES = Measure("sales", "sum", "amount")
WEIGHT = Measure("weight", "sum", "weight")


@pytest.fixture(params=["small", "large"])
def star(frame, request):
    products = frame(
        [(k, *v) for k, v in PRODUCTS.items()], "id int, category string, weight int"
    )
    days = frame([(k, *v) for k, v in DAYS.items()], "date_key int, year int, day int")
    return Star(
        frame(FACT, "product int, date_id int, channel string, amount int"),
        (
            dimension(
                products, "product", "id", ["category", "weight"], small=request.param == "small"
            ),
            dimension(days, "date_id", "date_key", ["year", "day"], small=True,
                      implied=reports.dates_of(days).implied),
        ),
        {"is_web": F.col("channel") == "web"},
    )


def expected(by, test=lambda row: True):
    out = defaultdict(lambda: [0, 0, None])
    for product, day, channel, amount in FACT:
        category, weight = PRODUCTS.get(product, (None, None))
        row = {"category": category, "channel": channel, "year": DAYS[day][0], "day": DAYS[day][1],
               "is_web": None if channel is None else channel == "web"}
        if not test(row):
            continue
        group = out[tuple(row[c] for c in by)]
        group[0] += amount
        group[1] += 1
        if weight is not None:
            group[2] = (group[2] or 0) + weight
    return {k: tuple(v) for k, v in out.items()}


def result(df, by):
    return {tuple(r[c] for c in by): (r.sales, r.n_lines, r.weight) for r in df.collect()}


@pytest.mark.parametrize(
    "by", [["category"], ["channel"], ["category", "channel"], ["year", "category"], ["is_web"], []]
)
def test_groups(star, by):
    assert result(star.aggregate(by, [SALES, LINES, WEIGHT]), by) == expected(by)


def test_filters(star):
    filters = {"category": "A", "year": [2024], "channel": None, "day": []}
    got = result(star.aggregate(["channel"], [SALES, LINES, WEIGHT], filters), ["channel"])
    assert got == expected(["channel"], lambda r: r["category"] == "A" and r["year"] == 2024)


def test_empty_total(star):
    row = star.aggregate([], [SALES, LINES], {"category": "none"}).first()
    assert (row.sales, row.n_lines) == (None, 0)


def test_cube(star):
    by = ["category", "channel"]
    cubed = star.cube(by, [SALES, LINES, WEIGHT])
    got = {}
    for r in cubed.collect():
        key = tuple(r[c] for i, c in enumerate(by) if not r.grouping_id & (2 >> i))
        got[(r.grouping_id, key)] = (r.sales, r.n_lines, r.weight)
    wanted = {}
    for grouping, columns in ((0, by), (1, by[:1]), (2, by[1:]), (3, [])):
        wanted.update({(grouping, k): v for k, v in expected(columns).items()})
    assert got == wanted


def test_filter_values(star):
    filters = {"category": "A", "year": [2024], "day": [6, 1]}
    got = {r.category: r.category_associativity for r in
           star.filter_values("category", filters).collect()}
    assert got == {"A": 3, "B": 1, None: 2}
    years = {r.year: r.year_associativity for r in star.filter_values("year", filters).collect()}
    assert years == {2024: 3, 2025: 1}


def test_wide_joins_only_what_is_asked(star):
    plan = star.wide(["channel", "amount"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
    assert star.wide(["amount", "category", "year"]).count() == len(FACT)


def test_hot_product_is_summed_before_the_join(star):
    plan = star.aggregate(["category"], [SALES])._jdf.queryExecution().optimizedPlan().toString()
    below_join = plan[plan.index("Join"):]
    assert ("Aggregate" in below_join) == (not star.dimensions[0].small)


def test_implied_filter_reaches_the_fact(star):
    df = star.aggregate(["channel"], [SALES], {"year": 2025})
    assert "20250101" in df._jdf.queryExecution().optimizedPlan().toString()
    assert {r.channel: r.sales for r in df.collect()} == {"app": 7}


def test_rows_meet_a_large_dimension_before_anything_widens_them(star):
    if star.dimensions[0].small:
        pytest.skip("for large dimensions")
    df = star.aggregate(["category", "year", "is_web"], [SALES, LINES])
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1
    below = star.wide(["amount", "category", "year", "is_web"])._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in below.splitlines() if "Join " in line]  # from the last one down to the first
    assert len(joins) == 2 and "date_id" in joins[0] and "product" in joins[1]
    assert "AS is_web" in below and "AS is_web" not in below[below.rindex("Join "):]


def test_a_filter_on_a_small_dimension_comes_before_the_large_one(star):
    filters = {"year": [2024], "category": "A"}
    got = sorted((r.amount, r.is_web) for r in star.wide(["amount", "is_web"], filters).collect())
    assert got == [(2, True), (5, True), (10, True)]


def test_filter_values_sum_the_rows_of_a_large_dimension_once(star):
    df = star.filter_values("year", {"category": "A", "year": [2024], "channel": "web"})
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 2  # the rows, then their groups
    assert {r.year: r.year_associativity for r in df.collect()} == {2024: 3, 2025: 0}


def filters_met(star, column):
    filters = {"category": "A", "weight": [3, 5], "year": [2024], "channel": "web"}
    return star.filter_values(column, filters)


def test_only_the_keys_that_pass_of_a_large_dimension_meet_the_rows(star):
    df = filters_met(star, "day")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    # counted again they are few, so nothing is shuffled by the large key
    assert plan.count("strategy=broadcast") == plan.count("Join ") == 2
    assert {r.day: r.day_associativity for r in df.collect()} == {1: 1, 6: 2}


def test_keys_that_repeat_or_are_null_count_as_in_a_join(star, frame):
    rows = [(1, "A", 3), (1, "A", 5), (1, "B", 3), (None, "A", 3), (3, None, 5), (9, "A", None)]
    repeated = frame(rows, "id int, category string, weight int")
    told = []
    for small in (True, False):
        products = dimension(repeated, "product", "id", ["category", "weight"], small=small)
        counted = filters_met(Star(star.fact, (products, star.dimensions[1])), "day").collect()
        told.append({r.day: r.day_associativity for r in counted})
    assert told[0] == told[1] == {1: 2, 6: 2}


def joins(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line.split("Join")[0].split()[-1] for line in plan.splitlines() if "Join " in line]


def test_sums_hold_a_large_dimension_and_not_the_rows(star, frame, monkeypatch, spark):
    monkeypatch.setattr(sizes, "SMALL_ROWS", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        products = frame([(k, *v) for k, v in PRODUCTS.items()], "id int, category string, weight int")
        large = dimension(products, "product", "id", ["category", "weight"], small_rows=1)
        wide = Star(star.fact, (large, star.dimensions[1]))
        summed = wide.filter_values("year", {"channel": "web"})
        assert "SortMerge" not in joins(summed)
        by_both = wide.aggregate(["category", "year"], [SALES])
        assert "ShuffledHash" in joins(by_both) and "SortMerge" not in joins(by_both)
        assert "SortMerge" in joins(wide.wide(["amount", "category"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_what_does_not_fit_a_task_is_sorted(frame, spark):
    df = frame([(1, "a")], "id int, t string")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = 2 * sizes.SMALL_ROWS

    def hinted(taken):
        return "shuffle_hash" in sizes.hash_if(df, (rows, taken))._jdf.queryExecution().logical().toString()

    assert hinted(rows) and not hinted(parts * sizes.HASHED_BYTES)
    assert sizes.hash_if(df, (sizes.SMALL_ROWS, 0)) is df
    assert sizes.counted_size(df) == (1, 2 * sizes.VALUE_BYTES + 1)


def test_heads_that_do_not_fit_are_cut_into_more_parts_and_not_sorted(frame, spark, tmp_path, monkeypatch):
    heads = [(1, 7, "web"), (2, 8, "app"), (2, 9, "web"), (3, 7, "web"), (None, 5, "app")]
    rows = frame(heads, "o_orderkey long, o_custkey long, o_orderpriority string")
    rows.withColumn("o_orderdate", F.lit("2024-01-06").cast("timestamp_ntz")).write.parquet(f"{tmp_path}/orders.parquet")
    lines = [(1, 1), (1, 2), (2, 1), (None, 1), (4, 1)]
    rows = frame(lines, "l_orderkey long, l_linenumber int").withColumns({"l_partkey": F.lit(1), "l_returnflag": F.lit("N")})
    amounts = {f"l_{c}": F.lit(1.0) for c in ("quantity", "extendedprice", "discount", "tax")}
    rows.withColumns(amounts).write.parquet(f"{tmp_path}/lineitem.parquet")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    counted = (10_000_000, parts * sizes.HASHED_BYTES)  # as if they were that many
    monkeypatch.setattr(standin, "counted_size", lambda df: counted)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        items = standin.plain_items(spark, str(tmp_path)).select("order_id", "item_seq", "o_custkey")
        assert joins(items) == ["ShuffledHash"]
        wanted = -(-(counted[1] + 3 * sizes.VALUE_BYTES * counted[0]) // sizes.PART_BYTES)
        plan = items._jdf.queryExecution().executedPlan().toString()
        assert len(re.findall(rf"hashpartitioning\(order_id#\d+L, {wanted}\)", plan)) == 2
        assert sorted(items.collect()) == [(1, 1, 7), (1, 2, 7), (2, 1, 8), (2, 1, 9)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_parts_grow_in_number_with_a_frame_and_not_in_size(frame, spark):
    df = frame([(1, "a")], "id int, t string")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for times in (1, 3, 30):
        rows = 3 * times * sizes.SMALL_ROWS
        taken = times * parts * sizes.PART_BYTES
        cut = sizes.hash_if(df, (rows, taken), key="id")
        plan = cut._jdf.queryExecution().logical().toString()
        number = int(re.search(r"RepartitionByExpression \[id#\d+\], (\d+)", plan)[1])
        assert "shuffle_hash" in plan
        assert (taken + 3 * sizes.VALUE_BYTES * rows) / number <= sizes.PART_BYTES
    few = sizes.hash_if(df, (sizes.SMALL_ROWS + 1, 0), key="id")._jdf.queryExecution().logical().toString()
    assert "shuffle_hash" in few and "Repartition" not in few  # the session's parts will do
    assert sizes.hash_if(df, (sizes.SMALL_ROWS, 0), key="id") is df
