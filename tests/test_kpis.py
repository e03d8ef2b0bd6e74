"""Bitmaps, quantiles, one-scan figures, maintained sums and clustered files."""

import random

import pytest
from pyspark.sql import functions as F

from goldvein.checks.reports import _FILTERS, star
from goldvein.operators import layout
from goldvein.operators.bitmaps import distinct_bitmaps, distinct_counts, merged_bitmaps
from goldvein.operators.maintained import ROWS, SIGN, images, load_report
from goldvein.operators.quantiles import with_ntile
from goldvein.plans import reports
from goldvein.sources.tables import read_table

SF_DIR = "/root/testdata/sf0.001"
R = random.Random


@pytest.fixture(scope="module")
def built(spark):
    return star(spark, SF_DIR, "products", "dates")


def scans(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("lineitem.parquet")


def plain(df, columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def test_all_widgets_come_from_one_scan(built):
    figures = reports.all_widgets(built)
    assert scans(figures) == 1
    figures = figures.cache()
    for name in reports.WIDGETS:
        if name == "grand_total":
            continue
        own = getattr(reports, name)(built)
        columns = [c for c in own.columns if c not in ("grouping_id",)]
        assert plain(reports.widget(figures, name), columns) == plain(own, columns), name
    total = reports.widget(figures, "grand_total").collect()
    assert [r.total_sales for r in total] == [reports.grand_total(built).first().total_sales]
    figures.unpersist()


def test_all_filter_lists_come_from_one_scan(built):
    lists = built.filter_lists(list(_FILTERS), _FILTERS)
    assert scans(lists) == 1
    got = lists.collect()
    for column in _FILTERS:
        own = built.filter_values(column, _FILTERS).collect()
        want = {(None if r[0] is None else str(r[0]), r[1]) for r in own}
        assert {(r.value, r.n_rows) for r in got if r["column"] == column} == want
    # an unset filter fails nothing
    free = built.filter_lists(["year"], {"year": None, "day_name": []}).collect()
    assert sum(r.n_rows for r in free) == built.fact.count()


def test_bitmaps_count_what_distinct_counts(spark):
    r = R(5)
    rows = [(r.choice("ab"), r.choice([1, 2, None]), r.choice([r.randrange(1, 200), r.randrange(1, 10**6), 32768, 32769, -1, None])) for _ in range(2000)]
    df = spark.createDataFrame(rows, "g string, h int, n long")
    stored = distinct_bitmaps(df, ["g", "h"], "n")
    for by in (["g", "h"], ["g"], []):
        want = df.where("n > 0").groupBy(*by).agg(F.count_distinct("n").alias("c"))
        assert plain(distinct_counts(stored, by, "c"), [*by, "c"]) == plain(want, [*by, "c"])
    twice = merged_bitmaps(stored.unionByName(stored), ["g", "h"])
    assert plain(distinct_counts(twice, ["g"], "c"), ["g", "c"]) == plain(distinct_counts(stored, ["g"], "c"), ["g", "c"])
    assert distinct_counts(stored.limit(0), [], "c").first().c == 0


@pytest.mark.parametrize("n", [0, 1, 3, 5, 7, 23, 100])
def test_ntile_like_the_window(spark, n):
    rows = spark.range(n).select(((F.col("id") * 37) % 101).alias("v"), "id")
    got = with_ntile(rows, 5, ["v", "id"], "part")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SinglePartition" not in plan
    want = rows.selectExpr("*", "ntile(5) OVER (ORDER BY v, id) AS part")
    assert plain(got, ["id", "part"]) == plain(want, ["id", "part"])


def test_maintained_sums_equal_a_recount(spark, zone):
    r, table = R(9), zone.table("report")
    schema = "k int, day int, shop string, cents long"
    state, by, sums = {}, ["day", "shop"], {"cents": F.col("cents")}
    now, stamp = F.lit("2024-01-01").cast("timestamp"), "_ingested_at"

    def frame():
        return spark.createDataFrame([(k, *v) for k, v in state.items()], schema)

    def audited(df):
        return df.withColumns({"date_creation": now, "date_modification": now})

    for load in range(4):
        days = [load + 1, load + 2]
        batch = {k: (r.choice(days), r.choice(["a", "b", None]), r.randrange(1000)) for k in r.sample(range(60), 25)}
        if load == 2:
            batch = {k: state[k] for k in list(state)[:10]}  # nothing new
        rows = spark.createDataFrame([(k, *v) for k, v in batch.items()], schema).withColumn(stamp, now)
        if load == 0:
            changes = rows.drop(stamp).withColumn(SIGN, F.lit(1))
        else:
            changes = images(audited(frame()), rows, ["k"], now)
        touched = load_report(changes, table, by, sums, ["day"])
        if load == 2:
            assert touched == 0
        state |= batch
        want = frame().groupBy(*by).agg(F.sum("cents").alias("cents"), F.count("*").alias(ROWS))
        assert plain(read_table(spark, table), [*by, "cents", ROWS]) == plain(want, [*by, "cents", ROWS])


def test_a_load_reads_only_touched_groups(spark, zone):
    table = zone.table("report")
    rows = spark.createDataFrame([(k, k % 5, k) for k in range(50)], "k int, day int, cents long")
    load_report(rows.withColumn(SIGN, F.lit(1)), table, ["day"], {"cents": F.col("cents")}, ["day"])
    before = {d: read_table(spark, table).where(F.col("day") == d).inputFiles() for d in range(5)}
    one = spark.createDataFrame([(7, 2, 1000, 1), (7, 2, 7, -1)], f"k int, day int, cents long, {SIGN} int")
    assert load_report(one, table, ["day"], {"cents": F.col("cents")}, ["day"]) == 1
    after = {d: read_table(spark, table).where(F.col("day") == d).inputFiles() for d in range(5)}
    assert [d for d in range(5) if before[d] != after[d]] == [2]


def test_clustered_files_are_skipped_on_either_column(spark, tmp_path):
    rows = spark.range(20_000).select(
        ((F.col("id") * 7919) % 1000).cast("int").alias("a"),
        F.date_add(F.lit("2024-01-01").cast("date"), ((F.col("id") * 104_729) % 365).cast("int")).alias("d"),
        F.when(F.col("id") % 50 > 0, F.concat(F.lit("n"), F.col("id") % 97)).alias("t"),
    )
    laid = layout.clustered(rows, ["a", "d"], files=64)
    assert laid.columns == rows.columns and plain(laid, rows.columns) == plain(rows, rows.columns)

    def files_for(path, test):
        boxes = spark.read.parquet(path).groupBy(F.input_file_name().alias("f")).agg(
            F.min("a").alias("a0"), F.max("a").alias("a1"), F.min("d").alias("d0"), F.max("d").alias("d1"))
        return boxes.where(test).count()

    laid.write.parquet(f"{tmp_path}/both")
    rows.repartitionByRange(64, "a").write.parquet(f"{tmp_path}/one")
    on_a, on_d = "a1 >= 100 AND a0 <= 110", "d1 >= DATE '2024-03-01' AND d0 <= DATE '2024-03-05'"
    assert files_for(f"{tmp_path}/one", on_d) == 64
    assert files_for(f"{tmp_path}/both", on_d) <= 20 and files_for(f"{tmp_path}/both", on_a) <= 20
    assert files_for(f"{tmp_path}/both", f"{on_a} AND {on_d}") <= 6


def test_texts_and_nulls_can_be_clustered(spark):
    rows = spark.createDataFrame([(None, 1.0), ("", None), ("abc", 2.0), ("abcdefgh", float("nan")), ("ü", -5.0)], "t string, x double")
    laid = layout.clustered(rows, ["t", "x"], files=2)
    assert plain(laid, ["t"]) == plain(rows, ["t"]) and laid.count() == 5
    order = [r.t for r in rows.where("t is not null").orderBy(layout.as_number(rows, "t")).collect()]
    assert order == sorted(order, key=lambda t: t.encode()[:6])
    with pytest.raises(ValueError):
        layout.clustered(rows, ["t", "x"], files=2, bits=40)
