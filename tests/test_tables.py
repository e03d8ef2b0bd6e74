import pytest
from pyspark.sql import functions as F

from conftest import DAY_ONE, SOME_DAY
from goldvein.sources import feeds, rejects, tables


def pairs(df):
    return sorted(tuple(r) for r in df.collect())


def test_zones(spark, zone):
    tables.create_zone(spark, zone)
    assert zone.name in {r[0] for r in tables.list_zones(spark).collect()}


def test_overwrite_and_append(spark, frame, zone):
    table = zone.table("t")
    assert not tables.table_exists(spark, table)
    tables.save_table(frame([(1, "a")], "i int, s string"), table)
    tables.save_table(frame([(2, "b", 2.5)], "i long, s string, d double"), table, "append")
    tables.save_table(frame([("c",)], "s string"), table, "append")
    got = tables.read_table(spark, table)
    assert [f.dataType.simpleString() for f in got.schema] == ["int", "string", "double"]
    rows = {r.s: (r.i, r.d) for r in got.collect()}
    assert rows == {"a": (1, None), "b": (2, 2.5), "c": (None, None)}
    tables.save_table(frame([("z", "y")], "other string, s string"), table)
    got = tables.read_table(spark, table)
    assert got.columns == ["i", "s", "d", "other"]
    assert [tuple(r) for r in got.collect()] == [(None, "y", None, "z")]
    tables.overwrite_table(frame([("z",)], "other string"), table)
    assert pairs(tables.read_table(spark, table)) == [("z",)]
    with pytest.raises(ValueError):
        tables.save_table(frame([("z",)], "other string"), table, "upsert")


def test_a_table_can_be_rebuilt_from_itself(spark, frame, zone):
    table = zone.table("self")
    tables.save_table(frame([(1,), (2,)], "i int"), table)
    doubled = tables.read_table(spark, table).select((F.col("i") * 2).alias("i"))
    tables.save_table(doubled, table)
    assert pairs(tables.read_table(spark, table)) == [(2,), (4,)]


def test_a_failed_overwrite_leaves_the_table(spark, frame, zone):
    table = zone.table("safe")
    tables.save_table(frame([(1,)], "i int"), table)
    broken = frame([(1,)], "i int").select(F.raise_error(F.lit("boom")).cast("int").alias("i"))
    with pytest.raises(Exception, match="boom"):
        tables.save_table(broken, table)
    assert pairs(tables.read_table(spark, table)) == [(1,)]


def test_partitioned_table(spark, frame, zone):
    table = zone.table("parts")
    df = frame([(1, "a"), (2, "b"), (3, "b")], "i int, p string")
    tables.save_table(df, table, partition_by=["p"])
    assert tables.partition_columns(spark, table) == ["p"]
    tables.save_table(frame([(4, "c", True)], "i int, p string, x boolean"), table, "append")
    assert len(tables.read_table(spark, table).collect()) == 4
    current = tables.read_table(spark, table).where("p = 'b'")
    tables.replace_partitions(current.withColumn("i", F.col("i") * 10), table)
    got = {(r.i, r.p) for r in tables.read_table(spark, table).collect()}
    assert got == {(1, "a"), (20, "b"), (30, "b"), (4, "c")}


def test_empty_table(spark, frame, zone):
    table = zone.table("empty")
    tables.create_empty(spark, frame([(1, "a")], "i int, s string"), table, ["s"])
    got = tables.read_table(spark, table)
    assert got.columns == ["i", "s"] and got.count() == 0


def test_views(spark, frame, zone):
    table, view = zone.table("base"), zone.table("v")
    tables.save_table(frame([(1,), (5,)], "i int"), table)
    tables.publish_view(spark, view, f"SELECT max(i) AS top FROM {table.sql_name}")
    assert pairs(tables.read_table(spark, view)) == [(5,)]
    tables.save_table(frame([(9,)], "i int"), table)
    assert pairs(tables.read_table(spark, view)) == [(9,)]
    tables.register_views(named=frame([(3,)], "i int"))
    assert pairs(spark.sql("SELECT * FROM named")) == [(3,)]


def test_feed_scan(spark, tmp_path):
    folder = tmp_path / "products"
    folder.mkdir()
    (folder / "a.csv").write_text(
        "id;x;\n1;SKU;cat;b;red;M;wool;250g;12,5;3,5;4,5;10\n", encoding="utf-8"
    )
    semicolon = feeds.Feed("p", "products", feeds.PRODUCTS.schema, ";")
    df = feeds.scan_feed(spark, str(tmp_path), semicolon, F.lit(DAY_ONE))
    row = df.first()
    assert (row.product_id, row.width_cm, row.height_cm) == (1, "3,5", "4,5")
    assert row._source_file.endswith("/products/a.csv") and row._ingested_at == DAY_ONE
    assert df.columns[-2:] == ["_source_file", "_ingested_at"]


def test_feed_schemas(spark):
    widths = {f.name: len(spark.createDataFrame([], f.schema).columns) for f in feeds.FEEDS}
    assert widths == {
        "ecommerce_brands": 3, "ecommerce_products": 12, "ecommerce_categories": 2,
        "ecommerce_customers": 5, "ecommerce_order_items": 13,
    }


def test_rejects_of_a_batch_are_written_once(spark, frame, tmp_path):
    turned_away = frame([(1, "two\nlines")], "i int, t string")
    for hour in (6, 6, 7):
        time = DAY_ONE.replace(hour=hour)
        folder = rejects.write_rejects(turned_away, str(tmp_path) + "/", "t", time, "why")
    assert folder == f"{tmp_path}/t_rejets/2024-01-01/"
    assert pairs(rejects.read_rejects(spark, folder)) == [(1, "two\nlines", "why")] * 2
