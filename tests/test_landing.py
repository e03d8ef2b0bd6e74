"""Landing files that are read once, and broken rows that are set aside."""

from pathlib import Path

import pytest

from conftest import DAY_ONE, DAY_TWO
from goldvein.plans import medallion, silver
from goldvein.sources import quarantine
from goldvein.sources.feeds import BRANDS, PRODUCTS
from goldvein.sources.rejects import read_rejects, rejects_folder
from goldvein.sources.tables import partition_values_of, read_table
from goldvein.streaming import landing

from test_medallion import FILES, house, write_feeds  # noqa: F401


def land(root, name, text):
    folder = Path(root) / "landing" / BRANDS.folder
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("brand_code,brand_name,category_code\n" + text, encoding="utf-8")


def run(spark, root, zone, day, **options):
    return landing.ingest_new(
        spark, f"{root}/landing", BRANDS, zone.table("brands"), f"{root}/ledger", f"{root}/rejects", day, **options
    )


def rows(spark, zone):
    table = read_table(spark, zone.table("brands"))
    return sorted((r.brand_code, r[landing.LOAD], Path(r._source_file).name) for r in table.collect())


def test_each_file_is_read_once(spark, zone, tmp_path):
    land(tmp_path, "one.csv", "A,a,x\nB,b,x\n")
    first = run(spark, tmp_path, zone, DAY_ONE)
    assert (first.loads, first.rows, first.rejected) == ((0,), 2, {})
    land(tmp_path, "two.csv", "C,c,x\n")
    second = run(spark, tmp_path, zone, DAY_TWO)
    assert (second.loads, second.rows) == ((1,), 1)
    assert run(spark, tmp_path, zone, DAY_TWO) == landing.Landed()
    assert rows(spark, zone) == [("A", 0, "one.csv"), ("B", 0, "one.csv"), ("C", 1, "two.csv")]
    # the second day's rows come from the partition of their load alone
    plan = landing.loaded(spark, zone.table("brands"), (1,))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [_load" in plan or "_load#" in plan.split("PartitionFilters:")[1].split("]")[0]
    assert [Path(f).parent.name for f in landing.loaded(spark, zone.table("brands"), (1,)).inputFiles()] == ["_load=1"]


def test_a_run_that_breaks_off_loses_and_repeats_nothing(spark, zone, tmp_path):
    land(tmp_path, "one.csv", "A,a,x\n")
    run(spark, tmp_path, zone, DAY_ONE)
    land(tmp_path, "two.csv", "B,b,x\nC,c\n")

    def fails(load):
        raise RuntimeError("lost the driver")

    with pytest.raises(Exception, match="lost the driver"):
        run(spark, tmp_path, zone, DAY_TWO, stored=fails)
    assert rows(spark, zone) == [("A", 0, "one.csv"), ("B", 1, "two.csv")]
    land(tmp_path, "three.csv", "D,d,x\n")
    again = run(spark, tmp_path, zone, DAY_TWO)
    assert again.loads == (1, 2) and again.rejected == {quarantine.TOO_FEW: 1}
    assert rows(spark, zone) == [("A", 0, "one.csv"), ("B", 1, "two.csv"), ("D", 2, "three.csv")]
    folder = rejects_folder(f"{tmp_path}/rejects", "brands/load=1", DAY_TWO.date())
    assert [r[quarantine.RECORD] for r in read_rejects(spark, folder).collect()] == ["C,c"]


def test_a_backlog_comes_in_bounded_loads(spark, zone, tmp_path):
    for n in range(5):
        land(tmp_path, f"f{n}.csv", f"K{n},k,x\n")
    done = run(spark, tmp_path, zone, DAY_ONE, max_files=2)
    assert done.loads == (0, 1, 2) and done.rows == 5
    assert sorted(partition_values_of(spark, zone.table("brands"))) == [(0,), (1,), (2,)]


def test_full_runs_on_new_files(spark, house):  # noqa: F811
    def parts(folder, name, text):
        target = Path(house.landing) / folder
        (target / name).write_text(text, encoding="utf-8")

    write_feeds(house, FILES)
    first = medallion.run(spark, house, {"USD": 1.1}, DAY_ONE, incremental=True, new_files=True)
    assert first["slv_ecommerce_order_items"].inserted == 2 and len(first) == 5
    head = FILES["order_items/landing"].splitlines()[0]
    parts("order_items/landing", "late.csv", f"{head}\n2024-02-06,2024-02-06 10:00:00,C1,200,1,2,3,EUR,$10,0%,0,app,\n")
    second = medallion.run(spark, house, {"USD": 1.1}, DAY_TWO, incremental=True, new_files=True)
    assert set(second) == {"slv_ecommerce_order_items"}
    lines = second["slv_ecommerce_order_items"]
    assert (lines.inserted, lines.updated, lines.unchanged, lines.touched) == (1, 0, 0, ((202402,),))
    assert read_table(spark, house.fact).count() == 3
    assert medallion.run(spark, house, {"USD": 1.1}, DAY_TWO, incremental=True, new_files=True) == {}


def test_a_load_is_refined_again_until_it_is_published(spark, house, monkeypatch):  # noqa: F811
    write_feeds(house, FILES)

    def fails(*args, **kwargs):
        raise RuntimeError("lost the driver")

    with monkeypatch.context() as m:
        m.setattr(medallion, "publish", fails)
        with pytest.raises(RuntimeError):
            medallion.run(spark, house, {"USD": 1.1}, DAY_ONE, new_files=True)
    results = medallion.run(spark, house, {"USD": 1.1}, DAY_TWO, incremental=True, new_files=True)
    lines = results[silver.ORDER_ITEMS.name]
    assert (lines.inserted, lines.updated, lines.unchanged) == (0, 0, 2)
    assert read_table(spark, house.fact).count() == 2
    assert medallion.pending_loads(spark, house, PRODUCTS) == ()


TEXT = """product_id,sku,category_code,brand_code,color,size,material,weight_grams,length_cm,width_cm,height_cm,rating_count
1,S-1,toy,acm,red,M,wood,250g,"12,5","3,5",4,10
2,S-2,toy,acm
3,S-3,toy,acm,red,M,wood,250g,1,2,3,10,more,and more
four,S-4,toy,acm,red,M,wood,250g,1,2,3,10
5,"S,5",,,,,,,,,,
6,S-6,,,,,,,,,
7,S-7,toy,acm,red,M,wood,250g,1,2,3,1.5
8,S-8,,,,,,,,,,,
"""


def test_broken_rows_are_told_apart_in_one_pass(spark, tmp_path):
    (tmp_path / "p.csv").write_text(TEXT, encoding="utf-8")
    found = quarantine.sorted_out(quarantine.scan_csv(spark, str(tmp_path / "p.csv"), PRODUCTS.schema))
    assert sorted(r.product_id for r in found.sound.collect()) == [1, 5]
    got = {r[quarantine.RECORD].split(",")[0]: r[quarantine.REASON] for r in found.broken.collect()}
    assert got == {"2": "too_few_columns", "3": "too_many_columns", "four": "wrong_type", "6": "too_few_columns", "7": "wrong_type", "8": "too_many_columns"}
    assert found.rows == 2 and found.rejected == {"too_few_columns": 2, "too_many_columns": 2, "wrong_type": 2}
    assert found.sound.columns == quarantine.declared(PRODUCTS.schema).names


def test_nothing_to_sort_out(spark, tmp_path):
    (tmp_path / "p.csv").write_text(TEXT.splitlines()[0] + "\n", encoding="utf-8")
    found = quarantine.sorted_out(quarantine.scan_csv(spark, str(tmp_path / "p.csv"), PRODUCTS.schema))
    assert (found.rows, found.rejected, found.sound.count(), found.broken.count()) == (0, {}, 0, 0)
