from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from conftest import DAY_ONE, DAY_TWO
from goldvein.operators import upsert
from goldvein.sources import tables
from goldvein.sources.rejects import read_rejects
from goldvein.sources.tables import read_table, table_exists, table_location

NOW = DAY_TWO + timedelta(hours=1)
LATER = NOW + timedelta(days=1)
TARGET = "k int, v string, w int, _source_file string, date_creation timestamp,"
TARGET += " date_modification timestamp"
BATCH = "k int, v string, w int, _source_file string, _ingested_at timestamp"

TARGET_ROWS = [
    (1, "same", 1, "f1", DAY_ONE, DAY_ONE),
    (2, "old", 1, "f1", DAY_ONE, DAY_ONE),
    (3, None, 1, "f1", DAY_ONE, DAY_ONE),
    (4, "value", 1, "f1", DAY_ONE, DAY_ONE),
    (5, "only here", 1, "f1", DAY_ONE, DAY_ONE),
    (6, None, None, "f1", DAY_ONE, DAY_ONE),
]
BATCH_ROWS = [
    (1, "same", 1, "f2", DAY_TWO),
    (2, "new", 1, "f2", DAY_TWO),
    (3, "value", 1, "f2", DAY_TWO),
    (4, None, 1, "f2", DAY_TWO),
    (6, None, None, "f2", DAY_TWO),
    (7, "fresh", 1, "f2", DAY_TWO),
]


def by_key(df):
    return {r.k: r.asDict() for r in df.collect()}


@pytest.mark.parametrize("small", [True, False])
def test_every_kind_of_row(frame, small):
    merged = upsert.merge_batch(
        frame(TARGET_ROWS, TARGET), frame(BATCH_ROWS, BATCH), ["k"], F.lit(NOW), small_batch=small
    )
    rows = by_key(merged)
    changes = {k: r["_change"] for k, r in rows.items()}
    assert changes == {
        1: "unchanged", 2: "update", 3: "update", 4: "update", 5: "kept", 6: "unchanged",
        7: "insert",
    }
    assert rows[2]["v"] == "new" and rows[3]["v"] == "value" and rows[4]["v"] is None
    assert rows[1]["_source_file"] == "f1" and rows[2]["_source_file"] == "f2"
    for k in (1, 5, 6):
        assert rows[k]["date_creation"] == rows[k]["date_modification"] == DAY_ONE
    for k in (2, 3, 4):
        assert (rows[k]["date_creation"], rows[k]["date_modification"]) == (DAY_ONE, NOW)
    assert (rows[7]["date_creation"], rows[7]["date_modification"]) == (DAY_TWO, NOW)
    counts = {r._change: r.n_rows for r in upsert.change_counts(merged).collect()}
    assert counts == {"unchanged": 2, "update": 3, "kept": 1, "insert": 1}


@pytest.mark.parametrize("small", [True, False])
def test_second_run_changes_nothing(frame, small):
    batch = frame(BATCH_ROWS, BATCH)
    options = {"small_batch": small}
    once = upsert.merge_batch(frame(TARGET_ROWS, TARGET), batch, ["k"], F.lit(NOW), **options)
    state = upsert.without_change(once)
    again = upsert.merge_batch(state, batch, ["k"], F.lit(LATER), **options)
    assert {r["_change"] for r in by_key(again).values()} == {"unchanged", "kept"}
    assert by_key(upsert.without_change(again)) == by_key(state)


def test_source_file_counts_when_asked(frame):
    merged = upsert.merge_batch(
        frame(TARGET_ROWS, TARGET), frame(BATCH_ROWS, BATCH), ["k"], F.lit(NOW), compare_ignore=()
    )
    assert by_key(merged)[1]["_change"] == "update"


@pytest.mark.parametrize("small", [True, False])
def test_new_and_absent_columns(frame, small):
    batch = frame([(1, "n", DAY_TWO), (9, "n", DAY_TWO)], "k int, extra string, _ingested_at timestamp")
    merged = upsert.merge_batch(
        frame(TARGET_ROWS, TARGET), batch, ["k"], F.lit(NOW), small_batch=small
    )
    rows = by_key(merged)
    assert rows[1]["extra"] == "n" and rows[1]["v"] == "same" and rows[1]["_change"] == "update"
    assert rows[2]["extra"] is None and rows[2]["_change"] == "kept"
    assert rows[9]["v"] is None and rows[9]["_change"] == "insert"


def test_load_time_is_required(frame):
    with pytest.raises(ValueError, match="_ingested_at"):
        upsert.merge_batch(
            frame(TARGET_ROWS, TARGET),
            frame(BATCH_ROWS, BATCH).drop("_ingested_at"),
            ["k"],
            F.lit(NOW),
        )


@pytest.mark.parametrize("small_batch_rows", [0, 100])
def test_table_loads(spark, frame, zone, tmp_path, small_batch_rows):
    table = zone.table("t")
    options = {"rejects_root": str(tmp_path / "rejects"), "small_batch_rows": small_batch_rows}
    first = [(1, "a", 1, "f1", DAY_ONE), (1, "b", 1, "f1", DAY_ONE), (2, "c", 1, "f1", DAY_ONE),
             (None, "d", 1, "f1", DAY_ONE)]
    result = upsert.upsert_table(frame(first, BATCH), table, ["k"], batch_time=DAY_ONE, **options)
    assert (result.inserted, result.updated, result.unchanged) == (2, 0, 0)
    rejects = read_rejects(spark, result.rejects_folder)
    assert {(r.v, r._reject_reason) for r in rejects.collect()} == {
        ("b", "duplicate_key"), ("d", "null_key"),
    }
    assert "t_rejets/2024-01-01" in result.rejects_folder

    second = [(1, "a", 1, "f2", DAY_TWO), (2, "x", 1, "f2", DAY_TWO), (3, "y", 1, "f2", DAY_TWO)]
    for now, expected in ((NOW, (1, 1, 1)), (LATER, (0, 0, 3))):
        result = upsert.upsert_table(frame(second, BATCH), table, ["k"], batch_time=now, **options)
        assert (result.inserted, result.updated, result.unchanged) == expected
        assert result.rejects_folder is None
    state = by_key(read_table(spark, table))
    assert {k: (r["v"], r["date_creation"], r["date_modification"]) for k, r in state.items()} == {
        1: ("a", DAY_ONE, DAY_ONE),
        2: ("x", DAY_ONE, NOW),
        3: ("y", DAY_TWO, NOW),
    }
    assert "_ingested_at" not in read_table(spark, table).columns


@pytest.mark.parametrize("small_batch_rows", [0, 100])
def test_only_touched_partitions_are_written(spark, frame, zone, tmp_path, small_batch_rows):
    table = zone.table("p")
    options = {
        "rejects_root": str(tmp_path / "rejects"),
        "partition_by": ("month",),
        "small_batch_rows": small_batch_rows,
    }
    schema = "k int, month int, v string, _ingested_at timestamp"
    keys = ["k", "month"]
    first = [(1, 202401, "a", DAY_ONE), (2, 202402, "b", DAY_ONE), (3, 202403, "c", DAY_ONE)]
    upsert.upsert_table(frame(first, schema), table, keys, batch_time=DAY_ONE, **options)

    def files():
        names = read_table(spark, table).select("month", F.col("_metadata.file_path")).collect()
        return {r.month: r.file_path for r in names}

    before, place = files(), table_location(spark, table)
    second = [(2, 202402, "B", DAY_TWO), (4, 202404, "d", DAY_TWO)]
    upsert.upsert_table(frame(second, schema), table, keys, batch_time=NOW, **options)
    after = files()
    assert table_location(spark, table) == place
    assert after[202401] == before[202401] and after[202403] == before[202403]
    assert after[202402] != before[202402] and 202404 in after
    assert {r.k: r.v for r in read_table(spark, table).collect()} == {
        1: "a", 2: "B", 3: "c", 4: "d",
    }


@pytest.mark.parametrize("parts", [("month",), ("month", "kind")])
def test_null_is_a_partition_too(spark, frame, zone, tmp_path, parts):
    table = zone.table("n")
    options = {"rejects_root": str(tmp_path / "rejects"), "partition_by": parts}
    schema = "k int, v string, month int, kind string, _ingested_at timestamp"
    first = [(1, "a", None, "x", DAY_ONE), (2, "b", None, "x", DAY_ONE), (3, "c", 1, "y", DAY_ONE)]
    upsert.upsert_table(frame(first, schema), table, ["k"], batch_time=DAY_ONE, **options)
    second = [(2, "B", None, "x", DAY_TWO), (4, "d", None, "x", DAY_TWO)]
    result = upsert.upsert_table(frame(second, schema), table, ["k"], batch_time=NOW, **options)
    assert (result.inserted, result.updated) == (1, 1)
    got = {r.k: r.v for r in read_table(spark, table).collect()}
    assert got == {1: "a", 2: "B", 3: "c", 4: "d"}


def test_an_empty_batch_creates_the_table(spark, frame, zone, tmp_path):
    table = zone.table("nothing")
    result = upsert.upsert_table(
        frame([], BATCH), table, ["k"], rejects_root=str(tmp_path), batch_time=DAY_ONE
    )
    assert (result.inserted, result.updated, result.rejects_folder) == (0, 0, None)
    assert table_exists(spark, table) and read_table(spark, table).count() == 0


@pytest.mark.parametrize("small_batch_rows", [0, 100])
def test_a_row_moves_to_another_partition(spark, frame, zone, tmp_path, small_batch_rows):
    """The key is found wherever it lies; a partition left without rows is gone."""
    table = zone.table("m")
    options = {
        "rejects_root": str(tmp_path / "rejects"),
        "partition_by": ["kind"],
        "small_batch_rows": small_batch_rows,
    }
    schema = "k int, v string, kind string, _ingested_at timestamp"
    first = [(1, "a", "x y+z:%", DAY_ONE), (2, "b", "it's", DAY_ONE), (3, "c", None, DAY_ONE)]
    upsert.upsert_table(frame(first, schema), table, ["k"], batch_time=DAY_ONE, **options)
    second = [(1, "a", "it's", DAY_TWO), (3, "c", "new", DAY_TWO), (4, "d", None, DAY_TWO)]
    result = upsert.upsert_table(frame(second, schema), table, ["k"], batch_time=NOW, **options)
    assert (result.inserted, result.updated, result.unchanged) == (1, 2, 0)
    rows = {r.k: (r.v, r.kind, r.date_creation) for r in read_table(spark, table).collect()}
    assert rows == {
        1: ("a", "it's", DAY_ONE), 2: ("b", "it's", DAY_ONE), 3: ("c", "new", DAY_ONE),
        4: ("d", None, DAY_TWO),
    }
    assert spark.sql(f"SHOW PARTITIONS {table.sql_name}").count() == 3


def test_a_load_that_breaks_off_leaves_the_old_rows(spark, frame, zone, tmp_path):
    table = zone.table("b")
    options = {"rejects_root": str(tmp_path / "rejects"), "partition_by": ["month"]}
    schema = "k int, month int, v string, _ingested_at timestamp"
    first = [(1, 1, "a", DAY_ONE), (2, 2, "b", DAY_ONE)]
    upsert.upsert_table(frame(first, schema), table, ["k", "month"], batch_time=DAY_ONE, **options)
    second = frame([(1, 1, "A", DAY_TWO), (2, 2, "B", DAY_TWO)], schema)
    target = read_table(spark, table)
    broken = target.withColumn("v", F.when(F.col("k") == 2, F.raise_error(F.lit("lost"))).otherwise("?"))
    with pytest.raises(Exception, match="lost"):
        tables.replace_partitions(broken, table)
    assert {r.k: r.v for r in read_table(spark, table).collect()} == {1: "a", 2: "b"}
    upsert.upsert_table(second, table, ["k", "month"], batch_time=NOW, **options)
    assert {r.k: r.v for r in read_table(spark, table).collect()} == {1: "A", 2: "B"}


def test_partition_expressions_use_key_columns_only(frame, zone, tmp_path):
    batch = frame(BATCH_ROWS, BATCH)
    with pytest.raises(Exception, match="w"):
        upsert.upsert_table(
            batch, zone.table("e"), ["k"], rejects_root=str(tmp_path), batch_time=NOW,
            partition_by={"part": F.col("w") % 2},
        )


def test_a_wide_batch_is_not_broadcast(frame):
    assert upsert._fits_broadcast(frame(BATCH_ROWS, BATCH), 100)
    wide = frame([(1, "x" * (9 << 20))], "k int, v string").selectExpr("k", *[f"v AS v{i}" for i in range(8)])
    assert not upsert._fits_broadcast(wide, 100)


def test_blank_keys(spark, frame, zone, tmp_path):
    schema = "k string, v int, _ingested_at timestamp"
    rows = [("a", 1, DAY_ONE), ("", 2, DAY_ONE), ("  ", 3, DAY_ONE)]
    for name, blank_is_null, kept in (("s", True, {"a"}), ("t", False, {"a", "", "  "})):
        table = zone.table(name)
        upsert.upsert_table(
            frame(rows, schema), table, ["k"], rejects_root=str(tmp_path / name), batch_time=NOW,
            blank_keys_are_null=blank_is_null,
        )
        assert {r.k for r in read_table(spark, table).collect()} == kept
