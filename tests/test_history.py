"""Histories, as-of joins and surrogate keys against plain Python."""

import random
from datetime import date, datetime, timedelta
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from goldvein.operators import surrogate
from goldvein.operators.history import CONFIRMED, ENDED, Historized, empty_history, load_history, merged_history
from goldvein.operators.ordered import DAY, MONTH, as_of, beside
from goldvein.sources.tables import partition_values_of, read_table

START = datetime(2024, 1, 1)
HOW = Historized(("k",), "at", ("a", "b"), "loaded")
SCHEMA = "k string, a string, b int, at timestamp, loaded timestamp"


def plain_history(batches):
    """Versions of all keys; of rows with one key and moment the last one loaded counts, then the largest."""
    told = {}
    for n, batch in enumerate(batches):
        for k, a, b, at, loaded in batch:
            if k is not None and at is not None:
                rank = (n, loaded)
                if (k, at) not in told or told[k, at][0] <= rank:
                    told[k, at] = (rank, (a, b))
    out = []
    for k, points in groupby(sorted(told), key=lambda p: p[0]):
        versions = []
        for _, at in points:
            value = told[k, at][1]
            if versions and versions[-1][0] == value:
                versions[-1][2].append(at)
            else:
                versions.append((value, at, []))
        ends = [v[1] for v in versions[1:]] + [None]
        out += [(k, *v, at, end, end is None, again) for (v, at, again), end in zip(versions, ends)]
    return sorted(out, key=repr)


def rows_of(df):
    return sorted(((r.k, r.a, r.b, r.valid_from, r.valid_to, r.is_current, r[CONFIRMED]) for r in df.collect()), key=repr)


def some_batches(seed, n, late):
    r = random.Random(seed)
    out = []
    for step in range(n):
        batch = []
        for i in range(40):
            when = 20 * step + r.randrange(20) - (r.choice([0, 0, 50]) if late else 0)
            row = (f"k{min(r.randrange(9), 6)}", r.choice(["x", "y", None]), r.choice([1, None]), START + timedelta(days=when), START + timedelta(days=20 * step, seconds=i))
            batch.append(row)
        out.append(batch)
    return out


@pytest.mark.parametrize("late, size", [(False, MONTH), (True, MONTH), (True, DAY)])
def test_history_of_random_batches(spark, late, size):
    how = Historized(HOW.keys, HOW.at, HOW.columns, HOW.loaded_at, size)
    batches, state = some_batches(7, 4, late), None
    for n, batch in enumerate(batches):
        df = spark.createDataFrame(batch, SCHEMA)
        state = merged_history(empty_history(df, how) if state is None else state, df, how)
        assert rows_of(state) == plain_history(batches[: n + 1])


def test_the_order_of_batches_does_not_matter(spark, zone):
    first = [("a", "x", 1, START, START), ("b", "x", 1, START, START), (None, "x", 1, START, START), ("c", "x", 1, None, START)]
    again = [("a", "x", 1, START + timedelta(days=60), START)]
    between = [("a", "y", 1, START + timedelta(days=40), START), ("b", "x", 1, START - timedelta(days=40), START)]
    got = []
    for n, order in enumerate(((first, again, between), (between, again, first, again))):
        table = zone.table(f"h{n}")
        for batch in order:
            load_history(spark.createDataFrame(batch, SCHEMA), table, HOW)
        got.append(rows_of(read_table(spark, table).drop(ENDED)))
    assert got[0] == got[1] == plain_history([first, again, between])
    assert [v[:3] for v in got[0]] == [("a", "x", 1), ("a", "x", 1), ("a", "y", 1), ("b", "x", 1)]


def test_a_load_leaves_earlier_months_alone(spark, zone):
    table = zone.table("h")
    for month in range(1, 5):
        load_history(spark.createDataFrame([("a", f"v{month}", 1, datetime(2024, month, 10), START)], SCHEMA), table, HOW)
    assert sorted(partition_values_of(spark, table)) == [(202402,), (202403,), (202404,), (999912,)]
    where = lambda month: read_table(spark, table).where(F.col(ENDED) == month).inputFiles()
    before = {m: where(m) for m in (202402, 202403)}
    load_history(spark.createDataFrame([("a", "late", 1, datetime(2024, 3, 20), START)], SCHEMA), table, HOW)
    assert where(202402) == before[202402] and where(202403) != before[202403]
    assert [r[1] for r in sorted(rows_of(read_table(spark, table).drop(ENDED)), key=lambda r: r[3])] == ["v1", "v2", "v3", "late", "v4"]
    load_history(spark.createDataFrame([(None, "x", 1, START, START)], SCHEMA), table, HOW)
    assert read_table(spark, table).count() == 5


def plain_as_of(left, right):
    out = []
    for k, t, x in left:
        best = max(((rt, v, u) for rk, rt, v, u in right if k is not None and t is not None and rk == k and rt is not None and rt <= t), default=None, key=lambda r: (r[0], r[1]))
        out.append((k, t, x, best[1] if best and (best[2] is None or t < best[2]) else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("size", [DAY, MONTH])
def test_as_of_against_plain_search(spark, size):
    r = random.Random(3)
    day = lambda n: date(2024, 1, 1) + timedelta(days=n)
    left = [(r.choice(["a", "b", "c", "hot", "hot", None]), r.choice([day(r.randrange(400)), day(r.randrange(400)), None]), i) for i in range(400)]
    right = [(r.choice(["a", "b", "hot", None]), day(r.randrange(-30, 380)), f"v{i}", r.choice([None, day(r.randrange(100, 420))])) for i in range(60)]
    right += [("b", day(50), "same day", None), ("b", day(50), "same day 2", None), ("a", None, "no day", None)]
    ldf = spark.createDataFrame(left, "k string, t date, x int").withColumn("m", F.create_map(F.lit("a"), "x"))
    rdf = spark.createDataFrame(right, "k string, since date, v string, till date")
    joined = as_of(ldf, rdf, ["k"], "t", "since", ["v"], until="till", size=size)
    assert joined.columns == ["k", "t", "x", "m", "v"]
    assert sorted(((q.k, q.t, q.x, q.v) for q in joined.collect()), key=repr) == plain_as_of(left, right)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    stamped = as_of(ldf, rdf.withColumn("since", F.col("since").cast("timestamp")), ["k"], "t", "since", ["v"], until="till", size=size)
    assert sorted(((q.k, q.t, q.x, q.v) for q in stamped.collect()), key=repr) == plain_as_of(left, right)


def test_as_of_with_an_empty_side(spark):
    left = spark.createDataFrame([("a", date(2024, 1, 1))], "k string, t date")
    right = spark.createDataFrame([], "k string, t2 date, v string")
    assert [tuple(r) for r in as_of(left, right, ["k"], "t", "t2", ["v"]).collect()] == [("a", date(2024, 1, 1), None)]
    assert as_of(left.limit(0), right, ["k"], "t", "t2", ["v"]).count() == 0


@pytest.mark.parametrize("following", [False, True])
def test_neighbours_across_buckets(spark, following):
    r = random.Random(1)
    rows = sorted({(r.choice(["a", "b", None]), START + timedelta(days=r.randrange(500))) for _ in range(120)}, key=repr)
    df = spark.createDataFrame(rows, "k string, t timestamp")
    got = {(q.k, q.t): q.n and q.n.t for q in beside(df, ["k"], "t", F.struct("t"), "n", following=following).collect()}
    for k, t in rows:
        others = [o for q, o in rows if q == k and (o > t if following else o < t)]
        assert got[k, t] == (min(others) if following else max(others)) if others else got[k, t] is None


def test_surrogate_keys_are_dense_and_stable(spark, zone):
    table, r = zone.table("keys"), random.Random(2)
    load = lambda rows: {(q.a, q.b): q.sk for q in surrogate.number_keys(spark.createDataFrame(rows, "a string, b int"), table, ["a", "b"], "sk").collect()}
    first = [(r.choice("xyz"), r.randrange(50)) for _ in range(300)]
    one = load(first + [(None, 1), ("x", None)])
    assert one == {k: n + 1 for n, k in enumerate(sorted(set(first)))}
    second = first[:100] + [(r.choice("wxyz"), r.randrange(40, 90)) for _ in range(200)]
    two = load(second)
    new = sorted(set(second) - set(first))
    assert two == one | {k: len(one) + n + 1 for n, k in enumerate(new)}
    assert load(second) == two and load([]) == two
    rows = spark.createDataFrame([("w", 1000), first[0], (None, 1)], "a string, b int")
    known = surrogate.with_numbers(rows, read_table(spark, table), ["a", "b"], "sk")
    assert sorted(q.sk for q in known.collect()) == [-1, -1, one[first[0]]]


def test_numbering_needs_no_single_task(spark):
    rows = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("id"))
    done = surrogate.numbered(rows, ["id"], "n", after=5)
    assert done.where("n <> id + 6").count() == 0
    plan = done._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Window" not in plan
