import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from conftest import DAY_ONE, DAY_TWO
from goldvein.operators import dedup

SCHEMA = "k1 int, k2 string, seq int, v string, _ingested_at timestamp"
KEYS = ["k1", "k2"]


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


def brute_force(rows):
    groups = defaultdict(list)
    for row in rows:
        if row[0] is not None and row[1] is not None:
            groups[row[:2]].append(row)
    kept, rejected = Counter(), Counter()
    for group in groups.values():
        ordered = sorted(group, key=lambda r: (-r[4].timestamp(), r[2], r[3]))
        kept[ordered[0]] += 1
        rejected.update(ordered[1:])
    return kept, rejected


def hot_rows(n=3000):
    """A third of all rows under one key, a third copies of one row, some null keys."""
    rnd = random.Random(7)
    rows = [(1, "hot", rnd.randrange(50), str(rnd.randrange(5)), DAY_ONE) for _ in range(n)]
    rows += [(2, "copies", 1, "same", DAY_TWO)] * n
    for _ in range(n):
        day = rnd.choice([DAY_ONE, DAY_TWO])
        rows.append((rnd.randrange(800), rnd.choice("ab"), rnd.randrange(3), "x", day))
    rows += [(None, "a", 1, "x", DAY_ONE), (3, None, 1, "x", DAY_ONE)]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("partitions", [1, 7])
@pytest.mark.parametrize(
    "limits", [{}, {"small_rows": 3, "hot_rows": 1000}, {"small_rows": 0, "hot_rows": 10}]
)
def test_split_is_exact_with_hot_keys(frame, partitions, limits):
    rows = hot_rows()
    df = frame(rows, SCHEMA).repartition(partitions)
    kept, rejected = brute_force(rows)
    assert rows_of(dedup.latest_per_key(df, KEYS, tie_breakers=["seq"])) == kept
    known = {"repeated": dedup.repeated_keys(df, KEYS), "small_rows": limits.get("small_rows", 9999)}
    kept_otherwise = dedup.latest_per_key(df, KEYS, tie_breakers=["seq"], **known)
    assert kept_otherwise.columns == df.columns and rows_of(kept_otherwise) == kept
    losers = dedup.duplicate_rows(df, KEYS, tie_breakers=["seq"], **limits)
    assert losers.columns == df.columns
    assert rows_of(losers) == rejected
    unmatched = dedup.null_key_rows(df, KEYS)
    assert sum(kept.values()) + sum(rejected.values()) + unmatched.count() == len(rows)


def test_newest_wins_then_tie_breaker(frame):
    df = frame(
        [(1, "a", 2, "old", DAY_ONE), (1, "a", 2, "new", DAY_TWO), (1, "b", 2, "x", DAY_ONE),
         (1, "b", 1, "y", DAY_ONE)],
        SCHEMA,
    )
    got = {r.k2: r.v for r in dedup.latest_per_key(df, KEYS, tie_breakers=["seq"]).collect()}
    assert got == {"a": "new", "b": "y"}
    last = dedup.latest_per_key(df, KEYS, tie_breakers=[F.col("seq").desc()])
    assert {r.k2: r.v for r in last.collect()} == {"a": "new", "b": "x"}


def test_no_duplicates(frame):
    df = frame([(1, "a", 1, "x", DAY_ONE), (1, "b", 1, "x", DAY_ONE)], SCHEMA)
    repeated = dedup.repeated_keys(df, KEYS)
    assert rows_of(dedup.latest_per_key(df, KEYS, repeated=repeated)) == rows_of(df)
    assert not dedup.has_rows(dedup.repeated_keys(df, KEYS))
    assert not dedup.has_rows(dedup.duplicate_rows(df, KEYS))


def test_a_longer_key_keeps_both_lines(frame):
    df = frame([(1, "a", 1, "x", DAY_ONE), (1, "a", 2, "x", DAY_ONE)], SCHEMA)
    assert dedup.latest_per_key(df, KEYS).count() == 1
    assert dedup.latest_per_key(df, [*KEYS, "seq"]).count() == 2


def test_losers_are_dropped_before_the_shuffle(frame):
    df = frame([(1, "a", 1, "x", DAY_ONE)], SCHEMA)
    plan = dedup.latest_per_key(df, KEYS)._jdf.queryExecution().executedPlan().toString()
    final, partial = plan.index("Final"), plan.index("Partial")
    assert final < plan.index("Exchange") < partial
