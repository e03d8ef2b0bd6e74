"""Stored sums that a load brings up to date from what it changed.

An upsert knows the rows it changed before and after.  The values before count down, the
values after count up, and a group's new sums are its stored ones plus these.  So a load
costs what it changed, not what the table holds.  Sums must be exact for that: whole
numbers or decimals, not floating point.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldvein.operators.upsert import CHANGE, INSERT, UPDATE, merge_batch
from goldvein.sources.tables import (
    Table,
    overwrite_table,
    partition_columns,
    partition_values,
    partitions_of,
    read_table,
    replace_partitions,
    table_exists,
)

SIGN, ROWS = "_sign", "_n_rows"


def images(target: DataFrame, batch: DataFrame, keys: Sequence[str], now: Column, **options) -> DataFrame:
    """What a batch changes in a target: the rows before it with sign -1, those after it with +1.

    ``options`` are those of `upsert.merge_batch`; both sides have one row a key.
    """
    merged = merge_batch(target, batch, keys, now, **options)
    after = merged.where(F.col(CHANGE).isin(INSERT, UPDATE))
    gone = after.where(F.col(CHANGE) == UPDATE).select(*keys)
    before = target.join(gone, list(keys), "left_semi")
    plus = after.drop(CHANGE).withColumn(SIGN, F.lit(1))
    return plus.unionByName(before.withColumn(SIGN, F.lit(-1)), allowMissingColumns=True)


def deltas(changes: DataFrame, by: Sequence[str], sums: Mapping[str, Column]) -> DataFrame:
    """By how much signed rows move the sums and the row count of each group."""
    moved = [F.sum(F.col(SIGN) * c).alias(n) for n, c in sums.items()]
    return changes.groupBy(*by).agg(*moved, F.sum(SIGN).cast("bigint").alias(ROWS))


def brought_up(stored: DataFrame, moved: DataFrame, by: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Stored sums with deltas added; a group that has no rows left goes.

    Deltas are merged by a union and one more sum: groups meet whatever is null in them.
    """
    both = stored.select(*by, *names, ROWS).unionByName(moved.select(*by, *names, ROWS))
    total = both.groupBy(*by).agg(*[F.sum(n).alias(n) for n in (*names, ROWS)])
    return total.where(F.col(ROWS) > 0)


def load_report(
    changes: DataFrame, table: Table, by: Sequence[str], sums: Mapping[str, Column], partition_by: Sequence[str]
) -> int:
    """Bring a table of sums up to date; reads and rewrites the partitions of touched groups only.

    ``partition_by`` are some of ``by``.  Gives the number of partitions that were touched.
    """
    spark, names = changes.sparkSession, list(sums)
    moved = deltas(changes, by, sums)
    if not table_exists(spark, table):
        overwrite_table(moved.where(F.col(ROWS) > 0), table, partition_by)
        return len(partition_values(read_table(spark, table), partition_by))
    # a group in which nothing changed on balance needs no look at its partition
    still = reduce(lambda a, b: a & b, [F.col(n) == 0 for n in (*names, ROWS)])
    moved = moved.where(~F.coalesce(still, F.lit(False)))
    parts = partition_columns(spark, table)
    touched = partition_values(moved, parts)
    if touched:
        stored = partitions_of(read_table(spark, table), parts, touched)
        replace_partitions(brought_up(stored, moved, by, names), table, touched)
    return len(touched)
