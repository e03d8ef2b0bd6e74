"""Surrogate keys: dense, stable numbers for business keys.

New keys are sorted by range; each range is counted, and a range's numbers begin where
those of the ranges before it end.  No task sees more than its range, and the driver
one count for each range.  A key that has a number keeps it for good.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldvein.operators.dedup import null_key
from goldvein.session import scratch_path
from goldvein.sources.tables import Table, append_table, overwrite_table, read_table, table_exists

#: the number of what is in no table of keys
UNKNOWN_MEMBER = -1


def numbered(rows: DataFrame, order: Sequence[str], name: str, after: int = 0) -> DataFrame:
    """The rows with the numbers after + 1, after + 2 and so on, by some columns, nulls first.

    Rows that are equal in these columns are numbered in any order.  The sorted rows are a
    table in the session's shared folder, so that the numbers of a range stay what they
    were counted as.
    """
    spark, path = rows.sparkSession, scratch_path(rows.sparkSession, "numbered")
    spread = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    spread.withColumn("_place", F.monotonically_increasing_id()).write.parquet(path)
    lying = spark.read.parquet(path).withColumn("_range", F.shiftright("_place", 33))
    # a row for each range: as many as the shuffle has partitions
    counts = lying.groupBy("_range").agg(F.count("*").alias("n"), F.min("_place").alias("first")).orderBy("_range").collect()
    before = accumulate((r["n"] for r in counts), initial=after)
    shift = [(r["_range"], b - r["first"] + 1) for r, b in zip(counts, before)]
    shifts = spark.createDataFrame(shift, "_range long, _shift long")
    joined = lying.join(F.broadcast(shifts), "_range")
    return joined.withColumn(name, F.col("_place") + F.col("_shift")).drop("_place", "_range", "_shift")


def new_keys(known: DataFrame | None, rows: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Numbers for the keys in rows that have none yet; keys with a null part never get one."""
    found = rows.where(~null_key(keys)).select(*keys).distinct()
    last = 0
    if known is not None:
        found = found.join(known.select(*keys), list(keys), "left_anti")
        last = known.agg(F.max(name)).first()[0] or 0
    return numbered(found, keys, name, last).select(*keys, name)


def number_keys(rows: DataFrame, table: Table, keys: Sequence[str], name: str) -> DataFrame:
    """Give numbers to the new keys of rows and add them to the table of keys; gives the whole table.

    The rows of one load at a time: two loads that number at once would use the same
    numbers.  A repeated load adds nothing.
    """
    spark = rows.sparkSession
    known = read_table(spark, table) if table_exists(spark, table) else None
    fresh = new_keys(known, rows, keys, name)
    if known is None:
        overwrite_table(fresh, table)
    else:
        append_table(fresh, table)
    return read_table(spark, table)


def with_numbers(rows: DataFrame, known: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Rows with the numbers of their keys, `UNKNOWN_MEMBER` where a key has none."""
    joined = rows.drop(name).join(known.select(*keys, name), list(keys), "left")
    return joined.withColumn(name, F.coalesce(name, F.lit(UNKNOWN_MEMBER).cast("long")))
