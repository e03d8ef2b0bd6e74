"""Distinct counts that add up, as stored bitmaps.

A count of distinct orders cannot be summed: an order with lines in two categories is in
both counts.  A bitmap can be: numbers are split into ranges of one bitmap each, a group
holds a bitmap for each range it has numbers in, and the bitmaps of several groups are
merged by OR before the bits are counted.  The numbers should be dense (`surrogate`), so
that a bitmap, of four kilobytes, stands for up to 32,768 orders.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RANGE, BITS = "_range", "_bits"


def distinct_bitmaps(rows: DataFrame, by: Sequence[str], number: str) -> DataFrame:
    """A bitmap for each group and range of numbers (1 and up); rows without a number do not count."""
    known = rows.where(F.col(number) > 0)
    bits = F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias(BITS)
    return known.groupBy(*by, F.bitmap_bucket_number(number).alias(RANGE)).agg(bits)


def merged_bitmaps(bitmaps: DataFrame, by: Sequence[str]) -> DataFrame:
    """Bitmaps of fewer groups: of a coarser table, or of stored ones and a new load's."""
    return bitmaps.groupBy(*by, RANGE).agg(F.bitmap_or_agg(BITS).alias(BITS))


def distinct_counts(bitmaps: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """How many different numbers each group has, from bitmaps of any finer groups."""
    counted = merged_bitmaps(bitmaps, by).withColumn("_n", F.bitmap_count(BITS))
    return counted.groupBy(*by).agg(F.coalesce(F.sum("_n"), F.lit(0).cast("bigint")).alias(name))
