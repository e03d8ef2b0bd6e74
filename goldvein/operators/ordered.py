"""Neighbours in time, within a key, without a task that holds a whole key.

A window over a key sorts all rows of the key in one task, whatever share of the rows it
has.  Here a window covers a key within a stretch of time (a bucket).  What a bucket
needs from the others is one value: the last one before it, or the first one behind.
Those come from a table of one row for each key and bucket, which partial aggregation
makes in the map tasks.  Both sides are dealt by key and bucket, so the rows are
shuffled once.

The rows are read twice (in full, and for the table of buckets, which needs keys, time
and value only), so hand over a table or a cheap frame.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_BUCKET, _NEAR, _EDGE, _FIRST = "_bucket", "_near", "_edge", "_first"

#: stretch of time that one window covers
DAY, MONTH = "day", "month"


def bucket_of(time: Column, size: str = MONTH) -> Column:
    """The number of the stretch of time that a moment is in."""
    day = time.cast("date")
    if size == DAY:
        return F.datediff(day, F.lit("1970-01-01").cast("date")).cast("long")
    return (F.year(day) * 12 + F.month(day)).cast("long")


def beside(
    rows: DataFrame,
    keys: Sequence[str],
    time: str,
    value: Column,
    name: str,
    *,
    following: bool = False,
    size: str = MONTH,
) -> DataFrame:
    """Rows with the value of the row before (or ``following``) them in their key, null at its end.

    A key has one row at a time at most, and ``value`` is null in none of them.
    """
    rows = rows.withColumn(_BUCKET, bucket_of(F.col(time), size))
    turn = F.desc if following else F.asc
    here = Window.partitionBy(*keys, _BUCKET).orderBy(turn(time))
    end = (F.min_by if following else F.max_by)(value, F.col(time))
    edges = rows.groupBy(*keys, _BUCKET).agg(end.alias(_EDGE))
    across = Window.partitionBy(*keys).orderBy(turn(_BUCKET))
    edges = edges.withColumn(_EDGE, F.lag(_EDGE).over(across))
    found = rows.withColumns({_NEAR: F.lag(value).over(here), _FIRST: F.row_number().over(here) == 1})
    joined = _same_keys(found, edges, [*keys, _BUCKET])
    return joined.withColumn(name, F.when(F.col(_FIRST), F.col(_EDGE)).otherwise(F.col(_NEAR))).drop(
        _BUCKET, _NEAR, _EDGE, _FIRST
    )


def _same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A join in which null keys meet, as they do in a window."""
    named = right.toDF(*[f"_r_{c}" if c in keys else c for c in right.columns])
    meet = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in keys])
    return left.join(named, meet, "left").drop(*[f"_r_{c}" for c in keys])


def _time_type(*types: T.DataType) -> T.DataType:
    return types[0] if all(t == types[0] for t in types) else T.TimestampType()


def as_of(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_time: str,
    right_time: str,
    columns: Sequence[str],
    *,
    until: str | None = None,
    size: str = MONTH,
) -> DataFrame:
    """Left rows with columns of the last right row of their key at or before their time.

    Both sides are merged by key and time, and each left row takes the last value that
    came before it; no pair of rows is ever compared.  ``until`` names a right column from
    which on a row no longer holds.  Left rows without a key, a time or a right row get
    nulls.  Of several right rows with the same key and time the one with the largest
    values counts.
    """
    kind = _time_type(left.schema[left_time].dataType, right.schema[right_time].dataType)
    keys = [f"_k{i}" for i in range(len(on))]
    value = F.struct(*[F.col(f"`{c}`") for c in (*columns, *([until] if until else []))])
    none = reduce(lambda a, b: a | b, [F.col(f"`{c}`").isNull() for c in (*on, left_time)])

    def common(df: DataFrame, time: str, what: Column, name: str) -> DataFrame:
        named = [F.col(f"`{c}`").alias(k) for c, k in zip(on, keys)]
        return df.select(*named, F.col(f"`{time}`").cast(kind).alias("_time"), what.alias(name))

    versions = common(right, right_time, value, "_value").where(
        reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in (*keys, "_time")])
    )
    versions = versions.withColumn(_BUCKET, bucket_of(F.col("_time"), size))
    row = F.struct(*[F.col(f"`{c}`") for c in left.columns])
    # rows that can match nothing stay spread over as many buckets as there are input tasks
    rows = common(left.withColumn("_none", none), left_time, F.struct(row.alias("row"), "_none"), "_row")
    bucket = F.when(F.col("_row._none"), -1 - F.spark_partition_id()).otherwise(bucket_of(F.col("_time"), size))
    rows = rows.withColumn(_BUCKET, bucket)

    empty_row = F.lit(None).cast(rows.schema["_row"].dataType)
    empty_value = F.lit(None).cast(versions.schema["_value"].dataType)
    both = rows.withColumn("_value", empty_value).unionByName(versions.withColumn("_row", empty_row))
    so_far = Window.partitionBy(*keys, _BUCKET).orderBy("_time", F.col("_row").isNotNull(), "_value")
    held = both.withColumn("_value", F.last("_value", ignorenulls=True).over(so_far)).where("_row IS NOT NULL")

    last = F.max_by("_value", F.when(F.col("_value").isNotNull(), F.struct("_time", "_value"))).alias(_EDGE)
    places = rows.select(*keys, _BUCKET, "_time").withColumn("_value", empty_value)
    edges = places.unionByName(versions).groupBy(*keys, _BUCKET).agg(last)
    earlier = Window.partitionBy(*keys).orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    edges = edges.where(F.col(keys[0]).isNotNull()).withColumn(_EDGE, F.last(_EDGE, ignorenulls=True).over(earlier))
    joined = held.join(edges, [*keys, _BUCKET], "left")
    known = F.coalesce("_value", _EDGE)
    if until:
        ended = F.col("_time") >= known[until].cast(kind)
        known = F.when(~F.coalesce(ended, F.lit(False)), known)
    joined = joined.withColumn("_known", known)
    return joined.select("_row.row.*", *[F.col("_known")[c].alias(c) for c in columns])
