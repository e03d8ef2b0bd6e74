"""Checks that decide between broadcasting a frame, hashing its shuffled parts and sorting both sides."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: a frame up to this many rows may be broadcast
SMALL_ROWS = 500_000

#: if its values take no more bytes than this
SMALL_BYTES = 64 << 20

#: what a value takes beside the bytes of a text
VALUE_BYTES = 16

#: what a task may hold of one side of a join as a hash table, which cannot spill
HASHED_BYTES = 512 << 20

#: what such a table is made to take where the number of parts can be chosen
PART_BYTES = 64 << 20


def _text_bytes(df: DataFrame):
    """Bytes of a row's values of no fixed size."""
    fixed = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
    open_ended = [f.name for f in df.schema if not isinstance(f.dataType, fixed)]
    sizes = [F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)).cast("long") for c in open_ended]
    return reduce(lambda a, b: a + b, sizes, F.lit(0).cast("long"))


def counted_size(df: DataFrame) -> tuple[int, int]:
    """Rows of a frame, and the bytes that they take.

    One pass in which each task hands on two numbers.  (A ``limit`` before it would send
    that many rows of every task to a single one.)  Hand over the columns that are to be
    broadcast or hashed; of those of fixed size none is read.
    """
    found = df.agg(F.count("*").alias("n"), F.sum(_text_bytes(df)).alias("b")).first()
    return found["n"], (found["b"] or 0) + VALUE_BYTES * len(df.columns) * found["n"]


def is_small(size: tuple[int, int], limit: int = SMALL_ROWS, most: int = SMALL_BYTES) -> bool:
    rows, taken = size
    return rows <= limit and taken <= most


def counted_small(df: DataFrame, limit: int = SMALL_ROWS, most: int = SMALL_BYTES) -> bool:
    """Whether a frame has at most ``limit`` rows that take at most ``most`` bytes."""
    return is_small(counted_size(df), limit, most)


def broadcast_if(df: DataFrame, small: bool) -> DataFrame:
    """Hint only what was counted small; anything else Spark measures and may shuffle."""
    return F.broadcast(df) if small else df


def hash_if(df: DataFrame, size: tuple[int, int], most: int = HASHED_BYTES, key: str | None = None) -> DataFrame:
    """Hint to join with hash tables of a frame's shuffled parts, if it was counted so that they fit.

    Then neither side is sorted, and a task holds its part of this frame only, whatever the
    other side has.  What is larger is sorted, which can spill; what is small is left to Spark.

    With ``key``, the column it is joined by, a frame that is large for the session's parts is cut
    into as many as it takes instead, so a task's table does not grow with the frame.  Adaptive
    execution does not split such parts, so this is for keys that hardly repeat on either side.
    """
    rows, taken = size
    if rows <= SMALL_ROWS:
        return df
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # a row's head, its place in the table and the table's free half
    taken += 3 * VALUE_BYTES * rows
    if key and taken > parts * PART_BYTES:
        return df.repartition(-(-taken // PART_BYTES), key).hint("shuffle_hash")
    return df.hint("shuffle_hash") if taken <= parts * most else df
