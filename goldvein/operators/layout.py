"""Clustered files: rows that are near in several columns lie near in the files.

Each column's values are cut into parts of equal size; the bits of the part numbers, taken
in turns from each column, are one sort key.  A file then holds a small box of values
in every column, so a filter on any of them skips files and row groups by their
statistics.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: bits of a part number: 2 ** BITS parts of a column
BITS = 8

#: how far off the size of a part may be, as a share of all rows
PART_ERROR = 0.001


def as_number(df: DataFrame, column: str) -> Column:
    """A number in the order of the column's values; a text by its first six bytes."""
    kind = df.schema[column].dataType.typeName()
    value = F.col(f"`{column}`")
    if kind == "string":
        head = F.rpad(F.hex(F.substring(F.encode(value, "UTF-8"), 1, 6)), 12, "0")
        return F.conv(head, 16, 10).cast("double")
    if kind == "date":
        return F.unix_date(value).cast("double")
    if kind == "timestamp_ntz":
        value = value.cast("timestamp")
    return value.cast("double")


def cuts(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> dict[str, list[float]]:
    """Where the parts of each column begin: 2 ** bits numbers a column at most, from one pass."""
    plain = df.select(*[as_number(df, c).alias(f"c{i}") for i, c in enumerate(columns)])
    shares = [k / (1 << bits) for k in range(1, 1 << bits)]
    found = plain.approxQuantile(plain.columns, shares, PART_ERROR)
    return {c: sorted(set(points)) for c, points in zip(columns, found)}


def interleaved(parts: Sequence[Column], bits: int) -> Column:
    """The bits of the part numbers, the highest of each first, as one number."""
    n = len(parts)
    placed = [
        F.shiftleft(F.shiftright(part, b).bitwiseAND(1).cast("long"), b * n + (n - 1 - i))
        for i, part in enumerate(parts)
        for b in range(bits)
    ]
    return reduce(lambda x, y: x.bitwiseOR(y), placed)


def clustered(
    df: DataFrame, columns: Sequence[str], files: int, points: Mapping[str, list[float]] | None = None, bits: int = BITS
) -> DataFrame:
    """Rows in ``files`` ranges of the interleaved key, each sorted by it.

    Nulls are in a part of their own.  Give ``points`` to lay out a later load like an
    earlier one.
    """
    if len(columns) * (bits + 1) > 62:
        raise ValueError("too many columns for one key; give fewer bits")
    points = points or cuts(df, columns, bits)
    names, out = [], df
    for i, c in enumerate(columns):
        edges = [float("-inf"), *points[c], float("inf")]
        part = Bucketizer(splits=edges, inputCol=f"_v{i}", outputCol=f"_p{i}", handleInvalid="keep")
        out = part.transform(out.withColumn(f"_v{i}", as_number(df, c))).drop(f"_v{i}")
        names.append(f"_p{i}")
    key = interleaved([F.coalesce(F.col(n) + 1, F.lit(0)).cast("int") for n in names], bits + 1)
    keyed = out.withColumn("_key", key).drop(*names)
    return keyed.repartitionByRange(files, "_key").sortWithinPartitions("_key").drop("_key")
