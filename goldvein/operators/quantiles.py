"""Exact quantile segments of all rows, without a window over all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldvein.operators.surrogate import numbered

_AT = "_at"


def ntile_of(at: Column, n: int, parts: int) -> Column:
    """The part that row ``at`` (from 1) of ``n`` is in: the first parts have the rows left over."""
    size, more = divmod(n, parts)
    if not size:
        return at.cast("int")
    ahead = more * (size + 1)
    late = more + F.ceil((at - ahead) / size)
    return F.when(at <= ahead, F.ceil(at / (size + 1))).otherwise(late).cast("int")


def with_ntile(rows: DataFrame, parts: int, order: Sequence[str], name: str) -> DataFrame:
    """Rows with their part by some columns, ascending; the last of them should make the order total.

    Rows are sorted by range and numbered by the counts of the ranges before theirs.
    """
    n = rows.count()
    placed = numbered(rows, order, _AT)
    return placed.withColumn(name, ntile_of(F.col(_AT), n, parts)).drop(_AT)
