"""Named measures over a star of one fact and its dimensions.

A report names its grouping columns and measures; only the dimensions those
columns come from are joined.  All measures here can be summed up from partial
results, which gives two ways to reach a dimension:

* a dimension counted to be small is broadcast, and the fact is aggregated once;
* a large one needs the fact shuffled by its key, where one popular key can hold a
  large share of the rows.  If groups come from that dimension alone, the fact is
  summed up per key first, within the map tasks, and only those sums meet the
  dimension.  With other columns beside the key such sums are about as many as the
  rows; then the rows meet the dimension, skewed keys split by adaptive execution,
  before anything that widens them, and are summed up once.  For sums a task holds
  its part of the dimension as a hash table, if that was counted to fit, and no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldvein.operators.sizes import SMALL_ROWS, broadcast_if, counted_size, hash_if, is_small

_ROWS = "_rows"


@dataclass(frozen=True)
class Measure:
    """``sum`` of a column, or ``count`` of rows."""

    name: str
    kind: str = "sum"
    column: str | None = None


TOTAL_SALES = Measure("total_sales", "sum", "net_amount")
TOTAL_SALES_EUR = Measure("total_sales_eur", "sum", "net_amount_eur")
TOTAL_GROSS = Measure("total_gross", "sum", "gross_amount")
SUM_MONTH = Measure("sum_month", "sum", "month")
QUANTITY = Measure("total_quantity", "sum", "quantity")
LINES = Measure("n_lines", "count")


@dataclass(frozen=True)
class Dimension:
    """A dimension, the fact column it hangs on, and whether it was counted small.

    ``size`` is what it was counted to have, rows and bytes.  ``implied`` turns a filter on one of its columns into a filter on the fact,
    which the scan can use to skip data.
    """

    frame: DataFrame
    fact_key: str
    key: str
    columns: tuple[str, ...]
    small: bool = False
    implied: Mapping[str, object] | None = None
    size: tuple[int, int] | None = None

    def part(self, columns: Iterable[str], in_key_order: bool = False) -> DataFrame:
        wanted = [c for c in self.columns if c in set(columns)]
        part = self.frame.select(F.col(self.key).alias("_dim_key"), *wanted)
        if self.size and not self.small and not in_key_order:
            return hash_if(part, self.size)
        return broadcast_if(part, self.small)

    def passing(self, tests: Column, flag: str) -> Dimension:
        """The keys of its rows that pass, marked in a column ``flag``, and counted again."""
        keys = self.frame.where(tests).select(self.key, F.lit(True).alias(flag))
        return dimension(keys, self.fact_key, self.key, [flag])


def dimension(
    frame: DataFrame,
    fact_key: str,
    key: str,
    columns: Sequence[str],
    *,
    small: bool | None = None,
    small_rows: int = SMALL_ROWS,
    implied: Mapping[str, object] | None = None,
    size: tuple[int, int] | None = None,
) -> Dimension:
    """Describe a dimension, counting it unless its size is already known."""
    if small is None:
        have = [c for c in columns if c in frame.columns]
        size = size or counted_size(frame.select(key, *have))
        small = is_small(size, small_rows)
    return Dimension(frame, fact_key, key, tuple(columns), small, implied, size)


def _test(column: str, wanted) -> Column:
    if isinstance(wanted, (list, tuple, set, frozenset)):
        return F.col(column).isin(list(wanted))
    return F.col(column) == F.lit(wanted)


def _chosen(filters: Mapping[str, object] | None) -> dict[str, object]:
    """Filters that are set; an unset one (None or nothing selected) lets all through."""
    return {
        c: v
        for c, v in (filters or {}).items()
        if v is not None and not (isinstance(v, (list, tuple, set, frozenset)) and not v)
    }


@dataclass(frozen=True)
class Star:
    """A fact frame and the dimensions that widen it.

    ``derived`` names columns computed from the fact row itself, ``widened`` columns
    that take a join; the join is planned only if the column is asked for.
    """

    fact: DataFrame
    dimensions: tuple[Dimension, ...] = ()
    derived: Mapping[str, Column] | None = None
    widened: Mapping[str, Callable[[DataFrame], DataFrame]] | None = None

    def _base(self, needed: Iterable[str], df: DataFrame | None = None) -> DataFrame:
        """The fact, or a frame made from it, with the needed columns that it can have by itself.

        Widened columns may stand on derived ones, so with them all derived ones are there.
        """
        needed, df = set(needed), self.fact if df is None else df
        widened = [w for n, w in (self.widened or {}).items() if n in needed and n not in df.columns]
        used = {
            n: c for n, c in (self.derived or {}).items() if (widened or n in needed) and n not in df.columns
        }
        df = df.withColumns(used) if used else df
        for widen in widened:
            df = widen(df)
        return df

    def _used(self, needed: Iterable[str]) -> list[Dimension]:
        needed = set(needed)
        return [d for d in self.dimensions if needed & set(d.columns)]

    @staticmethod
    def _join(df: DataFrame, dim: Dimension, needed: Iterable[str], in_key_order: bool = False) -> DataFrame:
        part = dim.part(needed, in_key_order)
        return df.join(part, df[dim.fact_key] == part["_dim_key"], "left").drop("_dim_key")

    def wide(
        self, columns: Sequence[str], filters: Mapping[str, object] | None = None, *, in_key_order: bool = True
    ) -> DataFrame:
        """The fact with the given columns, joining only where they come from.

        ``in_key_order`` lets a large dimension be joined by sorting, for rows that are written:
        equal values then lie together, and files get smaller.  Sums need no order.
        """
        filters = _chosen(filters)
        needed = {*columns, *filters}
        dims = self._used(needed)
        # Large dimensions shuffle the fact.  Only what filters it comes before, what widens it after.
        first = [d for d in dims if d.small and set(d.columns) & set(filters)]
        far = [d for d in dims if not d.small]
        near = [d for d in dims if d.small and d not in first]
        df = self._base({*filters, *[d.fact_key for d in (*first, *far)]})
        for dim in dims:
            for column, to_fact in (dim.implied or {}).items():
                if column in filters:
                    df = self._base([dim.fact_key], df).where(to_fact(filters[column]))
        for dim in (*first, *far):
            df = self._join(df, dim, needed, in_key_order)
        df = self._base({*needed, *[d.fact_key for d in near]}, df)
        for dim in near:
            df = self._join(df, dim, needed)
        for column, wanted in filters.items():
            df = df.where(_test(column, wanted))
        return df.select(*columns)

    def aggregate(
        self,
        by: Sequence[str] = (),
        measures: Sequence[Measure] = (TOTAL_SALES,),
        filters: Mapping[str, object] | None = None,
    ) -> DataFrame:
        """Measures per group; filters are equality or membership tests."""
        filters = _chosen(filters)
        needed = {*by, *filters, *[m.column for m in measures if m.column]}
        dims = self._used(needed)
        near, far = [d for d in dims if d.small], [d for d in dims if not d.small]
        of_far = {c for d in far for c in d.columns}

        if len(far) > 1 or far and set(by) - of_far:
            # hardly two rows of a task share all of a large key and other columns
            own = self._base({*needed, *[d.fact_key for d in dims]})
            told = list(dict.fromkeys([*by, *[m.column for m in measures if m.column]]))
            rows = replace(self, fact=own).wide(told, filters, in_key_order=False)
            return rows.groupBy(*by).agg(*[_whole(m) for m in measures])

        df = self._base({*needed, *[d.fact_key for d in dims]})
        for dim in dims:
            for column, to_fact in (dim.implied or {}).items():
                if column in filters:
                    df = df.where(to_fact(filters[column]))
        for dim in near:
            df = self._join(df, dim, needed)
        for column, wanted in filters.items():
            if column not in of_far:
                df = df.where(_test(column, wanted))
        if not far:
            return df.groupBy(*by).agg(*[_whole(m) for m in measures])

        keys = [d.fact_key for d in far]
        partial = [
            F.sum(m.column).alias(f"_sum_{m.name}")
            for m in measures
            if m.kind == "sum" and m.column not in of_far
        ]
        df = df.groupBy(*keys).agg(F.count("*").alias(_ROWS), *partial)
        for dim in far:
            df = self._join(df, dim, needed)
        for column, wanted in filters.items():
            if column in of_far:
                df = df.where(_test(column, wanted))
        return df.groupBy(*by).agg(*[_combined(m, of_far) for m in measures])

    def cube(
        self,
        by: Sequence[str],
        measures: Sequence[Measure] = (TOTAL_SALES,),
        filters: Mapping[str, object] | None = None,
    ) -> DataFrame:
        """All subtotals of ``by``; ``grouping_id`` tells them apart.

        The fact is aggregated to the finest groups first.  Cubing the fact
        itself would copy every row once per grouping set.
        """
        finest = self.aggregate(by, measures, filters)
        sums = [F.sum(m.name).alias(m.name) for m in measures]
        return finest.cube(*by).agg(F.grouping_id().alias("grouping_id"), *sums)

    def grouping_sets(
        self,
        sets: Sequence[Sequence[str]],
        measures: Sequence[Measure] = (TOTAL_SALES,),
        filters: Mapping[str, object] | None = None,
    ) -> DataFrame:
        """Measures by each of some sets of columns, from one look at the fact.

        The fact is aggregated once by all columns together.  `set_number` tells which
        set a row belongs to; columns outside it are null.
        """
        by = list(dict.fromkeys(c for s in sets for c in s))
        finest = self.aggregate(by, measures, filters)
        bit = {c: 1 << (len(by) - 1 - i) for i, c in enumerate(by)}
        number = F.lit(None).cast("int")
        for i, s in reversed(list(enumerate(sets))):
            left_out = sum(b for c, b in bit.items() if c not in s)
            number = F.when(F.grouping_id() == left_out, F.lit(i)).otherwise(number)
        sums = [F.sum(m.name).alias(m.name) for m in measures]
        grouped = finest.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in by])
        return grouped.agg(number.alias("set_number"), *sums)

    def filter_lists(self, columns: Sequence[str], filters: Mapping[str, object] | None = None) -> DataFrame:
        """The values of several filters, and how many rows each would still select under the others.

        (column, value as text, n_rows).  Each group of filter values has a bit for
        every filter it fails; it counts for a list if it fails no other filter than
        that list's own.
        """
        chosen = _chosen(filters)
        every = list(dict.fromkeys([*columns, *chosen]))
        bit = {c: 1 << i for i, c in enumerate(every)}
        failed = F.lit(0)
        for c, wanted in chosen.items():
            failed = failed + F.when(F.coalesce(_test(c, wanted), F.lit(False)), 0).otherwise(bit[c])
        groups = self.aggregate(every, [LINES]).withColumn("_failed", failed)
        lists = [
            F.struct(
                F.lit(c).alias("column"),
                F.col(c).cast("string").alias("value"),
                F.when(F.col("_failed").bitwiseAND(~bit[c]) == 0, F.col(LINES.name)).otherwise(F.lit(0).cast("bigint")).alias("n"),
            )
            for c in columns
        ]
        told = groups.select(F.explode(F.array(*lists)).alias("l")).select("l.*")
        return told.groupBy("column", "value").agg(F.sum("n").alias("n_rows"))

    def filter_values(self, column: str, filters: Mapping[str, object] | None = None) -> DataFrame:
        """The values to offer for a filter, and how many rows each would still
        select under the other filters."""
        others = {c: v for c, v in _chosen(filters).items() if c != column}
        dims, holds, by = [], F.lit(True), [column]
        for number, dim in enumerate(self.dimensions):
            tests = [_test(c, others[c]) for c in dim.columns if c in others]
            if dim.small or column in dim.columns or not tests:
                dims.append(dim)
                continue
            # of a large dimension only the keys that pass meet the rows, which may be few
            for c in dim.columns:
                others.pop(c, None)
            by.append(f"_passes_{number}")
            dims.append(dim.passing(reduce(and_, tests), by[-1]))
            holds = holds & F.col(by[-1]).isNotNull()
        for other, wanted in others.items():
            holds = holds & _test(other, wanted)
        counted = replace(self, dimensions=tuple(dims)).aggregate([*by, *others], [LINES])
        rows = F.when(holds, F.col(LINES.name)).otherwise(F.lit(0).cast("bigint"))
        return counted.groupBy(column).agg(F.sum(rows).alias(f"{column}_associativity"))


def _whole(m: Measure) -> Column:
    return (F.count("*") if m.kind == "count" else F.sum(m.column)).alias(m.name)


def _combined(m: Measure, of_far: set[str]) -> Column:
    if m.kind == "count":
        # no rows at all is a count of zero, not null
        return F.coalesce(F.sum(_ROWS), F.lit(0).cast("bigint")).alias(m.name)
    if m.column in of_far:
        return F.sum(F.col(m.column) * F.col(_ROWS)).alias(m.name)
    return F.sum(f"_sum_{m.name}").alias(m.name)
