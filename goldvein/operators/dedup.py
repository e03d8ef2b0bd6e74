"""One row per business key, with the rejected rows kept.

The newest row of a key wins.  Rows loaded at the same moment are common (a load
stamps all its rows alike), so the order continues with the caller's
tie-breakers and then with every other column: the result does not depend on
how the data happens to be partitioned.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldvein.operators.sizes import SMALL_ROWS, counted_small

LOADED_AT = "_ingested_at"
ROWS = "_rows"

#: a key with more rows than this is not ranked by a single task
HOT_KEY_ROWS = 1_000_000


def null_key(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def null_key_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows no key can match, which would be inserted again by every load."""
    return df.where(null_key(keys))


def newest_first(
    df: DataFrame,
    keys: Sequence[str],
    loaded_at: str = LOADED_AT,
    tie_breakers: Sequence[Column | str] = (),
) -> list[Column]:
    """A total order within a key: load time, tie-breakers, then the other columns."""
    ties = [F.col(t) if isinstance(t, str) else t for t in tie_breakers]
    rest = [
        F.col(f"`{f.name}`")
        for f in df.schema.fields
        if f.name not in (*keys, loaded_at) and not isinstance(f.dataType, T.MapType)
    ]
    return [F.col(loaded_at).desc(), *ties, *rest]


def _winners(rows: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key.

    Filtering the row number to 1 lets Spark drop the losers inside each map
    task, so a key with very many rows sends one row per task to the shuffle.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return (
        rows.withColumn("_row_num", F.row_number().over(w))
        .where("_row_num = 1")
        .drop("_row_num")
    )


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    loaded_at: str = LOADED_AT,
    tie_breakers: Sequence[Column | str] = (),
    *,
    repeated: DataFrame | None = None,
    small_rows: int = SMALL_ROWS,
) -> DataFrame:
    """The winning row of every key.

    A caller that has the repeated keys at hand can pass them: if they are few,
    all other rows go through without a shuffle.
    """
    on = list(keys)
    order = newest_first(df, keys, loaded_at, tie_breakers)
    valid = df.where(~null_key(keys))
    if repeated is None or not counted_small(repeated, small_rows):
        return _winners(valid, keys, order)
    few = F.broadcast(repeated.select(*on))
    single = valid.join(few, on, "left_anti")
    ranked = _winners(valid.join(few, on, "left_semi"), keys, order)
    return single.unionByName(ranked).select(*df.columns)


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys with more than one row, and how many; combined before the shuffle."""
    return (
        df.where(~null_key(keys))
        .groupBy(*keys)
        .agg(F.count("*").alias(ROWS))
        .where(F.col(ROWS) > 1)
    )


def _losers(rows: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Rank each key in one window; for keys of limited size."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_rank", F.row_number().over(w)).where("_rank > 1").drop("_rank")


def _losers_of_any_size(
    rows: DataFrame, keys: Sequence[str], order: Sequence[Column]
) -> DataFrame:
    """Rank in two steps, so that no task has to hold all rows of a key.

    First among the rows of a key that sit in the same input partition, then
    among those partitions' winners.  A row rejected in the first step stays in
    its small group in the second.
    """
    local = Window.partitionBy(*keys, "_part").orderBy(*order)
    final = Window.partitionBy(*keys, "_group").orderBy(*order)
    return (
        rows.withColumn("_part", F.spark_partition_id())
        .withColumn("_local", F.row_number().over(local))
        .withColumn("_group", F.when(F.col("_local") == 1, F.lit(-1)).otherwise(F.col("_part")))
        .withColumn("_final", F.row_number().over(final))
        .where("_local > 1 OR _final > 1")
        .drop("_part", "_local", "_group", "_final")
    )


def duplicate_rows(
    df: DataFrame,
    keys: Sequence[str],
    loaded_at: str = LOADED_AT,
    tie_breakers: Sequence[Column | str] = (),
    *,
    repeated: DataFrame | None = None,
    small_rows: int = SMALL_ROWS,
    hot_rows: int = HOT_KEY_ROWS,
) -> DataFrame:
    """Every row that ``latest_per_key`` leaves out, copies included.

    Three plans with the same result, chosen by counting keys (``repeated``
    passes on keys the caller has counted before):

    * few repeated keys are broadcast, and only their rows are shuffled;
    * among many, only the hot keys are broadcast and ranked in two steps, the
      others in one window;
    * should even the hot keys be many, all rows are ranked in two steps.
    """
    if repeated is None:
        repeated = repeated_keys(df, keys)
    on = list(keys)
    order = newest_first(df, keys, loaded_at, tie_breakers)
    valid = df.where(~null_key(keys))
    if counted_small(repeated, small_rows):
        few = F.broadcast(repeated.select(*on))
        found = _losers_of_any_size(valid.join(few, on, "left_semi"), keys, order)
    else:
        hot = repeated.where(F.col(ROWS) > hot_rows).select(*on)
        if counted_small(hot, small_rows):
            hot = F.broadcast(hot)
            found = _losers(valid.join(hot, on, "left_anti"), keys, order).unionByName(
                _losers_of_any_size(valid.join(hot, on, "left_semi"), keys, order)
            )
        else:
            found = _losers_of_any_size(valid, keys, order)
    return found.select(*df.columns)


def has_rows(df: DataFrame) -> bool:
    return not df.isEmpty()
