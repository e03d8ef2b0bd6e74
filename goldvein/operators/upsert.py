"""Change-aware upsert: update what changed, insert what is new, delete nothing.

Open Spark tables have no row-level merge, so the upsert is a query that gives
the new state of the table together with what happened to each row.  Two plans
give the same result: a full outer join for batches of any size, and, for a
batch counted to be small, a plan that broadcasts the batch and never shuffles
the target.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldvein import TECHNICAL_COLUMNS
from goldvein.operators.dedup import (
    LOADED_AT,
    duplicate_rows,
    has_rows,
    latest_per_key,
    null_key,
    null_key_rows,
    repeated_keys,
)
from goldvein.session import remove_folder, scratch_path
from goldvein.sources.rejects import write_rejects
from goldvein.sources.tables import (
    Table,
    create_empty,
    gathered,
    overwrite_table,
    partition_columns,
    partition_values,
    partitions_of,
    read_table,
    replace_partitions,
    table_exists,
)

CREATED, MODIFIED, CHANGE = "date_creation", "date_modification", "_change"
INSERT, UPDATE, UNCHANGED, KEPT = "insert", "update", "unchanged", "kept"

#: a batch up to this many rows is broadcast instead of shuffling the target
SMALL_BATCH_ROWS = 100_000

#: a batch is broadcast only if its texts and numbers take no more bytes than this
SMALL_BATCH_BYTES = 64 << 20


def require_columns(df: DataFrame, columns: Iterable[str]) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"the batch lacks {', '.join(missing)}")


def _any_changed(columns: Iterable[str]) -> Column:
    tests = [~F.col(f"_t_{c}").eqNullSafe(F.col(f"_s_{c}")) for c in columns]
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def _prefixed(df: DataFrame, keys: Sequence[str], prefix: str) -> DataFrame:
    rest = [F.col(f"`{c}`").alias(f"{prefix}{c}") for c in df.columns if c not in keys]
    return df.select(*keys, *rest, F.lit(True).alias(f"{prefix}here"))


def _merged_row(
    joined: DataFrame,
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    now: Column,
    loaded_at: str,
    compare_ignore: Iterable[str],
) -> DataFrame:
    values = [c for c in batch.columns if c not in (*keys, loaded_at)]
    shared = [c for c in values if c in target.columns]
    added = [c for c in values if c not in target.columns]
    audit = (CREATED, MODIFIED)
    kept_only = [c for c in target.columns if c not in (*keys, *values, *audit)]
    compared = [c for c in values if c not in set(compare_ignore)]

    joined = joined.withColumns({f"_t_{c}": F.lit(None) for c in added})
    here, there = F.col("_t_here").isNotNull(), F.col("_s_here").isNotNull()
    change = (
        F.when(~here, INSERT)
        .when(~there, KEPT)
        .when(_any_changed(compared), UPDATE)
        .otherwise(UNCHANGED)
    )
    classed = joined.withColumn(CHANGE, change)
    taken = F.col(CHANGE).isin(INSERT, UPDATE)

    def value(c: str) -> Column:
        if c in keys:
            return F.col(c)
        if c == CREATED:
            new, old = F.col(f"_s_{loaded_at}"), F.col(f"_t_{c}")
            return F.when(F.col(CHANGE) == INSERT, new).otherwise(old).alias(c)
        if c == MODIFIED:
            return F.when(taken, now).otherwise(F.col(f"_t_{c}")).alias(c)
        if c in kept_only:
            return F.col(f"_t_{c}").alias(c)
        new = F.col(f"_s_{c}")
        if c in shared:
            new = new.cast(target.schema[c].dataType)
        return F.when(taken, new).otherwise(F.col(f"_t_{c}")).alias(c)

    return classed.select(*[value(c) for c in (*target.columns, *added)], CHANGE)


def merge_batch(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    now: Column,
    *,
    loaded_at: str = LOADED_AT,
    compare_ignore: Iterable[str] = TECHNICAL_COLUMNS,
    small_batch: bool = False,
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """The target after the batch, plus ``_change`` per row.

    Both sides have at most one row per key and no null key, so no key is hot.
    ``small_batch`` says that the batch is known to be small enough to broadcast;
    its new rows are then gathered by the partitions they will be written to, the
    target's rows lie there already.
    """
    require_columns(batch, [*keys, loaded_at])
    t, s = _prefixed(target, keys, "_t_"), _prefixed(batch, keys, "_s_")
    finish = (target, batch, keys, now, loaded_at, tuple(compare_ignore))
    if not small_batch:
        return _merged_row(t.join(s, list(keys), "full_outer"), *finish)

    present = _merged_row(t.join(F.broadcast(s), list(keys), "left"), *finish)
    # the keys found in the target: a subset of the batch, so as small as it is
    found = target.select(*keys).join(F.broadcast(batch.select(*keys)), list(keys), "left_semi")
    fresh = s.join(F.broadcast(found), list(keys), "left_anti")
    nothing = {
        f"_t_{c}": F.lit(None).cast(target.schema[c].dataType)
        for c in target.columns
        if c not in keys
    }
    fresh = fresh.withColumns({**nothing, "_t_here": F.lit(None).cast("boolean")})
    return present.unionByName(gathered(_merged_row(fresh, *finish), partition_by))


def first_load(
    batch: DataFrame, keys: Sequence[str], now: Column, loaded_at: str = LOADED_AT
) -> DataFrame:
    """A batch into an empty target: nothing to join with."""
    require_columns(batch, [*keys, loaded_at])
    values = [c for c in batch.columns if c != loaded_at]
    return batch.select(
        *values,
        F.col(loaded_at).alias(CREATED),
        now.alias(MODIFIED),
        F.lit(INSERT).alias(CHANGE),
    )


def change_counts(merged: DataFrame) -> DataFrame:
    return merged.groupBy(CHANGE).agg(F.count("*").alias("n_rows"))


def without_change(merged: DataFrame) -> DataFrame:
    return merged.drop(CHANGE)


@dataclass(frozen=True)
class LoadResult:
    """What one load did to its table."""

    inserted: int
    updated: int
    unchanged: int
    rejects_folder: str | None
    #: values that casts turned into null, by column
    lost_in_casts: Mapping[str, int] = field(default_factory=dict)
    #: partitions that were rewritten; None if the table has none or is new
    touched: tuple[tuple, ...] | None = None


def _observed(merged: DataFrame) -> tuple[DataFrame, Observation]:
    """Count the changes while the rows are written, not in a job of their own.

    To be applied after the last shuffle: there every row is counted once, also
    when lost executors make Spark run tasks again.
    """
    seen = Observation()
    counts = [F.count_if(F.col(CHANGE) == c).alias(c) for c in (INSERT, UPDATE, UNCHANGED)]
    return without_change(merged.observe(seen, *counts)), seen


def _count_repeated(
    batch: DataFrame, keys: Sequence[str], name: str
) -> tuple[DataFrame, str]:
    """The repeated keys of a batch, written down because several steps look at them."""
    counted = repeated_keys(batch, keys)
    path = scratch_path(batch.sparkSession, f"repeated-{name}")
    counted.write.parquet(path)
    return batch.sparkSession.read.schema(counted.schema).parquet(path), path


def _export_rejects(
    batch: DataFrame,
    repeated: DataFrame,
    keys: Sequence[str],
    order: Mapping[str, object],
    root: str,
    name: str,
    batch_time: datetime,
) -> str | None:
    """Write duplicates and rows without a key; touch nothing if there are none."""
    folder = None
    if has_rows(repeated):
        losers = duplicate_rows(batch, keys, repeated=repeated, **order)
        folder = write_rejects(losers, root, name, batch_time, "duplicate_key")
    unmatched = null_key_rows(batch, keys)
    if has_rows(unmatched):
        folder = write_rejects(unmatched, root, name, batch_time, "null_key")
    return folder


def _touched_partitions(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], parts: Sequence[str], by_key: bool, small: bool
) -> list[tuple]:
    """The partitions a batch falls into, and those that hold its keys now.

    Where partitions follow from the key both are the same.  Otherwise a row may
    move, so its key is looked for in all partitions; only key and partition columns
    are read for that.
    """
    touched = batch.select(*parts)
    if not by_key:
        wanted = batch.where(~null_key(keys)).select(*keys)
        if not small:
            wanted = wanted.distinct()
        held = target.select(*dict.fromkeys((*keys, *parts)))
        found = held.join(F.broadcast(wanted) if small else wanted, list(keys), "left_semi")
        touched = touched.unionByName(found.select(*parts))
    return partition_values(touched, parts)


def _key_partitions(
    batch: DataFrame, keys: Sequence[str], partition_by: Sequence[str] | Mapping[str, Column]
) -> tuple[DataFrame, tuple[str, ...], bool]:
    """The batch with its partition columns, and whether they follow from the key.

    They do if they are key columns, or are given as expressions over key columns.
    """
    if not isinstance(partition_by, Mapping):
        return batch, tuple(partition_by), set(partition_by) <= set(keys)
    batch.select(*keys).select(*partition_by.values())  # fails on a column that is no key
    return batch.withColumns(dict(partition_by)), tuple(partition_by), True


def blank_keys_as_null(batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """An empty or blank text names no row, so as a key it is as good as none."""
    texts = [k for k in keys if isinstance(batch.schema[k].dataType, T.StringType)]
    return batch.withColumns({k: F.when(F.trim(F.col(k)) != "", F.col(k)) for k in texts})


def _fits_broadcast(batch: DataFrame, rows: int) -> bool:
    """Whether a batch is small in rows and in bytes; one pass, one number a task."""
    wide = [F.coalesce(F.length(F.col(f"`{f.name}`").cast("string")), F.lit(0)) for f in batch.schema]
    size = batch.agg(F.count("*").alias("n"), F.sum(reduce(lambda a, b: a + b, wide)).alias("b")).first()
    return size.n <= rows and (size.b or 0) + 16 * len(wide) * size.n <= SMALL_BATCH_BYTES


def upsert_table(
    batch: DataFrame,
    table: Table,
    keys: Sequence[str],
    *,
    rejects_root: str,
    batch_time: datetime,
    tie_breakers: Sequence[Column | str] = (),
    loaded_at: str = LOADED_AT,
    compare_ignore: Iterable[str] = TECHNICAL_COLUMNS,
    partition_by: Sequence[str] | Mapping[str, Column] = (),
    small_batch_rows: int = SMALL_BATCH_ROWS,
    blank_keys_are_null: bool = True,
    lost_in_casts: Observation | None = None,
) -> LoadResult:
    """Deduplicate a batch, keep its rejects, and bring the table up to date.

    A load reads and rewrites only the partitions that the batch falls into or that
    hold its keys.  ``partition_by`` are key columns or, as a mapping, expressions
    over key columns; then the key says where its row lies.  Other columns may
    change with a row: the row's old partition is found and rewritten too.

    ``lost_in_casts`` is an observation of the batch; its counts go into the result.
    """
    spark = batch.sparkSession
    require_columns(batch, [*keys, loaded_at])
    if blank_keys_are_null:
        batch = blank_keys_as_null(batch, keys)
    batch, parts, by_key = _key_partitions(batch, keys, partition_by)
    now = F.lit(batch_time)
    # Cleaning is the costly part of a batch and several steps below read it, most of
    # them a few columns only.  Written once, it also outlives lost executors.
    staged_at = scratch_path(spark, f"batch-{table.name}")
    batch.write.parquet(staged_at)
    batch = spark.read.schema(batch.schema).parquet(staged_at)
    if not table_exists(spark, table):
        empty_state = without_change(first_load(batch, keys, now, loaded_at))
        create_empty(spark, empty_state, table, parts)

    order = {"loaded_at": loaded_at, "tie_breakers": tie_breakers}
    repeated, repeated_at = _count_repeated(batch, keys, table.name)
    folder = _export_rejects(batch, repeated, keys, order, rejects_root, table.name, batch_time)
    newest = latest_per_key(batch, keys, repeated=repeated, **order)
    target = read_table(spark, table)
    touched = None

    if not has_rows(target):
        loaded = gathered(first_load(newest, keys, now, loaded_at), parts)
        state, seen = _observed(loaded)
        overwrite_table(state, table, parts, gather=False)
    else:
        table_parts = partition_columns(spark, table)
        small = _fits_broadcast(batch, small_batch_rows)
        if table_parts:
            by_key = by_key and set(table_parts) <= {*parts, *keys}
            touched = _touched_partitions(target, batch, keys, table_parts, by_key, small)
            target = partitions_of(target, table_parts, touched)
        merged = merge_batch(
            target,
            newest,
            keys,
            now,
            loaded_at=loaded_at,
            compare_ignore=compare_ignore,
            small_batch=small,
            partition_by=table_parts,
        )
        state, seen = _observed(gathered(merged, table_parts, gather=not (small and by_key)))
        if table_parts:
            replace_partitions(state, table, touched, gather=False)
        else:
            overwrite_table(state, table)
    # the table points to its new state, so what was staged for it can go
    remove_folder(spark, staged_at)
    remove_folder(spark, repeated_at)
    counts = [seen.get.get(c, 0) for c in (INSERT, UPDATE, UNCHANGED)]
    lost = dict(lost_in_casts.get) if lost_in_casts is not None else {}
    return LoadResult(*counts, folder, lost, None if touched is None else tuple(touched))
