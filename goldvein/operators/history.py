"""History of a dimension: a row for each stretch of time in which a key's values were the same.

A batch says what values a key has from some moment on.  Values that differ close the
version that holds then and open a new one; a change that comes late, for a moment in
the past, splits the version that holds at that moment.  Values that are the same open
nothing but are remembered (`confirmed`): if a late change comes before them, the old
values are back from there on.  So the state does not depend on the order in
which batches arrive.

A load works on the versions that end at or after the earliest moment that the batch
brings for their key; versions that ended before are not touched.  In a table these
lie in partitions by the month in which they ended, so earlier months are not read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldvein.functions.amounts import month_key
from goldvein.operators.dedup import latest_per_key, null_key
from goldvein.operators.ordered import MONTH, as_of, beside
from goldvein.session import remove_folder, scratch_path
from goldvein.sources.tables import (
    Table,
    create_empty,
    partition_values_of,
    read_table,
    replace_partitions,
    table_exists,
)

FROM, TO, CURRENT, CONFIRMED = "valid_from", "valid_to", "is_current", "confirmed"
ENDED = "ended_month"

#: the partition of versions that still hold
OPEN_MONTH = 999912


@dataclass(frozen=True)
class Historized:
    """How a dimension is kept: key, moment of a change, and the columns that are compared.

    ``loaded_at`` orders rows of one key and moment, the newest counts; ``size`` is the
    stretch of time that one window covers (`ordered`).
    """

    keys: tuple[str, ...]
    at: str
    columns: tuple[str, ...]
    loaded_at: str
    size: str = MONTH


def _values(columns: Sequence[str]) -> Column:
    return F.struct(*[F.col(f"`{c}`") for c in columns])


def empty_history(batch: DataFrame, how: Historized) -> DataFrame:
    """The columns of a history, without rows."""
    at = batch.schema[how.at].dataType
    return batch.limit(0).select(
        *how.keys,
        *how.columns,
        F.lit(None).cast(at).alias(FROM),
        F.lit(None).cast(at).alias(TO),
        F.lit(None).cast("boolean").alias(CURRENT),
        F.array().cast(f"array<{at.simpleString()}>").alias(CONFIRMED),
    )


def _versions(points: DataFrame, how: Historized) -> DataFrame:
    """Versions from all moments at which the values of a key are known."""
    keys, value = list(how.keys), _values(how.columns)
    told = beside(points, keys, how.at, F.struct(value.alias("v")), "_before", size=how.size)
    same = F.col("_before").isNotNull() & F.col("_before.v").eqNullSafe(value)
    told = told.withColumn("_same", same).drop("_before")
    path = scratch_path(points.sparkSession, "told")
    told.write.parquet(path)
    told = points.sparkSession.read.schema(told.schema).parquet(path)

    starts = told.where(~F.col("_same")).drop("_same").withColumnRenamed(how.at, FROM)
    ends = beside(starts, keys, FROM, F.struct(FROM), "_next", following=True, size=how.size)
    ends = ends.withColumn(TO, F.col(f"_next.{FROM}")).drop("_next")
    again = told.where("_same").select(*keys, how.at)
    begun = starts.select(*keys, F.col(FROM).alias("_from"), F.col(FROM).alias("_start"))
    again = as_of(again, begun, keys, how.at, "_from", ["_start"], size=how.size)
    # as many moments as a version was confirmed at
    again = again.groupBy(*keys, F.col("_start").alias(FROM)).agg(F.sort_array(F.collect_list(how.at)).alias(CONFIRMED))
    none = F.array().cast(again.schema[CONFIRMED].dataType)
    return ends.join(again, [*keys, FROM], "left").select(
        *keys, *how.columns, FROM, TO, F.col(TO).isNull().alias(CURRENT), F.coalesce(CONFIRMED, none).alias(CONFIRMED)
    )


def merged_history(history: DataFrame, batch: DataFrame, how: Historized) -> DataFrame:
    """The history after a batch.  Rows without a key or a moment are left out.

    Tables between the steps are in the session's shared folder.
    """
    spark, keys = batch.sparkSession, list(how.keys)
    named = batch.where(~null_key([*keys, how.at]))
    news = latest_per_key(named, [*keys, how.at], loaded_at=how.loaded_at).select(*keys, how.at, *how.columns)
    path = scratch_path(spark, "news")
    news.write.parquet(path)
    news = spark.read.schema(news.schema).parquet(path)

    since = news.groupBy(*keys).agg(F.min(how.at).alias("_since"))
    # unique keys on the right: no row is repeated, and the history is shuffled once at most
    seen = history.join(since, keys, "left")
    touched = F.col("_since").isNotNull() & (F.col(TO).isNull() | (F.col(TO) >= F.col("_since")))
    untouched = seen.where(~touched).select(*history.columns)
    held = seen.where(touched).select(
        *keys, F.explode(F.concat(F.array(FROM), CONFIRMED)).alias(how.at), *how.columns, F.lit(0).alias("_new")
    )
    points = held.unionByName(news.withColumn("_new", F.lit(1)))
    newest = F.max_by(_values(how.columns), F.col("_new")).alias("_v")
    points = points.groupBy(*keys, how.at).agg(newest).select(*keys, how.at, "_v.*")
    path = scratch_path(spark, "points")
    points.write.parquet(path)
    points = spark.read.schema(points.schema).parquet(path)
    return untouched.unionByName(_versions(points, how).select(*history.columns))


def _ended(versions: DataFrame) -> DataFrame:
    month = F.coalesce(month_key(F.col(TO).cast("date")), F.lit(OPEN_MONTH))
    return versions.withColumn(ENDED, month.cast("int"))


def load_history(batch: DataFrame, table: Table, how: Historized) -> None:
    """Bring the history in a table up to date; only months from the earliest change on are rewritten."""
    spark = batch.sparkSession
    path = scratch_path(spark, f"batch-{table.name}")
    batch.write.parquet(path)
    batch = spark.read.schema(batch.schema).parquet(path)
    if not table_exists(spark, table):
        create_empty(spark, _ended(empty_history(batch, how)), table, [ENDED])
    first = batch.where(~null_key(how.keys)).agg(month_key(F.min(how.at).cast("date"))).first()[0]
    if first is None:
        return
    months = [v for v in partition_values_of(spark, table) if v[0] >= first]
    held = read_table(spark, table).where(F.col(ENDED) >= first).drop(ENDED)
    replace_partitions(_ended(merged_history(held, batch, how)), table, months)
    remove_folder(spark, path)
