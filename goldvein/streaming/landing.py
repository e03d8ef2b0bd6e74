"""Landing files, each read once.

Every feed has a ledger: the checkpoint of a file stream that runs until it has read
what lies there and then ends.  The next run reads only files that the ledger does not
know.  A run is cut into loads of at most `max_files` files, numbered by the ledger.

A load is a partition of its raw table, so loading it again replaces it.  Where a run
breaks off after the table was written and before the ledger says so, the ledger gives
the next run the same files under the same number: nothing is lost and nothing comes
twice.  Files are told apart by path; one that is changed in place is not read again.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldvein.sources import quarantine
from goldvein.sources.feeds import Feed, with_provenance
from goldvein.sources.rejects import write_rejects
from goldvein.sources.tables import Table, overwrite_table, read_table, replace_partitions, table_exists

LOAD = "_load"

#: files of a load at most, so that a long backlog is worked off in bounded steps
MAX_FILES = 10_000


@dataclass(frozen=True)
class Landed:
    """What a run found: its loads, sound rows, and broken rows by reason."""

    loads: tuple[int, ...] = ()
    rows: int = 0
    rejected: Mapping[str, int] = field(default_factory=dict)


def new_files(
    spark: SparkSession, root: str, feed: Feed, batch_time: datetime, max_files: int = MAX_FILES
) -> DataFrame:
    """A stream of the rows of a feed's files, with provenance and, if broken, text and reason."""
    raw = (
        spark.readStream.schema(quarantine.reading_schema(feed.schema))
        .options(**quarantine.reading_options(feed.separator))
        .option("maxFilesPerTrigger", max_files)
        .csv(f"{root.rstrip('/')}/{feed.folder}/*.csv")
    )
    why = quarantine.reject_reason(feed.schema, feed.separator)
    return with_provenance(raw, F.lit(batch_time)).withColumn(quarantine.REASON, why)


def store_load(rows: DataFrame, load: int, table: Table) -> None:
    """The rows as one load of a raw table, in place of what that load had before."""
    numbered = rows.withColumn(LOAD, F.lit(load).cast("long"))
    if not table_exists(rows.sparkSession, table):
        overwrite_table(numbered, table, [LOAD], gather=False)
    else:
        replace_partitions(numbered, table, [(load,)], gather=False)


def ingest_new(
    spark: SparkSession,
    root: str,
    feed: Feed,
    table: Table,
    ledger: str,
    rejects_root: str,
    batch_time: datetime,
    *,
    max_files: int = MAX_FILES,
    stored: Callable[[int], None] | None = None,
) -> Landed:
    """Bring the files that are new since the last run into a raw table.

    Broken rows go to the rejects of the table.  ``stored`` is called with the number of
    each load when it is in the table and the ledger does not know yet.
    """
    loads: list[int] = []
    rows, rejected = 0, dict.fromkeys(quarantine.REASONS, 0)

    def one(batch: DataFrame, load: int) -> None:
        nonlocal rows
        parts = quarantine.sorted_out(batch)
        store_load(parts.sound, load, table)
        for reason, n in parts.rejected.items():
            broken = parts.broken.where(F.col(quarantine.REASON) == reason)
            named = broken.select(quarantine.RECORD, "_source_file", "_ingested_at")
            write_rejects(named, rejects_root, f"{table.name}/load={load}", batch_time, reason)
            rejected[reason] += n
        parts.done()
        rows += parts.rows
        loads.append(load)
        if stored:
            stored(load)

    stream = new_files(spark, root, feed, batch_time, max_files)
    run = stream.writeStream.trigger(availableNow=True).option("checkpointLocation", ledger).foreachBatch(one).start()
    run.awaitTermination()
    return Landed(tuple(loads), rows, {r: n for r, n in rejected.items() if n})


def loaded(spark: SparkSession, table: Table, loads: tuple[int, ...] | None = None) -> DataFrame:
    """Rows of some loads of a raw table; only their partitions are read."""
    rows = read_table(spark, table)
    if loads is not None:
        rows = rows.where(F.col(LOAD).isin(list(loads)))
    return rows.drop(LOAD)
