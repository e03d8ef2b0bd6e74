"""Rows a load turned away, kept with the reason."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def rejects_folder(root: str, table_name: str, day: date) -> str:
    return f"{root.rstrip('/')}/{table_name}_rejets/{day:%Y-%m-%d}/"


def write_rejects(
    rejected: DataFrame, root: str, table_name: str, batch_time: datetime, reason: str
) -> str:
    """Write the rejects of one batch and reason; the same batch again replaces its own.

    Each batch has a folder of its own below its day's, so a repeated run leaves the
    same rows.  Parquet, because texts may hold line breaks.  Gives the day's folder.
    """
    folder = rejects_folder(root, table_name, batch_time.date())
    own = f"{folder}batch={batch_time:%H%M%S%f}/reason={reason}"
    with_reason(rejected, reason).write.mode("overwrite").parquet(own)
    return folder


def read_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """All rejects of a day, with the columns that any of its batches has."""
    found = spark.read.option("mergeSchema", "true").parquet(folder)
    return found.drop("batch", "reason")


def with_reason(rejected: DataFrame, reason: str) -> DataFrame:
    return rejected.withColumn("_reject_reason", F.lit(reason))
