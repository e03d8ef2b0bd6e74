"""Broken CSV rows: told apart while the file is read, kept with reason, file and text.

A row is broken if it has fewer or more columns than declared or a value that its
declared type cannot hold.  Spark's reader puts the text of such a row into a column
of its own; why it is broken is worked out for these rows only.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldvein.session import remove_folder, scratch_path

RECORD, REASON = "_record", "_reject_reason"
TOO_FEW, TOO_MANY, WRONG_TYPE = "too_few_columns", "too_many_columns", "wrong_type"
REASONS = (TOO_FEW, TOO_MANY, WRONG_TYPE)
_MARK = "\x01"


def declared(schema: str | T.StructType) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)


def reading_schema(schema: str | T.StructType) -> T.StructType:
    """The declared columns and one for the text of a broken row."""
    return T.StructType([*declared(schema).fields, T.StructField(RECORD, T.StringType())])


def reading_options(separator: str = ",", header: bool = True) -> dict[str, str]:
    return {"header": str(header).lower(), "sep": separator, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": RECORD}


def reject_reason(schema: str | T.StructType, separator: str = ",") -> Column:
    """Why a row is broken, null for a sound one.

    The text is parsed once more with every column as text and a mark at its end: the
    column that the mark falls into tells how many columns the row has.
    """
    n = len(declared(schema))
    marked = F.concat(F.col(RECORD), F.lit(separator + _MARK))
    texts = ", ".join(f"c{i} STRING" for i in range(n + 1))
    parsed = F.from_csv(marked, texts, {"sep": separator, "mode": "PERMISSIVE"})
    columns = F.array_position(F.array(*[parsed[f"c{i}"] for i in range(n + 1)]), _MARK) - 1
    why = F.when(columns == n, WRONG_TYPE).when(columns >= 0, TOO_FEW).otherwise(TOO_MANY)
    return F.when(F.col(RECORD).isNotNull(), why)


def scan_csv(
    spark: SparkSession, path: str, schema: str | T.StructType, separator: str = ",", header: bool = True
) -> DataFrame:
    """CSV with the declared columns, the text of broken rows, and the reason why they are."""
    raw = spark.read.schema(reading_schema(schema)).options(**reading_options(separator, header)).csv(path)
    return raw.withColumn(REASON, reject_reason(schema, separator))


@dataclass(frozen=True)
class Sorted:
    """One pass over a batch: its sound rows, its broken rows, and how many of each."""

    sound: DataFrame
    broken: DataFrame
    rows: int
    rejected: Mapping[str, int] = field(default_factory=dict)
    folder: str = ""

    def done(self) -> None:
        """Both parts have been stored elsewhere."""
        remove_folder(self.sound.sparkSession, self.folder)


def sorted_out(scanned: DataFrame) -> Sorted:
    """Write a scanned batch once, sound and broken rows apart, counted on the way.

    The text is read and parsed in this one job.  Both parts are files in the session's
    shared folder, so what follows can read them as often as it likes.
    """
    spark, folder = scanned.sparkSession, scratch_path(scanned.sparkSession, "landed")
    seen = Observation()
    counts = [F.count_if(F.col(REASON).isNull()).alias("rows")]
    counts += [F.count_if(F.col(REASON) == r).alias(r) for r in REASONS]
    marked = scanned.observe(seen, *counts).withColumn("_broken", F.col(REASON).isNotNull())
    marked.write.partitionBy("_broken").parquet(folder)
    found = spark.read.schema(marked.schema).parquet(folder)
    sound = found.where(~F.col("_broken")).drop("_broken", RECORD, REASON)
    broken = found.where("_broken").drop("_broken")
    got = seen.get
    return Sorted(sound, broken, got["rows"], {r: got[r] for r in REASONS if got[r]}, folder)
