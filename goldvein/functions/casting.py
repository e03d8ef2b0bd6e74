"""Casting by a column -> type mapping."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

DATE_FORMAT = "yyyy-MM-dd"
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"

_BLANKS = r"[\x00-\x20\x7f-\x9f]*"
# What every text that a type name can read looks like.  A lenient cast makes an exception
# of each text it can't read, some twenty microseconds each, so others don't reach it.
_READABLE = {
    "tinyint": rf"^{_BLANKS}[+-]?0*[0-9]{{1,3}}{_BLANKS}$",
    "smallint": rf"^{_BLANKS}[+-]?0*[0-9]{{1,5}}{_BLANKS}$",
    "int": rf"^{_BLANKS}[+-]?0*[0-9]{{1,10}}{_BLANKS}$",
    "bigint": rf"^{_BLANKS}[+-]?0*[0-9]{{1,19}}{_BLANKS}$",
    "float": "(?i)[0-9]|inf|nan",
    "double": "(?i)[0-9]|inf|nan",
    "decimal": r"\p{Nd}",
    "date": rf"^{_BLANKS}[+-]?[0-9]{{4,7}}(-|{_BLANKS}$)",
}
_SHORT_NAMES = {"byte": "tinyint", "short": "smallint", "integer": "int", "long": "bigint"}


def cast_value(
    value: Column,
    dtype: str | T.DataType,
    *,
    date_format: str = DATE_FORMAT,
    timestamp_format: str = TIMESTAMP_FORMAT,
    strict: bool = False,
) -> Column:
    """Cast one column; a value that does not fit is null, or an error if ``strict``.

    Type objects for dates and timestamps read text by the given format, type
    names use Spark's own rules.
    """
    if isinstance(dtype, T.DateType):
        return F.to_date(value, date_format) if strict else F.try_to_date(value, date_format)
    if isinstance(dtype, T.TimestampType):
        parse = F.to_timestamp if strict else F.try_to_timestamp
        return parse(value, F.lit(timestamp_format) if not strict else timestamp_format)
    return value.cast(dtype) if strict else value.try_cast(dtype)


def _cast(df: DataFrame, column: str, dtype: str | T.DataType, **options) -> Column:
    """Cast a column of a frame; of a text column, only texts that look like the type."""
    value = F.col(column)
    cast = cast_value(value, dtype, **options)
    if options.get("strict") or not isinstance(df.schema[column].dataType, T.StringType):
        return cast
    if isinstance(dtype, (T.DateType, T.TimestampType)):  # read by a format
        return cast
    name = (dtype if isinstance(dtype, str) else dtype.simpleString()).strip().lower()
    name = name.split("(")[0].strip()
    readable = _READABLE.get(_SHORT_NAMES.get(name, name))
    return F.when(value.rlike(readable), cast) if readable else cast


def cast_columns(df: DataFrame, types: Mapping[str, str | T.DataType], **options) -> DataFrame:
    """Cast the named columns that exist, all in one projection."""
    return df.withColumns(
        {c: _cast(df, c, t, **options) for c, t in types.items() if c in df.columns}
    )


def _with_losses(
    df: DataFrame, types: Mapping[str, str | T.DataType], **options
) -> tuple[DataFrame, list[str]]:
    """The frame with every cast made once, as ``_cast_<column>``, and whether it lost a
    non-empty value, as ``_lost_<column>``."""
    named = [c for c in types if c in df.columns]
    cast = df.withColumns({f"_cast_{c}": _cast(df, c, types[c], **options) for c in named})

    def lost(c: str) -> Column:
        given = F.col(c).isNotNull() & (F.trim(F.col(c).cast("string")) != "")
        return F.col(f"_cast_{c}").isNull() & given

    return cast.withColumns({f"_lost_{c}": lost(c) for c in named}), named


def cast_and_observe(
    df: DataFrame, types: Mapping[str, str | T.DataType], lost: Observation, **options
) -> DataFrame:
    """Like ``cast_columns``; what the casts lose is counted when the frame is written."""
    both, named = _with_losses(df, types, **options)
    if not named:
        return df
    both = both.observe(lost, *[F.count_if(F.col(f"_lost_{c}")).alias(c) for c in named])
    return both.select(*[F.col(f"_cast_{c}").alias(c) if c in named else F.col(f"`{c}`") for c in df.columns])


def cast_failures(df: DataFrame, types: Mapping[str, str | T.DataType], **options) -> DataFrame:
    """One row per cast column: how many values were lost.  One pass over the data."""
    both, named = _with_losses(df, types, **options)
    counts = both.agg(*[F.count_if(F.col(f"_lost_{c}")).alias(c) for c in named])
    return counts.unpivot([], named, "column_name", "failed")
