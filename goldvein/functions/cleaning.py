"""Cleaning expressions and the frame-wide cleaner."""

from __future__ import annotations

import string
import unicodedata
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldvein import TECHNICAL_COLUMNS

# What a cleaned text may not contain, and what stands for "missing".  Characters
# one by one are looked up in a table; ranges would be tried one after the other at each.
_KEPT = string.ascii_letters + string.digits
NOT_KEPT = rf"[^{_KEPT}&:\-, ]"
NOT_KEPT_WITH_POINT = rf"[^{_KEPT}&:\-,. ]"
EMPTY_DATE = "1900-01-01"
EMPTY_TIMESTAMP = "1900-01-01 00:00:00"


def _accent_pairs() -> tuple[str, str]:
    """Latin letters with marks, and the plain letters they are built on."""
    marked, plain = [], []
    for code in range(0x00C0, 0x0180):
        base = unicodedata.normalize("NFD", chr(code))[0]
        if base.isascii() and base.isalpha():
            marked.append(chr(code))
            plain.append(base)
    return "".join(marked), "".join(plain)


_MARKED, _PLAIN = _accent_pairs()


def fold_accents(text: Column) -> Column:
    """Replace accented Latin letters by their plain letter."""
    return F.translate(text, _MARKED, _PLAIN)


def clean_text(text: Column, not_kept: str = NOT_KEPT, fold: bool = False) -> Column:
    """Null becomes empty, outer blanks go, then every unwanted character goes."""
    text = F.coalesce(text, F.lit(""))
    if fold:
        text = fold_accents(text)
    return F.regexp_replace(F.trim(text), not_kept, "")


def filled(value: Column, dtype: T.DataType) -> Column:
    """The column with its type's stand-in for null; other types stay as they are."""
    if isinstance(dtype, T.NumericType):
        return F.coalesce(value, F.lit(0).cast(dtype))
    if isinstance(dtype, T.DateType):
        return F.coalesce(value, F.lit(EMPTY_DATE).cast(dtype))
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.coalesce(value, F.lit(EMPTY_TIMESTAMP).cast(dtype))
    return value


def clean_frame(
    df: DataFrame,
    *,
    not_kept: Mapping[str, str] | None = None,
    fold: bool = False,
    skip: Iterable[str] = TECHNICAL_COLUMNS,
) -> DataFrame:
    """Clean every column by its type in one projection.

    ``not_kept`` overrides the deleted characters per column (for example to keep
    the decimal point of an amount); columns in ``skip`` pass through.
    """
    not_kept = not_kept or {}
    skip = set(skip)
    out = []
    for field in df.schema.fields:
        value = F.col(f"`{field.name}`")
        if field.name in skip:
            cleaned = value
        elif isinstance(field.dataType, T.StringType):
            cleaned = clean_text(value, not_kept.get(field.name, NOT_KEPT), fold)
        else:
            cleaned = filled(value, field.dataType)
        out.append(cleaned.alias(field.name))
    return df.select(*out)


def upper_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.withColumns({c: F.upper(F.col(c)) for c in columns})


def lower_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.withColumns({c: F.lower(F.col(c)) for c in columns})


def phone_number(value: Column) -> Column:
    """Undo numbers that were stored as floats: everything from the first point goes."""
    return F.regexp_replace(value, r"\..*", "")


def phone_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.withColumns({c: phone_number(F.col(c)) for c in columns})


def digits_only(value: Column) -> Column:
    """``250g`` -> ``250``."""
    return F.regexp_replace(value, r"[^0-9]", "")


def decimal_point(value: Column) -> Column:
    """``12,5`` -> ``12.5``."""
    return F.translate(value, ",", ".")


def without_thousands(value: Column) -> Column:
    """``1,234,567`` -> ``1234567``; a comma that does not part three digits stays."""
    return F.regexp_replace(value, r"(?<=\d),(?=\d{3}(?!\d))", "")


def replace_values(df: DataFrame, column: str, values: Mapping[str, str]) -> DataFrame:
    """Swap whole values, such as a number word for its digits."""
    return df.replace(dict(values), subset=[column])


def leading_columns(df: DataFrame, first: Iterable[str]) -> DataFrame:
    """Put ``first`` in front; the other columns keep their order."""
    first = list(first)
    return df.select(*first, *[c for c in df.columns if c not in first])
