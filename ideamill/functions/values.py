"""Missing values, keys, dates and defaults."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ideamill.settings import (
    MAX_TIMESTAMP, MISSING_MARKS, NO_COMPANY_NAME, NO_DESCRIPTION, UNKNOWN_KEY,
)

# Milliseconds of the nanosecond time range; a value outside is not a date.
MAX_EPOCH_MS = 9_223_372_036_854


def missing_to_null(column: Column, data_type: T.DataType) -> Column:
    """NULL for an empty text, the text 'None' and NaN; other values unchanged."""
    if isinstance(data_type, T.StringType):
        return F.when(~column.isin(*MISSING_MARKS), column)
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return F.nanvl(column, F.lit(None).cast(data_type))
    return column


def normalise_missing(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Collapse all spellings of a missing value to NULL in the given columns."""
    chosen = set(df.columns if columns is None else columns)
    return df.select(*[
        missing_to_null(F.col(f.name), f.dataType).alias(f.name) if f.name in chosen
        else F.col(f.name)
        for f in df.schema.fields
    ])


def not_blank(column: Column) -> Column:
    """True for a text worth embedding: not NULL, blank or the text 'None'."""
    return F.coalesce(~F.trim(column).isin(*MISSING_MARKS), F.lit(False))


def known_key(column: Column) -> Column:
    """The key as a long, 0 where it is unknown."""
    return F.coalesce(column.cast("long"), F.lit(UNKNOWN_KEY).cast("long"))


def timestamp_or(column: Column, sentinel: str = MAX_TIMESTAMP) -> Column:
    return F.coalesce(column, F.lit(sentinel).cast("timestamp"))


def company_name(column: Column) -> Column:
    return F.coalesce(column, F.lit(NO_COMPANY_NAME))


def field_description(column: Column) -> Column:
    return F.when(column == "", F.lit(NO_DESCRIPTION)).otherwise(column)


def epoch_ms_to_date(column: Column) -> Column:
    """Day of an epoch-millisecond value; NULL outside the time range."""
    valid = F.when(column.between(-MAX_EPOCH_MS, MAX_EPOCH_MS), column)
    return F.to_date(F.timestamp_millis(valid))


def epoch_ms_to_timestamp(column: Column) -> Column:
    return F.timestamp_millis(F.when(column.between(-MAX_EPOCH_MS, MAX_EPOCH_MS), column))


def text_to_date(column: Column) -> Column:
    """Day of a date text; NULL when it does not parse."""
    return F.to_date(F.try_to_timestamp(column))


def day_of(df: DataFrame, column: str) -> Column:
    """Day of a column that holds epoch milliseconds, date text or a timestamp."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.IntegralType):
        return epoch_ms_to_date(F.col(column))
    if isinstance(kind, T.StringType):
        return text_to_date(F.col(column))
    return F.to_date(column)


def moment_of(df: DataFrame, column: str) -> Column:
    """Timestamp of a column that holds epoch milliseconds, date text or a timestamp."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.IntegralType):
        return epoch_ms_to_timestamp(F.col(column))
    if isinstance(kind, T.StringType):
        return F.try_to_timestamp(F.col(column))
    return F.col(column).cast("timestamp")


def without_time_zone(column: Column) -> Column:
    return column.cast("timestamp_ntz")


def part_after(column: Column, separator: str) -> Column:
    """Text after the last separator; the whole text when it is absent."""
    return F.substring_index(column, separator, -1)


def word_at(column: Column, index: int, separator: str = " ") -> Column:
    """The index-th part (from 0) of a split text, NULL when there are fewer."""
    return F.get(F.split(column, rf"\Q{separator}\E"), F.lit(index))


def day_text(column: Column, day_first: bool = False) -> Column:
    return F.date_format(column, "dd-MM-yyyy" if day_first else "yyyy-MM-dd")


def ensure_columns(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Add the absent columns (name -> type) as NULL."""
    absent = {n: F.lit(None).cast(t) for n, t in columns.items() if n not in df.columns}
    return df.withColumns(absent) if absent else df


def compact_left(df: DataFrame, families: Iterable[list[str]]) -> DataFrame:
    """Move the non-NULL values of each numbered family to its first columns."""
    moved = {}
    for family in families:
        filled = F.array_compact(F.array(*family))
        moved |= {name: F.get(filled, F.lit(i)) for i, name in enumerate(family)}
    return df.withColumns(moved)
