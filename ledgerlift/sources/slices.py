"""Landed entities in slices by year: what is written, and filters that read only the slices they need."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The partition column of landed entities that have a year.
SLICE = "_year"
#: Years beyond these share the first or last slice, so that stray dates open no slices of their own.
FIRST, LAST = 1900, 2200


def _clamped(year: int) -> int:
    return min(max(year, FIRST), LAST)


def slice_of(value: Column, kind: T.DataType) -> Column:
    """The slice of a year, or of the year of a day; NULL where there is none."""
    typed = value.try_cast(kind)
    year = F.year(typed) if _is_day(kind) else typed
    return F.when(year.isNotNull(), F.least(F.greatest(year, F.lit(FIRST)), F.lit(LAST))).cast("int")


def of_years(df: DataFrame, column: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """Rows whose year, or the year of whose day, lies from ``first`` to ``last``.

    Of a landed entity only the slices of these years are read; the rows come without the slice.
    """
    value, where = F.col(column), F.lit(True)
    day = _is_day(df.schema[column].dataType)
    if first is not None:
        where = where & (value >= (F.lit(f"{first}-01-01").cast("date") if day else F.lit(first)))
    if last is not None:
        where = where & (value < F.lit(f"{last + 1}-01-01").cast("date") if day else value <= F.lit(last))
    if SLICE not in df.columns:
        return df.filter(where)
    if first is not None:
        where = where & (F.col(SLICE) >= _clamped(first))
    if last is not None:
        where = where & (F.col(SLICE) <= _clamped(last))
    return df.filter(where).drop(SLICE)


def _is_day(kind: T.DataType) -> bool:
    return isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType))


def clustered(df: DataFrame, by: list[str], key: str) -> DataFrame:
    """Rows of one slice together, in pieces of the advised size however uneven slices are, each piece in order of ``key``.

    So a slice has few files, and their key ranges let joins and look-ups skip row groups.
    """
    return df.hint("rebalance", *by).sortWithinPartitions(*by, key)
