"""Row-local column expressions and schema helpers; everything here stays inside code generation."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_FLOATING = (T.FloatType, T.DoubleType)


def quoted(name: str) -> str:
    """Backtick a column name so that dots, dashes and blanks in it are taken literally."""
    return "`" + name.replace("`", "``") + "`"


def column(name: str) -> Column:
    return F.col(quoted(name))


def safe_name(text: object) -> str:
    """Turn any value into something usable inside a column name (letters, digits, underscore)."""
    return re.sub(r"[^A-Za-z0-9_]+", "_", str(text)).strip("_") or "blank"


def numeric_columns(df: DataFrame, booleans: bool = False) -> list[str]:
    """Names of the numeric columns; ``booleans`` says whether true/false columns count as numbers."""
    wanted = (T.NumericType, T.BooleanType) if booleans else (T.NumericType,)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, wanted)]


def as_double(name: str) -> Column:
    return column(name).cast("double")


def nan_to_null(df: DataFrame) -> DataFrame:
    """Make NULL the only missing value: in Spark NaN compares greater than every number."""
    cleaned = {
        f.name: F.when(~F.isnan(column(f.name)), column(f.name))
        for f in df.schema.fields
        if isinstance(f.dataType, _FLOATING)
    }
    return df.withColumns(cleaned) if cleaned else df


def replace_sentinel(df: DataFrame, sentinel: float, columns: Iterable[str] | None = None) -> DataFrame:
    """Make a 'no value' code missing in the given (default: all numeric) columns."""
    names = list(columns) if columns is not None else numeric_columns(df)
    return df.withColumns({c: F.when(column(c) != sentinel, column(c)) for c in names})


def identify_missing(df: DataFrame, columns: Iterable[str] | None = None, suffix: str = "_missing") -> DataFrame:
    """Append a missing flag for every column, all in one projection."""
    names = list(columns) if columns is not None else df.columns
    return df.select("*", *[column(c).isNull().alias(c + suffix) for c in names])


def cut_binary(value: Column, threshold: float, or_equal_to: bool = False) -> Column:
    """Above the threshold or not; a missing value is not above it. As a filter it reaches the scan."""
    above = value >= threshold if or_equal_to else value > threshold
    return value.isNotNull() & above


def flag_to_double(value: Column, true_text: str = "t") -> Column:
    """Text flag to 1.0/0.0; a missing flag is 0.0."""
    return F.coalesce(value == true_text, F.lit(False)).cast("double")


def create_time_diff(start: Column, end: Column) -> Column:
    """The interval from ``start`` to ``end``."""
    return end - start


def whole_days(interval: Column) -> Column:
    """Whole days of a day-time interval rounded down, so that minus one hour is day -1.

    Works on intervals only, so no session time zone can move a day boundary.
    """
    toward_zero = F.extract(F.lit("DAY"), interval)
    past = interval < F.make_dt_interval(toward_zero.cast("int"))
    return toward_zero.cast("bigint") - past.cast("bigint")


def to_timestamp(value: Column, fmt: str | None = None) -> Column:
    """Text to a zone-less timestamp; text that is no date becomes missing."""
    parsed = F.try_to_timestamp(value, F.lit(fmt)) if fmt else F.try_to_timestamp(value)
    return parsed.cast("timestamp_ntz")


def within_dates(value: Column, *ranges: tuple[str, str]) -> Column:
    """Inside any of the half-open ranges ``[start, end)``; as a filter it reaches the scan."""
    hits = F.lit(False)
    for start, end in ranges:
        hits = hits | (
            (value >= F.lit(start).cast("timestamp_ntz")) & (value < F.lit(end).cast("timestamp_ntz"))
        )
    return value.isNotNull() & hits


def year_to_date(value: Column, year: int, end: str) -> Column:
    """From the first day of ``year`` up to but not including ``end``."""
    return within_dates(value, (f"{year}-01-01", end))


def month_on_common_year(value: Column) -> Column:
    """First day of the month in the year 1900, so that several years overlay on one axis."""
    return F.make_date(F.lit(1900), F.month(value), F.lit(1))


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole, missing when the whole is zero."""
    return F.try_divide(part.cast("double"), whole.cast("double")) * 100.0
