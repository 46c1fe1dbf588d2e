"""Rolling train and test sets by time, as one long table with ``split_id`` and ``role``."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.functions import column

SPLIT, ROLE = "split_id", "role"
# The list of boundaries is held on the driver; a history cut into more windows than this is a wrong window length.
MAX_SPLITS = 100_000
# Lower bounds in seconds of the units a window may be given in, to size the list of windows.
SHORTEST_SECONDS = {
    "years": 365 * 86400, "months": 28 * 86400, "weeks": 7 * 86400, "days": 86400, "hours": 3600, "minutes": 60,
    "seconds": 1,
}


def _moment(value: datetime) -> Column:
    """A literal without a time zone; going through text keeps the driver's own zone out of it."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def shift(start: Column, length: Mapping[str, int], times: Column | int = 1, sign: int = 1) -> Column:
    """``start`` plus ``times`` lengths: months first (the day is cut to the month's last), then the rest."""
    unknown = set(length) - set(SHORTEST_SECONDS)
    if unknown:
        raise ValueError(f"unknown time units {sorted(unknown)}")
    n = F.lit(times) if isinstance(times, int) else times
    months = 12 * length.get("years", 0) + length.get("months", 0)
    days = 7 * length.get("weeks", 0) + length.get("days", 0)
    moved = start
    if months:
        moved = moved + F.make_ym_interval(F.lit(0), (n * F.lit(sign * months)).cast("int"))
    rest = [length.get(u, 0) for u in ("hours", "minutes", "seconds")]
    if days or any(rest):
        moved = moved + F.make_dt_interval(
            (n * F.lit(sign * days)).cast("int"), (n * F.lit(sign * rest[0])).cast("int"),
            (n * F.lit(sign * rest[1])).cast("int"), (n * F.lit(sign * rest[2])).cast("decimal(18,6)"),
        )
    return moved


def split_boundaries(
    spark: SparkSession, first_date, last_date, time_length: Mapping[str, int], gap: Mapping[str, int] | None = None,
    first_test=None,
) -> list:
    """Rows ``split_id, train_end, test_start, test_end``, held on the driver: ``MAX_SPLITS`` at most.

    The first test window starts at ``first_test``, else one length after the first date. Windows
    are counted from that origin, so month ends do not drift, and stop once a window would start at
    or after the last date: a last row exactly on such a boundary is in no test set.
    """
    shortest = sum(SHORTEST_SECONDS[u] * n for u, n in time_length.items())
    if shortest <= 0:
        raise ValueError("time_length must be positive")
    upper = int((last_date - first_date).total_seconds() // shortest) + 2
    if upper > 20 * MAX_SPLITS:
        raise ValueError(f"more than {MAX_SPLITS} splits; use a longer time_length")
    i = F.col("id")
    origin = _moment(first_test) if first_test is not None else shift(
        _moment(first_date), time_length)
    start = shift(F.col("origin"), time_length, i)
    rows = (
        spark.range(upper).withColumn("origin", origin)
        .select(
            (i + 1).cast("int").alias(SPLIT), start.alias("test_start"),
            shift(F.col("origin"), time_length, i + 1).alias("test_end"),
        )
        .where(F.col("test_start") < _moment(last_date))
        .withColumn("train_end", shift(F.col("test_start"), gap, sign=-1) if gap else F.col("test_start"))
        .orderBy(SPLIT).collect()
    )
    if len(rows) > MAX_SPLITS:
        raise ValueError(f"more than {MAX_SPLITS} splits; use a longer time_length")
    return rows


def assign_splits(df: DataFrame, date_col: str, boundaries: list) -> DataFrame:
    """Copy each row into every training and test set it belongs to.

    The windows follow each other without a break and are literals in the plan, so this is a
    row-local generator: no join, no shuffle.
    """
    if not boundaries:
        return df.select("*", F.lit(1).alias(SPLIT), F.lit("train").alias(ROLE)).limit(0)
    first_id, last_id = boundaries[0][SPLIT], boundaries[-1][SPLIT]
    d = column(date_col).cast("timestamp_ntz")

    def reached(name: str) -> Column:
        """How many windows have this boundary at or before the date; the boundaries are in order."""
        limits = F.array(*[_moment(b[name]) for b in boundaries])
        return F.size(F.filter(limits, lambda limit: limit <= d))

    tested = F.lit(first_id - 1) + reached("test_start")
    in_test = (tested >= first_id) & (d < _moment(boundaries[-1].test_end))
    first_trained = F.lit(first_id) + reached("train_end")
    none = F.array().cast("array<int>")
    train_ids = F.when(first_trained <= last_id, F.sequence(first_trained, F.lit(last_id), F.lit(1))).otherwise(none)
    # one number per copy of the row; the test copy carries its split as a negative number
    copies = F.concat(F.when(in_test, F.array(-tested)).otherwise(none), train_ids)
    member = df.where(d.isNotNull()).select("*", F.explode(copies).alias("__copy"))
    return member.select(
        *[column(c) for c in df.columns], F.abs("__copy").alias(SPLIT),
        F.when(F.col("__copy") < 0, "test").otherwise("train").alias(ROLE))


def date_range(df: DataFrame, date_col: str):
    d = column(date_col).cast("timestamp_ntz")
    return df.agg(F.min(d).alias("first"), F.max(d).alias("last")).first()


def temporal_boundaries(
    df: DataFrame, date_col: str, time_length: Mapping[str, int], gap: Mapping[str, int] | None = None,
    start_date: str | None = None, drop_before: bool = False,
) -> tuple[DataFrame, list]:
    """The rows that take part, and the boundaries of ``create_temporal_splits``; none without a date."""
    if start_date and drop_before:
        df = df.where(column(date_col) > F.lit(start_date).cast("timestamp_ntz"))
    span = date_range(df, date_col)
    if span.last is None:
        return df, []
    return df, split_boundaries(df.sparkSession, span.first, span.last, time_length, gap, _iso(start_date))


def create_temporal_splits(
    df: DataFrame, date_col: str, time_length: Mapping[str, int], gap: Mapping[str, int] | None = None,
    start_date: str | None = None, drop_before: bool = False,
) -> DataFrame:
    """Test windows of one length, each with all earlier rows (less a gap) as training rows.

    ``start_date`` (ISO) is the first date of the first test window. ``drop_before`` also removes the
    rows up to and including it, as some callers expect. Every row is copied into each split it belongs to;
    ``windows.temporal_windows`` has the same splits without copies.
    """
    rows, boundaries = temporal_boundaries(df, date_col, time_length, gap, start_date, drop_before)
    return assign_splits(rows, date_col, boundaries)


def consecutive_boundaries(
    df: DataFrame, date_col: str, time_length: Mapping[str, int], start_date: str | None = None
) -> tuple[DataFrame, list]:
    """The rows that take part, and the boundaries of ``create_consecutive_splits``; none without a date."""
    if start_date:
        df = df.where(column(date_col) > F.lit(start_date).cast("timestamp_ntz"))
    span = date_range(df, date_col)
    if span.last is None:
        return df, []
    origin = _iso(start_date) or span.first
    windows = split_boundaries(df.sparkSession, span.first, span.last, time_length, None, origin)[1:]
    return df, [_renumber(w) for w in windows]


def create_consecutive_splits(
    df: DataFrame, date_col: str, time_length: Mapping[str, int], start_date: str | None = None
) -> DataFrame:
    """Windows counted from the first date (or ``start_date``); window i is tested on all windows before it."""
    rows, boundaries = consecutive_boundaries(df, date_col, time_length, start_date)
    return assign_splits(rows, date_col, boundaries)


def _renumber(window):
    values = window.asDict()
    values[SPLIT] -= 1
    return type(window)(**values)


def _iso(text: str | None) -> datetime | None:
    return datetime.fromisoformat(text) if text else None


def train_rows(splits: DataFrame, split_id: int) -> DataFrame:
    return splits.where((F.col(SPLIT) == split_id) & (F.col(ROLE) == "train"))


def test_rows(splits: DataFrame, split_id: int) -> DataFrame:
    return splits.where((F.col(SPLIT) == split_id) & (F.col(ROLE) == "test"))
