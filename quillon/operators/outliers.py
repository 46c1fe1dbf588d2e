"""Values more than 1.5 quartile ranges outside the quartiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.functions import as_double, column, numeric_columns
from quillon.operators.describe import long_numbers
from quillon.operators.ranks import exact_quantiles

REACH = 1.5


def fit_outlier_bounds(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Lower and upper bound per column, all from one set of exact quartiles."""
    quartiles = exact_quantiles(long_numbers(df, columns), ["column"], "value", [0.25, 0.75], ["q1", "q3"])
    return {
        r["column"]: (r.q1 - REACH * (r.q3 - r.q1), r.q3 + REACH * (r.q3 - r.q1)) for r in quartiles.collect()
    }


def outlier_flag(name: str, bounds: dict[str, tuple[float, float]]) -> Column:
    if name not in bounds:
        return F.lit(False)
    low, high = bounds[name]
    return F.coalesce((as_double(name) < low) | (as_double(name) > high), F.lit(False))


def find_outliers_univariate(df: DataFrame, name: str, flag: str = "outlier") -> DataFrame:
    """Append whether the row's value is an outlier of its column; a missing value is none."""
    return df.withColumn(flag, outlier_flag(name, fit_outlier_bounds(df, [name])))


def find_outliers(df: DataFrame, key: str | None = None, excluded: str | Sequence[str] | None = None) -> DataFrame:
    """Per row: a flag per checked column, how many are set, and that as a percentage of the columns."""
    left_out = {excluded} if isinstance(excluded, str) else set(excluded or ())
    names = [c for c in numeric_columns(df) if c not in left_out and c != key]
    bounds = fit_outlier_bounds(df, names)
    flags = df.select(*([column(key)] if key else []), *[outlier_flag(c, bounds).alias(c) for c in names])
    count = sum((column(c).cast("bigint") for c in names), F.lit(0).cast("bigint"))
    return flags.withColumn("count_outlier", count).withColumn(
        "pct_outlier", F.col("count_outlier") * 100.0 / F.lit(float(max(len(names), 1)))
    )


def outlier_histogram(outliers: DataFrame) -> DataFrame:
    """How many rows have how many outlying columns."""
    return outliers.groupBy("count_outlier").agg(F.count(F.lit(1)).alias("n"))


def outliers_per_column(outliers: DataFrame, key: str | None = None) -> DataFrame:
    """Outliers per column: ``column, n_outliers``."""
    names = [c for c in outliers.columns if c not in (key, "count_outlier", "pct_outlier")]
    totals = outliers.agg(*[F.count_if(column(c)).alias(c) for c in names])
    return totals.unpivot([], [column(c) for c in names], "column", "n_outliers")
