"""Eight-number summaries, value counts and the numbers behind distribution charts."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.functions import as_double, column, numeric_columns
from quillon.operators import ranks
from quillon.operators.params import attach
from quillon.operators.ranks import exact_quantiles
from quillon.session import materialize

QUARTILES = [0.25, 0.5, 0.75]
QUARTILE_NAMES = ["p25", "p50", "p75"]
MAX_HISTOGRAM_BINS = 50


def long_numbers(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """One row per (row, column): ``by..., column, value`` with every value a double."""
    wide = df.select(*[column(b) for b in by], *[as_double(c).alias(c) for c in columns])
    return wide.unpivot([column(b) for b in by], [column(c) for c in columns], "column", "value")


def summarize_data(
    df: DataFrame, grouping_vars: Sequence[str] | None = None, agg_cols: Sequence[str] | None = None
) -> DataFrame:
    """Count, mean, standard deviation, minimum, quartiles and maximum per numeric column (and group).

    Missing values are ignored and rows with a missing group key are left out. All columns are summarised together
    in two passes over the rows: one for the moments and a sketch of the values, one for the exact quartiles.
    """
    groups = list(grouping_vars or [])
    columns = list(agg_cols) if agg_cols else [c for c in numeric_columns(df) if c not in groups]
    long = long_numbers(df, columns, groups)
    if groups:
        long = long.dropna(subset=groups)
    keys = [*groups, "column"]
    moments = [
        F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"),
    ]
    grouped = long.groupBy(*[column(k) for k in keys])
    found = materialize(grouped.agg(*moments, ranks.sketch_of("value", QUARTILES).alias("__sketch")))
    known = long.where(F.col("value").isNotNull() & ~F.isnan("value"))
    sketched = found.where(F.col("__sketch").isNotNull()).select(*[column(k) for k in keys], "__sketch")
    quartiles = ranks.quantiles_from_sketch(known, sketched, keys, "value", QUARTILES, QUARTILE_NAMES)
    summary = found.join(quartiles, keys, "left")
    return summary.select(*[column(k) for k in keys], "count", "mean", "std", "min", *QUARTILE_NAMES, "max")


def summarize_weighted(df: DataFrame, columns: Sequence[str], weight: str) -> DataFrame:
    """``summarize_data`` of rows that each stand for ``weight`` (a positive whole number) equal ones."""
    long = materialize(long_numbers(df, columns, [weight]).withColumnRenamed(weight, "w"))
    w, v = F.when(F.col("value").isNotNull(), F.col("w")), F.col("value")
    means = long.groupBy("column").agg(
        F.coalesce(F.sum(w), F.lit(0)).alias("count"), F.try_divide(F.sum(w * v), F.sum(w)).alias("mean"),
        F.min("value").alias("min"), F.max("value").alias("max"))
    means = materialize(means)  # a row per column
    squares = long.join(F.broadcast(means.select("column", "mean")), "column").groupBy("column").agg(F.sum(w * (v - F.col("mean")) ** 2).alias("__squares"))
    known = long.where(v.isNotNull() & ~F.isnan(v))
    quartiles = ranks.weighted_quantiles(known, ["column"], "value", "w", QUARTILES, QUARTILE_NAMES)
    std = F.when(F.col("count") > 1, F.sqrt(F.col("__squares") / (F.col("count") - 1))).alias("std")
    return means.join(squares, "column", "left").join(quartiles, "column", "left").select("column", "count", "mean", std, "min", *QUARTILE_NAMES, "max")


def group_means(df: DataFrame, grouping_vars: Sequence[str], agg_cols: Sequence[str] | None = None) -> DataFrame:
    """Only the mean of every numeric column per group: ``group..., column, mean``."""
    groups = list(grouping_vars)
    columns = list(agg_cols) if agg_cols else [c for c in numeric_columns(df) if c not in groups]
    wide = df.dropna(subset=groups).groupBy(*[column(g) for g in groups]).agg(
        *[F.avg(as_double(c)).alias(c) for c in columns]
    )
    return wide.unpivot([column(g) for g in groups], [column(c) for c in columns], "column", "mean")


def value_counts(df: DataFrame, field: str, name: str = "n") -> DataFrame:
    """Rows per value, missing left out. Unsorted: the caller orders what it shows."""
    return df.where(column(field).isNotNull()).groupBy(column(field)).agg(F.count(F.lit(1)).alias(name))


def count_per_categorical(df: DataFrame, cat_column: str) -> DataFrame:
    """Summary of how many rows the values of a category have."""
    name = f"obs_per_{cat_column}"
    return summarize_data(value_counts(df, cat_column, name), agg_cols=[name])


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Number of different values per column, missing left out: ``column, n_distinct``.

    Each (column, value) pair is merged map-side, so a value held by most rows costs one row per task.
    """
    wide = df.select(*[column(c).cast("string").alias(c) for c in columns])
    pairs = wide.unpivot([], [column(c) for c in columns], "column", "value")
    return pairs.dropna(subset=["value"]).distinct().groupBy("column").agg(F.count(F.lit(1)).alias("n_distinct"))


def fixed_histogram(df: DataFrame, field: str, low: float, high: float, width: float, overflow: bool = True) -> DataFrame:
    """Rows per bin ``[low + i*width, low + (i+1)*width)``, the last bin closed; empty bins included.

    With ``overflow``, bin -1 holds what lies below the range (its start is missing) and one bin more what lies
    above it or is not a number (its end is missing), so the counts add up to all values that are not missing.
    """
    bins = round((high - low) / width)
    x = as_double(field)
    inner = F.least(F.floor((x - F.lit(float(low))) / F.lit(float(width))), F.lit(bins - 1)).cast("bigint")
    index = F.when(x < low, F.lit(-1)).when(x <= high, inner).otherwise(F.lit(bins)).cast("bigint")
    known = df.where(x.isNotNull()) if overflow else df.where(x.between(low, high))
    counts = known.groupBy(index.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    first, last = (-1, bins + 1) if overflow else (0, bins)
    start = F.lit(float(low)) + F.col("bin") * F.lit(float(width))
    end = F.lit(float(low)) + (F.col("bin") + 1) * F.lit(float(width))
    return _with_empty_bins(counts, first, last).select(
        "bin", F.when(F.col("bin") >= 0, start).alias("bin_start"), F.when(F.col("bin") < bins, end).alias("bin_end"), "n")


def _with_empty_bins(counts: DataFrame, first: int, end: int) -> DataFrame:
    spine = counts.sparkSession.range(first, end).withColumnRenamed("id", "bin")
    return spine.join(counts, "bin", "left").select("bin", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


def box_plot(df: DataFrame, field: str) -> DataFrame:
    """Quartiles, whiskers (furthest values within 1.5 quartile ranges) and the number beyond them."""
    values = df.select(as_double(field).alias("value")).dropna()
    fences = exact_quantiles(values, [], "value", QUARTILES, QUARTILE_NAMES).select(
        "*", (F.col("p25") - 1.5 * (F.col("p75") - F.col("p25"))).alias("lower_fence"),
        (F.col("p75") + 1.5 * (F.col("p75") - F.col("p25"))).alias("upper_fence"),
    )
    marked = attach(values, [], fences)
    inside = F.col("value").between(F.col("lower_fence"), F.col("upper_fence"))
    return marked.agg(
        F.count(F.lit(1)).alias("count"), F.min("value").alias("min"), *[F.first(q).alias(q) for q in QUARTILE_NAMES],
        F.max("value").alias("max"), F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("value"))).alias("whisker_high"), F.count_if(~inside).alias("n_outliers"),
    )


def histogram(df: DataFrame, field: str) -> DataFrame:
    """Equal-width bins over the data range; width by Freedman and Diaconis (1981), at most 50 bins."""
    values = df.select(as_double(field).alias("value")).dropna()
    range_row = values.agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi")).first()
    if not range_row.n:
        return values.select(F.lit(0).cast("bigint").alias("bin"), F.lit(0.0).alias("bin_start"),
                             F.lit(0.0).alias("bin_end"), F.lit(0).cast("bigint").alias("n")).limit(0)
    q = exact_quantiles(values, [], "value", [0.25, 0.75], ["q1", "q3"]).first()
    bins = freedman_diaconis_bins(range_row.n, range_row.lo, range_row.hi, q.q1, q.q3)
    lo, hi = range_row.lo, range_row.hi
    if lo == hi:  # a single value sits in the middle of a range of width one
        lo, hi = lo - 0.5, hi + 0.5
    return fixed_histogram(values, "value", lo, hi, (hi - lo) / bins, overflow=False)


def freedman_diaconis_bins(n: int, lo: float, hi: float, q1: float, q3: float) -> int:
    if n < 2:
        return 1
    width = 2 * (q3 - q1) / n ** (1 / 3)
    bins = math.isqrt(n) if width == 0 else math.ceil((hi - lo) / width)
    return max(1, min(bins, MAX_HISTOGRAM_BINS))


def distribution(df: DataFrame, field: str) -> dict[str, DataFrame]:
    """The tables behind a distribution chart: histogram and box plot of numbers, counts of anything else."""
    if field in numeric_columns(df, booleans=True):
        return {"histogram": histogram(df, field), "box_plot": box_plot(df, field)}
    return {"counts": value_counts(df, field)}


def report_n_missing(df: DataFrame) -> DataFrame:
    """Missing values per column: ``column, n_missing, pct_missing``; one aggregation for all columns."""
    flags = df.agg(
        F.count(F.lit(1)).alias("__rows"), *[F.count_if(column(c).isNull()).alias(c) for c in df.columns]
    )
    long = flags.unpivot(["__rows"], [column(c) for c in df.columns], "column", "n_missing")
    return long.select(
        "column", "n_missing", F.try_divide(F.col("n_missing") * 100.0, F.col("__rows")).alias("pct_missing")
    )


def pw_correlate(df: DataFrame, variables: Sequence[str] | None = None) -> DataFrame:
    """Pearson correlation of every pair, over rows where no variable is missing.

    Long form ``variable_a, variable_b, correlation``; missing where a variable does not vary. All
    co-moments come from one aggregation over the data.
    """
    names = list(variables) if variables else numeric_columns(df, booleans=True)
    rows = df.select(*[as_double(c).alias(c) for c in names]).dropna()
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
    moments = rows.agg(
        *[F.covar_samp(column(names[i]), column(names[j])).alias(f"c_{i}_{j}") for i, j in pairs]
    )
    cells = []
    for i, a in enumerate(names):
        for j, b in enumerate(names):
            cov = F.col(f"c_{min(i, j)}_{max(i, j)}")
            spread = F.sqrt(F.col(f"c_{i}_{i}")) * F.sqrt(F.col(f"c_{j}_{j}"))
            value = F.try_divide(F.col(f"c_{i}_{i}"), F.col(f"c_{i}_{i}")) if i == j else F.try_divide(cov, spread)
            cells.append(F.struct(F.lit(a).alias("variable_a"), F.lit(b).alias("variable_b"), value.alias("correlation")))
    return moments.select(F.inline(F.array(*cells)))
