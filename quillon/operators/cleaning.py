"""Filling missing values: per-column methods, fitted per group and applied in one projection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillon.functions import column, identify_missing, numeric_columns
from quillon.operators.describe import long_numbers
from quillon.operators.params import attach
from quillon.operators.ranks import exact_quantiles

METHODS = ("mean", "median", "mode", "manual")
DEFAULT_FILL = "N/A"


def choose_methods(df: DataFrame, columns: Sequence[str], methods: Mapping[str, str] | None) -> dict[str, str]:
    """The method of every column: what was asked for, else median for numbers and mode for the rest."""
    numbers = set(numeric_columns(df, booleans=True))
    chosen = {c: (methods or {}).get(c) or ("median" if c in numbers else "mode") for c in columns}
    for name, method in chosen.items():
        if method not in METHODS:
            raise ValueError(f"unknown imputation method {method!r} for {name}")
        if method in ("mean", "median") and name not in numbers:
            raise ValueError(f"{method} needs a numeric column, {name} is not one")
    return chosen


def fit_fill_values(df: DataFrame, methods: Mapping[str, str], by: Sequence[str] = ()) -> DataFrame:
    """One row per group with the fitted values of mean, median and mode columns.

    ``__num`` maps a column to its mean or median, ``__mode`` to its most frequent value as text (the
    smallest of equally frequent ones). A column with no value at all has no entry.
    """
    by = list(by)
    pieces = []
    means = [c for c, m in methods.items() if m == "mean"]
    medians = [c for c, m in methods.items() if m == "median"]
    if means:
        long = long_numbers(df, means, by)
        pieces.append(long.groupBy(*by, "column").agg(F.avg("value").alias("num")).select(
            *by, "column", "num", F.lit(None).cast("string").alias("mode")))
    if medians:
        long = long_numbers(df, medians, by)
        pieces.append(exact_quantiles(long, [*by, "column"], "value", [0.5], ["num"]).select(
            *by, "column", "num", F.lit(None).cast("string").alias("mode")))
    for kind in _mode_kinds(df, methods):
        pieces.append(_modes(df, kind, by))
    if not pieces:
        return df.select(*by).distinct().select(
            *by, F.create_map().cast("map<string,double>").alias("__num"),
            F.create_map().cast("map<string,string>").alias("__mode"))
    fitted = pieces[0]
    for piece in pieces[1:]:
        fitted = fitted.unionByName(piece)
    entry = F.struct("column", "num"), F.struct("column", "mode")
    return fitted.groupBy(*by).agg(
        F.map_from_entries(F.collect_list(F.when(F.col("num").isNotNull(), entry[0]))).alias("__num"),
        F.map_from_entries(F.collect_list(F.when(F.col("mode").isNotNull(), entry[1]))).alias("__mode"),
    )


def _mode_kinds(df: DataFrame, methods: Mapping[str, str]) -> list[list[str]]:
    """Mode columns grouped by data type: only values of one type can be ordered together."""
    kinds: dict[str, list[str]] = {}
    for f in df.schema.fields:
        if methods.get(f.name) == "mode":
            kinds.setdefault(f.dataType.simpleString(), []).append(f.name)
    return list(kinds.values())


def _modes(df: DataFrame, columns: list[str], by: list[str]) -> DataFrame:
    """Count every (column, value) pair first, then keep the most frequent: no list of values is built."""
    long = df.select(*by, *[column(c) for c in columns]).unpivot(
        by, [column(c) for c in columns], "column", "value"
    ).dropna(subset=["value"])
    counts = long.groupBy(*by, "column", "value").agg(F.count(F.lit(1)).alias("n"))
    best = F.min(F.struct((-F.col("n")).alias("rank"), F.col("value")))
    return counts.groupBy(*by, "column").agg(best["value"].cast("string").alias("mode")).select(
        *by, "column", F.lit(None).cast("double").alias("num"), "mode")


def apply_fill_values(
    df: DataFrame, fitted: DataFrame, methods: Mapping[str, str], manual_vals: Mapping[str, object] | None = None,
    by: Sequence[str] = (), flags: bool = True,
) -> DataFrame:
    """Fill the columns; with ``flags`` also append ``<column>_missing`` from the values before filling."""
    manual = manual_vals or {}
    flagged = identify_missing(df, methods) if flags else df
    rows = attach(flagged, by, fitted)
    types = {f.name: f.dataType for f in df.schema.fields}
    filled = {}
    for name, method in methods.items():
        original = column(name)
        if method == "manual":
            fill = manual.get(name, DEFAULT_FILL)
            original, fill = _same_type(original, fill, types[name])
        elif method == "mode":
            fill = F.col("__mode")[name].cast(types[name])
        else:  # a mean or median need not be a whole number
            original = original.cast("double")
            fill = F.col("__num")[name]
        filled[name] = F.coalesce(original, fill)
    return rows.withColumns(filled).drop("__num", "__mode")


def _same_type(original, fill, data_type: T.DataType):
    """A text fill in a column of another type turns the column into text."""
    if isinstance(fill, str) and not isinstance(data_type, T.StringType):
        return original.cast("string"), F.lit(fill)
    return original, F.lit(fill).cast(data_type)


def impute_missing(df: DataFrame, name: str, method: str | None = None, manual_val: object = None) -> DataFrame:
    """Fill one column by mean, median, mode or a given value."""
    methods = choose_methods(df, [name], {name: method} if method else None)
    manual = {name: manual_val} if manual_val is not None else {}
    return apply_fill_values(df, fit_fill_values(df, methods), methods, manual, flags=False)


def preprocess_data(
    df: DataFrame, methods: Mapping[str, str] | None = None, manual_vals: Mapping[str, object] | None = None,
    columns: Sequence[str] | None = None, by: Sequence[str] = (), flags: bool = True, fit_on: str | None = None,
) -> DataFrame:
    """Fill every column and flag what was missing.

    ``by`` fits separate values per group, for example per split and role. ``fit_on='train'`` takes
    the values of a split's training rows for its test rows as well (``by`` must then hold 'role').
    """
    names = [c for c in (columns or df.columns) if c not in by]
    chosen = choose_methods(df, names, methods)
    if fit_on is None:
        return apply_fill_values(df, fit_fill_values(df, chosen, by), chosen, manual_vals, by, flags)
    shared = [b for b in by if b != "role"]
    fitted = fit_fill_values(df.where(F.col("role") == fit_on), chosen, shared)
    return apply_fill_values(df, fitted, chosen, manual_vals, shared, flags)


def replace_missing(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Median for numbers, most frequent value for the rest, no flags."""
    return preprocess_data(df, columns=columns, flags=False)
