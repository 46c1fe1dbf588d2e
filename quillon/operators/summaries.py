"""Counts, shares and year-over-year comparisons of event records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillon.functions import column, month_on_common_year, percent
from quillon.operators.describe import fixed_histogram, summarize_data, summarize_weighted, value_counts
from quillon.operators.joins import dimension_join
from quillon.operators.params import attach
from quillon.session import materialize

# More pivot columns than this would make a plan nobody can read; list the values wanted instead.
MAX_PIVOT_VALUES = 1000


def summarize_on_field(reports: DataFrame, field: str) -> DataFrame:
    """Rows per value with their percentage of all rows that have a value, largest first."""
    return _with_total(value_counts(reports, field)).select(
        column(field), "n", percent(F.col("n"), F.col("__total")).alias("percentage")
    ).orderBy(F.desc("n"), column(field))


def _with_total(counts: DataFrame) -> DataFrame:
    """Append the sum of all counts as a literal: a window would pull every value into one task.

    The grouped table is written once, so the rows behind it are read once.
    """
    counts = materialize(counts)
    return attach(counts, [], counts.agg(F.sum("n").alias("__total")))


def conditional_share(reports: DataFrame, condition: Column, field: str) -> DataFrame:
    """Share of each value among the rows that meet a condition."""
    counts = _with_total(value_counts(reports.where(condition), field))
    share = F.try_divide(F.col("n").cast("double"), F.col("__total").cast("double"))
    return counts.select(column(field), "n", share.alias("share"))


def share_difference(reports: DataFrame, condition: Column, field: str, first: Sequence, second: Sequence) -> DataFrame:
    """Summed share of two sets of values among the rows that meet a condition, and the difference."""
    value = column(field)
    totals = reports.where(condition & value.isNotNull()).agg(
        F.count(F.lit(1)).cast("double").alias("all"),
        F.count_if(value.isin(list(first))).cast("double").alias("a"),
        F.count_if(value.isin(list(second))).cast("double").alias("b"),
    )
    return totals.select(
        F.try_divide("a", "all").alias("share_first"), F.try_divide("b", "all").alias("share_second"),
        (F.try_divide("a", "all") - F.try_divide("b", "all")).alias("difference"),
    )


def posterior_share(reports: DataFrame, condition: Column, field: str, values: Sequence) -> DataFrame:
    """Probability of each listed value given the condition, with no other value possible."""
    return conditional_share(reports, condition & column(field).isin(list(values)), field)


def summarize_yearly(reports: DataFrame, year: Column | str = "year") -> DataFrame:
    """Rows per year and the percent change from the previous year that has rows."""
    by = column(year) if isinstance(year, str) else year
    counts = reports.select(by.alias("year")).dropna().groupBy("year").agg(F.count(F.lit(1)).alias("n"))
    previous = F.lag("n").over(Window.orderBy("year"))
    return counts.select("year", "n", percent(F.col("n") - previous, previous).alias("pct_change")).orderBy("year")


def summarize_monthly(reports: DataFrame, date: str) -> DataFrame:
    """Rows per month and year; months carry the year 1900 so that years overlay."""
    d = column(date)
    parts = reports.where(d.isNotNull()).select(month_on_common_year(d).alias("month"), F.year(d).alias("year"))
    return parts.groupBy("month", "year").agg(F.count(F.lit(1)).alias("counts"))


def summarize_yoy_change(
    reports: DataFrame, field: str, start_year: int, end_year: int, year: str = "year"
) -> DataFrame:
    """Rows per value in two years and the change between them; no rows counts as zero.

    A value that occurs in neither of the two years is still listed when it occurs in another one.
    """
    f = column(field)
    y = column(year)
    return reports.where(f.isNotNull() & y.isNotNull()).groupBy(f).agg(
        F.count_if(y == start_year).alias(f"n_{start_year}"), F.count_if(y == end_year).alias(f"n_{end_year}"),
    ).withColumn("change", F.col(f"n_{end_year}") - F.col(f"n_{start_year}"))


def largest_changes(changes: DataFrame, field: str, n: int = 5, increases: bool = True) -> DataFrame:
    """The ``n`` largest increases (or decreases); equal changes in order of the value."""
    order = F.desc("change") if increases else F.asc("change")
    return changes.orderBy(order, column(field)).limit(n)


def pivot_values(df: DataFrame, field: str) -> list:
    """The values a pivot would spread out, found once and checked against a bound."""
    found = df.select(column(field)).where(column(field).isNotNull()).distinct().limit(MAX_PIVOT_VALUES + 1).collect()
    if len(found) > MAX_PIVOT_VALUES:
        raise ValueError(f"{field} has more than {MAX_PIVOT_VALUES} values: pass the ones to pivot, or use map_by_block")
    return sorted(r[0] for r in found)


def summarize_by_block(
    reports: DataFrame, field: str, values: Sequence | None = None, keys: Sequence[str] = ("block", "geoid10")
) -> DataFrame:
    """One row per block with a zero-filled count column per value of ``field``."""
    values = list(values) if values is not None else pivot_values(reports, field)
    known = reports.dropna(subset=[*keys, field])
    wide = known.groupBy(*keys).pivot(field, values).agg(F.count(F.lit(1)))
    return wide.na.fill(0, [str(v) for v in values])


def count_by_block(reports: DataFrame, field: str, keys: Sequence[str] = ("block", "geoid10")) -> DataFrame:
    """One row per block and value of ``field`` that occurs there, with the count ``n``: a pivot in long form, for any number of values."""
    return reports.dropna(subset=[*keys, field]).groupBy(*map(column, keys), column(field)).agg(F.count(F.lit(1)).alias("n"))


def map_by_block(reports: DataFrame, field: str, keys: Sequence[str] = ("block", "geoid10"), out: str = "counts") -> DataFrame:
    """One row per block with a map from each value that occurs there to its count, in the order of the values.

    Takes any number of values, and the schema does not follow from the data. A value that is not in a map counts 0
    (``count_of``).
    """
    entries = F.sort_array(F.collect_list(F.struct(column(field), F.col("n"))))
    return count_by_block(reports, field, keys).groupBy(*map(column, keys)).agg(F.map_from_entries(entries).alias(out))


def count_of(counts: Column, value) -> Column:
    """The count of a value in a map of ``map_by_block``."""
    return F.coalesce(F.try_element_at(counts, value if isinstance(value, Column) else F.lit(value)), F.lit(0))


def link_reports_neighborhoods(
    reports: DataFrame, areas: DataFrame, code: str = "community_area", number: str = "area_number",
    name: str = "community",
) -> DataFrame:
    """Replace an area code by the area's name; an unknown code becomes missing."""
    names = areas.select(column(number).alias(code), column(name).alias("__name"))
    named = {c: F.col("__name") if c == code else column(c) for c in reports.columns}
    return dimension_join(reports, names, [code]).select(*[v.alias(c) for c, v in named.items()])


def link_reports_block_stats(reports: DataFrame, stats: DataFrame, key: str = "geoid10") -> DataFrame:
    """Append area statistics to every row; rows without a match keep missing statistics."""
    return dimension_join(reports, stats, [key])


def describe_blocks(
    block_summaries: DataFrame, stats: DataFrame, columns: Sequence[str], key: str = "geoid10", weight: str | None = None,
) -> DataFrame:
    """Eight-number summary of area statistics over the given blocks; a row counts ``weight`` times, if that is given."""
    rows = block_summaries.select(column(key), *([column(weight).alias("__weight")] if weight else []))
    linked = link_reports_block_stats(rows, stats.select(column(key), *map(column, columns)), key)
    return summarize_weighted(linked, columns, "__weight") if weight else summarize_data(linked, agg_cols=columns)


def summarize_neighborhoods(
    reports: DataFrame, field: str = "community_area", low: float = 0, high: float = 32000, width: float = 1000
) -> dict[str, DataFrame]:
    """Rows per area (smallest first), their summary, and their histogram; areas outside its range are in its outer bins."""
    counts = value_counts(reports, field)
    return {
        "description": summarize_data(counts, agg_cols=["n"]),
        "histogram": neighborhood_distribution(reports, field, low, high, width),
        "counts": counts.orderBy("n", column(field)),
    }


def neighborhood_distribution(
    reports: DataFrame, field: str = "community_area", low: float = 0, high: float = 32000, width: float = 1000
) -> DataFrame:
    """How many areas have how many rows."""
    return fixed_histogram(value_counts(reports, field), "n", low, high, width)


def map_neighborhood_stats(
    reports: DataFrame, areas: DataFrame, field: str = "community_area", name: str = "community"
) -> DataFrame:
    """Row counts joined to the areas, with the smallest and largest count for a colour scale."""
    counts = value_counts(reports, field, "counts").withColumnRenamed(field, name)
    drawn = materialize(dimension_join(materialize(counts), areas, [name], "inner"))
    return attach(drawn, [], drawn.agg(F.min("counts").alias("scale_min"), F.max("counts").alias("scale_max")))
