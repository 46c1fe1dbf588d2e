"""Crime reports by type, area and time, and the census profile of the blocks they happen on."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.functions import column, within_dates, year_to_date
from quillon.operators.spatial import groups_in_areas, link_points_areas
from quillon.operators.summaries import (
    describe_blocks,
    largest_changes,
    link_reports_neighborhoods,
    map_neighborhood_stats,
    summarize_monthly,
    summarize_neighborhoods,
    summarize_on_field,
    summarize_yearly,
    summarize_yoy_change,
)
from quillon.session import materialize
from quillon.sources import PROFILE_COLUMNS


def link_reports_blocks(reports: DataFrame, blocks: DataFrame, key: str | None = None) -> DataFrame:
    """Reports with the id of the block group they lie in; reports without a place or a block drop out."""
    return link_points_areas(reports, blocks, "longitude", "latitude", "the_geom", key)


def crime_overview(reports: DataFrame, areas: DataFrame, start_year: int, end_year: int) -> dict[str, DataFrame]:
    """Types, yearly and monthly counts, areas, and the changes between two years."""
    named = link_reports_neighborhoods(reports, areas)
    tables = {
        "types": summarize_on_field(named, "primary_type"),
        "yearly": summarize_yearly(named),
        "monthly": summarize_monthly(named, "date"),
        "area_map": map_neighborhood_stats(named, areas),
    }
    for name, table in summarize_neighborhoods(named).items():
        tables[f"area_{name}"] = table
    for field in ("primary_type", "community_area"):
        changes = summarize_yoy_change(named, field, start_year, end_year)
        tables[f"{field}_changes"] = changes.orderBy("change", column(field))
        tables[f"{field}_decreases"] = largest_changes(changes, field, increases=False)
        tables[f"{field}_increases"] = largest_changes(changes, field)
    return tables


def compare_windows(reports: DataFrame, ranges: Sequence[tuple[str, str]], date: str = "date") -> DataFrame:
    """Yearly counts and change over the same part of several years."""
    return summarize_yearly(reports.where(within_dates(column(date), *ranges)))


def compare_year_to_date(reports: DataFrame, ends: dict[int, str], date: str = "date") -> DataFrame:
    """Yearly counts and change from the first of January up to a day of each year."""
    wanted = F.lit(False)
    for year, end in ends.items():
        wanted = wanted | year_to_date(column(date), year, end)
    return summarize_yearly(reports.where(wanted))


def block_profile(
    reports: DataFrame, blocks: DataFrame, stats: DataFrame, types: Sequence[str], key: str | None = None,
) -> dict[str, DataFrame]:
    """For each crime type: the census profile of blocks with at least one such report.

    An area counts once for each ``block`` with such a report in it; these are counted per area and not written out as pairs.
    ``key`` is accepted and not needed.
    """
    wanted = reports.where(column("primary_type").isin(list(types)))
    counted = materialize(groups_in_areas(wanted, blocks, ["block", "primary_type"], "geoid10"))
    return {t: describe_blocks(counted.where(column("primary_type") == F.lit(t)), stats, PROFILE_COLUMNS, weight="n") for t in types}
