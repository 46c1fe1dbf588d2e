"""Aggregates of points in areas: equal places and equal shapes are one row in the join, and results are those of all pairs."""

from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillon.operators import spatial
from quillon.operators.describe import summarize_data, summarize_weighted
from quillon.plans import crime
from quillon.plans.catalog import QUERIES
from quillon.sources import PROFILE_COLUMNS


def square(x, y, w, h):
    return [[{"x": float(a), "y": float(b)} for a, b in ((x, y), (x + w, y), (x + w, y + h), (x, y + h))]]


@pytest.fixture
def joined(monkeypatch):
    """Rows of points and areas that reach the join."""
    sizes, link = [], spatial.link_points_areas

    def counted(points, areas, *args, **kwargs):
        sizes.append((points.count(), areas.count()))
        return link(points, areas, *args, **kwargs)

    monkeypatch.setattr(spatial, "link_points_areas", counted)
    monkeypatch.setattr(crime, "link_points_areas", counted)
    return sizes


def test_points_in_copies_of_areas_are_counted_without_pairs(spark, joined, tmp_path):
    """Suppliers that share a rectangle, and lines at one place: 40 * 40 copies of each pair."""
    folder = str(tmp_path)
    period = 12_600  # keys that far apart have the same rectangle
    spark.range(40).select((F.col("id") * period + 1).alias("s_suppkey")).write.parquet(f"{folder}/supplier.parquet")
    spark.range(40).select(
        F.col("id").alias("l_orderkey"), F.lit(3).alias("l_linenumber"), F.lit("N").alias("l_returnflag"), F.lit(3950.0).alias("l_extendedprice"),
        F.lit(61.5).alias("l_quantity"), F.lit(0.0).alias("l_discount")).write.parquet(f"{folder}/lineitem.parquet")
    found = QUERIES["point_in_polygon"](spark, folder).collect()
    assert {tuple(r) for r in found} == {(i * period + 1, 40, 0, 3) for i in range(40)}
    assert joined == [(1, 1)]


def test_block_profile_counts_blocks_per_area(spark, joined):
    """Areas under one id, ids with the same areas, rows that repeat, missing keys: as all pairs give it."""
    rng = random.Random(5)
    areas = [("a", square(0, 0, 4, 4)), ("a", square(2, 2, 4, 4)), ("b", square(2, 2, 4, 4)), ("b", square(0, 0, 4, 4)), ("c", square(1, 0, 9, 1)),
             ("c", square(1, 0, 9, 1)), ("d", square(1, 0, 9, 1)), ("e", square(50, 50, 1, 1)), (None, square(0, 0, 9, 9))]
    rows = [(rng.choice(["p", "q", "r", None]), rng.choice(["X", "Y", "Z", None]), rng.randint(0, 20) / 2, rng.randint(0, 12) / 2) for _ in range(150)] * 2
    rows += [("p", "X", None, 1.0)]
    reports = spark.createDataFrame(rows, "block string, primary_type string, longitude double, latitude double")
    blocks = spark.createDataFrame(areas, f"geoid10 string, the_geom {spatial.RING_TYPE}")
    values = {"a": 1.0, "b": 7.0, "c": None, "d": 2.5}
    stats = spark.createDataFrame([(k, v, v, v, v, v) for k, v in values.items()], "geoid10 string, a double, b double, c double, d double, e double")
    stats = stats.withColumnsRenamed(dict(zip("abcde", PROFILE_COLUMNS, strict=True)))
    found = crime.block_profile(reports, blocks, stats, ["X", "Y"])
    for kind in ("X", "Y"):
        pairs = defaultdict(set)
        for block, t, x, y in rows:
            for name, g in areas:
                x0, y0, x1, y1 = g[0][0]["x"], g[0][0]["y"], g[0][2]["x"], g[0][2]["y"]
                if None not in (block, name, x) and t == kind and x0 < x < x1 and y0 < y < y1:
                    pairs[name].add(block)
        numbers = [values[n] for n, b in pairs.items() for _ in b if values.get(n) is not None]
        assert numbers
        for r in found[kind].collect():
            wanted = [np.mean(numbers), np.std(numbers, ddof=1), min(numbers), *np.percentile(numbers, [25, 50, 75]), max(numbers)]
            assert r["count"] == len(numbers)
            assert [r["mean"], r["std"], r["min"], r["p25"], r["p50"], r["p75"], r["max"]] == pytest.approx(wanted)
    # three sets of shapes: those of a and b, of c and d, and of e
    assert joined[0][0] == len({(t, b, x, y) for b, t, x, y in rows if t in ("X", "Y") and None not in (b, x)}) and joined[0][1] == 4


def test_weighted_summary_equals_the_one_of_repeated_rows(spark):
    rng = random.Random(2)
    rows = [(rng.choice([1.5, -2.0, 8.25, None, rng.random()]), float(i), rng.randint(1, 9)) for i in range(60)]
    df = spark.createDataFrame([(a, b, None, w) for a, b, w in rows], "a double, b double, none double, w int")
    repeated = df.withColumn("i", F.explode(F.sequence(F.lit(1), "w")))
    wanted = {r["column"]: r for r in summarize_data(repeated, agg_cols=["a", "b", "none"]).collect()}
    found = summarize_weighted(df, ["a", "b", "none"], "w")
    assert found.columns == ["column", "count", "mean", "std", "min", "p25", "p50", "p75", "max"]
    for r in found.collect():
        assert tuple(r)[1:] == pytest.approx(tuple(wanted[r["column"]])[1:], nan_ok=True)
