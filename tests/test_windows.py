"""Splits of rows stored once against the same splits as a table of copies."""

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from quillon.operators import cleaning, evaluate, features, splits, windows
from quillon.session import Scratch

LENGTH, GAP = {"months": 2}, {"days": 20}


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(3)
    start = datetime(2012, 1, 31, 23, 59, 59, 999999)
    out = []
    for i in range(1500):
        day = start + timedelta(days=rng.randrange(400), microseconds=rng.randrange(3)) if i % 50 else None
        x = None if rng.random() < 0.1 else float(rng.choice([rng.randrange(6), rng.random() * 100, 5.0, -1e9]))
        out.append((i, day, x, None if i % 9 == 0 else rng.randrange(40), f"v{min(rng.randrange(60), 20)}" if i % 7 else None, i % 3 == 0))
    out += [(2000, start, 1.0, 1, "v20", True), (2001, datetime(2012, 3, 31), 2.0, 2, "v20", False), (2002, datetime(2013, 3, 31), 7.0, 3, None, None)]
    return spark.createDataFrame(out, "id int, d timestamp_ntz, x double, k int, v string, late boolean").repartition(4).cache()


@pytest.fixture
def scratch(spark):
    found = Scratch(spark)
    yield found
    found.clear()


@pytest.fixture(scope="module")
def both(rows):
    return windows.temporal_windows(rows, "d", LENGTH, GAP), splits.create_temporal_splits(rows, "d", LENGTH, GAP).cache()


def table(df, *names):
    return Counter(tuple(round(v, 9) if isinstance(v, float) else v for v in (r[n] for n in names)) for r in df.collect())


def test_splits_have_the_same_rows(both, scratch):
    placed, copies = both
    stored = placed.kept(scratch)
    assert placed.splits == tuple(range(1, 1 + len(placed.splits))) and len(placed.splits) > 5
    for s in placed.splits:
        assert table(stored.split(s), "id", "split_id", "role") == table(copies.where(f"split_id = {s}"), "id", "split_id", "role")
    plan = stored.split(3)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(trains_from" in plan and "PartitionFilters: [isnotnull(tested_in" in plan
    assert stored.rows.count() == placed.rows.count()
    assert placed.usable() == [s for s in placed.splits if copies.where(f"split_id = {s}").select("role").distinct().count() == 2]


def test_consecutive_splits_have_the_same_rows(rows):
    placed, copies = windows.consecutive_windows(rows, "d", {"months": 3}), splits.create_consecutive_splits(rows, "d", {"months": 3})
    for s in placed.splits:
        assert table(placed.split(s), "id", "role") == table(copies.where(f"split_id = {s}"), "id", "role")


def test_splits_in_another_time_zone(spark, rows, both):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        placed = windows.temporal_windows(rows, "d", LENGTH, GAP)
        assert table(placed.rows, "id", "tested_in", "trains_from") == table(both[0].rows, "id", "tested_in", "trains_from")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_states_by_group(both):
    placed, copies = both
    found = placed.states({"n": (F.count(F.lit(1)), "sum"), "lo": (F.min("x"), "min"), "hi": (F.max("x"), "max")}, ["v"])
    wanted = copies.groupBy("v", "split_id", "role").agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"))
    names = ("v", "split_id", "role", "n", "lo", "hi")
    # a missing group is one only for the aggregation; joins of the splits leave it out
    assert table(found.where("v IS NOT NULL"), *names) == table(wanted.where("v IS NOT NULL"), *names)


@pytest.mark.parametrize("buckets", [windows.LEAST_BUCKETS, 2, 500])
def test_order_statistics(spark, both, scratch, monkeypatch, buckets):
    monkeypatch.setattr(windows, "LEAST_BUCKETS", buckets)
    monkeypatch.setattr(windows, "CUT_ROWS", 300)
    placed, copies = both
    matrix = windows.ValueMatrix(placed, ["x", "k"], scratch)
    found = matrix.quantiles([0.0, 0.1, 0.5, 1.0], ["a", "b", "c", "d"])
    for name in ("x", "k"):
        quantiles = F.percentile(F.col(name), [0.0, 0.1, 0.5, 1.0])
        wanted = copies.where(F.col(name).isNotNull()).groupBy("split_id", "role").agg(*[quantiles[i].alias(n) for i, n in enumerate("abcd")])
        assert table(found.where(F.col("column") == name), "split_id", "role", *"abcd") == table(wanted, "split_id", "role", *"abcd")
    points = [("x", s, i, p) for s in placed.splits for i, p in enumerate([-1e10, -1e9, 0.0, 5.0, 37.5, 1e9])]
    below = matrix.at_most(spark.createDataFrame(points, "column string, split_id int, number int, value double"))
    counted = Counter()
    for r in copies.select("split_id", "role", "x").collect():
        for column, s, i, p in points:
            if s == r["split_id"]:
                counted[(s, i, r["role"])] += r["x"] is not None and r["x"] <= p
    assert {(r["split_id"], r["number"], r["role"]): r["n"] for r in below.collect() if r["n"]} == {k: n for k, n in counted.items() if n}


def test_summaries_equal_those_of_the_copies(both, scratch):
    placed, copies = both
    filled = cleaning.preprocess_data(copies, columns=["x"], by=["split_id", "role"]).groupBy("split_id", "role").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("x_missing").alias("n_filled"), F.round(F.sum("x"), 3).alias("total"))
    found = windows.imputed_summary(placed, ["x"], scratch).withColumn("total", F.round("total", 3))
    assert table(found, "split_id", "role", "n", "n_filled", "total") == table(filled, "split_id", "role", "n", "n_filled", "total")
    scaled = features.split_minmax(copies, ["k"]).groupBy("split_id", "role").agg(F.min("k").alias("lo"), F.max("k").alias("hi"), F.avg("k").alias("mean"))
    assert table(windows.scaled_summary(placed, ["k"]), "split_id", "role", "lo", "hi", "mean") == table(scaled, "split_id", "role", "lo", "hi", "mean")
    labels = ["a", "b", "c", "d", "e"]
    cut = features.split_bins(copies, {"k": {"bins": 5, "labels": labels}}).groupBy("split_id", "role", "k").agg(F.count(F.lit(1)).alias("n"))
    found = windows.bin_counts(placed, "k", 5, scratch).withColumn("k", features.bin_label(F.col("bin"), F.array(), labels))
    assert table(found, "split_id", "role", "k", "n") == table(cut, "split_id", "role", "k", "n")
    counted = features.split_n_occurrences(copies, ["v"], ["id"]).groupBy("split_id", "role").agg(F.sum("v_n_occur").alias("total"), F.max("v_n_occur").alias("most"))
    assert table(windows.occurrence_summary(placed, "v"), "split_id", "role", "total", "most") == table(counted, "split_id", "role", "total", "most")
    shares = evaluate.baseline(copies, "late", ["split_id", "role"])
    assert table(windows.baseline(placed, "late"), "split_id", "role", "baseline") == table(shares, "split_id", "role", "baseline")


def test_no_plan_copies_rows_into_splits(both):
    placed, _ = both
    for df in (windows.scaled_summary(placed, ["x"]), windows.occurrence_summary(placed, "v"), windows.baseline(placed, "late")):
        assert "Generate" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_bins_of_equal_values(spark, scratch):
    rows = spark.createDataFrame([(datetime(2012, 1, 1) + timedelta(days=i), 4.0 if i < 80 else 9.0) for i in range(120)], "d timestamp_ntz, x double")
    placed, copies = windows.temporal_windows(rows, "d", {"months": 1}), splits.create_temporal_splits(rows, "d", {"months": 1})
    cut = features.split_bins(copies, {"x": {"bins": 3, "labels": ["a", "b", "c"]}}).groupBy("split_id", "role", "x").agg(F.count(F.lit(1)).alias("n"))
    found = windows.bin_counts(placed, "x", 3, scratch).withColumn("x", features.bin_label(F.col("bin"), F.array(), ["a", "b", "c"]))
    assert table(found, "split_id", "role", "x", "n") == table(cut, "split_id", "role", "x", "n")


def test_no_rows_and_no_dates(rows, scratch):
    for empty in (rows.limit(0), rows.where("d IS NULL")):
        placed = windows.temporal_windows(empty, "d", LENGTH, GAP)
        assert placed.splits == () and placed.usable() == []
        assert windows.scaled_summary(placed, ["x"]).count() == 0
