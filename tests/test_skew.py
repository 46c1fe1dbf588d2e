"""Joins by measured skew, cells that follow the areas, and pivots of any number of values."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quillon.operators import params, spatial, summaries
from quillon.operators.joins import lookup


def rows_of(df, *names):
    return Counter(tuple(r[n] for n in names) for r in df.collect())


@pytest.fixture(scope="module")
def crowded(spark):
    """Half of the rows have one key, a tenth none."""
    key = F.when(F.col("id") % 2 == 0, 7).when(F.col("id") % 10 == 1, None).otherwise(F.col("id") % 500)
    return spark.range(20_000).select("id", key.cast("int").alias("k"))


def test_only_heavy_keys_are_copied(spark, crowded):
    heavy, missing = params.heavy_keys(crowded, ["k"], 1.0)
    assert [k for k, _ in heavy] == [7] and 2 <= heavy[0][1] <= 8 and missing >= 2
    table = spark.range(600).select(F.col("id").cast("int").alias("k"), (F.col("id") * 2).alias("v"))
    for how in ("left", "inner"):
        found = params.skew_join(crowded, table, ["k"], how, sample=1.0)
        assert rows_of(found, "id", "k", "v") == rows_of(crowded.join(table, "k", how), "id", "k", "v")
    plain = params.skew_join(crowded.where("k <> 7"), table, ["k"], sample=1.0)
    assert "__salt" not in plain._jdf.queryExecution().optimizedPlan().toString()
    salted = params.skew_join(crowded, table, ["k"], sample=1.0)
    assert "__salt" in salted._jdf.queryExecution().optimizedPlan().toString()


def test_heavy_key_is_spread_over_tasks(spark, crowded):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        table = spark.range(600).select(F.col("id").cast("int").alias("k"), (F.col("id") * 2).alias("v"))
        found = params.skew_join(crowded, table, ["k"], sample=1.0).groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n"))
        assert max(r["n"] for r in found.collect()) < 0.45 * 20_000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_lookup_by_share(spark, crowded):
    counts = crowded.where("k IS NOT NULL").groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    wanted = rows_of(crowded.join(counts, "k", "left"), "id", "k", "n")
    assert rows_of(lookup(crowded, counts, ["k"], "n", ["id"], small_limit=0), "id", "k", "n") == wanted


def ring(points):
    return [{"x": float(x), "y": float(y)} for x, y in points]


def inside(x, y, rings):
    crossed = False
    for r in rings:
        for a, b in zip(r, r[1:] + r[:1], strict=True):
            cross = (b["x"] - a["x"]) * (y - a["y"]) - (b["y"] - a["y"]) * (x - a["x"])
            if cross == 0 and min(a["x"], b["x"]) <= x <= max(a["x"], b["x"]) and min(a["y"], b["y"]) <= y <= max(a["y"], b["y"]):
                return False
            if (a["y"] > y) != (b["y"] > y) and (cross > 0) == (b["y"] > a["y"]):
                crossed = not crossed
    return crossed


@pytest.mark.parametrize("broadcast_bytes", [spatial.BROADCAST_BYTES, 0])
def test_cells_follow_the_areas(spark, broadcast_bytes):
    rng = random.Random(3)
    star = ring([(50 + r * math.cos(t), 50 + r * math.sin(t)) for i in range(400) for t, r in [(2 * math.pi * i / 400, 40 if i % 2 else 25)]])
    box = ring([(10, 10), (90, 10), (90, 90), (10, 90)])
    hole = ring([(40, 40), (60, 40), (60, 60), (40, 60)])
    tiny = ring([(50, 50), (50.001, 50), (50.001, 50.001)])
    huge = ring([(-1e6, -1e6), (1e6, -1e6), (1e6, 1e6), (-1e6, 1e6)])
    flat = ring([(0, 0), (5, 0)])
    areas = [("star", [star]), ("box", [box, hole]), ("tiny", [tiny]), ("huge", [huge]), ("flat", [flat]), ("none", [])]
    points = [(i, rng.choice([rng.uniform(0, 100), float(rng.randrange(0, 100, 10))]), rng.choice([rng.uniform(0, 100), float(rng.randrange(0, 100, 10))])) for i in range(1500)]
    points += [(2000 + i, 50.0005, 50.0002) for i in range(500)] + [(5000, None, 1.0), (5001, 2e6, 0.0)]
    frame = spark.createDataFrame(points, "id int, longitude double, latitude double")
    table = spark.createDataFrame(areas, f"name string, the_geom {spatial.RING_TYPE}")
    found = spatial.link_points_areas(frame, table, broadcast_bytes=broadcast_bytes)
    wanted = Counter((i, n) for i, x, y in points if x is not None for n, rings in areas if inside(x, y, rings))
    assert rows_of(found, "id", "name") == wanted
    cells = spatial.area_cells(table).groupBy("name").agg(F.max(F.size("__edges")).alias("most"), F.count_if("__inner").alias("inner"), F.count(F.lit(1)).alias("n"))
    by_name = {r["name"]: r for r in cells.collect()}
    assert by_name["star"]["most"] < 250 and by_name["star"]["n"] > 30 and by_name["star"]["inner"] > 0


def test_pivot_of_more_values_than_columns(spark):
    rows = spark.range(6000).select(F.lit("b").alias("block"), (F.col("id") % 2).alias("geoid10"), (F.col("id") % 1500).alias("v"))
    found = summaries.map_by_block(rows, "v")
    assert len(found.columns) == 3 and found.count() == 2
    first = found.where("geoid10 = 0").select("counts", summaries.count_of(F.col("counts"), F.lit(4).cast("bigint")).alias("four"), summaries.count_of(F.col("counts"), F.lit(3).cast("bigint")).alias("three")).first()
    assert len(first["counts"]) == 750 and (first["four"], first["three"]) == (4, 0)
    keys = F.map_keys("counts")
    assert found.where(keys == F.sort_array(keys)).count() == 2
    with pytest.raises(ValueError, match="map_by_block"):
        summaries.summarize_by_block(rows, "v")
    assert summaries.count_by_block(rows, "v").count() == 1500
