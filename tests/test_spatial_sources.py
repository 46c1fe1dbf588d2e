import json
import random

import pytest
from pyspark.sql import functions as F

from quillon import sources
from quillon.operators.spatial import RING_TYPE, link_points_areas

SQUARE = [[(0, 0), (2, 0), (2, 2), (0, 2)]]
CONCAVE = [[(3, 0), (7, 0), (7, 4), (5, 1), (3, 4)]]
HOLED = [[(0, 3), (3, 3), (3, 6), (0, 6)], [(1, 4), (2, 4), (2, 5), (1, 5)]]
HUGE = [[(-500, -500), (500, -500), (500, 500), (-500, 500)]]
AREAS = {"square": SQUARE, "concave": CONCAVE, "holed": HOLED, "huge": HUGE}


def on_segment(p, a, b):
    cross = (b[0] - a[0]) * (p[1] - a[1]) - (b[1] - a[1]) * (p[0] - a[0])
    return cross == 0 and min(a[0], b[0]) <= p[0] <= max(a[0], b[0]) and min(a[1], b[1]) <= p[1] <= max(a[1], b[1])


def inside(p, rings):
    odd = False
    for ring in rings:
        for a, b in zip(ring, ring[1:] + ring[:1]):
            if on_segment(p, a, b):
                return False
            if (a[1] > p[1]) != (b[1] > p[1]) and p[0] < (b[0] - a[0]) * (p[1] - a[1]) / (b[1] - a[1]) + a[0]:
                odd = not odd
    return odd


@pytest.mark.parametrize("broadcast_bytes", [1 << 20, 0])
def test_points_in_areas_equal_ray_cast(spark, broadcast_bytes):
    rng = random.Random(1)
    points = [(i, rng.randint(-4, 32) / 4, rng.randint(-4, 28) / 4) for i in range(700)] + [(900, None, 1.0), (901, 1.0, None)]
    areas = spark.createDataFrame(
        [(n, [[{"x": float(x), "y": float(y)} for x, y in ring] for ring in rings]) for n, rings in AREAS.items()],
        f"name string, the_geom {RING_TYPE}")
    df = spark.createDataFrame(points, "id int, longitude double, latitude double")
    linked = link_points_areas(df, areas, key="id", broadcast_bytes=broadcast_bytes)
    found = sorted((r.id, r["name"]) for r in linked.collect())
    expected = sorted((i, n) for i, x, y in points[:700] for n, rings in AREAS.items() if inside((x, y), rings))
    assert found == expected
    assert linked.columns == ["id", "longitude", "latitude", "name"]


def test_areas_and_blocks_from_json(spark, tmp_path):
    square = {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 1], [0, 0]]]}
    two = {"type": "MultiPolygon", "coordinates": [square["coordinates"], [[[5, 5], [6, 5], [6, 6], [5, 5]]]]}
    path = tmp_path / "areas.json"
    path.write_text("\n".join(json.dumps(r) for r in [
        {"area_numbe": "1", "community": "ROGERS PARK", "the_geom": square},
        {"area_numbe": "2", "community": "LOOP", "the_geom": two}]))
    areas = {r.area_number: r for r in sources.load_areas(spark, str(path)).collect()}
    assert len(areas["1"].the_geom) == 1 and len(areas["2"].the_geom) == 2 and areas["2"].the_geom[1][0].x == 5
    blocks = tmp_path / "blocks.json"
    blocks.write_text(json.dumps({"geoid10": "170310101001000", "the_geom": square}))
    row = sources.load_blocks(spark, str(blocks)).first()
    assert row.geoid10 == "170310101001"
    points = spark.createDataFrame([(0, 0.5, 0.5), (1, 5.9, 5.2), (2, 1.0, 0.5)], "id int, longitude double, latitude double")
    linked = link_points_areas(points, sources.load_areas(spark, str(path)))
    assert {(r.id, r.community) for r in linked.collect()} == {(0, "ROGERS PARK"), (0, "LOOP"), (1, "LOOP")}


def test_read_csv(spark, tmp_path):
    path = tmp_path / "people.csv"
    path.write_text("PersonID,zipcode,past-due,note\n7,00601,1.5,ok\n8,NA,,N/A\n9,x,NaN,null\n")
    df = sources.read_csv(spark, str(path), ["past-due", "zipcode", "note"], {"past-due": float, "PersonID": "bigint"}, "PersonID")
    assert df.columns == ["PersonID", "past-due", "zipcode", "note"]
    assert [tuple(r) for r in df.orderBy("PersonID").collect()] == [
        (7, 1.5, "00601", "ok"), (8, None, None, None), (9, None, "x", None)]
    with pytest.raises(ValueError):
        sources.read_csv(spark, str(path), ["other"])


def test_reports_are_filtered_by_year(spark, tmp_path):
    rows = [("2017-01-05T10:00:00", 2017, "41.8", "-87.6"), ("2016-01-05T10:00:00", 2016, "41.8", "-87.6"), ("2018-12-31T00:00:00", 2018, None, "x")]
    path = str(tmp_path / "reports")
    sources.write_table(spark.createDataFrame(rows, "date string, year int, latitude string, longitude string"), path)
    df = sources.load_reports(spark, path, 2017, 2018)
    out = df.orderBy("year").collect()
    assert [r.year for r in out] == [2017, 2018] and out[0].latitude == 41.8 and out[1].longitude is None
    assert out[0].date.isoformat() == "2017-01-05T10:00:00"
    text = str(tmp_path / "text")
    sources.write_table(spark.createDataFrame(rows, "date string, year int, latitude string, longitude string"), text, "csv")
    again = sources.load_reports(spark, text, 2017, 2017, "csv", "date string, year string, latitude string, longitude string")
    assert [r.year for r in again.collect()] == [2017]


def test_block_statistics(spark, tmp_path):
    names = [*sources.BLOCK_MEASURES, *sources.BLOCK_CODES]
    values = [200, 50, 100, 80, 20, 100, 10, 5, 3, 2, -666666666, "17", "031", "010100", "1"]
    empty = [0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 1000, "17", "031", "010100", "2"]
    path = tmp_path / "stats.csv"
    path.write_text(",".join(names) + "\n" + "\n".join(",".join(map(str, v)) for v in (values, empty)) + "\n")
    first, second = sources.load_block_stats(spark, str(path)).orderBy("geoid10").collect()
    assert first.geoid10 == "170310101001"
    assert [first[c] for c in sources.PROFILE_COLUMNS] == [25.0, 50.0, 25.0, 20.0, None]
    assert [second[c] for c in sources.PROFILE_COLUMNS] == [None, None, None, None, 1000.0]


def test_number_columns_with_dashes_survive(spark):
    from quillon.operators.describe import report_n_missing, summarize_data

    df = spark.createDataFrame([(1.0, None), (2.0, 5.0)], "`30-59 days` double, `a.b` double")
    assert {r["column"] for r in summarize_data(df).collect()} == {"30-59 days", "a.b"}
    assert {r["column"]: r.n_missing for r in report_n_missing(df).collect()} == {"30-59 days": 0, "a.b": 1}
    assert df.agg(F.count("`a.b`")).first()[0] == 1


def test_hot_and_missing_keys_are_spread(spark):
    from quillon.operators.joins import dimension_join

    rows = spark.range(4000).selectExpr("if(id % 4 = 0, null, if(id % 4 = 1, id, 7)) as k").repartition(4).select("k")
    table = spark.range(5000).selectExpr("id as k", "id * 2 as v")
    joined = dimension_join(rows, table, ["k"], broadcast_rows=0)
    assert joined.count() == 4000
    assert joined.where("v <> 2 * k or (v is null) <> (k is null)").count() == 0
    assert "__salt" not in joined.columns
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        from pyspark.sql import functions as F

        tasks = dimension_join(rows, table, ["k"], broadcast_rows=0).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert max(r["count"] for r in tasks) < 1500


def test_csv_with_quotes_breaks_and_torn_rows(spark, tmp_path):
    import pytest

    path = tmp_path / "rows.csv"
    path.write_text('id,txt,n\n1,"a ""b"", c",3\n2,"x\ny",4\n3,NA,zz\n4,plain,\n')
    rows = sources.read_csv(spark, str(path), col_types={"id": "bigint", "n": "int"}).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [(1, 'a "b", c', 3), (2, "x\ny", 4), (3, None, None), (4, "plain", None)]
    torn = tmp_path / "torn.csv"
    torn.write_text("id,txt\n1,a\n2,b,c\n3\n")
    with pytest.raises(Exception, match="wrong number of fields"):
        sources.read_csv(spark, str(torn), col_types={"id": "bigint"}).collect()
    assert [r.id for r in sources.read_csv(spark, str(torn), col_types={"id": "bigint"}, bad_rows="drop").collect()] == [1]
    assert sources.read_csv(spark, str(torn), bad_rows="drop").count() == 1
    assert sources.read_csv(spark, str(path)).count() == 4
