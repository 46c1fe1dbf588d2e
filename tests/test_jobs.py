import random

import pytest
from pyspark.sql import functions as F

from quillon.operators.spatial import RING_TYPE
from quillon.plans import credit, crime
from quillon.sources import PROFILE_COLUMNS


@pytest.fixture(scope="module")
def city(spark):
    rng = random.Random(6)
    rows = []
    for i in range(400):
        year = 2017 + i % 2
        place = (rng.randint(0, 40) / 10, rng.randint(0, 20) / 10) if i % 10 else (None, None)
        rows.append((i, f"{year}-{1 + i % 12:02d}-15 10:00:00", year, place[0], place[1], rng.choice(["THEFT", "BATTERY", "HOMICIDE"]),
                     f"block{rng.randint(0, 9)}", str(rng.randint(1, 4)), "43"))
    reports = spark.createDataFrame(
        rows, "id int, date string, year int, longitude double, latitude double, primary_type string, block string, "
              "community_area string, ward string").withColumn("date", F.col("date").cast("timestamp_ntz")).persist()
    areas = spark.createDataFrame([("1", "LOOP", 10.0), ("2", "AUSTIN", 20.0), ("3", "UPTOWN", 30.0)],
                                  "area_number string, community string, size double")
    return rows, reports, areas


def test_overview(city):
    rows, reports, areas = city
    tables = crime.crime_overview(reports, areas, 2017, 2018)
    counts = {r.primary_type: r.n for r in tables["types"].collect()}
    assert counts == {t: sum(r[5] == t for r in rows) for t in counts} and sum(counts.values()) == 400
    assert [(r.year, r.n, r.pct_change) for r in tables["yearly"].collect()] == [(2017, 200, None), (2018, 200, 0.0)]
    named = {r.community_area: r.n for r in tables["area_counts"].collect()}
    assert named == {n: sum(r[7] == c for r in rows) for c, n in (("1", "LOOP"), ("2", "AUSTIN"), ("3", "UPTOWN"))}
    chart = tables["area_map"].collect()
    assert {r.scale_min for r in chart} == {min(named.values())} and {r.scale_max for r in chart} == {max(named.values())}
    assert tables["area_description"].first()["count"] == 3
    assert sum(r.n for r in tables["area_histogram"].collect()) == 3
    assert tables["monthly"].count() == 12
    assert tables["primary_type_decreases"].count() == 3


def test_windows_of_the_year(city):
    rows, reports, _ = city
    window = crime.compare_windows(reports, [("2017-03-01", "2017-06-01"), ("2018-03-01", "2018-06-01")]).collect()
    assert sum(r.n for r in window) == sum(r[1][5:7] in ("03", "04", "05") for r in rows)
    to_date = crime.compare_year_to_date(reports, {2017: "2017-06-01", 2018: "2018-06-01"}).collect()
    assert sum(r.n for r in to_date) == sum(r[1][5:7] < "06" for r in rows)


def test_block_profiles_keep_every_linked_report(spark, city):
    rows, reports, _ = city

    def square(x):
        return [[{"x": float(a), "y": float(b)} for a, b in ((x, 0), (x + 2, 0), (x + 2, 2), (x, 2))]]

    blocks = spark.createDataFrame([("g0", square(0)), ("g2", square(2))], f"geoid10 string, the_geom {RING_TYPE}")
    linked = crime.link_reports_blocks(reports, blocks, "id")
    inside = [r for r in rows if r[3] is not None and 0 < r[4] < 2 and 0 < r[3] < 4 and r[3] != 2]
    assert linked.count() == len(inside)
    stats = spark.createDataFrame([("g0", 1.0, 2.0, 3.0, 4.0, 5.0)], "geoid10 string, a double, b double, c double, d double, e double")
    stats = stats.withColumnsRenamed(dict(zip("abcde", PROFILE_COLUMNS)))
    profiles = crime.block_profile(reports, blocks, stats, ["BATTERY", "HOMICIDE"], "id")
    found = {r["column"]: r for r in profiles["BATTERY"].collect()}
    batteries = {(r[6], "g0" if r[3] < 2 else "g2") for r in inside if r[5] == "BATTERY"}
    assert set(found) == set(PROFILE_COLUMNS)
    assert found[PROFILE_COLUMNS[0]]["count"] == sum(g == "g0" for _, g in batteries)


def test_credit_job(spark, tmp_path):
    rng = random.Random(8)
    names = [credit.KEY, credit.ZIP, *credit.NUMBERS]
    lines = [",".join(names)]
    for i in range(150):
        late = rng.randint(0, 3)
        row = {c: str(rng.randint(0, 90)) for c in credit.NUMBERS}
        row |= {credit.KEY: str(i), credit.ZIP: rng.choice(["60601", "60602", "60603"]), credit.LABEL: str(int(late > 1)),
                credit.LATE_COUNTS[0]: str(late), "MonthlyIncome": "" if i % 9 == 0 else str(rng.randint(1000, 9000))}
        lines.append(",".join(row[c] for c in names))
    path = tmp_path / "credit.csv"
    path.write_text("\n".join(lines) + "\n")
    people = credit.load_people(spark, str(path))
    few = people.select(credit.KEY, credit.ZIP, credit.LABEL, "MonthlyIncome", "age")
    tables = credit.explore_data(few)
    assert {r["column"]: r["count"] for r in tables["summary"].collect()}["MonthlyIncome"] == 150 - 17
    assert tables["group_means"].count() == 9 and tables["zipcode_counts"].count() == 3
    accuracy = credit.build_and_score(people).first().accuracy
    assert accuracy > 0.9


@pytest.mark.parametrize("broadcast_rows", [100, 0])
def test_dimension_join_small_and_large(spark, broadcast_rows):
    from quillon.operators.joins import dimension_join

    rows = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i}") for i in range(60)] + [(99, None)], "id int, k string")
    table = spark.createDataFrame([("hot", 1), ("k3", 2)], "k string, v int")
    out = {r.id: r.v for r in dimension_join(rows, table, ["k"], broadcast_rows=broadcast_rows).collect()}
    assert len(out) == 61 and out[1] == 1 and out[3] == 2 and out[6] is None and out[99] is None
    assert dimension_join(rows, table, ["k"], "inner", broadcast_rows).count() == 41
