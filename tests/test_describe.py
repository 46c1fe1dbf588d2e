import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from quillon.operators import describe, outliers, ranks
from quillon.operators.summaries import (
    largest_changes,
    posterior_share,
    share_difference,
    summarize_by_block,
    summarize_on_field,
    summarize_yearly,
    summarize_yoy_change,
)


def test_summary(animals, any_size):
    row = describe.summarize_data(animals, agg_cols=["age"]).first()
    values = np.array([1.0, 3, 9, 4])
    assert (row["count"], row["mean"], row["min"], row["max"]) == (4, 4.25, 1, 9)
    assert row["std"] == pytest.approx(values.std(ddof=1))
    assert [row.p25, row.p50, row.p75] == pytest.approx(list(np.quantile(values, [0.25, 0.5, 0.75])))


def test_grouped_summary_leaves_out_missing_groups(animals, any_size):
    rows = {r["name"]: r for r in describe.summarize_data(animals, ["name"], ["age"]).collect()}
    assert set(rows) == {"Lance", "Barry", "Tom"}
    assert rows["Barry"].p50 == 3.5 and rows["Lance"]["std"] is None
    assert rows["Tom"]["count"] == 0 and rows["Tom"].p50 is None


def test_summary_of_empty_table(animals, any_size):
    assert describe.summarize_data(animals.limit(0), agg_cols=["age"]).collect() == []


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 2), st.floats(-1e6, 1e6).map(lambda x: round(x, 2))), min_size=1, max_size=60))
def test_bucketed_quantiles_equal_numpy(spark, monkeypatch, rows):
    monkeypatch.setattr(ranks, "SMALL_ROWS", -1)
    monkeypatch.setattr(ranks, "CUT_SAMPLE", 0.5)
    df = spark.createDataFrame(rows, "g int, x double")
    found = ranks.exact_quantiles(df, ["g"], "x", [0.0, 0.1, 0.5, 0.9, 1.0], list("abcde"))
    for r in found.collect():
        expected = np.quantile([x for g, x in rows if g == r.g], [0.0, 0.1, 0.5, 0.9, 1.0])
        assert list(r)[1:] == pytest.approx(list(expected), abs=1e-6)


def test_skewed_group_is_spread_over_buckets(spark, monkeypatch):
    monkeypatch.setattr(ranks, "SMALL_ROWS", 0)
    monkeypatch.setattr(ranks, "ROWS_PER_BUCKET", 100)
    monkeypatch.setattr(ranks, "CUT_SAMPLE", 0.2)
    df = spark.range(6000).selectExpr("if(id % 3 = 0, 'hot', string(id % 50)) AS g", "double(id) AS x")
    totals = ranks.bucket_totals(ranks.add_value_bucket(df, "x"), ["g"])
    assert totals.where("g = 'hot'").agg({"n": "max"}).first()[0] < 300


def test_correlation(spark):
    rows = [(1.0, 2.0, 5.0, True), (2.0, 4.1, 5.0, False), (3.0, 6.2, 5.0, True), (None, 1.0, 5.0, True)]
    df = spark.createDataFrame(rows, "a double, b double, c double, f boolean")
    found = {(r.variable_a, r.variable_b): r.correlation for r in describe.pw_correlate(df).collect()}
    expected = np.corrcoef([1, 2, 3], [2.0, 4.1, 6.2])[0, 1]
    assert found["a", "b"] == pytest.approx(expected) and found["a", "a"] == 1.0
    assert found["a", "c"] is None and found["c", "c"] is None and found["a", "f"] == pytest.approx(0.0)


def test_missing_report(animals):
    rows = {r["column"]: (r.n_missing, r.pct_missing) for r in describe.report_n_missing(animals).collect()}
    assert rows == {"id": (0, 0), "species": (0, 0), "age": (1, 20), "name": (1, 20)}


def test_category_sizes(animals):
    row = describe.count_per_categorical(animals, "species").first()
    assert (row["column"], row["count"], row["mean"], row["max"]) == ("obs_per_species", 4, 1.25, 2)


def test_histograms(spark):
    df = spark.createDataFrame([(float(x),) for x in [0, 1, 1, 5, 9, 10, 11]] + [(None,)], "x double")
    counts = [r.n for r in describe.fixed_histogram(df, "x", 0, 10, 5).orderBy("bin").collect()]
    assert counts == [0, 3, 3, 1]
    outer = describe.fixed_histogram(df, "x", 1, 9, 4).orderBy("bin").collect()
    assert [(r.bin, r.bin_start, r.bin_end, r.n) for r in outer] == [(-1, None, 1.0, 1), (0, 1.0, 5.0, 2), (1, 5.0, 9.0, 2), (2, 9.0, None, 2)]
    table = describe.histogram(df, "x").orderBy("bin").collect()
    values = np.array([0, 1, 1, 5, 9, 10, 11.0])
    q1, q3 = np.quantile(values, [0.25, 0.75])
    bins = int(np.ceil(11 / (2 * (q3 - q1) / 7 ** (1 / 3))))
    assert [r.n for r in table] == list(np.histogram(values, bins)[0])
    single = spark.createDataFrame([(3.0,)] * 9, "x double")
    assert [r.n for r in describe.histogram(single, "x").orderBy("bin").collect()] == list(np.histogram([3.0] * 9, 3)[0])


def test_box_plot(spark, any_size):
    df = spark.createDataFrame([(float(x),) for x in [1, 2, 3, 4, 5, 100]], "x double")
    row = describe.box_plot(df, "x").first()
    assert (row.whisker_low, row.whisker_high, row.n_outliers) == (1, 5, 1)


def test_outliers(spark, any_size):
    rows = [(i, float(v), 1.0) for i, v in enumerate([1, 2, 3, 4, 5, 100])] + [(6, None, 1.0)]
    df = spark.createDataFrame(rows, "id bigint, x double, y double")
    found = outliers.find_outliers(df, "id")
    flags = {r.id: (r.x, r.y, r.count_outlier, r.pct_outlier) for r in found.collect()}
    assert flags[5] == (True, False, 1, 50.0) and flags[6] == (False, False, 0, 0.0)
    assert {r.count_outlier: r.n for r in outliers.outlier_histogram(found).collect()} == {0: 6, 1: 1}
    assert {r["column"]: r.n_outliers for r in outliers.outliers_per_column(found, "id").collect()} == {"x": 1, "y": 0}
    assert "x" not in outliers.find_outliers(df, "id", excluded="x").columns


def test_counts_and_shares(spark):
    rows = [("THEFT", "A", 2017)] * 3 + [("BATTERY", "A", 2018)] + [(None, "B", 2018)] + [("BATTERY", "B", 2020)] * 4
    df = spark.createDataFrame(rows, "kind string, area string, year int")
    assert [(r.kind, r.n, r.percentage) for r in summarize_on_field(df, "kind").collect()] == [
        ("BATTERY", 5, 62.5), ("THEFT", 3, 37.5)]
    yearly = summarize_yearly(df).collect()
    assert [(r.year, r.n) for r in yearly] == [(2017, 3), (2018, 2), (2020, 4)]
    assert yearly[0].pct_change is None and yearly[2].pct_change == 100.0
    changes = summarize_yoy_change(df, "kind", 2017, 2018)
    assert {r.kind: r.change for r in changes.collect()} == {"THEFT": -3, "BATTERY": 1}
    assert largest_changes(changes, "kind", 1).first().kind == "BATTERY"
    difference = share_difference(df, df.year > 2000, "area", ["A"], ["B"]).first()
    assert difference.difference == pytest.approx(4 / 9 - 5 / 9)


def test_share_among_two_areas(spark):
    rows = [("Garfield", "BATTERY")] * 100 + [("Uptown", "BATTERY")] * 160 + [("Loop", "BATTERY")] * 7 + [("Uptown", "THEFT")]
    df = spark.createDataFrame(rows, "area string, kind string")
    shares = {r.area: r.share for r in posterior_share(df, df.kind == "BATTERY", "area", ["Garfield", "Uptown"]).collect()}
    assert shares == pytest.approx({"Garfield": 100 / 260, "Uptown": 160 / 260})


def test_block_pivot_fills_zero(spark):
    rows = [("b1", "g1", "THEFT"), ("b1", "g1", "THEFT"), ("b2", "g1", "ARSON"), ("b2", None, "ARSON")]
    out = summarize_by_block(spark.createDataFrame(rows, "block string, geoid10 string, kind string"), "kind")
    assert {r.block: (r.ARSON, r.THEFT) for r in out.collect()} == {"b1": (0, 2), "b2": (1, 0)}
