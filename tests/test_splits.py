from datetime import datetime

from pyspark.sql import functions as F

from quillon.functions import create_time_diff, to_timestamp, whole_days, within_dates, year_to_date
from quillon.operators import splits


def days(spark, *texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string").select(
        "id", to_timestamp(F.col("t")).alias("d"))


def members(table, split_id, role):
    return {r.id for r in table.where(f"split_id = {split_id} AND role = '{role}'").collect()}


def test_splits_with_gap(spark):
    df = days(spark, "2012-01-01", "2012-03-01", "2012-06-30", "2012-07-01", "2012-12-31", "2013-01-01", "2013-03-01")
    out = splits.create_temporal_splits(df, "d", {"months": 6}, {"days": 60})
    assert members(out, 1, "test") == {3, 4} and members(out, 1, "train") == {0, 1}
    assert members(out, 2, "test") == {5, 6} and members(out, 2, "train") == {0, 1, 2, 3}
    assert out.select("split_id").distinct().count() == 2


def test_last_row_on_a_boundary_is_in_no_test_set(spark):
    df = days(spark, "2012-01-01", "2012-02-01", "2012-03-01")
    out = splits.create_temporal_splits(df, "d", {"months": 1})
    assert members(out, 1, "test") == {1}
    assert not out.where("role = 'test' AND id = 2").count()


def test_start_date(spark):
    df = days(spark, "2012-01-01", "2012-05-01", "2012-06-01")
    out = splits.create_temporal_splits(df, "d", {"months": 2}, start_date="2012-04-01")
    assert members(out, 1, "test") == {1} and members(out, 1, "train") == {0}
    strict = splits.create_temporal_splits(df, "d", {"months": 2}, start_date="2012-04-01", drop_before=True)
    assert members(strict, 1, "train") == set()


def test_month_ends_do_not_drift(spark):
    bounds = splits.split_boundaries(
        spark, datetime(2011, 8, 31), datetime(2013, 12, 1), {"months": 6}, first_test=datetime(2011, 8, 31))
    assert [b.test_start.date().isoformat() for b in bounds][:3] == ["2011-08-31", "2012-02-29", "2012-08-31"]


def test_consecutive_splits(spark):
    df = days(spark, "2012-01-01", "2012-02-15", "2012-03-15", "2012-04-15")
    out = splits.create_consecutive_splits(df, "d", {"months": 1})
    assert members(out, 1, "train") == {0} and members(out, 1, "test") == {1}
    assert members(out, 3, "train") == {0, 1, 2} and members(out, 3, "test") == {3}


def test_training_rows_lie_before_the_gap(spark):
    df = spark.range(400).select("id", (F.lit("2012-01-01").cast("timestamp_ntz") + F.make_dt_interval(F.col("id").cast("int"))).alias("d"))
    out = splits.create_temporal_splits(df, "d", {"months": 2}, {"days": 10})
    ranges = out.groupBy("split_id").agg(
        F.max(F.when(F.col("role") == "train", F.col("d"))).alias("last"),
        F.min(F.when(F.col("role") == "test", F.col("d"))).alias("first")).collect()
    assert len(ranges) == 6
    assert all((r["first"] - r["last"]).days > 10 for r in ranges)
    # every row is tested at most once
    assert out.where("role = 'test'").groupBy("id").count().agg({"count": "max"}).first()[0] == 1


def test_empty_table_and_missing_dates(spark):
    df = days(spark, "2012-01-01", None)
    assert splits.create_temporal_splits(df.limit(0), "d", {"months": 1}).count() == 0
    both = days(spark, "2012-01-01", None, "2012-05-01")
    assert 1 not in {r.id for r in splits.create_temporal_splits(both, "d", {"months": 2}).collect()}


def test_whole_days_round_down(spark):
    df = spark.createDataFrame([("2012-01-01 12:00:00", "2012-01-03 11:00:00"), ("2012-01-02 00:00:00", "2012-01-01 23:00:00"),
                                ("2012-01-02 00:00:00", "2012-01-01 00:00:00"), ("2012-01-02 00:00:00", None)], "a string, b string")
    out = df.select(whole_days(create_time_diff(to_timestamp(F.col("a")), to_timestamp(F.col("b")))).alias("n"))
    assert [r.n for r in out.collect()] == [1, -1, -1, None]


def test_date_ranges(spark):
    df = days(spark, "2017-06-29", "2017-07-27", "2018-01-01", "not a date")
    hit = df.select(within_dates(F.col("d"), ("2017-06-29", "2017-07-27")).alias("w"), year_to_date(F.col("d"), 2018, "2018-07-27").alias("y"))
    assert [tuple(r) for r in hit.collect()] == [(True, False), (False, False), (False, True), (False, False)]
