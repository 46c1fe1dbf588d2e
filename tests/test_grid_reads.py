"""Rows that need no features of a split are not copied for it, and their categories are counted once for all splits."""

from datetime import datetime, timedelta

from pyspark.ml import Pipeline
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from quillon.operators import features
from quillon.operators.windows import temporal_windows
from quillon.plans import grid


def _labels(train, names):
    indexer = StringIndexer(inputCols=names, outputCols=[f"{n}_i" for n in names], stringOrderType="frequencyDesc", handleInvalid="keep")
    return [list(x) for x in indexer.fit(train).labelsArray]


def test_categories_are_in_the_order_of_the_string_indexer(spark):
    rows = [("b", 1.0, 3), ("a", float("nan"), 3), ("b", 2.5, None), (None, 2.5, 10), ("\U0001f600", None, 9), ("￮", -0.0, 10), ("B", 0.0, 10), ("A", 1.0, 9)]
    names = ["s", "d", "k"]
    train = spark.createDataFrame(rows, "s string, d double, k int")
    model = features.sparse_encoder(train, names, [])
    assert [list(s.labels) for s in model.stages[:3]] == _labels(train, names)
    old = Pipeline(stages=[
        StringIndexer(inputCols=names, outputCols=[f"{c}__index" for c in names], stringOrderType="frequencyDesc", handleInvalid="keep"), *model.stages[3:]])
    assert model.transform(train).select("features").collect() == old.fit(train).transform(train).select("features").collect()


def test_splits_share_one_count_and_copy_no_rows(spark, monkeypatch):
    start = datetime(2020, 1, 1)
    rows = [(i, start + timedelta(days=4 * i), float(i % 9), None if i % 11 == 0 else "abcde"[(i * i + i // 40) % 5], i % 3 == 0) for i in range(300)]
    df = spark.createDataFrame(rows, "id bigint, day timestamp, x double, c string, late boolean")
    placed = temporal_windows(df, "day", {"months": 6}, {"days": 30})
    plain, encoded, copied = features.sparse_encoder, [], []

    def encoder(train, categorical, numeric, counts=None):
        model = plain(train, categorical, numeric, counts=counts)
        encoded.append((counts is not None, [list(model.stages[0].labels)], _labels(train, categorical)))
        return model

    persist = type(df).persist
    monkeypatch.setattr(grid, "sparse_encoder", encoder)
    monkeypatch.setattr(type(df), "persist", lambda self, *a: copied.append(self.columns) or persist(self, *a))
    scores = grid.score_grid(placed.without("day"), [{"model": "dt", "max_depth": 2}], "late", "id", ["c"]).collect()
    monkeypatch.undo()
    assert len(encoded) > 3 and all(given and found == expected for given, found, expected in encoded), encoded
    assert len(copied) == len(encoded) and all("features" in c for c in copied)  # the encoded training rows alone
    again = grid.score_grid(placed, [{"model": "dt", "max_depth": 2}], "late", "id", ["c"], features=lambda r: r.drop("day"))
    assert sorted(scores) == sorted(again.collect())
    assert {r["id"] for r in scores} == {r["id"] for r in placed.rows.where(F.col("tested_in").isin(placed.usable())).collect()}
