"""Sparse dummies: the entry of each value, missing values, values of another table, and columns too wide for columns of their own."""

import pytest

from quillon.operators import features

ROWS = [(0, "b"), (1, "a"), (2, "b"), (3, None), (4, "c"), (5, "a"), (6, "d")]


@pytest.fixture
def letters(spark):
    return spark.createDataFrame(ROWS, "id int, c string")


def _ones(df, name="c_dummies"):
    return {r.id: None if r[name] is None else [int(i) for i in r[name].indices] for r in df.collect()}


def test_entries_are_in_the_order_of_frequency(letters):
    out = features.sparse_dummies(letters, ["c"], keep_index=True)
    assert {r.id: r.c_index for r in out.collect()} == {0: 1, 1: 0, 2: 1, 3: None, 4: 2, 5: 0, 6: 3}
    assert _ones(out) == {0: [1], 1: [0], 2: [1], 3: [], 4: [2], 5: [0], 6: [3]}


def test_missing_values_and_values_of_another_table(letters):
    assert _ones(features.sparse_dummies(letters, ["c"], missing="null"))[3] is None
    fitted = features.sparse_dummies(letters, ["c"], fit_on=letters.where("id IN (0, 2, 4)"))
    assert _ones(fitted) == {0: [0], 1: [], 2: [0], 3: [], 4: [1], 5: [], 6: []}


def test_wide_columns_become_sparse(letters, monkeypatch):
    monkeypatch.setattr(features, "MAX_DUMMIES", 2)
    assert _ones(features.create_dummies(letters, "c"))[4] == [2]
    assert _ones(features.create_dummies_many(letters, ["c"]))[6] == [3]
