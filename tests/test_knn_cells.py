"""Neighbours where vectors repeat, cells are many, and cells are visited in bundles."""

from __future__ import annotations

import numpy as np
import pytest

from quillon.operators import knn
from quillon.operators.knn import NearestNeighbours


def brute(train, test, k):
    distance = np.sqrt(((test[:, None, :] - train[None, :, :]) ** 2).sum(axis=2))
    return [[(j, distance[i, j]) for j in sorted(range(len(train)), key=lambda j: (distance[i, j], j))[:k]] for i in range(len(test))]


@pytest.mark.parametrize(("dims", "pivots", "block_rows", "most_visits"), [(2, 40, 50, 48), (2, 40, None, 0), (12, 30, 30, 48), (12, 30, None, 0), (1, 1, None, 48)])
def test_neighbours_equal_brute_force(spark, dims, pivots, block_rows, most_visits):
    rng = np.random.default_rng(dims + pivots)
    train = np.vstack([rng.normal(size=(250, dims)), rng.integers(0, 3, size=(150, dims)), np.ones((30, dims))]).astype(float)
    test = np.vstack([rng.normal(size=(60, dims)), rng.integers(0, 3, size=(40, dims)), np.ones((9, dims)), 1e6 * np.ones((1, dims))]).astype(float)
    t = spark.createDataFrame([(i, v.tolist(), i % 3 == 0) for i, v in enumerate(train)], "id bigint, v array<double>, y boolean")
    q = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(test)], "id bigint, v array<double>")
    search = NearestNeighbours(t, "id", "v", "y", 7, pivots=pivots, block_rows=block_rows, most_visits=most_visits)
    found = {}
    for r in search.neighbours(q).orderBy("distance", "n_key").collect():
        found.setdefault(r.q_key, []).append((r.n_key, r.distance))
    for i, wanted in enumerate(brute(train, test, 7)):
        assert [n for n, _ in found[i]] == [n for n, _ in wanted]
        assert [d for _, d in found[i]] == pytest.approx([d for _, d in wanted])


def test_copies_are_searched_once(spark, monkeypatch):
    """500 copies of 40 training rows and 20 copies of 30 test rows."""
    seen, search = [], NearestNeighbours._search

    def counted(self, visits, groups):
        seen.append((self.train.count(), visits.select("q").distinct().count()))
        return search(self, visits, groups)

    monkeypatch.setattr(knn.NearestNeighbours, "_search", counted)
    t = spark.range(20_000).selectExpr("id", "array(double(id % 40), double(id % 8)) AS v", "id % 2 AS y")
    q = spark.range(600).selectExpr("id", "array(double(id % 30) + 0.25, 0.0D) AS v")
    rows = NearestNeighbours(t, "id", "v", "y", 3).score(q).collect()
    assert seen[0] == (120, 30) and len(rows) == 600
    # the nearest of 8.25 is 8: keys 8, 48, 88
    assert {r.score for r in rows if r.id % 30 == 8} == {0.0}
