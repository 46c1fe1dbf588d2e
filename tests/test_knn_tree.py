"""The trees of the neighbour search: they leave neighbours as they are, and rule most rows out where values lie in few dimensions."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quillon.operators import knn
from quillon.operators.knn import NearestNeighbours


def _block(kind, n, seed):
    rng = np.random.default_rng(seed)
    if kind == "grid":  # many equal distances
        return rng.integers(0, 12, size=(n, 3)).astype(float)
    if kind == "flags":  # dummies beside numbers
        return np.hstack([np.eye(9)[rng.integers(0, 9, n)], np.eye(4)[rng.integers(0, 4, n)], rng.uniform(-1, 1, size=(n, 2))])
    if kind == "heavy tail":
        return np.exp(3 * rng.normal(size=(n, 2)))
    return rng.normal(size=(n, 24))  # little can be ruled out


@pytest.mark.parametrize("kind", ["grid", "flags", "heavy tail", "wide"])
@pytest.mark.parametrize("limit", [np.inf, 0.4])
def test_a_block_pair_equals_brute_force(kind, limit, monkeypatch):
    monkeypatch.setattr(knn, "KERNEL_CELLS", 20_000)
    t, q, k = _block(kind, 1500, 1), _block(kind, 300, 2), 4
    q[:20] = t[:20]
    train = pa.table({"n_key": np.arange(len(t)), "n_vec": list(t), "own": np.arange(len(t)) % 3})
    queries = pa.table({"q_vec": list(q), "bound": np.full(len(q), limit), "home": np.arange(len(q)) % 3})
    lines, cols, d = knn._nearest(queries, train, k)
    far = np.sqrt(((q[:, None, :] - t[None, :, :]) ** 2).sum(axis=2))
    far[(np.arange(len(q)) % 3)[:, None] == (np.arange(len(t)) % 3)[None, :]] = np.inf  # rows of the home cell
    for i in range(len(q)):
        wanted = [j for j in sorted(range(len(t)), key=lambda j: (far[i, j], j))[:k] if far[i, j] <= min(limit, 1e9)]
        assert list(cols[lines == i]) == wanted and list(d[lines == i]) == [far[i, j] for j in wanted]


def test_a_row_visits_few_cells(spark, monkeypatch):
    """20,000 rows of a category and two numbers: a test row needs its own cell and a few beside it, and few rows of a block."""
    sent, search = [], NearestNeighbours._search

    def counted(self, visits, groups):
        sent.append(visits.count())
        return search(self, visits, groups)

    monkeypatch.setattr(NearestNeighbours, "_search", counted)
    flags = [(F.col("id") % 7 == i).cast("double") for i in range(7)]
    rows = spark.range(24_000).select("id", F.array(*flags, F.rand(1), F.rand(2)).alias("v"), (F.col("id") % 2).alias("y")).localCheckpoint()
    found = NearestNeighbours(rows.where("id % 6 > 0"), "id", "v", "y", 5, pivots=40)
    assert found.score(rows.where("id % 6 = 0").select("id", "v")).where("score IS NULL").count() == 0
    assert sent[0] == 4000 and sent[1] < 2 * 4000, sent


def test_most_rows_of_a_block_are_not_compared(monkeypatch):
    t, q = _block("flags", 8000, 3), _block("flags", 2000, 4)
    compared, squares = [], knn._squares
    monkeypatch.setattr(knn, "_squares", lambda a, b: compared.append(len(a) * len(b)) or squares(a, b))
    knn._nearest(
        pa.table({"q_vec": list(q), "bound": np.full(len(q), np.inf), "home": np.full(len(q), -1)}),
        pa.table({"n_key": np.arange(len(t)), "n_vec": list(t), "own": np.zeros(len(t), int)}), 5)
    assert sum(compared) < 0.2 * len(t) * len(q)


def test_a_row_without_a_vector_is_an_error():
    with pytest.raises(ValueError, match="no vector"):
        knn._vectors(pa.table({"v": pa.array([[1.0, 2.0], None])}), "v")
