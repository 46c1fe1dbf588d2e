"""Balanced centroids, the graph that searches them, and the rules that choose posting lists."""

from __future__ import annotations

import numpy as np

DEGREE = 16
BEAM = 8
REPLICAS = 3
CLOSE = 1.15
PAIRS = 1 << 20


def augmented(vectors: np.ndarray, largest: float) -> np.ndarray:
    """Vectors as points whose distance to a query of the same length falls as their inner product with it rises.

    One coordinate more brings each vector to the length ``largest``.
    """
    wide = vectors.astype(np.float64) / largest
    rest = np.sqrt(np.maximum(0, 1 - (wide**2).sum(axis=1)))
    return np.column_stack([wide, rest]).astype(np.float32)


def as_queries(vectors: np.ndarray) -> np.ndarray:
    """Queries as points for ``augmented`` ones: of length 1, nothing in the added coordinate."""
    wide = vectors.astype(np.float64)
    wide /= np.abs(wide).max(axis=1, keepdims=True)
    wide /= np.sqrt((wide**2).sum(axis=1, keepdims=True))
    return np.column_stack([wide, np.zeros(len(wide))]).astype(np.float32)


def balanced_centroids(points: np.ndarray, k: int, rounds: int = 8, seed: int = 0) -> np.ndarray:
    """At most ``k`` centroids whose clusters among ``points`` have about equal sizes.

    Lloyd's rounds in which a cluster with more than its share of points gets a price that is added to the
    squared distances, and a smaller one a rebate.
    """
    k = min(k, len(points))
    rng = np.random.default_rng(seed)
    centroids = points[rng.choice(len(points), k, replace=False)].astype(np.float64)
    price, step = np.zeros(k), 0.1 * float(points.var(axis=0).sum())
    for _ in range(rounds):
        squares = (centroids**2).sum(axis=1) + price
        of = np.concatenate([np.argmin(squares - 2 * (part @ centroids.T), axis=1) for part in np.array_split(points, -(-len(points) * k // (1 << 23)) or 1)])
        sizes = np.bincount(of, minlength=k)
        order = np.argsort(of, kind="stable")
        used = np.flatnonzero(sizes)
        sums = np.add.reduceat(points[order].astype(np.float64), np.concatenate([[0], np.cumsum(sizes[used])[:-1]]), axis=0)
        centroids[used] = sums / sizes[used, None]
        price += step * (sizes * k / len(points) - 1).clip(-1, 3)
    return np.unique(centroids.astype(np.float32), axis=0)


def bundled(centroids: np.ndarray, most: int) -> np.ndarray:
    """The bundle of each centroid: halves along the longest axis of spread until none has more than ``most``."""
    bundle = np.zeros(len(centroids), dtype=np.int32)
    todo, made = [np.arange(len(centroids))], 0
    while todo:
        part = todo.pop()
        if len(part) <= most:
            bundle[part] = made
            made += 1
            continue
        points = centroids[part] - centroids[part].mean(axis=0)
        axis = np.linalg.eigh(points.T @ points)[1][:, -1]
        order = part[np.argsort(points @ axis, kind="stable")]
        todo += [order[: len(order) // 2], order[len(order) // 2 :]]
    return bundle


class CentroidGraph:
    """Centroids with links to their nearest ones, searched from a few pivots; a ring of links keeps all reachable."""

    def __init__(self, centroids: np.ndarray, degree: int = DEGREE, pivots: int = 32):
        k = len(centroids)
        self.centroids, self.squares = centroids, (centroids**2).sum(axis=1)
        degree = min(degree, k - 1)
        near = np.zeros((k, degree), dtype=np.int32)
        for rows in np.array_split(np.arange(k), -(-k * k // (1 << 24)) or 1):
            if degree:
                far = self.squares - 2 * (centroids[rows] @ centroids.T)
                far[np.arange(len(rows)), rows] = np.inf
                near[rows] = np.argpartition(far, degree - 1, axis=1)[:, :degree]
        self.links = np.column_stack([near, (np.arange(k) + 1) % k]).astype(np.int32)
        self.pivots = np.unique(np.linspace(0, k - 1, min(pivots, k)).astype(np.int64))

    def __len__(self) -> int:
        return len(self.centroids)

    def _distances(self, points: np.ndarray, squares: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Squared distances of each point to its row of centroids."""
        dots = np.matmul(self.centroids[ids], points[:, :, None])[:, :, 0]
        return np.maximum(0, squares[:, None] + self.squares[ids] - 2 * dots)

    def nearest(self, points: np.ndarray, width: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
        """(ids, squared distances), ascending, of about the ``width`` nearest centroids: a beam search of all points at once."""
        width, n = min(width, len(self)), len(points)
        squares = (points**2).sum(axis=1)
        start = np.broadcast_to(self.pivots, (n, len(self.pivots)))
        first = np.maximum(0, squares[:, None] + self.squares[self.pivots] - 2 * (points @ self.centroids[self.pivots].T))
        ids = np.full((n, width), -1, dtype=np.int64)
        far = np.full((n, width), np.inf, dtype=np.float32)
        some = min(width, len(self.pivots))
        best = np.argsort(first, axis=1, kind="stable")[:, :some]
        ids[:, :some], far[:, :some] = np.take_along_axis(start, best, 1), np.take_along_axis(first, best, 1)
        walked = ~np.isfinite(far)
        rows = np.arange(n)
        while len(rows):
            at = np.argmin(np.where(walked[rows], np.inf, far[rows]), axis=1)
            rows, at = rows[~walked[rows, at]], at[~walked[rows, at]]
            if not len(rows):
                break
            walked[rows, at] = True
            found = self.links[ids[rows, at]].astype(np.int64)
            found.sort(axis=1)
            d = self._distances(points[rows], squares[rows], found)
            d[(found[:, :, None] == ids[rows][:, None, :]).any(axis=2)] = np.inf
            d[:, 1:][found[:, 1:] == found[:, :-1]] = np.inf
            both, where = np.concatenate([far[rows], d], axis=1), np.concatenate([ids[rows], found], axis=1)
            done = np.concatenate([walked[rows], np.zeros(d.shape, bool)], axis=1)
            keep = np.argpartition(both, width - 1, axis=1)[:, :width]
            far[rows], ids[rows] = np.take_along_axis(both, keep, 1), np.take_along_axis(where, keep, 1)
            walked[rows] = np.take_along_axis(done, keep, 1) | ~np.isfinite(far[rows])
        order = np.argsort(far, axis=1, kind="stable")
        return np.take_along_axis(ids, order, 1), np.take_along_axis(far, order, 1)

    def within(self, points: np.ndarray, ratio: float, sizes: np.ndarray, need: int) -> np.ndarray:
        """Which centroids each point selects, as a table of booleans.

        Those no farther than ``ratio`` times the nearest, reached over the links; where their lists hold fewer than
        ``need`` entries, farther ones too, in the end all.
        """
        ids, near = self.nearest(points)
        squares = (points**2).sum(axis=1)
        far = np.full((len(points), len(self)), np.inf, dtype=np.float32)
        far[np.arange(len(points))[:, None], ids] = near
        limit = np.maximum(near[:, 0] * ratio**2, 1e-12)
        fresh = far <= limit[:, None]
        while True:
            r, c = np.nonzero(fresh)
            walked = far <= limit[:, None]
            while len(r):
                flat = np.unique(r[:, None] * len(self) + self.links[c])
                r, c = flat // len(self), flat % len(self)
                new = ~np.isfinite(far[r, c])
                r, c = r[new], c[new]
                for part in np.array_split(np.arange(len(r)), -(-len(r) // PAIRS) or 1):
                    a, b = r[part], c[part]
                    far[a, b] = np.maximum(0, squares[a] + self.squares[b] - 2 * np.einsum("ij,ij->i", points[a], self.centroids[b]))
                inside = far[r, c] <= limit[r]
                r, c = r[inside], c[inside]
            chosen = far <= limit[:, None]
            short = (chosen @ sizes < need) & ~chosen.all(axis=1)
            if not short.any():
                return chosen
            known = np.where(np.isfinite(far) & ~chosen, far, np.inf).min(axis=1)
            limit = np.where(short, np.where(np.isfinite(known), np.maximum(limit * 1.5, known), np.inf), limit)
            fresh = (far <= limit[:, None]) & (~walked | short[:, None])

    def lists(self, points: np.ndarray, replicas: int = REPLICAS, close: float = CLOSE) -> tuple[np.ndarray, np.ndarray]:
        """(ids, used): the lists each point is posted in, the nearest first.

        A boundary point goes to several: to centroids nearly as near as the nearest, unless one that it was posted to
        already lies nearer to that centroid than the point does.
        """
        ids, far = self.nearest(points)
        used = np.zeros(ids.shape, bool)
        used[:, 0] = True
        for j in range(1, ids.shape[1]):
            between = self._distances(self.centroids[ids[:, j]], self.squares[ids[:, j]], ids[:, :j])
            shadowed = (used[:, :j] & (between <= far[:, j, None])).any(axis=1)
            used[:, j] = ~shadowed & (far[:, j] <= far[:, 0] * close**2) & (used[:, :j].sum(axis=1) < replicas)
        return ids, used
