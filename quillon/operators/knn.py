"""Exact k nearest neighbours (Euclidean) as a blocked join over the cells of a k-d tree.

Equal training vectors are one group, of which the k smallest keys are kept (no other row can be a neighbour), and equal
test vectors are searched once. A k-d tree over a sample of the training rows cuts them into cells, and the box of each cell, and of
each node above, is measured over all rows. A test row first searches the cell it falls into, which bounds the distance of its k-th
neighbour; it is then sent only to cells whose boxes are as close. Cells and test rows are cut into blocks, so no task ever sees more
than one block of either side, and a block pair hands back at most k neighbours per test row. Within a block pair another tree over the
block's rows does the same, where boxes rule enough out. Where cells can't be ruled out, they are visited in bundles, so that a test row
is copied a bounded number of times.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillon.functions import column
from quillon.session import materialize, spread

LEAST_CELLS, MOST_CELLS, ROWS_PER_CELL = 16, 4096, 4000
SAMPLE_PER_CELL, SAMPLE_NUMBERS = 32, 1 << 22  # rows of the sample that cells are cut in, and its numbers
LEAF_ROWS = 64  # of the tree over a block's rows
BATCH_NUMBERS = 1 << 20  # doubles of the rows that go down the tree together
BLOCK_ROWS = 16_000
BLOCK_NUMBERS = 1 << 21  # doubles of one side of a block pair
KERNEL_CELLS = 4_000_000  # doubles held at once by the distance kernel
CHUNK_NUMBERS = 1 << 22  # differences held at once when distances are taken
SLACK = 1e-9  # rounding allowance when a whole cell is ruled out
BUNDLES = 16
MOST_VISITS = 48  # cells a test row visits on average, before these are bundled
TRIED, MOST_TRIED = 64, 0.25  # test rows of a block that try its tree, and the share of leaves they may need


def _as_array(df: DataFrame, name: str) -> Column:
    if isinstance(df.schema[name].dataType, VectorUDT):
        return vector_to_array(column(name))
    return column(name).cast("array<double>")


def _squares(q: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared distances of all pairs by one matrix product, and a bound on their error for each row of ``q``."""
    q2, t2 = (q * q).sum(axis=1), (t * t).sum(axis=1)
    error = 4e-16 * (q.shape[1] + 16) * (q2 + (t2.max() if len(t2) else 0.0))
    return q2[:, None] + t2[None, :] - 2.0 * (q @ t.T), error


class _Tree:
    """A k-d tree: nodes with a dimension and a cut (values up to the cut go left), and leaves numbered from left to right."""

    def __init__(self, v: np.ndarray, leaves: int, least: int):
        """Cut the largest node first, in the dimension of the most variance that leaves ``least`` rows on both sides, near the median."""
        self.dim, self.cut, self.left, self.right = [-1], [0.0], [-1], [-1]
        rows, heap, n = {0: np.arange(len(v))}, [(-len(v), 0)], 1
        while heap and n < leaves:
            _, node = heapq.heappop(heap)
            found = self._cut(v, rows[node], max(1, least))
            if found is None:
                continue
            dim, cut, low = found
            at, n = rows.pop(node), n + 1
            for part in (at[low], at[~low]):
                child = len(self.dim)
                for values, x in ((self.dim, -1), (self.cut, 0.0), (self.left, -1), (self.right, -1)):
                    values.append(x)
                rows[child] = part
                heapq.heappush(heap, (-len(part), child))
            self.dim[node], self.cut[node], self.left[node], self.right[node] = dim, cut, child - 1, child
        self.parent, self.leaf, self.members = [-1] * len(self.dim), [-1] * len(self.dim), []
        for node in self._order():
            if self.dim[node] < 0:
                self.leaf[node] = len(self.members)
                self.members.append(rows[node])
            else:
                self.parent[self.left[node]] = self.parent[self.right[node]] = node

    @staticmethod
    def _cut(v: np.ndarray, at: np.ndarray, least: int) -> tuple[int, float, np.ndarray] | None:
        if len(at) < 2 * least:
            return None
        x = v[at]
        with np.errstate(all="ignore"):
            spread = x.var(axis=0)
        for dim in np.argsort(-spread, kind="stable"):
            if not spread[dim] > 0:
                return None
            values = x[:, dim]
            cut = np.partition(values, (len(values) - 1) // 2)[(len(values) - 1) // 2]
            low = values <= cut
            if low.all() and (values < cut).any():
                cut = values[values < cut].max()
                low = values <= cut
            if least <= low.sum() <= len(low) - least:
                return int(dim), float(cut), low
        return None

    def _order(self) -> list[int]:
        """The nodes, each before its children, leaves from left to right."""
        out, waiting = [], [0]
        while waiting:
            node = waiting.pop()
            out.append(node)
            if self.dim[node] >= 0:
                waiting += [self.right[node], self.left[node]]
        return out

    def measured(self, n: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
        """Take the number of rows of the leaves and their boxes; an empty leaf has a box from inf to -inf."""
        size, dims = len(self.dim), low.shape[1]
        self.n, self.low, self.high = np.zeros(size, np.int64), np.full((size, dims), np.inf), np.full((size, dims), -np.inf)
        for node in reversed(self._order()):
            if self.dim[node] < 0:
                at = self.leaf[node]
                self.n[node], self.low[node], self.high[node] = n[at], low[at], high[at]
            else:
                a, b = self.left[node], self.right[node]
                self.n[node] = self.n[a] + self.n[b]
                self.low[node], self.high[node] = np.fmin(self.low[a], self.low[b]), np.fmax(self.high[a], self.high[b])

    def home(self, v: np.ndarray) -> np.ndarray:
        """The leaf that each row falls into."""
        out, waiting = np.zeros(len(v), np.int64), [(0, np.arange(len(v)))]
        while waiting:
            node, at = waiting.pop()
            if self.dim[node] < 0:
                out[at] = self.leaf[node]
            elif len(at):
                low = v[at, self.dim[node]] <= self.cut[node]
                waiting += [(self.left[node], at[low]), (self.right[node], at[~low])]
        return out

    def _far(self, v: np.ndarray, node: int) -> np.ndarray:
        return np.sqrt((np.maximum(self.high[node] - v, v - self.low[node]) ** 2).sum(axis=1))

    def bounds(self, v: np.ndarray, home: np.ndarray, bounds: np.ndarray, k: int) -> np.ndarray:
        """Bounds where there are none: the furthest place of the smallest node above a row's leaf that holds k rows."""
        out, node_of = bounds.copy(), {leaf: node for node, leaf in enumerate(self.leaf) if leaf >= 0}
        for leaf in np.unique(home[np.isinf(bounds)]):
            node = node_of[leaf]
            while node >= 0 and self.n[node] < k:
                node = self.parent[node]
            if node >= 0:
                at = np.flatnonzero(np.isinf(bounds) & (home == leaf))
                out[at] = self._far(v[at], node)
        return out

    def near(self, v: np.ndarray, bounds: np.ndarray):
        """(leaf, rows) for every leaf with rows whose bound its box is within; ``bounds`` may shrink meanwhile."""
        waiting = [(0, np.arange(len(v)))]
        while waiting:
            node, at = waiting.pop()
            if not self.n[node] or not len(at):
                continue
            x = v[at]
            gap = np.maximum(np.maximum(self.low[node] - x, x - self.high[node]), 0.0)
            at = at[np.einsum("ij,ij->i", gap, gap) <= bounds[at] ** 2 * (1 + SLACK) + SLACK * SLACK]
            if self.dim[node] < 0:
                if len(at):
                    yield self.leaf[node], at
            else:
                waiting += [(self.right[node], at), (self.left[node], at)]


def _boxes(leaf: np.ndarray, v: np.ndarray, leaves: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of rows, least and greatest values of each leaf."""
    n = np.bincount(leaf, minlength=leaves)
    low, high = np.full((leaves, v.shape[1]), np.inf), np.full((leaves, v.shape[1]), -np.inf)
    order = np.argsort(leaf, kind="stable")
    held = np.flatnonzero(n)
    if len(held):
        starts = np.concatenate([[0], np.cumsum(n[held])[:-1]])
        low[held], high[held] = np.fmin.reduceat(v[order], starts), np.fmax.reduceat(v[order], starts)
    return n, low, high


def _batched(batches: Iterable[pa.RecordBatch], name: str) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Batches put together, with the vectors of a column as a matrix."""
    held, numbers = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            numbers += len(batch.column(name).flatten())
            if numbers >= BATCH_NUMBERS:
                table = pa.Table.from_batches(held)
                yield table, _vectors(table, name)
                held, numbers = [], 0
    if held:
        table = pa.Table.from_batches(held)
        yield table, _vectors(table, name)


def _numbers(values) -> Column:
    """A constant array of whole numbers, however many, as one expression."""
    return F.split(F.lit(",".join(str(int(x)) for x in values)), ",").cast("array<int>")


class NearestNeighbours:
    """Holds training rows prepared for search: the tree of cells, the cell of every row, cell sizes and boxes."""

    def __init__(
        self, train: DataFrame, key: str, features: str, label: str, k: int, pivots: int | None = None,
        block_rows: int | None = None, most_visits: float = MOST_VISITS,
    ):
        self.key, self.features, self.k, self.most_visits = key, features, k, most_visits
        rows = train.select(
            column(key).alias("n_key"), _as_array(train, features).alias("n_vec"),
            F.coalesce(column(label).cast("double"), F.lit(0.0)).alias("n_label"))
        # the hash goes first: arrays are slow to sort by
        same = Window.partitionBy(F.xxhash64("n_vec"), "n_vec").orderBy("n_key")
        rows = materialize(rows.withColumn("r", F.row_number().over(same)).where(F.col("r") <= k).drop("r"))
        n = rows.count()
        wanted = pivots or min(MOST_CELLS, max(LEAST_CELLS, n // ROWS_PER_CELL))
        dims = rows.select(F.size("n_vec").alias("n")).first()
        if dims is None:
            raise ValueError("no training rows")
        sample = max(1, n * max(1, dims.n) // min(SAMPLE_NUMBERS, wanted * SAMPLE_PER_CELL * max(1, dims.n)))
        first = rows.where(F.pmod(F.xxhash64("n_key", "n_vec"), F.lit(sample)) == 0).select("n_vec").toArrow()
        if not first.num_rows:
            first = rows.select("n_vec").limit(1).toArrow()
        self.cells = _Tree(_vectors(first, "n_vec"), wanted, 1)
        self.leaves = len(self.cells.members)
        self.cells.members = None
        self.block_rows = block_rows or max(1, min(BLOCK_ROWS, BLOCK_NUMBERS // max(1, dims.n)))
        self.train = materialize(spread(rows).mapInArrow(self._placing("n_vec", "cell"), T.StructType([*rows.schema.fields, T.StructField("cell", T.IntegerType())])))
        self._measure()

    def _placing(self, vectors: str, name: str):
        cells = self.cells

        def place(batches):
            for table, v in _batched(batches, vectors):
                yield from table.append_column(name, pa.array(cells.home(v).astype(np.int32))).to_batches()

        return place

    def _measure(self) -> None:
        """Boxes of the cells: made by task, then put together by cell."""
        leaves = self.leaves

        def partly(batches):
            found = None
            for table, v in _batched(batches, "n_vec"):
                n, low, high = _boxes(table.column("cell").to_numpy(), v, leaves)
                found = (n, low, high) if found is None else (found[0] + n, np.fmin(found[1], low), np.fmax(found[2], high))
            if found is not None:
                held = np.flatnonzero(found[0])
                yield pa.RecordBatch.from_pydict({
                    "cell": pa.array(held.astype(np.int32)), "n": pa.array(found[0][held]),
                    "low": pa.array(list(found[1][held]), pa.list_(pa.float64())), "high": pa.array(list(found[2][held]), pa.list_(pa.float64()))})

        def whole(table: pa.Table) -> pa.Table:
            low, high = np.fmin.reduce(_vectors(table, "low"), axis=0), np.fmax.reduce(_vectors(table, "high"), axis=0)
            return pa.table({
                "cell": table.column("cell").slice(0, 1), "n": pa.array([pc.sum(table.column("n")).as_py()], pa.int64()),
                "low": pa.array([low], pa.list_(pa.float64())), "high": pa.array([high], pa.list_(pa.float64()))})

        box = "cell int, n bigint, low array<double>, high array<double>"
        found = self.train.select("cell", "n_vec").mapInArrow(partly, box).groupBy("cell").applyInArrow(whole, box).toArrow()
        at, low, high = found.column("cell").to_numpy(), _vectors(found, "low"), _vectors(found, "high")
        self.n = np.zeros(leaves, np.int64)
        self.n[at] = found.column("n").to_numpy()
        lows, highs = np.full((leaves, low.shape[1]), np.inf), np.full((leaves, low.shape[1]), -np.inf)
        lows[at], highs[at] = low, high
        self.cells.measured(self.n, lows, highs)

    def _visiting(self):
        cells, k = self.cells, self.k

        def visited(v, home, bounds):
            found = [(leaf, at[home[at] != leaf]) for leaf, at in cells.near(v, bounds)]
            rows = np.concatenate([at for _, at in found]) if found else np.empty(0, np.int64)
            leaves = np.repeat(np.array([leaf for leaf, _ in found], np.int32), [len(at) for _, at in found])
            order = np.argsort(rows, kind="stable")  # leaves come from left to right
            offsets = np.searchsorted(rows[order], np.arange(len(v) + 1)).astype(np.int32)
            return pa.ListArray.from_arrays(pa.array(offsets), pa.array(leaves[order]))

        def visit(batches):
            for table, v in _batched(batches, "q_vec"):
                home = table.column("home").to_numpy()
                bounds = cells.bounds(v, home, table.column("bound").to_numpy(), k)
                table = table.set_column(table.column_names.index("bound"), "bound", pa.array(bounds))
                tried = np.arange(0, len(v), -(-len(v) // TRIED))
                each = sum(len(at) for _, at in cells.near(v[tried], bounds[tried])) / len(tried)
                step = max(1, int(KERNEL_CELLS / max(each, 1.0)))
                for i in range(0, len(v), step):
                    part = table.slice(i, step)
                    yield from part.append_column("cells", visited(v[i : i + step], home[i : i + step], bounds[i : i + step])).to_batches()

        return visit

    def _bundles(self) -> np.ndarray:
        """The bundle of each cell: cells beside each other in the tree, equally many."""
        return np.arange(self.leaves) // -(-self.leaves // BUNDLES)

    def neighbours(self, test: DataFrame) -> DataFrame:
        """The k nearest training rows of every test row: ``q_key, n_key, n_label, distance``.

        Equal distances are ordered by the training key.
        """
        queries = test.select(column(self.key).alias("q_key"), _as_array(test, self.features).alias("q_vec"))
        hashed = queries.withColumn("h", F.xxhash64("q_vec"))
        different = hashed.select("h", "q_vec").distinct().withColumn("q", F.monotonically_increasing_id())
        different = materialize(different.mapInArrow(self._placing("q_vec", "home"), "h bigint, q_vec array<double>, q bigint, home int"))
        infinite = F.lit(float("inf"))
        at_home = different.select("q", "q_vec", infinite.alias("bound"), F.col("home").alias("cell"))
        near = materialize(self._search(at_home, np.arange(self.leaves)))  # read twice below

        bound = near.groupBy("q").agg(F.when(F.count(F.lit(1)) >= self.k, F.max("distance")).otherwise(infinite).alias("bound"))
        bounded = different.join(bound, "q", "left").select("q", "q_vec", "home", F.coalesce("bound", infinite).alias("bound"))
        visits = materialize(bounded.mapInArrow(self._visiting(), "q bigint, q_vec array<double>, home int, bound double, cells array<int>"))
        mean = visits.agg(F.avg(F.size("cells")).alias("n")).first().n or 0
        groups = self._bundles() if mean > self.most_visits else np.arange(self.leaves)
        named = _numbers(groups)
        sent = visits.withColumn("cell", F.explode(F.array_distinct(F.transform("cells", lambda c: F.get(named, c))))).drop("cells")
        rest = self._search(sent, groups)
        found = self._keep_nearest(near.unionByName(rest), "q")
        return self._keep_nearest(hashed.join(different, ["h", "q_vec"]).select("q_key", "q").join(found, "q").drop("q"), "q_key")

    def _keep_nearest(self, found: DataFrame, of: str) -> DataFrame:
        """Merge the block results of each test row: at most k per block pair came back."""
        order = Window.partitionBy(of).orderBy("distance", "n_key")
        return found.withColumn("r", F.row_number().over(order)).where(F.col("r") <= self.k).drop("r")

    def _search(self, visits: DataFrame, groups: np.ndarray) -> DataFrame:
        """Exact k nearest rows, within the bound, of the group of cells that each row of ``visits`` names; but not of its ``home`` cell, if it has that."""
        held = np.bincount(groups, weights=self.n, minlength=len(groups)).astype(int)
        sizes = {r.cell: r.n for r in visits.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per cell at most
        n_blocks = _numbers(max(1, -(-int(n) // self.block_rows)) for n in held)
        q_blocks = _numbers(max(1, -(-sizes.get(c, 0) // self.block_rows)) for c in range(len(groups)))
        group = F.get(_numbers(groups), F.col("cell"))
        home = F.col("home") if "home" in visits.columns else F.lit(-1)
        left = visits.select(
            "cell", F.pmod(F.xxhash64("q"), F.get(q_blocks, F.col("cell")).cast("bigint")).cast("int").alias("q_block"),
            F.explode(F.sequence(F.lit(0), F.get(n_blocks, F.col("cell")) - 1)).alias("n_block"), "q", "q_vec", "bound", home.alias("home"))
        grouped = self.train.withColumn("own", F.col("cell")).withColumn("cell", group)
        # hashing the key spreads even identical rows over the blocks of a crowded cell
        right = grouped.select(
            "cell", F.explode(F.sequence(F.lit(0), F.get(q_blocks, F.col("cell")) - 1)).alias("q_block"),
            F.pmod(F.xxhash64("n_key", "n_vec"), F.get(n_blocks, F.col("cell")).cast("bigint")).cast("int").alias("n_block"), "n_key", "n_vec", "n_label", "own")
        train_key = self.train.schema["n_key"].dataType.simpleString()
        keys = ["cell", "q_block", "n_block"]
        found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
            _block_kernel(self.k), f"q bigint, n_key {train_key}, n_label double, distance double")
        return self._keep_nearest(found, "q")

    def score(self, test: DataFrame, out: str = "score") -> DataFrame:
        """Append the share of positives among the k nearest training rows."""
        shares = self.neighbours(test).groupBy("q_key").agg(F.avg("n_label").alias(out))
        return test.join(shares.withColumnRenamed("q_key", self.key), self.key, "left")


def _vectors(table: pa.Table, name: str) -> np.ndarray:
    parts = [c for c in table.column(name).chunks if len(c)]
    if any(p.null_count for p in parts):
        raise ValueError("a row has no vector")
    return np.concatenate([p.flatten().to_numpy(zero_copy_only=False).reshape(len(p), -1) for p in parts])


def _block_kernel(k: int):
    """Nearest rows of one training block for the queries of one query block."""

    def nearest(queries: pa.Table, train: pa.Table) -> pa.Table:
        train = train.take(pc.sort_indices(train, sort_keys=[("n_key", "ascending")], null_placement="at_start"))
        lines, chosen, distances = _nearest(queries, train, k) if queries.num_rows and train.num_rows else ([], [], [])
        at, of = pa.array(chosen, pa.int64()), pa.array(lines, pa.int64())
        return pa.table({
            "q": queries.column("q").take(of), "n_key": train.column("n_key").take(at), "n_label": train.column("n_label").take(at),
            "distance": pa.array(distances, pa.float64())})

    return nearest


def _nearest(queries: pa.Table, train: pa.Table, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, training row, distance) of the k nearest within the queries' bounds; the order of the training rows breaks ties.

    A tree over the training rows tells which of them to compare, unless a few queries show that it would rule out little.
    """
    t, q = _vectors(train, "n_vec"), _vectors(queries, "q_vec")
    bound, home, own = (table.column(c).to_numpy() for table, c in ((queries, "bound"), (queries, "home"), (train, "own")))
    search = _Block(t, q, bound.copy(), home if home[0] >= 0 else None, own, k)
    tree, everywhere = None, np.arange(len(q))
    if len(t) > 2 * LEAF_ROWS and len(q) > TRIED:
        tree = _Tree(t, -(-len(t) // LEAF_ROWS), k)
        leaf, leaves = np.empty(len(t), np.int64), [np.sort(at) for at in tree.members]
        for number, at in enumerate(leaves):
            leaf[at] = number
        tree.measured(*_boxes(leaf, t, len(leaves)))
        first = np.where(np.isinf(bound), tree.home(q), -1)
        order = np.argsort(first, kind="stable")
        for at in np.split(order, np.flatnonzero(np.diff(first[order])) + 1):
            if first[at[0]] >= 0:
                search.compare(at, leaves[first[at[0]]])
        tried = everywhere[:: -(-len(q) // TRIED)]
        if sum(len(at) for _, at in tree.near(q[tried], search.bound[tried])) > MOST_TRIED * len(tried) * len(leaves):
            tree = None
    if tree is None:
        search = _Block(t, q, bound.copy(), search.home, own, k)
        search.compare(everywhere, np.arange(len(t)))
    else:
        for number, at in tree.near(q, search.bound):
            search.compare(at[first[at] != number], leaves[number])
    search.gather()
    return search.found[0]


class _Block:
    """The pairs of a block that are within the bounds of their queries; bounds shrink to the k-th distance known."""

    def __init__(self, t: np.ndarray, q: np.ndarray, bound: np.ndarray, home: np.ndarray | None, own: np.ndarray, k: int):
        self.t, self.q, self.bound, self.home, self.own, self.k = t, q, bound, home, own, k
        self.found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.pairs = 0

    def compare(self, queries: np.ndarray, rows: np.ndarray) -> None:
        """All pairs of some queries and some rows, in steps of a bounded number of them.

        Candidates come from a matrix product, with an allowance for its rounding; distances from differences.
        """
        step, t = max(1, KERNEL_CELLS // len(rows)), self.t[rows]
        for start in range(0, len(queries), step):
            at = queries[start : start + step]
            square, error = _squares(self.q[at], t)
            if self.home is not None:
                square[self.home[at][:, None] == self.own[rows][None, :]] = np.inf
            limit = self.bound[at] ** 2 * (1 + SLACK) + SLACK * SLACK
            if len(rows) >= self.k and (np.isinf(limit).any() or len(rows) <= 4 * LEAF_ROWS):
                limit = np.minimum(limit, np.partition(square, self.k - 1, axis=1)[:, self.k - 1])
                self.bound[at] = np.minimum(self.bound[at], np.sqrt(np.maximum(limit, 0.0) + 4 * error))
            lines, cols = np.nonzero((square <= (limit + 4 * error)[:, None]) & (square < np.inf))
            width = max(1, CHUNK_NUMBERS // t.shape[1])
            d = [np.sqrt(((self.q[at[lines[i : i + width]]] - t[cols[i : i + width]]) ** 2).sum(axis=1)) for i in range(0, len(lines), width)]
            self.found.append((at[lines], rows[cols], np.concatenate(d) if d else np.empty(0)))
            self.pairs += len(lines)
            if self.pairs > KERNEL_CELLS:
                self.gather()

    def gather(self) -> None:
        """Keep the k nearest rows of each query."""
        lines, cols, d = (np.concatenate([f[i] for f in self.found]) for i in range(3)) if self.found else (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
        order = np.lexsort((cols, d, lines))
        lines, cols, d = lines[order], cols[order], d[order]
        rank = np.arange(len(lines)) - np.searchsorted(lines, lines)
        full = rank == self.k - 1
        self.bound[lines[full]] = np.minimum(self.bound[lines[full]], d[full])
        kept = rank < self.k
        self.found, self.pairs = [(lines[kept], cols[kept], d[kept])], 0
