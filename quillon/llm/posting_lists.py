"""Approximate nearest neighbours by largest inner product, from balanced posting lists."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillon.llm.posting_graph import CentroidGraph, as_queries, augmented, balanced_centroids, bundled
from quillon.session import Scratch, spread

LIST_ROWS = 256
MOST_LISTS = 8192
SAMPLE_ROWS = 50_000
SAMPLE_BYTES = 64 << 20
BUNDLE_LISTS = 32
BLOCK_ROWS = 8192
TRIALS = 192
TARGET = 0.96
BROADCAST_ROWS = 1_000_000
NEAREST = 20


class Index(NamedTuple):
    """What every task holds: the graph, the bundle of each list, list sizes and the distance ratio."""

    graph: CentroidGraph
    bundle: np.ndarray
    sizes: np.ndarray
    largest: float
    ratio: float


def usable(vector: Column) -> Column:
    """Neither NULL nor zero (or empty), and without NULL or non-finite components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def matrix(column: pa.Array, dtype: str) -> np.ndarray:
    """A column of binary vectors of one length as rows."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(len(column), -1) if len(column) else np.empty((0, 1), dtype)


def search(
    rows: DataFrame, scratch: Scratch, id_column: str = "vec_id", vector_column: str = "embedding", every: int = 20, nearest: int = NEAREST,
    list_rows: int = LIST_ROWS, target: float = TARGET, block_rows: int = BLOCK_ROWS, bundle_lists: int = BUNDLE_LISTS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest rows found for each query, by largest inner product.

    Queries are the rows whose id is divisible by ``every``; candidates are all rows but those of the query's id. Scores are
    exact sums in double precision; ties go to the smaller id. A query gets fewer than ``nearest`` rows only where
    there are fewer candidates.

    1. Balanced centroids are fitted on a sample of at most ``SAMPLE_ROWS`` vectors, chosen by a hash of the id.
    2. Every vector is posted in the list of its nearest centroid, boundary vectors in up to three; a graph finds
       the centroids. Copies of a vector are one entry with the smallest ids.
    3. A query selects all lists within a distance ratio of the nearest one. The ratio is the least that reaches
       ``target`` of the true neighbours of ``TRIALS`` queries, which are compared with all vectors.
    4. Neighbouring lists are bundled, and bundles and their queries cut into blocks; a task scores the queries of
       a block on the lists they selected, and the best of all blocks are merged.

    Vectors that are NULL, zero or empty, or that hold NULL or non-finite components, and rows with a NULL id
    take no part. Vectors are compared with those of their own length only. Rows that repeat id and vector
    count once; of an id with several vectors each is a query and a candidate (for other ids). An empty table gives an
    empty result. Other columns are not looked at.
    """
    kind = rows.schema[vector_column].dataType
    double = not (isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType))
    vector = F.col(f"`{vector_column}`").cast("array<double>" if double else "array<float>")
    named = rows.select(F.col(f"`{id_column}`").cast("bigint").alias("vec_id"), vector.alias("v"))
    good = named.where(F.col("vec_id").isNotNull() & usable(F.col("v")))
    largest = F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    lengths = good.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n"), F.sqrt(largest).alias("largest")).collect()
    dtype = "<f8" if double else "<f4"
    out = None
    for r in sorted(lengths):
        part = _search_length(good.where(F.size("v") == r["d"]), scratch, dtype, r, every, nearest, list_rows, target, block_rows, bundle_lists)
        out = part if out is None else out.unionByName(part)
    if out is None:
        return rows.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    return out


def _search_length(
    good: DataFrame, scratch: Scratch, dtype: str, found: T.Row, every: int, nearest: int, list_rows: int, target: float, block_rows: int, bundle_lists: int,
) -> DataFrame:
    spark, n, largest = good.sparkSession, found["n"], found["largest"]
    named = spread(good).mapInArrow(_digests(dtype), "vec_id bigint, key binary, vector binary")
    once = scratch.keep(named.select("vec_id", "key").distinct())
    asked = F.col("vec_id") % every == 0
    same = once.groupBy("vec_id").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0]
    wanted = nearest + same  # some of which may be the query's own
    copies = scratch.keep(_copies(once, asked, wanted, scratch))
    small = F.broadcast(copies) if copies.count() * wanted <= BROADCAST_ROWS else copies
    # a vector that has copies stands under its smallest id
    entries = named.distinct() if once.count() < n else named
    merged = entries.join(small, "key", "left").where(F.col("ids").isNull() | (F.col("vec_id") == F.col("ids")[0]))
    entries = merged.select(
        "key", "vector", F.coalesce("ids", F.array("vec_id")).alias("ids"), F.coalesce("asked", asked).alias("asked"))
    index = _fit(good, dtype, n, largest, list_rows, bundle_lists)
    sent = spark.sparkContext.broadcast(index)  # at most MOST_LISTS centroids and their links
    posted = scratch.keep(entries.mapInArrow(_post(sent, dtype), "key binary, vector binary, ids array<bigint>, asked boolean, lists array<int>, bundles array<int>"))
    sizes = np.zeros(len(index.graph), dtype=np.int64)
    for r in posted.select(F.explode("lists").alias("list")).groupBy("list").agg(F.count("*").alias("n")).collect():
        sizes[r["list"]] = r["n"]
    index = index._replace(sizes=sizes, ratio=_ratio(posted, index, dtype, nearest, target))
    sent = spark.sparkContext.broadcast(index)
    queries = posted.where("asked").select("key", "vector")
    probes = scratch.keep(spread(queries).mapInArrow(_probe(sent, dtype, wanted), "bundle int, key binary, vector binary, lists array<int>"))
    answers = _answers(posted, probes, index, dtype, wanted, block_rows)
    told = once.where(asked).join(answers, "key").select(F.col("vec_id").alias("query_id"), F.filter("found", lambda e: e["id"] != F.col("vec_id")).alias("found"))
    listed = told.select("query_id", F.posexplode(F.slice("found", 1, nearest)).alias("rank", "e"))
    return listed.select("query_id", (F.col("rank") + 1).alias("rank"), F.col("e.id").alias("vec_id"), (-F.col("e.s")).alias("score"))


def _copies(once: DataFrame, asked: Column, wanted: int, scratch: Scratch) -> DataFrame:
    """Per vector with copies: its ``wanted`` smallest ids, ascending, and whether any of its ids is a query.

    Rows beyond the smallest of their task's copies end before the shuffle, so a vector that a third of
    all rows hold is no large group.
    """
    many = scratch.keep(once.groupBy("key").agg(F.count("*").alias("n"), F.bool_or(asked).alias("asked")).where("n > 1").select("key", "asked"))
    ranked = once.join(F.broadcast(many) if many.count() <= BROADCAST_ROWS else many, "key").withColumn("rank", F.row_number().over(Window.partitionBy("key").orderBy("vec_id")))
    return ranked.where(F.col("rank") <= wanted).groupBy("key").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"), F.first("asked").alias("asked"))


def _digests(dtype: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Vectors as bytes, with their digest (minus zero as zero)."""

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("v")
            flat = np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype) + 0
            rows = [r.tobytes() for r in flat.reshape(len(column), -1)]
            keys = [hashlib.blake2b(r, digest_size=16).digest() for r in rows]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(keys, pa.binary()), pa.array(rows, pa.binary())], ["vec_id", "key", "vector"])

    return digests


def _fit(good: DataFrame, dtype: str, n: int, largest: float, list_rows: int, bundle_lists: int) -> Index:
    """Centroids from about ``SAMPLE_ROWS`` vectors (twice as many at most, and fewer where vectors are long)."""
    width = len(good.select("v").first()["v"])
    limit = max(1, min(SAMPLE_ROWS, SAMPLE_BYTES // (8 * width)))
    chance = F.pmod(F.xxhash64("vec_id"), F.lit(1 << 31)) < int(min(1.0, limit / n) * (1 << 31))
    sample = good.where(chance).select("vec_id", "v").limit(2 * limit).toPandas().sort_values("vec_id", kind="stable")
    if not len(sample):
        sample = good.limit(1).toPandas()
    points = np.unique(augmented(np.stack(sample["v"].to_list()), largest), axis=0)
    centroids = balanced_centroids(points, max(1, min(MOST_LISTS, -(-n // list_rows), -(-len(points) // 4))))
    graph = CentroidGraph(centroids)
    return Index(graph, bundled(centroids, bundle_lists), np.zeros(len(graph), np.int64), largest, 1.0)


def _post(sent, dtype: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: Index = sent.value
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                ids, used = index.graph.lists(augmented(matrix(batch.column("vector"), dtype), index.largest))
                ends = pa.array(np.concatenate([[0], np.cumsum(used.sum(axis=1))]), pa.int32())
                lists, bundles = (pa.ListArray.from_arrays(ends, pa.array(x, pa.int32())) for x in (ids[used], index.bundle[ids[used]]))
                yield pa.RecordBatch.from_arrays([*batch.columns, lists, bundles], ["key", "vector", "ids", "asked", "lists", "bundles"])

    return post


def _probe(sent, dtype: str, wanted: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """One row per query and bundle, with the lists selected there."""

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: Index = sent.value
        step = max(1, (1 << 22) // len(index.graph))
        for whole in batches:
            for at in range(0, whole.num_rows, step):
                batch = whole.slice(at, step)
                # an entry is in three lists at most, so these hold enough different ones
                chosen = index.graph.within(as_queries(matrix(batch.column("vector"), dtype)), index.ratio, index.sizes, 3 * wanted)
                row, where = np.nonzero(chosen)
                order = np.lexsort((where, index.bundle[where], row))
                row, where = row[order], where[order]
                bundle = index.bundle[where]
                first = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (bundle[1:] != bundle[:-1])])) if len(row) else np.empty(0, np.int64)
                lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(row)), pa.int32()), pa.array(where, pa.int32()))
                rows = batch.take(pa.array(row[first]))
                yield pa.RecordBatch.from_arrays([pa.array(bundle[first], pa.int32()), *rows.columns, lists], ["bundle", "key", "vector", "lists"])

    return probe


def _ratio(posted: DataFrame, index: Index, dtype: str, nearest: int, target: float) -> float:
    """The least distance ratio whose lists hold ``target`` of the true neighbours of up to ``TRIALS`` queries."""
    trials = posted.where("asked").select("key", "vector").orderBy(F.xxhash64("key"), "key").limit(TRIALS).toPandas()
    if not len(trials):
        return 1.0
    spark, keys = posted.sparkSession, trials["key"].map(bytes).to_list()
    wide = np.stack([np.frombuffer(v, dtype) for v in trials["vector"]]).astype(np.float64)
    sent = spark.sparkContext.broadcast((keys, wide))  # TRIALS vectors

    def true(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, wide = sent.value
        for batch in batches:
            scores = wide @ matrix(batch.column("vector"), dtype).astype(np.float64).T
            own = {k: i for i, k in enumerate(batch.column("key").to_pylist())}
            for i, k in enumerate(keys):
                if k in own:
                    scores[i, own[k]] = -np.inf
            some = min(nearest, scores.shape[1])
            best = np.argpartition(-scores, some - 1, axis=1)[:, :some]
            row = np.repeat(np.arange(len(keys)), some)
            yield pa.RecordBatch.from_arrays(
                [pa.array(row, pa.int32()), pa.array(scores[row, best.ravel()], pa.float64()), batch.column("vector").take(pa.array(best.ravel()))], ["q", "s", "vector"])

    found = posted.select("key", "vector").mapInArrow(true, "q int, s double, vector binary")
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("s"), "vector"))).where((F.col("rank") <= nearest) & (F.col("s") > -float("inf")))
    best = ranked.select("q", "vector").toPandas()  # TRIALS * nearest vectors at most
    if not len(best):
        return 1.0
    points = as_queries(wide)
    _, near = index.graph.nearest(points)
    ids, used = index.graph.lists(augmented(np.stack([np.frombuffer(v, dtype) for v in best["vector"]]), index.largest))
    q = best["q"].to_numpy()
    far = index.graph._distances(points[q], (points[q] ** 2).sum(axis=1), ids)
    needed = np.where(used, far, np.inf).min(axis=1) / np.maximum(near[q, 0], 1e-12)
    return float(np.sqrt(np.maximum(1.0, np.quantile(needed, target, method="higher")))) * (1 + 1e-6)


def _answers(posted: DataFrame, probes: DataFrame, index: Index, dtype: str, wanted: int, block_rows: int) -> DataFrame:
    """(key, found): per query the best ids with their negative scores, ascending, from all blocks of all bundles."""
    bundles = int(index.bundle.max()) + 1
    held = np.bincount(index.bundle, index.sizes, bundles).astype(np.int64)
    asked = {r["bundle"]: r["n"] for r in probes.groupBy("bundle").agg(F.count("*").alias("n")).collect()}
    blocks = posted.sparkSession.createDataFrame(
        [(b, int(-(-held[b] // block_rows) or 1), -(-n // block_rows)) for b, n in sorted(asked.items())], "bundle int, vs int, qs int")
    here = F.broadcast(blocks)  # a row a bundle
    own = F.filter("lists", lambda x, i: F.get("bundles", i) == F.col("bundle"))
    vectors = posted.select("key", "vector", "ids", "lists", "bundles", F.explode(F.array_distinct("bundles")).alias("bundle")).withColumn("lists", own)
    vectors = vectors.join(here, "bundle").withColumn("vb", F.pmod(F.xxhash64("key"), F.col("vs")).cast("int")).withColumn(
        "qb", F.explode(F.sequence(F.lit(0), F.col("qs") - 1)))
    queries = probes.withColumn("ids", F.lit(None).cast("array<bigint>")).join(here, "bundle").withColumn(
        "qb", F.pmod(F.xxhash64("key", F.lit(1)), F.col("qs")).cast("int")).withColumn("vb", F.explode(F.sequence(F.lit(0), F.col("vs") - 1)))
    columns = ["bundle", "vb", "qb", "key", "vector", "ids", "lists"]
    groups = vectors.select(*columns).unionByName(queries.select(*columns)).groupBy("bundle", "vb", "qb")
    scored = groups.applyInArrow(_score(dtype, wanted), "key binary, found array<struct<s:double,id:bigint>>")
    merged = scored.groupBy("key").agg(F.flatten(F.collect_list("found")).alias("found"))
    return merged.select("key", F.slice(F.array_sort(F.array_distinct("found")), 1, wanted).alias("found"))


def _leading(group: np.ndarray, most: int) -> np.ndarray:
    """Which of the rows, sorted by group, are among the first ``most`` of their group."""
    first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    return np.arange(len(group)) - np.repeat(first, np.diff(np.append(first, len(group)))) < most


def _score(dtype: str, wanted: int, step: int = 512) -> Callable[[pa.Table], pa.Table]:
    """The best ``wanted`` ids of one block of vectors for each query of one block, on the lists it selected."""
    schema = pa.schema([("key", pa.binary()), ("found", pa.list_(pa.struct([("s", pa.float64()), ("id", pa.int64())])))])

    def score(block: pa.Table) -> pa.Table:
        block = block.combine_chunks()
        query = block.column("ids").is_null().to_numpy()
        if query.all() or not query.any():
            return schema.empty_table()
        asks, holds = block.filter(pa.array(query)), block.filter(pa.array(~query))
        holds = holds.take(pa.array(np.argsort([x[0].as_py() for x in holds.column("ids")], kind="stable")))
        wide, vectors = (matrix(t.column("vector"), dtype).astype(np.float64) for t in (asks, holds))
        length = np.sqrt((vectors**2).sum(axis=1).max())
        ids = holds.column("ids").combine_chunks()
        many, start, flat = np.diff(ids.offsets.to_numpy()), ids.offsets.to_numpy()[:-1], ids.values.to_numpy()
        sides = []
        for side in (asks, holds):
            lists = side.column("lists").combine_chunks()
            row = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
            of = lists.flatten().to_numpy()
            order = np.argsort(of, kind="stable")
            names, first = np.unique(of[order], return_index=True)
            sides.append(dict(zip(names.tolist(), np.split(row[order], first[1:]), strict=True)))
        members = {x: (q, sides[1][x]) for x, q in sides[0].items() if x in sides[1]}
        keys, found = [], []
        for at in range(0, len(wide), step):
            part = wide[at : at + step]
            scores = np.full((len(part), len(vectors)), -np.inf)
            for q, v in members.values():
                inside = q[(q >= at) & (q < at + step)] - at
                if len(inside):
                    scores[np.ix_(inside, v)] = part[inside] @ vectors[v].T
            some = min(wanted, len(vectors))
            least = -np.partition(-scores, some - 1, axis=1)[:, some - 1]
            least = least - 1e-12 * length * np.sqrt((part**2).sum(axis=1))  # sums in another order may differ so much
            row, col = np.nonzero((scores >= least[:, None]) & (scores > -np.inf))
            exact = np.concatenate([-(part[r] * vectors[c]).cumsum(axis=1)[:, -1] for r, c in _parts(row, col)] or [np.empty(0)])
            order = np.lexsort((col, exact, row))  # vectors lie by their smallest id
            order = order[_leading(row[order], wanted)] if len(order) else order
            row, col, exact = row[order], col[order], exact[order]
            each = np.repeat(np.arange(len(row)), many[col])
            names = flat[np.repeat(start[col], many[col]) + np.arange(len(each)) - np.repeat(np.cumsum(many[col]) - many[col], many[col])]
            order = np.lexsort((names, exact[each], row[each]))
            order = order[_leading(row[each][order], wanted)] if len(order) else order
            row, exact, names = row[each][order], exact[each][order], names[order]
            counts = np.bincount(row, minlength=len(part))
            told = pa.StructArray.from_arrays([pa.array(exact, pa.float64()), pa.array(names, pa.int64())], ["s", "id"])
            found.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), told))
            keys.append(asks.column("key").combine_chunks().slice(at, len(part)))
        return pa.table({"key": pa.chunked_array(keys), "found": pa.chunked_array(found)}).cast(schema)

    return score


def _parts(row: np.ndarray, col: np.ndarray, most: int = 1 << 15) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for at in range(0, len(row), most):
        yield row[at : at + most], col[at : at + most]
