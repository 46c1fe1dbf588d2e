"""The n-gram Jaccard join of a corpus with itself, by signature trees over blocks of documents."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillon.llm.components import components
from quillon.llm.signature_tree import Router, digest, linked, links, packed, promising, shingles, sketch, unpacked
from quillon.llm.turns import small
from quillon.session import Scratch, spread

SHINGLE = 4
PERCENT = 85
SAMPLED = 64
HOT_IN_SAMPLE = 16
HOT_KEYS = 10_000
COMMON = 32
CHUNK_SHINGLES = 400_000
SLICE_ROWS = 256  # rows described at once: a batch of keys is some hundred times as long as its input
PASSES = 4  # over the size classes of keys
BUNDLE_KEYS = 1 << 19  # keys that a task bundles at once
BUCKET_KEYS = 1 << 17  # keys of a bucket, about
PLANES = {"key": 6, "class": 8, "size": 4, "spare": 4, "n": 4}  # bytes of each value in a bundle


def near_duplicates(
    docs: DataFrame, scratch: Scratch, id_column: str = "doc_id", text_column: str = "text", shingle: int = SHINGLE, percent: int = PERCENT,
    chunk_shingles: int = CHUNK_SHINGLES,
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest doc_id reachable by links, itself included).

    A document's set holds its distinct runs of ``shingle`` words (all its words as one run, if fewer). Two
    documents are linked when 100 * |intersection| >= ``percent`` * |union|.

    1. Documents with equal sets are one class, so copies cost one row each.
    2. A class is routed under its pigeonhole keys (``Router``): two linked classes share one at least. The
       smallest class under a key leads it, and the classes led by one form a block; that is all rows of
       a key that ever meet. Keys found hot in a sample take a leader beforehand and skip the shuffle.
       The others are shuffled in bundles, some size classes after the others (keys of two of them never meet).
    3. A block all of whose classes are also in the block of the leader that its own leader shares most keys with is
       left out: all its pairs meet there. Of the many blocks that near copies of one text form, few are left.
    4. Of a block, sketches of the sets go first (``sketch``): sets that differ too much from all others there, as their
       sketches prove, are not sent to it. In a block a signature tree over the other sets is traversed against itself and
       pairs are verified (``links``); pairs that are connected already are passed over. In a block of more than ``chunk_shingles`` shingles all classes are first
       compared with the leader alone. Those that are not connected by that meet each other and the rest, in chunks; the
       rest don't meet again, so a large block of near copies costs one comparison each.
    5. Components of the links give each document its smallest partner.

    Sets are counted and told apart by 64-bit hashes of their shingles, and compared by the upper 48 bits of these. NULL, empty and white texts have no shingles and no
    links. A NULL id is never the smallest unless all in a component are NULL. Rows that repeat an id and text
    are copies like others; other columns are not looked at. An empty table gives an empty result.
    """
    id_type = docs.schema[id_column].dataType
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    known = scratch.keep(spread(rows).mapInArrow(_describe(shingle), T.StructType([
        T.StructField("doc_id", id_type), T.StructField("n_shingles", T.LongType()), T.StructField("set", T.BinaryType())])))
    distinct = known.where("n_shingles > 0").groupBy("set").agg(F.min("doc_id").alias("first"), F.first("n_shingles").alias("n"))
    classes = scratch.keep(distinct.withColumn("class", F.monotonically_increasing_id()))  # a number has fewer bytes to shuffle than a hash
    sets = _sets_of(rows, classes, scratch, shingle)
    work = Scratch(scratch.spark)
    pairs = _unique_blocks(_blocks(sets, work, percent), scratch)
    work.clear()  # the keys' shuffle files are as large as the texts
    placed = _sized(sets, pairs, scratch, chunk_shingles)
    near = _leader_links(sets, placed.where("large"), scratch, percent, chunk_shingles)
    found = near.unionByName(_tree_links(sets, placed, near, scratch, percent, chunk_shingles))
    labels = components(found, scratch)
    joined = classes.join(labels, classes["set"] == labels["node"])
    smallest = joined.groupBy("label").agg(F.min("first").alias("component_id"))
    resolved = scratch.keep(joined.join(smallest, "label").select("set", "component_id"))
    ids = scratch.keep(classes.join(resolved, "set", "left").select("set", F.coalesce("component_id", "first").alias("component_id")))
    return known.select("doc_id", "n_shingles", "set").join(ids, "set", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def _sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(start, SLICE_ROWS)


def _describe(shingle: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Size and digest of each document's set."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _sliced(batches):
            sizes, sets = [], []
            for text in batch.column("text"):
                hashes = shingles(text.as_py(), shingle)
                sizes.append(len(hashes))
                sets.append(digest(hashes) if len(hashes) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(sets, pa.binary())], ["doc_id", "n_shingles", "set"])

    return describe


def _keys(percent: int, only: Callable[[int], bool] | None = None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The routing keys of each class, one a row, with their size class, how many of that the class can do without, and its size.

    ``only`` says of a size class, by its first size, whether its keys are wanted.
    """

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        router = Router(percent)
        for batch in _sliced(batches):
            sets = [unpacked(h.as_py()) for h in batch.column("hashes")]
            found = [router.marked_keys(h, only) for h in sets]
            of = np.repeat(np.arange(batch.num_rows), [len(k) for k, _, _ in found])
            columns = [np.concatenate([f[i] for f in found]) if found else np.empty(0) for i in range(3)]
            # 48 bits of a key: another key of the same ones only adds comparisons
            names = (columns[0].astype(np.uint64) >> np.uint64(16)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("class").take(pa.array(of)), pa.array(names, pa.int64()), pa.array(columns[1].astype(np.int32)), pa.array(columns[2].astype(np.int32)),
                 pa.array(np.array([len(h) for h in sets], np.int32)).take(pa.array(of))],
                ["class", "key", "size", "spare", "n"])

    return keys


def _hot(percent: int, hot: np.ndarray, leaders: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(leader, class, size, spare, keys) of each class: how many of its keys are among the ``hot`` ones (sorted), by their leader and size class.

    A large group of near copies shares most of its keys, which few classes lead: a class is a few rows, however many keys it has.
    """

    def led(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _keys(percent)(batches):
            key = batch.column("key").to_numpy()
            at = np.minimum(np.searchsorted(hot, key), len(hot) - 1)
            own = np.flatnonzero(hot[at] == key)
            rows = np.stack([leaders[at[own]], *(batch.column(c).to_numpy()[own].astype(np.int64) for c in ("class", "size", "spare"))])
            found, keys = np.unique(rows, axis=1, return_counts=True)
            leader, name, size, spare = found
            yield pa.RecordBatch.from_arrays(
                [pa.array(leader), pa.array(name), pa.array(size.astype(np.int32)), pa.array(spare.astype(np.int32)), pa.array(keys.astype(np.int64))],
                ["leader", "class", "size", "spare", "keys"])

    return led


def _blocks(sets: DataFrame, scratch: Scratch, percent: int) -> DataFrame:
    """(leader, class, shared): every two classes that can be linked are together in a leader's block; how many keys led there.

    Under a key, a class meets no other unless the next smaller or the next larger one there is near enough in size.
    A key of more than ``COMMON`` classes, as a passage makes it that many texts hold, is left out by every class that
    has enough others. Linked classes that both leave it out share another key. A leader stands in its own block.
    """
    schema = "class bigint, key bigint, size int, spare int, n int"
    sampled = sets.where(F.pmod(F.xxhash64("class"), F.lit(SAMPLED)) == 0).select("class", "hashes").mapInArrow(_keys(percent), schema)
    counted = sampled.groupBy("key").agg(F.count("*").alias("n"), F.min("class").alias("leader"))
    # at most HOT_KEYS rows; a key that is missed here is only slower
    hot = scratch.keep(counted.where(F.col("n") >= HOT_IN_SAMPLE).orderBy(F.desc("n"), "key").limit(HOT_KEYS).select("key", "leader"))
    known, leaders = np.array(sorted((r["key"], r["leader"]) for r in hot.collect()), np.int64).reshape(-1, 2).T
    total = sets.agg(F.sum("n").alias("n"), F.max("n").alias("most")).first()
    met = []
    for turn in range(PASSES):
        met.append(scratch.keep(_met(sets, percent, turn, known, total["n"] or 0, total["most"] or 0)).withColumn("keys", F.lit(1).cast("bigint")))
        Scratch(scratch.spark).clear()  # of the shuffle files of this pass
    if len(known):
        led = sets.select("class", "hashes").mapInArrow(_hot(percent, known, leaders), "leader bigint, class bigint, size int, spare int, keys bigint")
        met.append(scratch.keep(led.withColumn("common", F.lit(True))))
    met = reduce(DataFrame.unionByName, met)
    many = met.where("common").groupBy("class", "size").agg(F.sum("keys").alias("k"), F.first("spare").alias("spare"))
    freed = many.where("k <= spare").select("class", "size", F.lit(True).alias("freed"))
    kept = met.where("NOT common").select("leader", "class", "keys").unionByName(
        met.where("common").join(freed, ["class", "size"], "left").where("freed IS NULL").select("leader", "class", "keys"))
    counts = scratch.keep(kept.where(F.col("leader") != F.col("class")).groupBy("leader", "class").agg(F.sum("keys").alias("shared")))
    return counts.unionByName(counts.select("leader", F.col("leader").alias("class"), F.lit(0).cast("bigint").alias("shared")).distinct())


def _met(sets: DataFrame, percent: int, turn: int, hot: np.ndarray, shingles_in_all: int, most: int) -> DataFrame:
    """(leader, class, size, spare, common) of the classes that meet under the keys of the size classes of this ``turn``, but not under ``hot`` ones."""
    firsts = Router(percent).ranges(most)[turn::PASSES]
    sizes = reduce(Column.__or__, [F.col("n").between(first, last * 100 // percent) for first, last in firsts], F.lit(False))
    # a shingle makes half a key or less
    buckets = int(min(1 << 31, max(1, shingles_in_all // (2 * PASSES * BUCKET_KEYS))))
    wanted = frozenset(first for first, _ in firsts)
    bundles = sets.where(sizes).select("class", "hashes").mapInArrow(_bundles(percent, wanted, buckets, hot), f"bucket bigint, {', '.join(f'`{c}` binary' for c in PLANES)}")
    return bundles.groupBy("bucket").applyInArrow(_led(percent), "leader bigint, class bigint, size int, spare int, common boolean")


def _bundles(percent: int, wanted: frozenset[int], buckets: int, hot: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The keys of ``_keys`` but the hot ones, sorted, those of a bucket in one row: a binary per column, in which the first bytes of all values come first.

    A shuffle packs such columns well, as most upper bytes are equal; a row per key would take twice as many bytes, and the more the
    more parts it is dealt to.
    """

    def bundled(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        columns = {c: np.concatenate([b.column(c).to_numpy() for b in parts]) for c in PLANES}
        if len(hot):
            at = np.minimum(np.searchsorted(hot, columns["key"]), len(hot) - 1)
            cold = hot[at] != columns["key"]
            columns = {c: v[cold] for c, v in columns.items()}
        order = np.argsort(columns["key"])
        columns = {c: v[order] for c, v in columns.items()}
        bucket = ((columns["key"].astype(np.uint64) >> np.uint64(16)) * np.uint64(buckets)) >> np.uint64(32)
        names, starts = np.unique(bucket, return_index=True)
        ends = [*starts[1:], len(bucket)]
        packs = [pa.array([_planes(v[a:b], PLANES[c]) for a, b in zip(starts, ends, strict=True)] if len(bucket) else [], pa.binary()) for c, v in columns.items()]
        return pa.RecordBatch.from_arrays([pa.array(names.astype(np.int64)), *packs], ["bucket", *columns])

    def bundles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in _keys(percent, wanted.__contains__)(batches):
            held.append(batch)
            n += batch.num_rows
            if n >= BUNDLE_KEYS:
                yield bundled(held)
                held, n = [], 0
        if held:
            yield bundled(held)

    return bundles


def _planes(values: np.ndarray, width: int) -> bytes:
    """The lowest ``width`` bytes of each value: first the highest of all, then the next of all."""
    return np.ascontiguousarray(values.astype(">i8").view(np.uint8).reshape(-1, 8)[:, 8 - width :].T).tobytes()


def _values(data: bytes, width: int) -> np.ndarray:
    """Values from ``_planes``; those of fewer than six bytes may be negative."""
    rows = np.frombuffer(data, np.uint8).reshape(width, -1)
    wide = np.zeros((rows.shape[1], 8), np.uint8)
    wide[:, 8 - width :] = rows.T
    found = wide.view(">i8").ravel().astype(np.int64)
    return found.astype(np.int32).astype(np.int64) if width == 4 else found


def _led(percent: int) -> Callable[[pa.Table], pa.Table]:
    """The rows of a bucket whose key another class has too, one near enough in size next to them, with the key's smallest class."""

    def led(bucket: pa.Table) -> pa.Table:
        def values(c: str) -> np.ndarray:
            return np.concatenate([_values(v, PLANES[c]) for v in bucket.column(c).to_pylist()])

        key = values("key")
        order = np.argsort(key)
        same = key[order[1:]] == key[order[:-1]]
        order = order[np.concatenate([same, [False]]) | np.concatenate([[False], same])]
        key, size, spare, n, name = key[order], *(values(c)[order] for c in ("size", "spare", "n", "class"))
        order = np.lexsort((n, key))
        key, size, spare, n, name = (v[order] for v in (key, size, spare, n, name))
        same = key[1:] == key[:-1]
        near = same & (100 * n[:-1] >= percent * n[1:])
        alike = np.concatenate([near, [False]]) | np.concatenate([[False], near]) if len(key) else np.empty(0, bool)
        starts = np.flatnonzero(np.concatenate([[True], ~same])) if len(key) else np.empty(0, np.int64)
        held = np.diff(np.concatenate([starts, [len(key)]])) if len(key) else np.empty(0, np.int64)
        leader, last = (np.repeat(f.reduceat(name, starts), held) if len(key) else name for f in (np.minimum, np.maximum))
        keep = alike & (leader < last)
        return pa.table({
            "leader": leader[keep], "class": name[keep], "size": size[keep].astype(np.int32), "spare": spare[keep].astype(np.int32),
            "common": np.repeat(held, held)[keep] > COMMON})

    return led


def _sets_of(rows: DataFrame, classes: DataFrame, scratch: Scratch, shingle: int) -> DataFrame:
    """(class, set, n, hashes, sketch) of each class, from its first document."""
    few = small(classes.select("first", "set", "class", "n"))
    texts = rows.join(few, rows["doc_id"].eqNullSafe(few["first"])).select("set", "class", "n", "text")
    found = scratch.keep(texts.mapInArrow(_sets(shingle), "class bigint, set binary, n bigint, hashes binary, sketch binary"))
    # rows that repeat an id and text give their set again
    return found if found.count() == classes.count() else scratch.keep(found.dropDuplicates(["set"]))


def _unique_blocks(pairs: DataFrame, scratch: Scratch) -> DataFrame:
    """``pairs`` (leader, class) without the blocks that lie within the block of a smaller leader."""
    above = scratch.keep(pairs.where("leader < class").groupBy(F.col("class").alias("leader")).agg(
        F.max_by("leader", F.struct("shared", "leader")).alias("above")))
    looked = pairs.select("leader", "class").join(small(above), "leader")
    there = pairs.select(F.col("leader").alias("above"), "class", F.lit(1).alias("there"))
    within = looked.join(there, ["above", "class"], "left").groupBy("leader").agg(F.count("*").alias("n"), F.count("there").alias("k")).where("n = k")
    gone = scratch.keep(within.select("leader"))
    return scratch.keep(pairs.select("leader", "class").join(small(gone), "leader", "left_anti"))


def _sized(sets: DataFrame, pairs: DataFrame, scratch: Scratch, chunk_shingles: int) -> DataFrame:
    """``pairs`` with the set's size ``n``, and whether the block is ``large``."""
    rows = scratch.keep(pairs.join(sets.select("class", "n").distinct(), "class"))
    large = scratch.keep(rows.groupBy("leader").agg(F.sum("n").alias("total")).where(F.col("total") > chunk_shingles).select("leader", F.lit(True).alias("large")))
    return rows.join(small(large), "leader", "left").withColumn("large", F.coalesce("large", F.lit(False)))


def _leader_links(sets: DataFrame, members: DataFrame, scratch: Scratch, percent: int, chunk_shingles: int) -> DataFrame:
    """Links (a, b) between the sets of the classes and leaders of ``members`` (leader, class, n)."""
    sizes = scratch.keep(members.groupBy("leader").agg(F.ceil(F.sum("n") / chunk_shingles).cast("int").alias("chunks")))
    dealt = members.where("leader <> class").join(small(sizes), "leader").select(
        "leader", "class", F.pmod(F.xxhash64("class"), F.col("chunks")).cast("int").alias("chunk"), F.lit(False).alias("leads"))
    heads = sizes.select("leader", F.col("leader").alias("class"), F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), F.lit(True).alias("leads"))
    sent = scratch.keep(dealt.unionByName(heads))
    rows = sets.select("class", "set", "hashes").join(small(sent), "class")
    return scratch.keep(rows.groupBy("leader", "chunk").applyInArrow(_join_leader(percent), "a binary, b binary"))


def _join_leader(percent: int) -> Callable[[pa.Table], pa.Table]:
    def join(block: pa.Table) -> pa.Table:
        leads, names, hashes = (block.column(c).to_pylist() for c in ("leads", "set", "hashes"))
        head = leads.index(True)
        first = unpacked(hashes[head])
        found = [n for n, h, l in zip(names, hashes, leads, strict=True) if not l and linked(first, unpacked(h), percent)]
        return pa.table({"a": pa.array([names[head]] * len(found), pa.binary()), "b": pa.array(found, pa.binary())})

    return join


def _tree_links(sets: DataFrame, pairs: DataFrame, near: DataFrame, scratch: Scratch, percent: int, chunk_shingles: int) -> DataFrame:
    """Links (a, b) between set digests that, with those to the leaders, connect all classes a chain of links connects."""
    labels = components(near, scratch)
    named = sets.select("class", "set").join(labels, F.col("set") == labels["node"], "left").select("class", F.coalesce("label", "set").alias("label"))
    placed = scratch.keep(pairs.join(named, "class"))
    own = F.max(F.when(F.col("class") == F.col("leader"), F.col("label")))
    blocks = placed.groupBy("leader").agg(own.alias("core"), F.min("label").alias("least"), F.max("label").alias("most"))
    mixed = scratch.keep(blocks.where("least <> most").select("leader", "core"))
    inside = placed.join(small(mixed), "leader").withColumn("apart", F.col("label") != F.col("core"))
    sizes = inside.groupBy("leader").agg(F.sum("n").alias("total"), F.sum(F.when(F.col("apart"), F.col("n")).otherwise(0)).alias("rest"))
    # a table of its own, so that the join may split a block that a third of the classes share
    sizes = scratch.keep(sizes.select(
        "leader", (F.col("total") <= chunk_shingles).alias("whole"), F.greatest(F.ceil(F.col("rest") / chunk_shingles), F.lit(1)).cast("int").alias("rests"),
        F.greatest(F.ceil((F.col("total") - F.col("rest")) / chunk_shingles), F.lit(1)).cast("int").alias("cores")))
    dealt = inside.join(small(sizes), "leader")
    hashed = F.xxhash64("class")
    r, c = F.pmod(hashed, F.col("rests")).cast("int"), F.pmod(hashed, F.col("cores")).cast("int")
    rests, cores = F.sequence(F.lit(0), F.col("rests") - 1), F.sequence(F.lit(0), F.col("cores") - 1)
    task = "struct<i:int,j:int>"
    # chunks of those connected with the leader have the numbers -1, -2 ...
    of_rest = F.concat(
        F.transform(rests, lambda x: F.struct(F.least(x, r).alias("i"), F.greatest(x, r).alias("j")).cast(task)),
        F.transform(cores, lambda x: F.struct(r.alias("i"), (-1 - x).alias("j")).cast(task)))
    of_core = F.transform(rests, lambda x: F.struct(x.alias("i"), (-1 - c).alias("j")).cast(task))
    one = F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j")).cast(task))
    tasks = F.when(F.col("whole"), one).when(F.col("apart"), of_rest).otherwise(of_core)
    chunk = F.when(F.col("whole"), 0).when(F.col("apart"), r).otherwise(-1 - c)
    sent = dealt.select("leader", "class", "label", chunk.alias("chunk"), F.explode(tasks).alias("task")).select("leader", "class", "label", "chunk", "task.i", "task.j")
    sketched = sets.select("class", "n", "sketch").join(small(scratch.keep(sent)), "class")
    # most classes of a block share but a passage with its others: a sketch is a 24th of a set at most, or 64 bits
    wanted = sketched.groupBy("leader", "i", "j").applyInArrow(_near_sketches(percent), sent.schema)
    found = sets.select("class", "set", "hashes").join(small(scratch.keep(wanted)), "class").groupBy("leader", "i", "j").applyInArrow(_join_block(percent), "a binary, b binary")
    return scratch.keep(found.distinct())


def _near_sketches(percent: int) -> Callable[[pa.Table], pa.Table]:
    """The rows of a block whose sets another one may be linked with that is not connected with them yet."""

    def near(block: pa.Table) -> pa.Table:
        own = block.select(["leader", "class", "label", "chunk", "i", "j"])
        _, label = np.unique(np.array(block.column("label").to_pylist(), dtype=object), return_inverse=True)
        across = bool(block.column("i")[0].as_py() != block.column("j")[0].as_py())
        side = block.column("chunk").to_numpy() if across else None
        found = promising(block.column("sketch").to_pylist(), block.column("n").to_numpy(), percent, label, side)
        return own.filter(pa.array(found))

    return near


def _sets(shingle: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The shingle hashes of the classes' first documents; other texts under such an id are passed over."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _sliced(batches):
            keep, out, sketches, counts = [], [], [], []
            for i, (text, name) in enumerate(zip(batch.column("text"), batch.column("set"), strict=True)):
                hashes = shingles(text.as_py(), shingle)
                if len(hashes) and digest(hashes) == name.as_py():
                    keep.append(i)
                    out.append(packed(hashes))
                    sketches.append(sketch(hashes))
                    counts.append(len(unpacked(out[-1])))  # rarely fewer than before they were cut
            rows = batch.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [rows.column("class"), rows.column("set"), pa.array(counts, pa.int64()), pa.array(out, pa.binary()), pa.array(sketches, pa.binary())],
                ["class", "set", "n", "hashes", "sketch"])

    return sets


def _join_block(percent: int) -> Callable[[pa.Table], pa.Table]:
    def join(block: pa.Table) -> pa.Table:
        names, chunk = block.column("set").to_pylist(), block.column("chunk").to_numpy()
        first = {name: i for i, name in reversed(list(enumerate(names)))}
        use = sorted(first.values())
        hashes = block.column("hashes")
        sets = [unpacked(hashes[i].as_py()) for i in use]
        across = bool(block.column("i")[0].as_py() != block.column("j")[0].as_py())
        label = block.column("label").to_pylist()
        found = links(sets, chunk[use], across, percent, [label[i] for i in use])
        return pa.table({"a": pa.array([names[use[x]] for x, _ in found], pa.binary()), "b": pa.array([names[use[y]] for _, y in found], pa.binary())})

    return join


SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i : i + 3], ' ') AS s FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 1) + 1)) AS i FROM d WHERE len(ws) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * shared.n >= 85 * (x.n + y.n - shared.n)),
reach AS (SELECT doc_id AS node, doc_id AS other FROM documents UNION SELECT r.node, l.b FROM reach r JOIN links l ON l.a = r.other)
SELECT d.doc_id, coalesce(sizes.n, 0)::BIGINT AS n_shingles, r.component_id
FROM d LEFT JOIN sizes USING (doc_id) JOIN (SELECT node AS doc_id, min(other) AS component_id FROM reach GROUP BY node) r USING (doc_id)
"""
