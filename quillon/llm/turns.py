"""Turns of conversations in order, and digests over sorted runs; no conversation or group is held whole in a task."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillon.session import Scratch

BROADCAST_ROWS = 1_000_000
CHUNK = 1 << 14


def small(table: DataFrame) -> DataFrame:
    """A kept table of few fixed-size columns, to be broadcast if it has at most ``BROADCAST_ROWS`` rows."""
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table


def in_order(rows: DataFrame, group: str, order: Sequence[Column], keep: Sequence[str], scratch: Scratch) -> DataFrame:
    """The columns ``keep`` and ``t``, each row's place in its group (from 0) in the given order.

    Rows are sorted by range, so a group that holds a third of all rows is cut over many tasks; places are
    counted along each task, and a group that goes on from earlier tasks adds the rows it had there.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ties = rows.withColumn("__tie", F.monotonically_increasing_id())
    by = [F.col(group).asc_nulls_first(), *order, F.col("__tie")]
    placed = ties.repartitionByRange(parts, *by).sortWithinPartitions(*by).select(*keep)
    types = ", ".join(f"`{c}` {t}" for c, t in placed.dtypes)
    kept = scratch.keep(placed.mapInArrow(_ranked(group), f"{types}, __rank bigint").withColumn("__task", F.spark_partition_id()))
    counts = scratch.keep(kept.groupBy(F.col(group).alias("g"), F.col("__task").alias("task")).agg(F.count("*").alias("n")))
    several = counts.groupBy(F.col("g").alias("h")).agg(F.count("*").alias("tasks")).where("tasks > 1").select("h")
    cut = counts.join(several, F.col("g").eqNullSafe(F.col("h"))).drop("h")  # a group or two at each border of tasks
    before = Window.partitionBy("g").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    past = scratch.keep(cut.select("g", "task", F.sum("n").over(before).alias("past")))
    joined = kept.join(F.broadcast(past), F.col(group).eqNullSafe(F.col("g")) & (F.col("__task") == F.col("task")), "left")
    return joined.select(*keep, (F.col("__rank") + F.coalesce("past", F.lit(0))).alias("t"))


def _ranked(group: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Number the rows of each group in a sorted task."""

    def ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, past = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            begins = runs(batch, [group])
            ranks = np.arange(batch.num_rows) - np.repeat(begins[:-1], np.diff(begins))
            column = batch.column(group)
            if now is not None and column[0].as_py() == now[0]:
                ranks[: begins[1]] += past
            now, past = (column[batch.num_rows - 1].as_py(),), int(ranks[-1]) + 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ranks, pa.int64())], [*batch.schema.names, "__rank"])

    return ranked


def digests(rows: DataFrame, keys: Sequence[str], order: Sequence[str], text: str, separator: str, name: str, scratch: Scratch) -> DataFrame:
    """(keys, name): SHA-256 in hexadecimal of each key's texts in order, joined by the separator.

    Rows are sorted by range and joined into pieces where they lie, so that a large group's rows are spread; only
    its pieces meet in one task, which reads them as a stream and holds one batch at a time.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names = [*keys, "__first"]
    head = rows.select(*keys, *order, text)
    sorted_rows = head.repartitionByRange(parts, *keys, *order).sortWithinPartitions(*keys, *order)
    types = ", ".join(f"`{c}` {dict(head.dtypes)[c]}" for c in keys)
    pieces = sorted_rows.withColumn("__first", F.monotonically_increasing_id()).select(*names, F.col(text).alias("__text"))
    # kept, so that the places by which pieces are put in order stay as they are
    joined = scratch.keep(pieces.mapInArrow(_joined(list(keys), separator), f"{types}, __first bigint, __text string"))
    streamed = joined.repartition(parts, *keys).sortWithinPartitions(*names)
    return streamed.mapInArrow(_hashed(list(keys), separator.encode(), name), f"{types}, `{name}` string")


def runs(batch: pa.RecordBatch, keys: Sequence[str]) -> np.ndarray:
    """Where runs of equal keys begin in a batch, and its end."""
    differs = np.zeros(max(0, batch.num_rows - 1), bool)
    for key in keys:
        column = batch.column(key)
        a, b = column.slice(0, max(0, len(column) - 1)), column.slice(min(1, len(column)))
        same = pc.fill_null(pc.equal(a, b), False)
        both = pc.and_(a.is_null(), b.is_null())
        differs |= ~np.asarray(pc.or_(same, both).to_numpy(zero_copy_only=False), bool)
    return np.concatenate([[0], np.flatnonzero(differs) + 1, [batch.num_rows]]) if batch.num_rows else np.zeros(1, np.int64)


def _joined(keys: list[str], separator: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            begins = runs(batch, keys)
            texts = batch.column("__text").to_pylist()
            out = [separator.join(texts[a:b]) for a, b in zip(begins[:-1], begins[1:], strict=True)]
            rows = batch.take(pa.array(begins[:-1]))
            yield pa.RecordBatch.from_arrays([*[rows.column(k) for k in keys], rows.column("__first"), pa.array(out, pa.string())], [*keys, "__first", "__text"])

    return joined


def _hashed(keys: list[str], separator: bytes, name: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, last = None, None, None
        for batch in batches:
            begins, rows, out = runs(batch, keys), [], []
            for a, b in zip(begins[:-1], begins[1:], strict=True):
                key = tuple(batch.column(k)[int(a)].as_py() for k in keys)
                if state is None or key != now:
                    if state is not None:
                        rows.append(last)
                        out.append(state.hexdigest())
                    now, state, last = key, hashlib.sha256(), batch.slice(int(a), 1)
                    a, first = int(a) + 1, batch.column("__text")[int(a)].as_py()
                    state.update(first.encode())
                for i in range(int(a), int(b)):
                    state.update(separator)
                    state.update(batch.column("__text")[i].as_py().encode())
            if rows:
                yield _told(rows, out, keys, name)
        if state is not None:
            yield _told([last], [state.hexdigest()], keys, name)

    return hashed


def _told(rows: list[pa.RecordBatch], out: list[str], keys: list[str], name: str) -> pa.RecordBatch:
    table = pa.Table.from_batches(rows).combine_chunks().to_batches()[0]
    return pa.RecordBatch.from_arrays([*[table.column(k) for k in keys], pa.array(out, pa.string())], [*keys, name])
