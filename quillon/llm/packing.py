"""Packing documents into fixed-length training sequences by linear grouping and best fit."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillon.llm.encoders import encoder
from quillon.llm.packing_plan import fewest_sequences
from quillon.session import Scratch, spread

CAPACITY = 1024
END = 2
RANK_ROWS = 100_000


def token_pieces(
    docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end: int = END, id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """Documents as runs of at most ``capacity`` token ids: id, piece, start, length, ids_crc32.

    A document is the ids of its text (NULL: empty) and then ``end``. Longer ones are cut into pieces of
    exactly ``capacity`` ids, but for the first, which takes what is over.
    """
    id_type = docs.schema[id_column].dataType
    schema = T.StructType([
        T.StructField("doc_id", id_type), T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType())])
    rows = spread(docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text")))
    return rows.mapInArrow(_cutter(tokenizer_path, capacity, end), schema)


def _cutter(path: str, capacity: int, end: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoder(path)
        for batch in batches:
            of, piece, start, length, crc = [], [], [], [], []
            for i, text in enumerate(batch.column("text")):
                ids = np.append(tokens.encode(text.as_py() or ""), np.uint32(end)).astype("<u4")
                pieces = -(-len(ids) // capacity)
                first = len(ids) - (pieces - 1) * capacity
                at = 0
                for p in range(pieces):
                    size = capacity if p else first
                    of.append(i)
                    piece.append(p)
                    start.append(at)
                    length.append(size)
                    crc.append(zlib.crc32(ids[at : at + size].tobytes()))
                    at += size
            arrays = [batch.column("doc_id").take(pa.array(of, pa.int32())), pa.array(piece, pa.int32()), *(pa.array(v, pa.int64()) for v in (start, length, crc))]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "piece", "start", "length", "ids_crc32"])

    return cut


def pack(pieces: DataFrame, scratch: Scratch, capacity: int = CAPACITY, rank_rows: int = RANK_ROWS) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``: as few sequences of at most ``capacity`` as the scheme finds.

    Only the histogram of lengths (at most ``capacity`` rows) reaches the driver, where the plan is made;
    pieces are spread over ranges of at most about ``rank_rows`` by their place, numbered within range and length,
    and each number is looked up in the plan. In a sequence, pieces lie without gaps from offset 0. Ties and repeated rows are separate pieces.
    No piece is longer than the capacity or shorter than 1. An empty table gives an empty result.
    """
    spark = pieces.sparkSession
    kept = scratch.keep(pieces.withColumn("__place", F.monotonically_increasing_id()))
    histogram = {r["length"]: r["n"] for r in kept.groupBy("length").agg(F.count("*").alias("n")).collect()}
    moves, _ = fewest_sequences(histogram, capacity)
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-sum(histogram.values()) // rank_rows))
    # by place and not by value, so that equal pieces are spread as others are
    placed = kept.withColumn("__range", F.pmod(F.xxhash64("__place"), F.lit(ranges)).cast("int")).repartition("__range")
    before = Window.partitionBy("length").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    firsts = placed.groupBy("__range", "length").agg(F.count("*").alias("__n")).select(
        "length", "__range", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__first"))
    inside = Window.partitionBy("__range", "length").orderBy("__place")
    numbered = placed.withColumn("__rank", F.row_number().over(inside) - 1).join(firsts, ["length", "__range"])
    numbered = numbered.withColumn("__number", F.col("__rank") + F.col("__first"))
    # the plan's size is bounded by the capacity, whatever the number of pieces
    table = spark.createDataFrame(
        [(m.length, m.start, m.start + m.count, m.first, m.offset) for m in moves],
        "length bigint, __from bigint, __to bigint, __sequence bigint, offset bigint").withColumnRenamed("length", "__length")
    found = numbered.join(F.broadcast(table), (F.col("length") == F.col("__length")) & (F.col("__number") >= F.col("__from")) & (F.col("__number") < F.col("__to")))
    return found.select(
        *[F.col(f"`{c}`") for c in pieces.columns], (F.col("__sequence") + F.col("__number") - F.col("__from")).alias("sequence_id"), "offset")


def pack_documents(docs: DataFrame, tokenizer_path: str, scratch: Scratch, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece of each document: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    NULL and empty texts are one piece that holds the end id alone. Documents with NULL or repeated ids
    are documents like others; other columns are not looked at.
    """
    return pack(token_pieces(docs, tokenizer_path, capacity), scratch, capacity)
