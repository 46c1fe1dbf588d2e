"""A uniformly random order over shards of exact sizes, by a hypergeometric communication matrix."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillon.session import Scratch

MATRIX_ROWS = 2048
BUCKET_ROWS = 100_000


def communication_matrix(counts: list[int], sizes: list[int], seed: int) -> np.ndarray:
    """How many rows each block sends to each shard, distributed as under a uniformly random permutation.

    Block after block draws its row from what the shards still have room for (a multivariate
    hypergeometric law), so rows sum to ``counts`` and columns to ``sizes`` exactly.
    """
    rng = np.random.default_rng(seed)
    room = np.array(sizes, dtype=np.int64)
    matrix = np.zeros((len(counts), len(sizes)), dtype=np.int64)
    for i, n in enumerate(counts):
        left, total = n, int(room.sum())
        for j in range(len(sizes)):  # one hypergeometric draw a shard: no limit on the totals' product
            others = total - int(room[j])
            take = left if others == 0 else _hypergeometric(rng, int(room[j]), others, left)
            matrix[i, j] = take
            left -= take
            total = others
        room -= matrix[i]
    return matrix


def _hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """A draw from the hypergeometric law; totals of 10**9 and more use its normal limit, kept inside the bounds."""
    if draws == 0 or good == 0:
        return 0
    if good + bad < 10**9:
        return int(rng.hypergeometric(good, bad, draws))
    total, p = good + bad, good / (good + bad)
    spread = (draws * p * (1 - p) * (total - draws) / (total - 1)) ** 0.5
    return int(min(good, draws, max(0, draws - bad, round(rng.normal(draws * p, spread)))))


def shuffle_into_shards(
    rows: DataFrame, shards: int, scratch: Scratch, seed: int = 0, matrix_rows: int = MATRIX_ROWS, bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """``rows`` with ``shard`` (0 to shards-1) and ``slot`` (place in the shard, gapless from 0), in uniformly random order.

    1. The rows are written once with their partition and place; partitions form at most ``matrix_rows``
       blocks. Only the block counts reach the driver, where the communication matrix is drawn.
    2. Each block is permuted by a seeded hash of the place; the matrix cuts the permuted block into
       runs for the shards. Blocks over ``bucket_rows`` are ordered in several hash ranges.
    3. Rows go to their shards and are permuted again by a second hash, also in hash ranges, so no task
       sorts a whole shard.

    Shard sizes differ by one row at most; the first shards hold the extra ones. Values play no part:
    NULLs, ties and repeated rows are rows like others. Columns named ``shard`` or ``slot`` are replaced.
    An empty table gives an empty result.
    """
    safe = {c: f"c{i}" for i, c in enumerate(rows.columns)}
    payload = [s for c, s in safe.items() if c not in ("shard", "slot")]
    kept = scratch.keep(rows.toDF(*safe.values()).select(*payload, F.monotonically_increasing_id().alias("__place")))
    block = F.pmod(F.shiftright("__place", 33), F.lit(matrix_rows)).cast("int")
    placed = kept.withColumn("__block", block)
    counts = {r["__block"]: r["n"] for r in placed.groupBy("__block").agg(F.count("*").alias("n")).collect()}
    blocks, total = sorted(counts), sum(counts.values())
    sizes = [total // shards + (s < total % shards) for s in range(shards)]
    matrix = communication_matrix([counts[b] for b in blocks], sizes, seed)
    ends = matrix.cumsum(axis=1)
    spark = rows.sparkSession
    runs = spark.createDataFrame(
        [(b, s, int(e - matrix[i, s]), int(e)) for i, b in enumerate(blocks) for s, e in enumerate(ends[i]) if matrix[i, s]],
        "__block int, shard int, __from bigint, __to bigint")
    most = max(counts.values(), default=0)
    local = _permuted(placed, "__block", "__rank", seed * 2 + 1, -(-most // bucket_rows))
    # at most matrix_rows x shards rows, whatever the size of the table
    sent = local.join(F.broadcast(runs), (local["__block"] == runs["__block"]) & (F.col("__rank") >= F.col("__from")) & (F.col("__rank") < F.col("__to")))
    arrived = sent.select(*payload, "__place", "shard")
    slots = _permuted(arrived, "shard", "slot", seed * 2 + 2, -(-total // (shards * bucket_rows)))
    return slots.select(*[F.col(s).alias(c) for c, s in safe.items() if s in payload], "shard", "slot")


def _permuted(rows: DataFrame, group: str, rank: str, seed: int, ranges: int) -> DataFrame:
    """Number the rows of each group in the order of a seeded hash of their place.

    The hash is cut into ``ranges`` equal ranges; a range's first number is the count of the rows in the
    ranges before it, so each sort holds one range of one group.
    """
    ranges = max(1, ranges)
    keyed = rows.withColumn("__hash", F.xxhash64(F.lit(seed), F.col("__place"))).withColumn(
        "__range", F.floor((F.col("__hash") / F.lit(2.0**64) + 0.5) * ranges).cast("int"))
    inside = Window.partitionBy(group, "__range").orderBy("__hash", "__place")
    numbered = keyed.withColumn(rank, F.row_number().over(inside) - 1)
    if ranges == 1:
        return numbered.withColumn(rank, F.col(rank).cast("bigint")).drop("__hash", "__range")
    before = Window.partitionBy(group).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    firsts = keyed.groupBy(group, "__range").agg(F.count("*").alias("__n")).select(
        group, "__range", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__first"))
    joined = numbered.join(firsts, [group, "__range"])
    return joined.withColumn(rank, F.col(rank) + F.col("__first")).drop("__hash", "__range", "__first")
