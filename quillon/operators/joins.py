"""Joins that stay even when a few keys hold most of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.functions import column
from quillon.operators.params import DRIVER_ROWS, skew_join
from quillon.session import materialize

SALTS = 4096
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 64 * 1024 * 1024


def lookup(
    rows: DataFrame, table: DataFrame, keys: Sequence[str], weight: str, spread_on: Sequence[str],
    small_limit: int = DRIVER_ROWS, hot_keys: int | None = None,
) -> DataFrame:
    """Left join of ``rows`` with a table that has one row per key and the key's row count in ``weight``.

    A table proven small is broadcast. Otherwise the keys with more than a quarter of a task's share of the rows (at most four
    times as many keys as there are tasks), or the ``hot_keys`` heaviest, are broadcast, and the rest is shuffled. Rows already answered, and rows with a missing key, travel under a salt made from the
    ``spread_on`` columns so that they do not pile up either.
    """
    keys = list(keys)
    table = materialize(table)  # read for its size, for its heaviest keys and for the join
    found = table.agg(F.count(F.lit(1)).alias("n"), F.sum(weight).alias("rows")).first()
    if found.n <= small_limit:
        return rows.join(F.broadcast(table), keys, "left")
    least = (found.rows or 0) / (4 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    values = [c for c in table.columns if c not in keys]
    heaviest = table.where(column(weight) > least) if hot_keys is None else table.orderBy(F.desc(weight)).limit(hot_keys)
    hot = heaviest.select(
        *keys, *[column(v).alias(f"__hot_{v}") for v in values], F.lit(True).alias("__hot"))
    missing = F.lit(False)
    for k in keys:
        missing = missing | column(k).isNull()
    salt = F.when(F.col("__hot") | missing, F.pmod(F.xxhash64(*map(column, spread_on)), F.lit(SALTS))).otherwise(-1)
    marked = rows.join(F.broadcast(hot), keys, "left").withColumn("__salt", salt.cast("bigint"))
    cold = table.withColumn("__salt", F.lit(-1).cast("bigint"))
    joined = marked.join(cold, [*keys, "__salt"], "left")
    return joined.select(
        *[column(c) for c in rows.columns],
        *[F.coalesce(column(f"__hot_{v}"), column(v)).alias(v) for v in values],
    )


def dimension_join(
    rows: DataFrame, table: DataFrame, keys: Sequence[str], how: str = "left", broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Join rows to a table that describes their keys.

    The table is counted: a small one of bounded row width is broadcast, a larger one joined by ``skew_join``.
    """
    keys = list(keys)
    if fits_broadcast(table, broadcast_rows):
        return rows.join(F.broadcast(table), keys, how)
    return skew_join(rows, table, keys, how)


def fits_broadcast(table: DataFrame, rows: int = BROADCAST_ROWS, total_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether a table has at most so many rows, and so many bytes as JSON text."""
    size = F.sum(F.octet_length(F.to_json(F.struct(*[column(c) for c in table.columns]))))
    found = table.agg(F.count(F.lit(1)).alias("n"), size.alias("bytes")).first()
    return found.n <= rows and (found.bytes or 0) <= total_bytes
