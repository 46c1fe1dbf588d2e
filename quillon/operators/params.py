"""Fitted values (one small row per group) and how rows get at them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillon.functions import column

# A table fetched to the driver never has more rows than this; beyond it, plans keep a shuffle join.
DRIVER_ROWS = 20_000
HEAVY_SAMPLE = 0.02
# A key has to turn up so often in a sample to count as heavy.
LEAST_IN_SAMPLE = 50


def fetch_bounded(df: DataFrame, limit: int = DRIVER_ROWS) -> list | None:
    """Rows of a small table, or None when it has more than ``limit`` rows.

    At most ``limit + 1`` rows ever reach the driver, so the answer doubles as a size check.
    """
    rows = df.limit(limit + 1).collect()
    return None if len(rows) > limit else rows


def bounded_or_lazy(df: DataFrame, limit: int = DRIVER_ROWS) -> tuple[DataFrame, bool]:
    """A broadcastable copy of ``df`` when it is proven small, else ``df`` itself (to be shuffled)."""
    rows = fetch_bounded(df, limit)
    if rows is None:
        return df, False
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema)), True


def attach(df: DataFrame, by: Sequence[str], table: DataFrame, how: str = "left") -> DataFrame:
    """Give every row the fitted values of its group.

    ``table`` has one row per value of ``by``. Without groups its single row is turned into
    literals, so the result is a plain projection that also runs on a stream.
    """
    names = [c for c in table.columns if c not in by]
    if not by:
        row = table.first()
        fields = {f.name: f.dataType for f in table.schema.fields}
        return df.select("*", *[_literal(row[c] if row else None, fields[c]).alias(c) for c in names])
    small, fits = bounded_or_lazy(table)
    return df.join(small, list(by), how) if fits else skew_join(df, table, list(by), how)


def heavy_keys(rows: DataFrame, keys: Sequence[str], sample: float | None = None) -> tuple[list, int]:
    """The keys that a fair share of a task could not hold, each with its number of tasks; and how many tasks missing keys need.

    Keys are counted in a sample of the rows. At most ``4 * shuffle partitions`` keys can reach the limit of a quarter of
    a task's share, so that many rows come to the driver at most. A key that the sample misses is no heavy one.
    """
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    names = [column(k) for k in keys]
    fraction = HEAVY_SAMPLE if sample is None else sample
    drawn = rows.select(*names) if fraction >= 1 else rows.select(*names).sample(fraction, seed=11)
    counts = drawn.groupBy(*names).agg(F.count(F.lit(1)).alias("__n"))
    least = F.greatest(F.lit(LEAST_IN_SAMPLE), F.col("__total") / (4 * parts))
    totals = counts.agg(F.sum("__n").alias("__total"))
    found = counts.join(F.broadcast(totals)).where(F.col("__n") >= least).collect()
    share = {tuple(r[k] for k in keys): min(parts, -(-4 * parts * r["__n"] // r["__total"])) for r in found}
    missing = max([n for key, n in share.items() if None in key], default=1)
    return [(*key, int(n)) for key, n in share.items() if None not in key and n > 1], int(missing)


def skew_join(rows: DataFrame, table: DataFrame, keys: Sequence[str], how: str = "left", sample: float | None = None) -> DataFrame:
    """Join rows to a table with few rows a key; a key that is heavy among the rows is spread over as many tasks as it needs.

    Only the table's rows of heavy keys are copied, once for each of the key's tasks; a row's task follows from its place
    in the input. Rows with a missing key match nothing and are spread as well. How heavy keys are is measured
    (``heavy_keys``), so a table without any is joined as it is.
    """
    keys = list(keys)
    heavy, missing = heavy_keys(rows, keys, sample)
    if not heavy and missing == 1:
        return rows.join(table, keys, how)
    place = F.monotonically_increasing_id()
    spark = rows.sparkSession
    kinds = T.StructType([*[T.StructField(k, table.schema[k].dataType) for k in keys], T.StructField("__tasks", T.IntegerType())])
    # at most 4 * shuffle partitions rows of a key and a number
    spread = F.broadcast(spark.createDataFrame(heavy, kinds))
    absent = reduce(lambda a, b: a | b, [column(k).isNull() for k in keys])
    tasks = F.when(absent, F.lit(missing)).otherwise(F.coalesce("__tasks", F.lit(1)))
    salted = rows.join(spread, keys, "left").withColumn("__salt", F.pmod(place, tasks).cast("int")).drop("__tasks")
    copied = table.join(spread, keys, "left").withColumn("__salt", F.explode(F.sequence(F.lit(0), F.coalesce("__tasks", F.lit(1)) - 1))).drop("__tasks")
    return salted.join(copied, [*keys, "__salt"], how).drop("__salt")


def _literal(value, data_type: T.DataType):
    if isinstance(value, dict):
        value_type = data_type.valueType
        pairs = [F.lit(x) if i % 2 == 0 else F.lit(x).cast(value_type) for kv in value.items() for i, x in enumerate(kv)]
        return F.create_map(*pairs).cast(data_type)
    return F.lit(value).cast(data_type)


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.drop(*[column(c) for c in names])
