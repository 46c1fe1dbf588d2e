"""Exact order statistics and running counts without sorting a whole group in one task.

The values are first cut into ranges of similar row count, more of them the more rows there are. The cut points are
approximate quantiles of a sample, as in Spark's own range partitioning, but they are fixed numbers by
the time the exact plan is built, so they only decide how evenly the work spreads, never the answer. Row counts per (group, bucket) then tell in
which bucket a wanted rank lies, and only the rows of those buckets are looked at closely. A group
that holds a third of all rows is thereby spread over a third of the buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillon.functions import column, quoted
from quillon.operators.params import attach, bounded_or_lazy
from quillon.session import materialize

CUT_SAMPLE = 0.01
# A table counted and found to be no larger than this needs no buckets: one task can hold all of it.
SMALL_ROWS = 500_000
ROWS_PER_BUCKET, MIN_BUCKETS, MAX_BUCKETS = 50_000, 8, 4096
HASH_BITS = 13
# A bucket with more rows than this is cut again before its rows are looked at closely.
SPLIT_ROWS = 20 * ROWS_PER_BUCKET
BUCKET = "__bucket"
# The sketch of a group is off by at most its rows divided by the accuracy; bounds are taken with three times that margin.
SKETCH_ACCURACY, SKETCH_MARGIN = 10_000, 3
NEAR_PARTS = 1024


def add_value_bucket(df: DataFrame, value: str, rows: int | None = None) -> DataFrame:
    """Append a bucket number that never decreases as ``value`` grows. Rows must have a value."""
    rows = df.count() if rows is None else rows
    if rows <= SMALL_ROWS:
        return df.withColumn(BUCKET, F.lit(0.0))
    buckets = min(max(rows // ROWS_PER_BUCKET, MIN_BUCKETS), MAX_BUCKETS)
    probabilities = ", ".join(f"{i / buckets!r}D" for i in range(1, buckets))
    sketch = df.sample(CUT_SAMPLE, seed=7).agg(
        F.expr(f"percentile_approx(double({quoted(value)}), array({probabilities}), {5 * buckets})").alias("edges")
    ).first()
    inf = float("inf")
    inner = sorted(set(sketch.edges or [0.0]) - {inf, -inf}) or [0.0]
    cutter = Bucketizer(
        splits=[-inf, *inner, inf], inputCol=value, outputCol=BUCKET, handleInvalid="keep"
    )
    return cutter.transform(df)


def add_hash_bucket(df: DataFrame, tie_class: Column, hashed: Column) -> DataFrame:
    """Bucket for values ordered by (tie class, 64-bit hash): the hash is already even."""
    top_bits = F.shiftright(hashed, 64 - HASH_BITS).cast("double")  # from -2^(bits-1) to 2^(bits-1) - 1
    return df.withColumn(BUCKET, tie_class.cast("double") * float(2**HASH_BITS) + top_bits)


def bucket_totals(df: DataFrame, by: Sequence[str], measures: Sequence[str] = ()) -> DataFrame:
    """Per (group, bucket): rows and measure sums, those of the buckets before it, and of the group.

    The window runs over at most one row per bucket and group.
    """
    sums = ["n", *measures]
    totals = df.groupBy(*by, BUCKET).agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(m).cast("bigint").alias(m) for m in measures]
    )
    group = Window.partitionBy(*by)
    earlier = group.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(
        "*",
        *[F.coalesce(F.sum(s).over(earlier), F.lit(0)).alias(f"{s}_before") for s in sums],
        *[F.sum(s).over(group).alias(f"{s}_total") for s in sums],
    )


def bucket_of_ranks(totals: DataFrame, ranks: dict[str, Column] | DataFrame, by: Sequence[str]) -> DataFrame:
    """The bucket in which each wanted 0-based rank lies; a rank outside the group gives no row.

    ``ranks`` is either ``{rank id: expression of n_total}`` or a table ``(by..., rank_id, rank)``.
    """
    if isinstance(ranks, dict):
        wanted = F.array(
            *[F.struct(F.lit(k).alias("rank_id"), e.cast("bigint").alias("rank")) for k, e in ranks.items()]
        )
        located = totals.withColumn(
            "w",
            F.explode(F.filter(wanted, lambda w: (w["rank"] >= F.col("n_before"))
                               & (w["rank"] < F.col("n_before") + F.col("n")))),
        ).select("*", "w.*").drop("w")
    else:
        located = totals.join(ranks, list(by)).where(
            (F.col("rank") >= F.col("n_before")) & (F.col("rank") < F.col("n_before") + F.col("n"))
        )
    return located


def values_at_ranks(
    df: DataFrame, by: Sequence[str], value: str, ranks, measures: Sequence[str] = (), larger: int | None = None,
) -> DataFrame:
    """Exact value at every wanted rank, plus what lies below it and what equals it.

    ``df`` must carry a bucket column (see above) and has neither missing values nor missing group
    keys. Output per (group, rank_id): ``rank, value, n_total, n_below, n_equal`` and for every
    measure ``m_total, m_below, m_equal``.
    """
    by = list(by)
    located = bucket_of_ranks(bucket_totals(df, by, measures), ranks, by)
    sums = ["n", *measures]
    keep = [*by, BUCKET, "rank_id", "rank", *[f"{s}_before" for s in sums], *[f"{s}_total" for s in sums]]
    located, _ = bounded_or_lazy(located.select("n", *keep))
    largest = located.agg(F.max("n").alias("n")).first().n or 0
    located = located.select(*keep)

    inside = df.join(located.select(*by, BUCKET).distinct(), [*by, BUCKET], "left_semi")
    # a bucket that cutting did not make smaller holds one value only, which is merged below
    if largest > SPLIT_ROWS and (larger is None or largest < larger) and isinstance(df.schema[value].dataType, T.NumericType):
        return _split_again(inside, located, by, value, measures, largest)
    counts = inside.groupBy(*by, BUCKET, value).agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(m).cast("bigint").alias(m) for m in measures]
    )
    earlier = Window.partitionBy(*by, BUCKET).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    running = counts.select(
        "*", *[F.coalesce(F.sum(s).over(earlier), F.lit(0)).alias(f"{s}_run") for s in sums]
    )
    below = F.col("n_before") + F.col("n_run")
    return (
        running.join(located, [*by, BUCKET])
        .where((F.col("rank") >= below) & (F.col("rank") < below + F.col("n")))
        .select(
            *by, "rank_id", "rank", F.col(value).alias("value"),
            *[F.col(f"{s}_total") for s in sums],
            *[(F.col(f"{s}_before") + F.col(f"{s}_run")).alias(f"{s}_below") for s in sums],
            *[F.col(s).alias(f"{s}_equal") for s in sums],
        )
    )


def _split_again(
    inside: DataFrame, located: DataFrame, by: list[str], value: str, measures: Sequence[str], largest: int,
) -> DataFrame:
    """``values_at_ranks`` for buckets that are too large for one task: each is cut into buckets of its own.

    A bucket becomes a group, its ranks start at its first row, and new edges are drawn from the rows of the
    wanted buckets alone. As often as needed, so no number of rows is too large.
    """
    outer, sums = f"{BUCKET}_{len(by)}", ["n", *measures]
    rows = inside.withColumnRenamed(BUCKET, outer)
    known = located.withColumnRenamed(BUCKET, outer)
    ranks = known.select(*by, outer, "rank_id", (F.col("rank") - F.col("n_before")).alias("rank"))
    found = values_at_ranks(add_value_bucket(rows, value, rows.count()), [*by, outer], value, ranks, measures, largest)
    before = known.select(*by, outer, "rank_id", F.col("rank").alias("__rank"), *[F.col(f"{s}_before") for s in sums], *[F.col(f"{s}_total").alias(f"__{s}") for s in sums])
    return found.join(before, [*by, outer, "rank_id"]).select(
        *by, "rank_id", F.col("__rank").alias("rank"), "value", *[F.col(f"__{s}").alias(f"{s}_total") for s in sums],
        *[(F.col(f"{s}_before") + F.col(f"{s}_below")).alias(f"{s}_below") for s in sums], *[F.col(f"{s}_equal") for s in sums])


def distinct_counts(df: DataFrame, by: Sequence[str], value: str, measures: Sequence[str] = ()) -> DataFrame:
    """One row per (group, distinct value): rows and measure sums at it, below it and in total.

    The rows are read once: equal values become one row per group, which is written. Each window then holds one
    bucket of one group, or one row per bucket.
    """
    by = list(by)
    sums = ["n", *measures]
    counts = materialize(df.groupBy(*map(column, by), column(value)).agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(m).cast("bigint").alias(m) for m in measures]))
    cut = add_value_bucket(counts, value)
    totals = cut.groupBy(*map(column, by), BUCKET).agg(*[F.sum(s).alias(s) for s in sums])
    group = Window.partitionBy(*map(column, by)) if by else Window.partitionBy(F.lit(0))
    earlier = group.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    summed = totals.select(*map(column, by), BUCKET, *[F.coalesce(F.sum(s).over(earlier), F.lit(0)).alias(f"{s}_before") for s in sums],
                           *[F.sum(s).over(group).alias(f"{s}_total") for s in sums])
    past = Window.partitionBy(*map(column, by), BUCKET).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    running = cut.select("*", *[F.coalesce(F.sum(s).over(past), F.lit(0)).alias(f"{s}_run") for s in sums])
    return running.join(summed, [*by, BUCKET]).select(
        *map(column, by), column(value).alias("value"), *[F.col(f"{s}_total") for s in sums],
        *[(F.col(f"{s}_before") + F.col(f"{s}_run")).alias(f"{s}_below") for s in sums], *[F.col(s).alias(f"{s}_equal") for s in sums])


def quantile_ranks(probabilities: Sequence[float]) -> dict[str, Column]:
    """The two neighbouring ranks of every linearly interpolated quantile."""
    ranks = {}
    for i, p in enumerate(probabilities):
        position = (F.col("n_total") - 1) * F.lit(float(p))
        ranks[f"{i}:lo"] = F.floor(position)
        ranks[f"{i}:hi"] = F.ceil(position)
    return ranks


def interpolate(at_ranks: DataFrame, by: Sequence[str], probabilities: Sequence[float], names: Sequence[str]) -> DataFrame:
    """Turn the values at neighbouring ranks into one column per quantile."""
    def at(rank_id: str) -> Column:
        return F.max(F.when(F.col("rank_id") == rank_id, F.col("value")))

    columns = []
    for i, (p, name) in enumerate(zip(probabilities, names, strict=True)):
        lo, hi = at(f"{i}:lo"), at(f"{i}:hi")
        position = (F.max("n_total") - 1) * F.lit(float(p))
        columns.append((lo + (hi - lo) * (position - F.floor(position))).alias(name))
    return at_ranks.groupBy(*by).agg(*columns)


def small_quantiles(value: Column | str, probabilities: Sequence[float], names: Sequence[str]) -> list[Column]:
    """The same quantiles as plain aggregates, for a table known to be small."""
    found = F.percentile(value, [float(p) for p in probabilities])
    return [found[i].alias(name) for i, name in enumerate(names)]


def sketch_of(value: str, probabilities: Sequence[float]) -> Column:
    """A mergeable sketch's values a little below and above each quantile, as an aggregate to go with others of the same pass."""
    near = [min(1.0, max(0.0, float(p) + side * SKETCH_MARGIN / SKETCH_ACCURACY)) for p in probabilities for side in (-1, 1)]
    return F.percentile_approx(F.col(value), F.array(*[F.lit(p) for p in near]), F.lit(SKETCH_ACCURACY))


def quantiles_from_sketch(
    numbers: DataFrame, sketches: DataFrame, by: Sequence[str], value: str, probabilities: Sequence[float], names: Sequence[str],
) -> DataFrame:
    """Linearly interpolated exact quantiles, from the rows and from ``sketches`` (``by..., __sketch``: ``sketch_of`` the rows).

    One pass over the rows: a value between a quantile's two sketched ones is counted by itself, all others only by
    the gap they lie in, so that little more than a few values per quantile and group is shuffled. Values near a quantile are
    spread over ``NEAR_PARTS`` parts.
    """
    by = list(by)
    order = sorted(range(len(probabilities)), key=lambda i: probabilities[i])
    bounds = F.array(*[F.struct(F.get("__sketch", F.lit(2 * i)).alias("lo"), F.get("__sketch", F.lit(2 * i + 1)).alias("hi")) for i in order])
    if by:
        placed = attach(numbers, by, sketches.select(*map(column, by), bounds.alias("__bounds")))
    else:
        row = sketches.first()
        points = (row["__sketch"] if row else None) or [0.0] * (2 * len(order))
        placed = numbers.withColumn("__sketch", F.array(*[F.lit(float(x)) for x in points])).withColumn("__bounds", bounds)
    v = F.col(value)
    passed = F.size(F.filter("__bounds", lambda b: b["hi"] < v))
    rows = placed.select(*map(column, by), v.alias("__v"), passed.alias("__gap"), F.get("__bounds", passed).alias("__next"))
    near = F.coalesce(F.col("__v") >= F.col("__next.lo"), F.lit(False))
    part = F.try_divide((F.col("__v") - F.col("__next.lo")) * NEAR_PARTS, F.col("__next.hi") - F.col("__next.lo"))
    inside = F.when(near & ~F.isnan(part), F.greatest(F.lit(0), F.least(F.lit(NEAR_PARTS - 1), F.floor(part)))).when(near, 0)
    # -1 is the gap before the quantile's own parts
    cut = rows.select(*map(column, by), (F.col("__gap") * (NEAR_PARTS + 1) + F.coalesce(inside, F.lit(-1))).cast("bigint").alias(BUCKET), F.when(near, F.col("__v")).alias("__v"))
    counts = materialize(cut.groupBy(*map(column, by), BUCKET, "__v").agg(F.count(F.lit(1)).alias("k")))
    totals = counts.groupBy(*map(column, by), BUCKET).agg(F.sum("k").alias("n"), F.max(F.col("__v").isNull()).alias("gap"))
    group = Window.partitionBy(*map(column, by)) if by else Window.partitionBy(F.lit(0))
    before = group.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    summed = totals.select("*", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n_before"), F.sum("n").over(group).alias("n_total"))
    located = materialize(bucket_of_ranks(summed, quantile_ranks(probabilities), by).select(*map(column, by), BUCKET, "gap", "n_before", "n_total", "rank_id", "rank"))
    if not located.where("gap").isEmpty():  # a sketch that missed its margin: cut the values in another way
        buckets = add_value_bucket(numbers, value)
        return interpolate(values_at_ranks(buckets, by, value, quantile_ranks(probabilities)), by, probabilities, names)
    past = Window.partitionBy(*map(column, by), BUCKET).orderBy("__v").rowsBetween(Window.unboundedPreceding, 0)
    running = counts.where("__v IS NOT NULL").withColumn("to", F.sum("k").over(past))
    at = running.join(located, [*by, BUCKET]).where(
        (F.col("rank") >= F.col("n_before") + F.col("to") - F.col("k")) & (F.col("rank") < F.col("n_before") + F.col("to")))
    return interpolate(at.select(*map(column, by), "rank_id", "n_total", F.col("__v").alias("value")), by, probabilities, names)


def weighted_quantiles(
    df: DataFrame, by: Sequence[str], value: str, weight: str, probabilities: Sequence[float], names: Sequence[str],
) -> DataFrame:
    """Linearly interpolated quantiles per group, where a row stands for ``weight`` (a whole number) equal ones."""
    at = distinct_counts(df, by, value, [weight]).withColumn("n_total", F.col(f"{weight}_total"))
    wanted = F.array(*[F.struct(F.lit(k).alias("rank_id"), e.cast("bigint").alias("rank")) for k, e in quantile_ranks(probabilities).items()])
    below = F.col(f"{weight}_below")
    here = F.filter(wanted, lambda r: (r["rank"] >= below) & (r["rank"] < below + F.col(f"{weight}_equal")))
    located = at.select(*map(column, by), "n_total", "value", F.explode(here).alias("r")).select(*map(column, by), "n_total", "value", "r.rank_id")
    return interpolate(located, by, probabilities, names)


def exact_quantiles(
    df: DataFrame, by: Sequence[str], value: str, probabilities: Sequence[float], names: Sequence[str]
) -> DataFrame:
    """Linearly interpolated quantiles per group: one row per group, one column per probability. Two passes over the rows."""
    by = list(by)
    numbers = df.select(*map(column, by), column(value).cast("double").alias("v")).dropna(subset=[*by, "v"])
    sketches = materialize(numbers.groupBy(*map(column, by)).agg(sketch_of("v", probabilities).alias("__sketch")))
    return quantiles_from_sketch(numbers, sketches, by, "v", probabilities, names)
