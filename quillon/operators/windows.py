"""Rolling splits over rows that are stored once: statistics of all splits from mergeable states per window.

A row is tested in one split at most and trains in all splits from a first one on. These two numbers are its window.
Sums, counts, minima and maxima are made per window and cumulated over the splits, so no row is copied into
the splits it belongs to. Exact order statistics come from a matrix of row counts by window and value bucket,
and a look at the rows of the few buckets that hold a wanted rank.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillon.functions import as_double, column
from quillon.operators.features import minmax
from quillon.operators.ranks import interpolate, quantile_ranks
from quillon.operators.splits import ROLE, SPLIT, consecutive_boundaries, temporal_boundaries
from quillon.session import Scratch

TESTED, SINCE = "tested_in", "trains_from"
MERGE = {"sum": F.sum, "min": F.min, "max": F.max}
ROWS_PER_BUCKET, LEAST_BUCKETS, MOST_BUCKETS = 20_000, 32, 4096
CUT_ROWS = 200_000
BROADCAST_ROWS = 500_000


@dataclass(frozen=True)
class Windows:
    """``rows`` with ``tested_in`` and ``trains_from`` (missing where a row is in no test set, or trains nothing)."""

    rows: DataFrame
    splits: tuple[int, ...]

    def kept(self, scratch: Scratch) -> Windows:
        """The rows written once, partitioned by window: a split reads its own windows only."""
        path = scratch.path()
        self.rows.write.partitionBy(SINCE, TESTED).parquet(path)
        read = self.rows.sparkSession.read.schema(self.rows.schema).parquet(path)
        return Windows(read.select(*[column(c) for c in self.rows.columns]), self.splits)

    def without(self, *names: str) -> Windows:
        """The windows without some columns, such as the date, which has done its work once rows are placed."""
        return Windows(self.rows.select(*[column(c) for c in self.rows.columns if c not in names]), self.splits)

    def split(self, split_id: int) -> DataFrame:
        """The rows of one split, with ``split_id`` and ``role``."""
        parts = [(F.col(SINCE) <= split_id, "train"), (F.col(TESTED) == split_id, "test")]
        found = [self.rows.where(c).withColumns({SPLIT: F.lit(split_id), ROLE: F.lit(role)}) for c, role in parts]
        return found[0].unionByName(found[1]).drop(SINCE, TESTED)

    def usable(self) -> list[int]:
        """The splits that have both training and test rows."""
        sizes = self.states({"n": (F.count(F.lit(1)), "sum")}).groupBy(SPLIT).agg(F.count(F.lit(1)).alias("roles"))
        return sorted(r[SPLIT] for r in sizes.collect() if r["roles"] == 2)

    def states(self, values: Mapping[str, tuple[Column, str]], by: Sequence[str] = ()) -> DataFrame:
        """``by..., split_id, role`` and each value: an aggregate per window, and how windows are merged (sum, min, max).

        One aggregation over the rows; what follows has one row per group and window, or per group and split.
        """
        own = {**{n: v for n, (v, _) in values.items()}, "__n": F.count(F.lit(1))}
        merge = {**{n: m for n, (_, m) in values.items()}, "__n": "sum"}
        parts = self.rows.where(F.col(SINCE).isNotNull() | F.col(TESTED).isNotNull()).groupBy(*map(column, by), SINCE, TESTED).agg(
            *[v.alias(n) for n, v in own.items()])
        return cumulated(parts, merge, by, self.splits).drop("__n")


def cumulated(parts: DataFrame, merge: Mapping[str, str], by: Sequence[str], splits: Sequence[int]) -> DataFrame:
    """States per window (``by..., trains_from, tested_in``) as states per split and role."""
    names = list(by)
    grouped = {role: parts.where(F.col(c).isNotNull()).groupBy(*map(column, names), F.col(c).alias(SPLIT)).agg(
        *[MERGE[m](n).alias(n) for n, m in merge.items()]) for c, role in ((SINCE, "train"), (TESTED, "test"))}
    columns = [*map(column, names), SPLIT, ROLE, *merge]
    test = grouped["test"].withColumn(ROLE, F.lit("test")).select(*columns)
    if not splits:
        return test
    started = grouped["train"]
    if names:
        firsts = started.groupBy(*map(column, names)).agg(F.min(SPLIT).alias("__first"))
        frame = firsts.select(*map(column, names), F.explode(F.sequence(F.col("__first"), F.lit(splits[-1]))).alias(SPLIT))
    else:
        frame = parts.sparkSession.range(splits[0], splits[-1] + 1).select(F.col("id").cast("int").alias(SPLIT))
    past = Window.partitionBy(*[column(c) for c in names] or [F.lit(0)]).orderBy(SPLIT).rowsBetween(Window.unboundedPreceding, 0)
    every = frame.join(started, [*names, SPLIT], "left").select(
        *map(column, names), SPLIT, F.lit("train").alias(ROLE), *[MERGE[m](n).over(past).alias(n) for n, m in merge.items()])
    return every.where(F.col("__n").isNotNull() if "__n" in merge else F.lit(True)).select(*columns).unionByName(test)


def place(df: DataFrame, date_col: str, boundaries: Sequence) -> Windows:
    """Give each row its window: binary searches among the boundaries, however many there are."""
    if not boundaries:
        none = F.lit(None).cast("int")
        return Windows(df.limit(0).withColumns({SINCE: none, TESTED: none}), ())
    first, last = boundaries[0][SPLIT], boundaries[-1][SPLIT]
    d = column(date_col).cast("timestamp_ntz")
    # Microseconds since 1970 on the calendar of the column, whatever the session's time zone. Doubles hold them exactly for centuries.
    clock = (F.hour(d) * 60 + F.minute(d)).cast("bigint") * 60_000_000 + (F.date_part(F.lit("SECOND"), d) * 1_000_000).cast("bigint")
    moment = (F.datediff(d.cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint") * 86_400_000_000 + clock).cast("double")

    def micros(value: datetime) -> float:
        return (value - datetime(1970, 1, 1)) // timedelta(microseconds=1)

    inf = float("inf")
    limits = {c: [-inf, *[float(micros(b[c])) for b in boundaries], inf] for c in ("test_start", "train_end")}
    cutter = Bucketizer(
        splitsArray=list(limits.values()), inputCols=["__moment", "__moment_2"], outputCols=["__reached", "__passed"], handleInvalid="keep")
    marked = cutter.transform(df.where(d.isNotNull()).withColumns({"__moment": moment, "__moment_2": moment}))
    reached, passed = F.col("__reached").cast("int"), F.col("__passed").cast("int")
    tested = F.when((reached >= 1) & (F.col("__moment") < micros(boundaries[-1]["test_end"])), reached + first - 1)
    since = F.when(passed + first <= last, passed + first)
    return Windows(marked.select(*[column(c) for c in df.columns], since.alias(SINCE), tested.alias(TESTED)), tuple(range(first, last + 1)))


def temporal_windows(df: DataFrame, date_col: str, time_length: Mapping[str, int], gap=None, start_date: str | None = None, drop_before: bool = False) -> Windows:
    """The splits of ``create_temporal_splits``, each row once."""
    rows, boundaries = temporal_boundaries(df, date_col, time_length, gap, start_date, drop_before)
    return place(rows, date_col, boundaries)


def consecutive_windows(df: DataFrame, date_col: str, time_length: Mapping[str, int], start_date: str | None = None) -> Windows:
    """The splits of ``create_consecutive_splits``, each row once."""
    rows, boundaries = consecutive_boundaries(df, date_col, time_length, start_date)
    return place(rows, date_col, boundaries)


# --- order statistics -----------------------------------------------------------------------------

def _small(kept: DataFrame) -> DataFrame:
    """A written table of a few numbers a row, broadcast if it has at most ``BROADCAST_ROWS`` rows."""
    return F.broadcast(kept) if kept.count() <= BROADCAST_ROWS else kept


class ValueMatrix:
    """Row counts by column, window and value bucket, and exact answers from them for all splits and roles.

    The rows are read for the cuts (a sample), for the counts, and once for each kind of question, then only
    in the buckets it points at.
    """

    def __init__(self, windows: Windows, columns: Sequence[str], scratch: Scratch):
        self.windows, self.columns, self.scratch = windows, list(columns), scratch
        members = windows.rows.where(F.col(SINCE).isNotNull() | F.col(TESTED).isNotNull())
        total = members.count()
        buckets = min(max(total // ROWS_PER_BUCKET, LEAST_BUCKETS), MOST_BUCKETS)
        sample = members if total <= CUT_ROWS else members.sample(CUT_ROWS / total, seed=7)
        chances = F.array(*[F.lit(i / buckets) for i in range(1, buckets)])
        found = sample.agg(*[F.percentile_approx(as_double(c), chances, 5 * buckets).alias(f"c{i}") for i, c in enumerate(self.columns)]).first()
        inf = float("inf")
        self.cuts = {c: [-inf, *(sorted(set(found[f"c{i}"] or [0.0]) - {inf, -inf}) or [0.0]), inf] for i, c in enumerate(self.columns)}
        counts = self.values().groupBy("column", "bucket", SINCE, TESTED).agg(F.count(F.lit(1)).alias("n"))
        states = cumulated(scratch.keep(counts), {"n": "sum"}, ["column", "bucket"], windows.splits)
        group = Window.partitionBy("column", SPLIT, ROLE)
        before = group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        self.cells = scratch.keep(states.select(
            "*", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n_before"), F.sum("n").over(group).alias("n_total")))

    def values(self) -> DataFrame:
        """(column, bucket, value, window) of all values that are there."""
        rows = self.windows.rows.where(F.col(SINCE).isNotNull() | F.col(TESTED).isNotNull()).select(
            SINCE, TESTED, *[as_double(c).alias(f"v{i}") for i, c in enumerate(self.columns)])
        names = [f"b{i}" for i in range(len(self.columns))]
        cut = Bucketizer(
            splitsArray=list(self.cuts.values()), inputCols=[f"v{i}" for i in range(len(self.columns))], outputCols=names, handleInvalid="keep").transform(rows)
        each = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"v{i}").alias("value"), F.col(f"b{i}").cast("int").alias("bucket")) for i, c in enumerate(self.columns)])
        return cut.select(SINCE, TESTED, F.inline(each)).where("value IS NOT NULL AND NOT isnan(value)")

    def _placed(self, points: DataFrame) -> DataFrame:
        """``points`` (column, value ...) with the bucket of each."""
        parts = []
        for name in self.columns:
            cutter = Bucketizer(splits=self.cuts[name], inputCol="value", outputCol="__b", handleInvalid="keep")
            parts.append(cutter.transform(points.where((F.col("column") == name) & F.col("value").isNotNull())))
        return reduce(DataFrame.unionByName, parts).withColumn("bucket", F.col("__b").cast("int")).drop("__b")

    def _looked(self, wanted: DataFrame) -> DataFrame:
        """``wanted`` (column, bucket, split, role ...) with each value of its bucket in its split, and how often."""
        places = self.scratch.keep(wanted.select("column", "bucket").distinct())
        near = self.values().join(_small(places), ["column", "bucket"])
        counts = self.scratch.keep(near.groupBy("column", "bucket", SINCE, TESTED, "value").agg(F.count(F.lit(1)).alias("k")))
        inside = F.when(F.col(ROLE) == "train", F.col(SINCE) <= F.col(SPLIT)).otherwise(F.col(TESTED) == F.col(SPLIT))
        return counts.join(_small(wanted), ["column", "bucket"]).where(inside)

    def quantiles(self, probabilities: Sequence[float], names: Sequence[str]) -> DataFrame:
        """``split_id, role, column`` and the linearly interpolated quantiles."""
        by = ["column", SPLIT, ROLE]
        ranks = F.array(*[F.struct(F.lit(k).alias("rank_id"), e.cast("bigint").alias("rank")) for k, e in quantile_ranks(probabilities).items()])
        mine = F.filter(ranks, lambda r: (r["rank"] >= F.col("n_before")) & (r["rank"] < F.col("n_before") + F.col("n")))
        wanted = self.scratch.keep(self.cells.select(*by, "bucket", "n_before", "n_total", F.explode(mine).alias("r")).select(*by, "bucket", "n_before", "n_total", "r.*"))
        found = self._looked(self.scratch.keep(wanted.select(*by, "bucket", "n_before").distinct()))
        counts = found.groupBy(*by, "bucket", "n_before", "value").agg(F.sum("k").alias("k"))
        past = Window.partitionBy(*by, "bucket").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
        running = counts.withColumn("to", F.col("n_before") + F.sum("k").over(past)).select(*by, "bucket", "value", "to", "k")
        at = running.join(_small(wanted), [*by, "bucket"]).where((F.col("rank") >= F.col("to") - F.col("k")) & (F.col("rank") < F.col("to")))
        return interpolate(at, by, probabilities, names)

    def at_most(self, points: DataFrame) -> DataFrame:
        """``points`` (column, split, number, value) for each role: ``split_id, role, column, number, n``, rows with at most the value."""
        names = ["column", SPLIT, "number"]
        cut = self._placed(points)
        roles = F.explode(F.array(F.lit("train"), F.lit("test"))).alias(ROLE)
        wanted = self.scratch.keep(cut.select(*names, "bucket", F.col("value").alias("point"), roles))
        lower = self.cells.withColumnRenamed("bucket", "b").join(_small(wanted), ["column", SPLIT, ROLE]).where(F.col("b") < F.col("bucket"))
        whole = lower.groupBy(*names, ROLE).agg(F.sum("n").alias("whole"))
        part = self._looked(wanted).where(F.col("value") <= F.col("point")).groupBy(*names, ROLE).agg(F.sum("k").alias("part"))
        joined = wanted.join(whole, [*names, ROLE], "left").join(part, [*names, ROLE], "left")
        return joined.select(*names, ROLE, (F.coalesce("whole", F.lit(0)) + F.coalesce("part", F.lit(0))).alias("n"))


# --- what the splits' features look like ------------------------------------------------------------

def _statistics(windows: Windows, columns: Sequence[str]) -> DataFrame:
    """``split_id, role`` and for column i: rows, values, least, largest and sum (``n``, ``k_i``, ``lo_i``, ``hi_i``, ``sum_i``)."""
    values: dict[str, tuple[Column, str]] = {"n": (F.count(F.lit(1)), "sum")}
    for i, c in enumerate(columns):
        x = as_double(c)
        values |= {f"k_{i}": (F.count(x), "sum"), f"lo_{i}": (F.min(x), "min"), f"hi_{i}": (F.max(x), "max"), f"sum_{i}": (F.sum(x), "sum")}
    return windows.states(values)


def baseline(windows: Windows, label: str) -> DataFrame:
    """``split_id, role, baseline``: share of positive labels among those there are."""
    positive = column(label).cast("int")
    found = windows.states({"ones": (F.sum(positive), "sum"), "k": (F.count(positive), "sum")})
    return found.select(SPLIT, ROLE, F.try_divide(F.col("ones"), F.col("k")).alias("baseline"))


def scaled_summary(windows: Windows, columns: Sequence[str]) -> DataFrame:
    """``split_id, role, column, lo, hi, mean`` of columns scaled by the range of each split's training rows.

    Scaling is linear and rising, so it can be done to the states.
    """
    found = _statistics(windows, columns)
    out = None
    for i, name in enumerate(columns):
        train = found.where(F.col(ROLE) == "train").select(SPLIT, F.col(f"hi_{i}").alias("a"), F.col(f"lo_{i}").alias("b"))
        rows = found.join(F.broadcast(train), SPLIT)  # a row a split
        mean = F.try_divide(F.col(f"sum_{i}"), F.col(f"k_{i}"))
        part = rows.select(SPLIT, ROLE, F.lit(name).alias("column"), *[
            minmax(v, F.col("a"), F.col("b")).alias(n) for n, v in (("lo", F.col(f"lo_{i}")), ("hi", F.col(f"hi_{i}")), ("mean", mean))])
        out = part if out is None else out.unionByName(part)
    return out


def imputed_summary(windows: Windows, columns: Sequence[str], scratch: Scratch) -> DataFrame:
    """``split_id, role, column, n, n_filled, fill, total`` of columns filled by the median of their split and role."""
    found = _statistics(windows, columns)
    medians = scratch.keep(ValueMatrix(windows, columns, scratch).quantiles([0.5], ["fill"]))
    out = None
    for i, name in enumerate(columns):
        part = found.join(F.broadcast(medians.where(F.col("column") == name).select(SPLIT, ROLE, "fill")), [SPLIT, ROLE], "left").select(
            SPLIT, ROLE, F.lit(name).alias("column"), "n", (F.col("n") - F.col(f"k_{i}")).alias("n_filled"), "fill",
            (F.coalesce(F.col(f"sum_{i}"), F.lit(0.0)) + F.coalesce((F.col("n") - F.col(f"k_{i}")) * F.col("fill"), F.lit(0.0))).alias("total"))
        out = part if out is None else out.unionByName(part)
    return out


def fitted_edges(matrix: ValueMatrix, count: int) -> DataFrame:
    """``split_id, column, edges`` of equally filled bins of the training rows; equal edges are merged."""
    names = [f"e{i}" for i in range(count + 1)]
    found = matrix.quantiles([i / count for i in range(count + 1)], names).where(F.col(ROLE) == "train")
    return found.select(SPLIT, "column", F.array_distinct(F.array(*names)).alias("edges"))


def bin_counts(windows: Windows, name: str, count: int, scratch: Scratch) -> DataFrame:
    """``split_id, role, bin, n``: rows per bin fitted on each split's training rows, with open outer bins.

    Missing values have no bin, and no value has one where all training values are equal.
    """
    matrix = ValueMatrix(windows, [name], scratch)
    edges = scratch.keep(fitted_edges(matrix, count))
    inner = edges.select("column", SPLIT, F.size("edges").alias("k"), F.posexplode("edges").alias("number", "value")).where("number > 0 AND number < k - 1")
    below = matrix.at_most(inner.select("column", SPLIT, "number", "value"))
    totals = windows.states({"n": (F.count(F.lit(1)), "sum"), "k": (F.count(as_double(name)), "sum")})
    sized = totals.join(F.broadcast(edges.select(SPLIT, (F.size("edges") - 1).alias("last"))), SPLIT)
    ends = below.select(SPLIT, ROLE, F.col("number").alias("bin"), F.col("n").alias("upto")).unionByName(
        sized.select(SPLIT, ROLE, F.col("last").alias("bin"), F.col("k").alias("upto")))
    order = Window.partitionBy(SPLIT, ROLE).orderBy("bin")  # a row a bin
    bins = ends.select(SPLIT, ROLE, "bin", (F.col("upto") - F.coalesce(F.lag("upto").over(order), F.lit(0))).alias("n"))
    missing = sized.select(SPLIT, ROLE, F.lit(None).cast("int").alias("bin"), (F.col("n") - F.col("k")).alias("n"))
    every = bins.withColumn("bin", F.when(F.col("bin") > 0, F.col("bin"))).unionByName(missing)
    return every.groupBy(SPLIT, ROLE, "bin").agg(F.sum("n").alias("n")).where("n > 0")


def occurrence_summary(windows: Windows, name: str) -> DataFrame:
    """``split_id, role, total, most``: sum and largest of the rows' occurrence counts.

    Training rows count training rows, test rows count both. A value's count is a step function of the split; a step from
    p to p + d adds (p + d)^2 - p^2 to the total from its split on.
    """
    known = windows.rows.where(column(name).isNotNull())
    counts = known.groupBy(column(name).alias("value"), SINCE, TESTED).agg(F.count(F.lit(1)).alias("n"))
    begun = counts.where(F.col(SINCE).isNotNull()).select("value", F.col(SINCE).alias(SPLIT), F.col("n").alias("d"), F.lit(0).cast("bigint").alias("t"))
    seen = counts.where(F.col(TESTED).isNotNull()).select("value", F.col(TESTED).alias(SPLIT), F.lit(0).cast("bigint").alias("d"), F.col("n").alias("t"))
    steps = begun.unionByName(seen).groupBy("value", SPLIT).agg(F.sum("d").alias("d"), F.sum("t").alias("t"))
    past = Window.partitionBy("value").orderBy(SPLIT).rowsBetween(Window.unboundedPreceding, 0)  # two rows a split at most
    running = steps.withColumn("r", F.sum("d").over(past))
    both = F.col("r") + F.col("t")
    parts = running.groupBy(SPLIT).agg(
        F.sum(F.col("r") * F.col("r") - (F.col("r") - F.col("d")) * (F.col("r") - F.col("d"))).alias("train_total"), F.max(F.when(F.col("d") > 0, F.col("r"))).alias("train_most"),
        F.sum(F.col("t") * both).alias("test_total"), F.max(F.when(F.col("t") > 0, both)).alias("test_most"))
    ids = windows.rows.sparkSession.createDataFrame([(s,) for s in windows.splits], f"{SPLIT} int")
    upto = Window.partitionBy(F.lit(0)).orderBy(SPLIT).rowsBetween(Window.unboundedPreceding, 0)  # a row a split
    train = ids.join(parts, SPLIT, "left").select(
        SPLIT, F.lit("train").alias(ROLE), F.sum("train_total").over(upto).cast("bigint").alias("total"), F.max("train_most").over(upto).alias("most"))
    test = parts.select(SPLIT, F.lit("test").alias(ROLE), F.col("test_total").cast("bigint").alias("total"), F.col("test_most").alias("most"))
    return train.unionByName(test).where(F.col("most").isNotNull())
