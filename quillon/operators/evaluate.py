"""Top-k predictions with explicit tie policies, and the metrics built on them.

Nothing here sorts a whole test set. The cut-off score of every threshold is an order statistic, and
the rows tied at it are ranked among themselves only where the tie policy asks for it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.functions import column
from quillon.operators.params import attach, bounded_or_lazy
from quillon.operators.ranks import (
    add_hash_bucket,
    add_value_bucket,
    distinct_counts,
    interpolate,
    quantile_ranks,
    values_at_ranks,
)
from quillon.session import materialize

TIE_BREAKERS = ("random", "pessimistic", "optimistic")
# The shares of the test set whose top scores count as positive.
THRESHOLDS = [0.01, 0.02, 0.05, 0.10, 0.20, 0.30, 0.50]
CURVE_POINTS = 33
CURVE_START = 0.01


def _scored(scores: DataFrame, by: Sequence[str], score: str, label: str | None, key: str | None = None, keep: bool = True) -> DataFrame:
    """Common column names, scores as doubles, labels as 0/1; rows without a score are left out.

    Steps that read these few columns several times ``keep`` them, so that they are computed once.
    """
    columns = [*map(column, by), column(score).cast("double").alias("s")]
    if label is not None:
        columns.append(F.coalesce(column(label).cast("int"), F.lit(0)).alias("pos"))
    if key is not None:
        columns.append(column(key).alias("k"))
    found = scores.select(*columns).dropna(subset=[*by, "s"])
    return materialize(found) if keep else found


def _positives(threshold: float) -> Column:
    """Number of rows to predict as positive: the share of the rows, rounded down, in doubles."""
    return F.floor(F.lit(float(threshold)) * F.col("n_total").cast("double")).cast("bigint")


def _cuts(scored: DataFrame, by: list[str], thresholds: Sequence[float], measures: Sequence[str]) -> DataFrame:
    """Per (group, threshold): the k-th highest score and the counts above, at and below it."""
    ranks = {repr(float(t)): F.col("n_total") - _positives(t) for t in thresholds}
    found = values_at_ranks(add_value_bucket(scored, "s"), by, "s", ranks, measures)
    above = F.col("n_total") - F.col("n_below") - F.col("n_equal")
    return found.select(
        *by, F.col("rank_id").cast("double").alias("threshold"), F.col("value").alias("cut"), "n_total", "n_equal",
        *[c for m in measures for c in (f"{m}_total", f"{m}_equal")],
        above.alias("n_above"), (F.col("n_total") - F.col("rank") - above).alias("slots"),
        *[(F.col(f"{m}_total") - F.col(f"{m}_below") - F.col(f"{m}_equal")).alias(f"{m}_above") for m in measures],
    )


def _tie_order(tie_breaker: str, seed: int) -> tuple[Column, Column]:
    """The class that goes first among tied rows, and the hash that orders rows within a class."""
    if tie_breaker not in TIE_BREAKERS:
        raise ValueError(f"tie_breaker must be one of {TIE_BREAKERS}")
    first = {"random": F.lit(0), "pessimistic": F.col("pos"), "optimistic": 1 - F.col("pos")}[tie_breaker]
    return first, F.xxhash64(F.lit(seed).cast("bigint"), F.col("k"))


def _tied_rows(scored: DataFrame, cuts: DataFrame, by: list[str], tie_breaker: str, seed: int) -> DataFrame:
    """Rows whose score equals some cut, with a unique place among the rows tied with them."""
    distinct_cuts = cuts.select(*by, F.col("cut").alias("s")).distinct()
    first, hashed = _tie_order(tie_breaker, seed)
    tied = scored.join(distinct_cuts, [*by, "s"], "left_semi") if by else scored.join(distinct_cuts, "s", "left_semi")
    placed = tied.withColumn("h", hashed).withColumn("place", F.struct(first.alias("c"), F.col("h"), F.col("k")))
    return add_hash_bucket(placed, F.col("place.c"), F.col("h"))


def _open(cuts: DataFrame) -> DataFrame:
    """The cuts at which some of the tied rows count and some don't."""
    return cuts.where((F.col("slots") > 0) & (F.col("slots") < F.col("n_equal")))


def _last_places(scored, cuts, by, tie_breaker, seed, measures=()) -> DataFrame:
    """Per (group, threshold): the place of the last tied row still predicted positive."""
    wanted = _open(cuts).select(
        *by, F.col("cut").alias("s"), F.col("threshold").alias("rank_id"), (F.col("slots") - 1).alias("rank"))
    tied = _tied_rows(scored, cuts, by, tie_breaker, seed)
    found = values_at_ranks(tied, [*by, "s"], "place", wanted, measures)
    return found.withColumnRenamed("rank_id", "threshold")


def predict_target_class(
    scores: DataFrame, key: str, score: str, threshold: float, tie_breaker: str = "random", label: str | None = None,
    seed: int = 0, by: Sequence[str] = (), out: str = "prediction",
) -> DataFrame:
    """Mark exactly ``floor(threshold * rows)`` rows per group as positive, the highest scores first.

    Rows tied at the cut are chosen by a seeded hash of ``key`` ('random'), true negatives first
    ('pessimistic') or true positives first ('optimistic'), by hash within a class.
    """
    if tie_breaker != "random" and label is None:
        raise ValueError(f"the {tie_breaker} tie breaker needs the label column")
    # the caller's columns may have any name, those of the helper columns too
    safe = {c: f"in_{i}" for i, c in enumerate(scores.columns)}
    marked = _mark_positives(
        materialize(scores.toDF(*safe.values())), safe[key], safe[score], threshold, tie_breaker, safe[label] if label is not None else None, seed,
        [safe[c] for c in by])
    return marked.select(*[F.col(s).alias(c) for c, s in safe.items() if c != out], F.col("chosen").alias(out))


def _mark_positives(
    scores: DataFrame, key: str, score: str, threshold: float, tie_breaker: str, label: str | None, seed: int, by: list[str],
) -> DataFrame:
    scored = _scored(scores, by, score, label, key, keep=False)  # of rows that are kept already
    cuts, _ = bounded_or_lazy(_cuts(scored, by, [threshold], []))
    if _open(cuts).isEmpty():
        last = scored.limit(0).select(
            *by, F.lit(0.0).alias("threshold"), F.lit(0).alias("__c"), F.lit(0).cast("bigint").alias("__h"), F.col("k").alias("__k"))
    else:
        last = _last_places(scored, cuts, by, tie_breaker, seed).select(
            *by, "threshold", F.col("value.c").alias("__c"), F.col("value.h").alias("__h"), F.col("value.k").alias("__k"))
    limits = cuts.join(last, [*by, "threshold"], "left").select(
        *by, F.col("cut").alias("__cut"), F.col("slots").alias("__slots"), F.col("n_equal").alias("__equal"),
        "__c", "__h", "__k")
    rows = attach(scores, by, limits).withColumn("k", column(key))
    if label is not None:
        rows = rows.withColumn("pos", F.coalesce(column(label).cast("int"), F.lit(0)))
    s = column(score).cast("double")
    first, hashed = _tie_order(tie_breaker, seed)
    place = F.struct(first.alias("c"), hashed.alias("h"), F.col("k"))
    last_place = F.struct(F.col("__c").alias("c"), F.col("__h").alias("h"), F.col("__k").alias("k"))
    early = F.col("__k").isNotNull() & (place <= last_place)
    tied = (F.col("__slots") >= F.col("__equal")) | early
    chosen = F.coalesce((s > F.col("__cut")) | ((s == F.col("__cut")) & tied), F.lit(False))
    return rows.select(*[column(c) for c in scores.columns], chosen.alias("chosen"))


def _ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def _threshold_metrics(counts: DataFrame, by: list[str]) -> DataFrame:
    """Accuracy, precision, recall and F1 from ``tp, predicted, p, n``: one row per metric."""
    tp, predicted, p, n = (F.col(c) for c in ("tp", "predicted", "p", "n"))
    metrics = {
        "accuracy": F.try_divide((tp + (n - p) - (predicted - tp)).cast("double"), n.cast("double")),
        "precision": _ratio(tp, predicted),
        "recall": _ratio(tp, p),
        "f1": _ratio(2 * tp, predicted + p),
    }
    return counts.select(*by, "threshold", *[v.alias(m) for m, v in metrics.items()]).unpivot(
        [*by, "threshold"], list(metrics), "metric", "value")


def topk_counts(
    scores: DataFrame, thresholds: Sequence[float], score: str, label: str, key: str | None = None,
    tie_breaker: str = "random", seed: int = 0, by: Sequence[str] = (),
) -> DataFrame:
    """Per (group, threshold): rows ``n``, true positives ``p``, predicted positives and hits ``tp``.

    For the pessimistic and optimistic policies the number of tied rows of each class decides, so no
    row has to be ranked.
    """
    return _topk_counts(_scored(scores, by, score, label, key), thresholds, key, tie_breaker, seed, list(by))


def _topk_counts(scored, thresholds, key, tie_breaker, seed, by: list[str]) -> DataFrame:
    if tie_breaker not in TIE_BREAKERS:
        raise ValueError(f"tie_breaker must be one of {TIE_BREAKERS}")
    cuts, _ = bounded_or_lazy(_cuts(scored, by, thresholds, ["pos"]))
    negatives = F.col("n_equal") - F.col("pos_equal")
    if tie_breaker == "optimistic":
        hits = cuts.withColumn("tied_tp", F.least("slots", "pos_equal"))
    elif tie_breaker == "pessimistic":
        hits = cuts.withColumn("tied_tp", F.greatest(F.lit(0), F.col("slots") - negatives))
    else:
        if key is None:
            raise ValueError("the random tie breaker needs the key column")
        last = _last_places(scored, cuts, by, tie_breaker, seed, ["pos"]).select(
            *by, "threshold", (F.col("pos_below") + F.col("pos_equal")).alias("tied_tp"))
        hits = cuts.join(last, [*by, "threshold"], "left").withColumn(
            "tied_tp", F.coalesce("tied_tp", F.col("pos_equal")))
    found = hits.select(
        *by, "threshold", (F.col("n_above") + F.col("slots")).alias("predicted"),
        (F.col("pos_above") + F.col("tied_tp")).alias("tp"))
    # a threshold that selects no row has no cut: it is still reported
    sizes = scored.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.sum("pos").cast("bigint").alias("p"))
    every = sizes.withColumn("threshold", F.explode(F.array(*[F.lit(float(t)) for t in thresholds])))
    return every.join(found, [*by, "threshold"], "left").select(
        *by, "threshold", "n", "p", F.coalesce("predicted", F.lit(0)).alias("predicted"),
        F.coalesce("tp", F.lit(0)).alias("tp"))


def auc_roc(scores: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC curve per group, exact with ties; missing when only one class occurs."""
    return _auc(_scored(scores, by, score, label, keep=False), list(by))


def _auc(scored: DataFrame, by: list[str]) -> DataFrame:
    counts = distinct_counts(scored, by, "s", ["pos"])
    negatives_below = (F.col("n_below") - F.col("pos_below")).cast("double")
    negatives_equal = (F.col("n_equal") - F.col("pos_equal")).cast("double")
    wins = F.sum(F.col("pos_equal") * (negatives_below + negatives_equal / 2))
    pairs = F.max("pos_total").cast("double") * (F.max("n_total") - F.max("pos_total")).cast("double")
    return counts.groupBy(*by).agg(F.try_divide(wins, pairs).alias("auc_roc"))


def evaluate_classifier(
    scores: DataFrame, score: str, label: str, thresholds: Sequence[float] = THRESHOLDS, key: str | None = None,
    tie_breaker: str = "random", seed: int = 0, by: Sequence[str] = (),
) -> DataFrame:
    """Long table ``by..., metric, threshold, value``.

    Accuracy, precision, recall and F1 of the top share at each threshold, ``auc_roc`` of the scores,
    and ``auc_at_last_threshold``, the area when only the classes at the last threshold are known.
    """
    by = list(by)
    scored = _scored(scores, by, score, label, key)
    counts = _topk_counts(scored, thresholds, key, tie_breaker, seed, by)
    none = F.lit(None).cast("double")
    auc = _auc(scored, by).select(
        *by, none.alias("threshold"), F.lit("auc_roc").alias("metric"), F.col("auc_roc").alias("value"))
    tpr = F.try_divide(F.col("tp").cast("double"), F.col("p").cast("double"))
    fpr = F.try_divide((F.col("predicted") - F.col("tp")).cast("double"), (F.col("n") - F.col("p")).cast("double"))
    at_last = counts.where(F.col("threshold") == float(thresholds[-1])).select(
        *by, none.alias("threshold"), F.lit("auc_at_last_threshold").alias("metric"),
        ((tpr + 1 - fpr) / 2).alias("value"))
    return _threshold_metrics(counts, by).unionByName(auc).unionByName(at_last)


def curve_thresholds(resolution: int = CURVE_POINTS) -> list[float]:
    """Evenly spaced shares from 1 % to all rows."""
    step = (1 - CURVE_START) / (resolution - 1)
    return [CURVE_START + i * step for i in range(resolution - 1)] + [1.0]


def precision_recall_at_shares(
    scores: DataFrame, score: str, label: str, resolution: int = CURVE_POINTS, key: str | None = None,
    tie_breaker: str = "random", seed: int = 0, by: Sequence[str] = (),
) -> DataFrame:
    """Precision and recall against the share of rows predicted positive: ``by..., threshold, precision, recall``."""
    counts = topk_counts(scores, curve_thresholds(resolution), score, label, key, tie_breaker, seed, by)
    return counts.select(
        *by, "threshold", _ratio(F.col("tp"), F.col("predicted")).alias("precision"),
        _ratio(F.col("tp"), F.col("p")).alias("recall"))


def quantile_metrics(
    scores: DataFrame, score: str, label: str, thresholds: Sequence[float] = THRESHOLDS, by: Sequence[str] = (),
) -> DataFrame:
    """The same metrics when every row at or above the interpolated quantile counts as positive."""
    by = list(by)
    scored = add_value_bucket(_scored(scores, by, score, label), "s")
    probabilities = [1 - float(t) for t in thresholds]
    found, _ = bounded_or_lazy(values_at_ranks(scored, by, "s", quantile_ranks(probabilities), ["pos"]))
    names = [f"c{i}" for i in range(len(thresholds))]
    cuts = interpolate(found, by, probabilities, names).select(
        *by, F.posexplode(F.array(*names)).alias("i", "cut"))
    neighbours = found.select(*by, F.split_part("rank_id", F.lit(":"), F.lit(1)).cast("int").alias("i"),
                              "value", "n_total", "pos_total", "n_below", "pos_below")
    # the cut lies at or between two neighbouring values: the smallest value that reaches it decides
    reached = neighbours.join(cuts, [*by, "i"]).where(F.col("value") >= F.col("cut"))
    at = reached.groupBy(*by, "i").agg(
        F.min_by(F.struct("n_total", "pos_total", "n_below", "pos_below"), "value").alias("x")).select(
        *by, F.element_at(F.array(*[F.lit(float(t)) for t in thresholds]), F.col("i") + 1).alias("threshold"),
        F.col("x.n_total").alias("n"), F.col("x.pos_total").alias("p"),
        (F.col("x.n_total") - F.col("x.n_below")).alias("predicted"),
        (F.col("x.pos_total") - F.col("x.pos_below")).alias("tp"))
    return _threshold_metrics(at, by)


def fixed_class_metrics(predictions: DataFrame, prediction: str, label: str, thresholds: Sequence[float] = THRESHOLDS,
                        by: Sequence[str] = ()) -> DataFrame:
    """The same metrics for classes a model gave itself: equal at every threshold."""
    said, truth = column(prediction).cast("boolean"), column(label).cast("boolean")
    counts = predictions.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(truth).alias("p"), F.count_if(said).alias("predicted"),
        F.count_if(said & truth).alias("tp"))
    every = counts.withColumn("threshold", F.explode(F.array(*[F.lit(float(t)) for t in thresholds])))
    return _threshold_metrics(every, list(by))


def precision_recall_curve(scores: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """One point per distinct score: precision and recall of all rows scoring at least that much."""
    by = list(by)
    counts = distinct_counts(_scored(scores, by, score, label, keep=False), by, "s", ["pos"])
    predicted, tp = F.col("n_total") - F.col("n_below"), F.col("pos_total") - F.col("pos_below")
    return counts.select(*by, F.col("value").alias("score"), _ratio(tp, predicted).alias("precision"),
                         _ratio(tp, F.col("pos_total")).alias("recall"))


def results_table(metrics: DataFrame, split: str = "split_id", splits: Sequence[int] | None = None) -> DataFrame:
    """Metrics in rows, splits in columns."""
    keys = [c for c in metrics.columns if c not in (split, "value")]
    return metrics.groupBy(*keys).pivot(split, list(splits) if splits is not None else None).agg(F.first("value"))


def baseline(scores: DataFrame, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Share of positives per group: the precision of choosing rows blindly."""
    return scores.groupBy(*by).agg(F.avg(column(label).cast("int")).alias("baseline"))


def accuracy(predictions: DataFrame, prediction: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Share of rows whose prediction equals the label."""
    same = (column(prediction).cast("double") == column(label).cast("double")).cast("int")
    return predictions.groupBy(*by).agg(F.avg(same).alias("accuracy"))
