"""AdaBoost of stumps in its real-valued form (Zhu, Zou, Rosset and Hastie, 2009) for two classes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.functions import column
from quillon.session import materialize

SMALLEST_PROBABILITY = 2.220446049250313e-16
ROUNDS_PER_CHECKPOINT = 10


def _log_odds() -> Column:
    positive = F.coalesce(F.get(vector_to_array(F.col("probability")), 1), F.lit(0.0))
    p = F.least(F.greatest(positive, F.lit(SMALLEST_PROBABILITY)), F.lit(1 - SMALLEST_PROBABILITY))
    return F.log(p / (1 - p))


def _without_outputs(df: DataFrame) -> DataFrame:
    return df.drop("rawPrediction", "probability", "prediction")


def fit_boosted_stumps(
    train: DataFrame, features: str, label: str, rounds: int, learning_rate: float, seed: int, out: str,
) -> Callable[[DataFrame], DataFrame]:
    """Fit up to ``rounds`` stumps; each round lowers the weight of rows the last one got right.

    Row weights live in a column and never leave the executors: a round is one weighted tree fit and
    one small aggregation. The lineage is cut every few rounds.
    """
    rows = train.select(
        column(features).alias("features"), column(label).cast("double").alias("label"), F.lit(1.0).alias("weight"))
    stumps = []
    for i in range(rounds):
        stump = DecisionTreeClassifier(
            featuresCol="features", labelCol="label", weightCol="weight", maxDepth=1, seed=seed + i).fit(rows)
        stumps.append(stump)
        scored = stump.transform(rows)
        sign = 2.0 * F.col("label") - 1.0
        factor = F.exp(-0.5 * learning_rate * sign * _log_odds())
        right = F.col("weight") * (F.col("prediction") == F.col("label")).cast("double")
        totals = scored.agg(
            F.sum("weight").alias("all"), F.sum(right).alias("right"), F.sum(F.col("weight") * factor).alias("next"),
            F.count(F.lit(1)).alias("n")).first()
        if not totals.n or totals.right >= totals["all"] or not totals.next or i == rounds - 1:
            break  # nothing left to learn
        scale = totals.n / totals.next
        weighted = _without_outputs(scored.withColumn("weight", F.col("weight") * factor * scale))
        if (i + 1) % ROUNDS_PER_CHECKPOINT == 0:
            weighted = materialize(weighted)
        # a round reads its rows several times: kept until the next round has its own
        weighted = weighted.persist()
        weighted.count()
        rows.unpersist()
        rows = weighted
    rows.unpersist()

    def score(frame: DataFrame) -> DataFrame:
        scored = frame.withColumn("__sum", F.lit(0.0))
        for stump in stumps:
            scored = stump.transform(scored)
            scored = _without_outputs(scored.withColumn("__sum", F.col("__sum") + _log_odds()))
        mean = F.col("__sum") / max(len(stumps), 1)
        return scored.withColumn(out, 1.0 / (1.0 + F.exp(-mean))).drop("__sum")

    return score
