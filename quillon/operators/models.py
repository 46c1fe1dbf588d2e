"""Classifiers from specifications, trained with ``pyspark.ml`` or with Spark jobs of their own."""

from __future__ import annotations

import warnings
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LinearSVC,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.functions import column
from quillon.operators.boosting import fit_boosted_stumps
from quillon.operators.knn import NearestNeighbours
from quillon.operators.specs import parameters

FEATURES, LABEL, SCORE = "features", "label", "score"
DEEPEST_TREE = 30  # the deepest tree Spark grows
BINS = 32
ROWS_PER_TASK = 50_000  # of a fit by gradients


@dataclass
class Classifier:
    """A trained model: ``score(rows)`` appends the positive-class score column."""

    model_type: str
    _score: Callable[[DataFrame], DataFrame]

    def score(self, rows: DataFrame) -> DataFrame:
        return self._score(rows)


def _depth(value: int | None) -> int:
    if value is not None and int(value) > DEEPEST_TREE:
        warnings.warn(f"Spark grows trees of at most {DEEPEST_TREE} levels; {value} were asked for", stacklevel=3)
    return DEEPEST_TREE if value is None else min(int(value), DEEPEST_TREE)


def _with_score(model, score: Column) -> Callable[[DataFrame], DataFrame]:
    extra = ("rawPrediction", "probability", "prediction")
    return lambda rows: model.transform(rows).withColumn(SCORE, score).drop(*extra)


def _probability() -> Column:
    """Probability of the positive class; zero from a model that never saw one."""
    return F.coalesce(F.get(vector_to_array(F.col("probability")), 1), F.lit(0.0))


def _common(label: str) -> dict:
    return {"featuresCol": FEATURES, "labelCol": label}


def _prepared(train: DataFrame, label: str) -> DataFrame:
    return train.withColumn(label, column(label).cast("double"))


def _gathered(train: DataFrame, label: str) -> tuple[DataFrame, int]:
    """Training rows for a fit by gradients, in no more parts than their number asks for, and that number.

    Such a fit runs a job for every step, some hundred of them. With a few thousand rows a part a step would be mostly the starting of tasks,
    and of a second stage that adds up their sums.
    """
    n = train.count()
    return _prepared(train, label).coalesce(max(1, -(-n // ROWS_PER_TASK))), n


def _tree(train, label, key, spec):
    p = parameters(spec, {"criterion": "gini", "max_depth": None, "min_samples_leaf": 1, "random_state": 0})
    model = DecisionTreeClassifier(
        **_common(label), impurity=p["criterion"], maxDepth=_depth(p["max_depth"]),
        minInstancesPerNode=p["min_samples_leaf"], seed=p["random_state"], maxBins=BINS,
    ).fit(_prepared(train, label))
    return _with_score(model, _probability())


def _forest(train, label, key, spec):
    p = parameters(spec, {"criterion": "gini", "max_depth": None, "n_estimators": 10, "max_features": "sqrt",
                          "min_samples_leaf": 1, "random_state": 0})
    return _grow(train, label, p, p["max_features"])


def _bagging(train, label, key, spec):
    """Bagged trees; ``base_estimator`` may hold the tree's own parameters."""
    base = {k: v for k, v in dict(spec.get("base_estimator") or {}).items() if k != "model"}
    spec = {**base, **{k: v for k, v in spec.items() if k != "base_estimator"}}
    p = parameters(spec, {"criterion": "gini", "max_depth": None, "n_estimators": 10, "max_samples": 1.0,
                          "min_samples_leaf": 1, "random_state": 0})
    return _grow(train, label, p, "all", p["max_samples"])


def _grow(train, label, p, subset, rate=1.0):
    model = RandomForestClassifier(
        **_common(label), impurity=p["criterion"], maxDepth=_depth(p["max_depth"]), numTrees=p["n_estimators"],
        featureSubsetStrategy=str(subset), subsamplingRate=rate, minInstancesPerNode=p["min_samples_leaf"],
        seed=p["random_state"], bootstrap=True, maxBins=BINS,
    ).fit(_prepared(train, label))
    return _with_score(model, _probability())


def _logistic(train, label, key, spec):
    p = parameters(spec, {"penalty": "l2", "C": 1.0, "max_iter": 100, "tol": 1e-4, "fit_intercept": True})
    if p["penalty"] not in ("l1", "l2"):
        raise ValueError("penalty must be 'l1' or 'l2'")
    rows, n = _gathered(train, label)
    model = LogisticRegression(
        **_common(label), regParam=1.0 / (p["C"] * max(n, 1)),
        elasticNetParam=1.0 if p["penalty"] == "l1" else 0.0, maxIter=p["max_iter"], tol=p["tol"],
        fitIntercept=p["fit_intercept"], standardization=False, family="binomial",
    ).fit(rows)
    return _with_score(model, _probability())


def _svc(train, label, key, spec):
    p = parameters(spec, {"C": 1.0, "max_iter": 1000, "tol": 1e-4, "fit_intercept": True})
    rows, n = _gathered(train, label)
    model = LinearSVC(
        **_common(label), regParam=1.0 / (p["C"] * max(n, 1)), maxIter=p["max_iter"], tol=p["tol"],
        fitIntercept=p["fit_intercept"], standardization=False,
    ).fit(rows)
    return _with_score(model, vector_to_array(F.col("rawPrediction"))[1])


def _boosting(train, label, key, spec):
    p = parameters(spec, {"n_estimators": 50, "learning_rate": 1.0, "random_state": 0})
    return fit_boosted_stumps(
        train, FEATURES, label, p["n_estimators"], p["learning_rate"], p["random_state"], SCORE)


def _neighbours(train, label, key, spec):
    p = parameters(spec, {"n_neighbors": 5})
    searcher = NearestNeighbours(train, key, FEATURES, label, p["n_neighbors"])
    return lambda rows: searcher.score(rows, SCORE)


def _dummy(train, label, key, spec):
    p = parameters(spec, {"strategy": "stratified", "random_state": 0, "constant": None})
    share = train.agg(F.avg(column(label).cast("double")).alias("p")).first().p or 0.0
    strategy = p["strategy"]
    uniform = F.pmod(F.xxhash64(F.lit(p["random_state"]), column(key)), F.lit(1 << 30)) / float(1 << 30)
    scores = {
        "most_frequent": F.lit(1.0 if share > 0.5 else 0.0),
        "prior": F.lit(float(share)),
        "stratified": (uniform < share).cast("double"),
        "uniform": F.lit(0.5),
        "constant": F.lit(float(p["constant"] or 0)),
    }
    if strategy not in scores:
        raise ValueError(f"unknown strategy {strategy!r}")
    return lambda rows: rows.withColumn(SCORE, scores[strategy])


TRAINERS = {
    "dt": _tree, "lr": _logistic, "knn": _neighbours, "svc": _svc, "rf": _forest, "boosting": _boosting,
    "bagging": _bagging, "dummy": _dummy,
}


def generate_classifier(train: DataFrame, spec: Mapping, label: str = LABEL, key: str = "key") -> Classifier:
    """Train the model a specification describes on rows with a ``features`` vector.

    Types: dt, lr, knn, svc, rf, boosting, bagging, dummy. Parameters that are not given have the
    usual library defaults (trees as deep as possible, C = 1, 5 neighbours, 10 trees, 50 rounds).
    """
    kind = spec.get("model")
    if kind not in TRAINERS:
        raise ValueError(f"unknown model type {kind!r}")
    return Classifier(kind, TRAINERS[kind](train, label, key, spec))


def generate_classifiers(train: DataFrame, specs: list[Mapping], label: str = LABEL, key: str = "key") -> list[Classifier]:
    """Train every specification on the same rows."""
    return [generate_classifier(train, spec, label, key) for spec in specs]


def predict_target_probability(model: Classifier, rows: DataFrame) -> DataFrame:
    """Append ``score``: the positive-class probability, or the decision value of a support vector machine."""
    return model.score(rows)


def generate_decision_tree(train: DataFrame, label: str = LABEL, spec: Mapping | None = None) -> Classifier:
    """A single decision tree, by default fully grown."""
    return generate_classifier(train, {"model": "dt", **(spec or {})}, label)


def score_decision_tree(model: Classifier, rows: DataFrame, label: str = LABEL) -> DataFrame:
    """Accuracy of the classes a model gives (score above one half), as a one-row table."""
    said = (model.score(rows).withColumn("__said", (F.col(SCORE) > 0.5).cast("double")))
    return said.agg(F.avg((F.col("__said") == column(label).cast("double")).cast("int")).alias("accuracy"))
