"""Train a grid of specifications over temporal splits and evaluate it in one table."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import Future, ThreadPoolExecutor
from functools import reduce

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.functions import column, numeric_columns
from quillon.operators.evaluate import THRESHOLDS, evaluate_classifier
from quillon.operators.features import category_values, sparse_encoder
from quillon.operators.models import FEATURES, SCORE, generate_classifier, predict_target_probability
from quillon.operators.specs import spec_label
from quillon.operators.splits import ROLE, SPLIT, test_rows, train_rows
from quillon.operators.windows import SINCE, TESTED, Windows
from quillon.session import Scratch


def score_grid(
    windows: Windows, specs: Sequence[Mapping], label: str, key: str, categorical: Sequence[str],
    parallelism: int = 4, features: Callable[[DataFrame], DataFrame] | None = None, scratch: Scratch | None = None,
) -> DataFrame:
    """Scores of every specification on every test set: ``model_id, model, split_id, key, score, label``.

    Each row is written once, in the folder of its window; a split reads the windows before its boundary. ``features``
    turns the rows of one split (with ``split_id`` and ``role``) into features; its result is cached, as it may take joins. Without it
    the stored rows are the features: each step reads the windows and columns it needs, nothing is copied a split, and
    categories are counted once by window for all splits.
    Encoders are fitted on the split's own training rows. As in Spark's cross validation, a few fits run side by side, each a distributed job.
    """
    scratch = scratch or Scratch(windows.rows.sparkSession)
    stored = windows.kept(scratch)
    counts = None
    if categorical and not features:
        values = Windows(category_values(stored.rows, categorical, SINCE, TESTED), stored.splits)
        counts = scratch.keep(values.states({"n": (F.count(F.lit(1)), "sum")}, ["i", "v"]).where(F.col(ROLE) == "train"))
    keep = [column(key), column(label).cast("int").alias(label), FEATURES]

    def prepare(split: int) -> tuple[list[DataFrame], DataFrame, DataFrame]:
        rows = stored.split(split)
        ready = features(rows).persist() if features else rows
        numeric = [c for c in numeric_columns(ready, booleans=True) if c not in (key, label, SPLIT)]
        numeric += [f.name for f in ready.schema.fields if isinstance(f.dataType, VectorUDT)]  # wide dummies
        encoder = sparse_encoder(train_rows(ready, split), categorical, numeric, counts=counts.where(F.col(SPLIT) == split) if counts else None)
        train = encoder.transform(train_rows(ready, split)).select(*keep).persist()
        return [train, *[ready] * bool(features)], train, encoder.transform(test_rows(ready, split)).select(*keep)

    def fit_and_score(split: int, train: DataFrame, test: DataFrame, number: int, spec: Mapping) -> DataFrame:
        model = generate_classifier(train, spec, label, key)
        scored = predict_target_probability(model, test)
        return scratch.keep(scored.select(
            F.lit(number).alias("model_id"), F.lit(spec_label(spec, number)).alias("model"), F.lit(split).alias(SPLIT),
            column(key), column(SCORE).cast("double").alias(SCORE), column(label)))

    pieces = []
    with ThreadPoolExecutor(parallelism) as pool:
        started = []
        for split in stored.usable():
            cached, train, test = prepare(split)
            fits = [pool.submit(fit_and_score, split, train, test, n, spec) for n, spec in enumerate(specs, start=1)]
            started.append((cached, fits))
            if len(started) > 1:  # at most two splits stay cached
                pieces += _finish(*started.pop(0))
        for cached, fits in started:
            pieces += _finish(cached, fits)
    if not pieces:
        raise ValueError("no split has both training and test rows")
    return reduce(DataFrame.unionByName, pieces)


def _finish(cached: list[DataFrame], fits: list[Future]) -> list[DataFrame]:
    scored = [fit.result() for fit in fits]
    for table in cached:
        table.unpersist()
    return scored


def evaluate_grid(
    scores: DataFrame, label: str, key: str, thresholds: Sequence[float] = THRESHOLDS, tie_breaker: str = "random",
    seed: int = 0,
) -> DataFrame:
    """All metrics of all models on all splits, computed together: no loop over models."""
    return evaluate_classifier(
        scores, SCORE, label, thresholds, key, tie_breaker, seed, by=["model_id", "model", SPLIT])
