import math
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from quillon.operators import evaluate, ranks


def brute_top_k(rows, threshold, tie_breaker):
    """Predicted positives and hits of one group, ties broken by class."""
    k = math.floor(threshold * len(rows))
    order = {"pessimistic": 1, "optimistic": -1}[tie_breaker]
    chosen = sorted(rows, key=lambda r: (-r[0], order * r[1]))[:k]
    return k, sum(r[1] for r in chosen)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.tuples(st.integers(0, 4).map(float), st.integers(0, 1)), min_size=1, max_size=40),
    st.sampled_from(["pessimistic", "optimistic"]), st.booleans())
def test_top_k_counts_equal_brute_force(spark, monkeypatch, rows, tie_breaker, bucketed):
    if bucketed:
        monkeypatch.setattr(ranks, "SMALL_ROWS", -1)
        monkeypatch.setattr(ranks, "CUT_SAMPLE", 0.5)
    thresholds = [0.0, 0.1, 0.35, 0.5, 1.0]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id bigint, s double, y int")
    found = evaluate.topk_counts(df, thresholds, "s", "y", "id", tie_breaker).collect()
    assert {r.threshold: (r.predicted, r.tp) for r in found} == {t: brute_top_k(rows, t, tie_breaker) for t in thresholds}


@pytest.mark.parametrize("tie_breaker", evaluate.TIE_BREAKERS)
def test_predictions_mark_exactly_k_rows(spark, any_size, tie_breaker):
    rng = random.Random(3)
    rows = [(g, 100 * i + ord(g), float(rng.randint(0, 3)), rng.randint(0, 1)) for g in "ab" for i in range(37)]
    df = spark.createDataFrame(rows, "g string, id bigint, s double, y int")
    for threshold in (0.0, 0.2, 0.5, 1.0):
        out = evaluate.predict_target_class(df, "id", "s", threshold, tie_breaker, "y", seed=0, by=["g"]).collect()
        for g in "ab":
            mine = [r for r in out if r.g == g]
            chosen = [r for r in mine if r.prediction]
            assert len(mine) == 37 and len(chosen) == math.floor(threshold * 37)
            if chosen:
                cut = min(r.s for r in chosen)
                assert all(r.prediction for r in mine if r.s > cut)
            if tie_breaker != "random":
                expected = brute_top_k([(r.s, r.y) for r in mine], threshold, tie_breaker)[1]
                assert sum(r.y for r in chosen) == expected


def test_random_ties_follow_the_seed(spark, any_size):
    df = spark.createDataFrame([(i, 0.5, i % 2) for i in range(200)], "id bigint, s double, y int")

    def chosen(seed):
        rows = evaluate.predict_target_class(df, "id", "s", 0.25, seed=seed).where("prediction").collect()
        return {r.id for r in rows}

    assert len(chosen(0)) == 50 and chosen(0) == chosen(0) and chosen(0) != chosen(1)
    counts = evaluate.topk_counts(df, [0.25], "s", "y", "id", seed=1).first()
    assert (counts.predicted, counts.tp) == (50, sum(i % 2 for i in chosen(1)))


def test_policies_are_ordered(spark):
    rng = random.Random(5)
    df = spark.createDataFrame(
        [(i, float(rng.randint(0, 5)), rng.randint(0, 1)) for i in range(300)], "id bigint, s double, y int")

    def precision(policy):
        rows = evaluate.evaluate_classifier(df, "s", "y", [0.1, 0.3, 0.5], "id", policy).where("metric = 'precision'")
        return [r.value for r in rows.orderBy("threshold").collect()]

    for low, middle, high in zip(precision("pessimistic"), precision("random"), precision("optimistic")):
        assert low <= middle <= high


def test_metrics_of_degenerate_scores(spark):
    df = spark.createDataFrame([(i, 0.5, 0) for i in range(10)], "id bigint, s double, y int")
    found = {(r.metric, r.threshold): r.value
             for r in evaluate.evaluate_classifier(df, "s", "y", [0.05, 0.5], "id", "pessimistic").collect()}
    assert found["precision", 0.5] == 0 and found["recall", 0.5] == 0 and found["f1", 0.05] == 0
    assert found["accuracy", 0.05] == 1 and found["accuracy", 0.5] == 0.5
    assert found["auc_roc", None] is None and found["auc_at_last_threshold", None] is None


def test_auc_and_curve(spark, any_size):
    rows = [(0, 0.1, 0), (1, 0.4, 0), (2, 0.35, 1), (3, 0.8, 1), (4, 0.4, 1)]
    df = spark.createDataFrame(rows, "id bigint, s double, y int")
    wins = [1.0 if p > n else 0.5 if p == n else 0.0 for p in (0.35, 0.8, 0.4) for n in (0.1, 0.4)]
    assert evaluate.auc_roc(df, "s", "y").first().auc_roc == pytest.approx(sum(wins) / 6)
    curve = {r.score: (r.precision, r.recall) for r in evaluate.precision_recall_curve(df, "s", "y").collect()}
    assert curve[0.8] == (1, pytest.approx(1 / 3)) and curve[0.4] == (pytest.approx(2 / 3), pytest.approx(2 / 3))
    assert curve[0.1] == (pytest.approx(0.6), 1)


def test_quantile_metrics_count_all_ties(spark, any_size):
    df = spark.createDataFrame([(i, s, y) for i, (s, y) in enumerate([(1.0, 0), (2.0, 0), (2.0, 1), (3.0, 1)])],
                               "id bigint, s double, y int")
    found = {(r.metric, r.threshold): r.value for r in evaluate.quantile_metrics(df, "s", "y", [0.25, 0.5]).collect()}
    # the quantile at 1 - 0.25 lies between 2 and 3; the one at 0.5 is 2 and takes both tied rows
    assert found["precision", 0.25] == 1 and found["recall", 0.25] == 0.5
    assert found["precision", 0.5] == pytest.approx(2 / 3) and found["recall", 0.5] == 1


def test_small_helpers(spark):
    df = spark.createDataFrame([(1, True, 1), (1, False, 0), (2, True, 0)], "split_id int, said boolean, y int")
    assert {r.split_id: r.baseline for r in evaluate.baseline(df, "y", ["split_id"]).collect()} == {1: 0.5, 2: 0.0}
    assert evaluate.accuracy(df, "said", "y").first().accuracy == pytest.approx(2 / 3)
    fixed = evaluate.fixed_class_metrics(df, "said", "y", [0.1, 0.2])
    assert fixed.where("metric = 'recall'").count() == 2
    wide = evaluate.results_table(evaluate.fixed_class_metrics(df, "said", "y", [0.1], by=["split_id"]))
    assert set(wide.columns) == {"threshold", "metric", "1", "2"}
    points = evaluate.curve_thresholds()
    assert len(points) == 33 and points[0] == 0.01 and points[-1] == 1.0
    with pytest.raises(ValueError):
        evaluate.predict_target_class(df, "y", "y", 0.5, "optimistic")


def test_predictions_whatever_the_columns_are_called(spark):
    from quillon.operators.evaluate import predict_target_class

    for names in (("k", "pos", "s", "n"), ("s", "k", "pos", "value"), ("pos", "s", "k", "h"), ("n", "place", "cut", "k")):
        key, score, label, other = names
        frame = spark.createDataFrame([(i, float(i // 2), i % 2 == 0, f"x{i}") for i in range(10)], list(names))
        for tie in ("random", "pessimistic", "optimistic"):
            rows = predict_target_class(frame, key, score, 0.3, tie, label).orderBy(key).collect()
            assert [tuple(r)[:4] for r in rows] == [(i, float(i // 2), i % 2 == 0, f"x{i}") for i in range(10)]
            chosen = {r[key] for r in rows if r["prediction"]}
            assert {8, 9} <= chosen and len(chosen) == 3
            assert tie == "random" or (7 if tie == "pessimistic" else 6) in chosen
