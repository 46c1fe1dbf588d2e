import random

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from quillon.operators.boosting import fit_boosted_stumps
from quillon.operators.evaluate import auc_roc, baseline
from quillon.operators.knn import NearestNeighbours
from quillon.operators.models import (
    generate_classifier,
    generate_decision_tree,
    predict_target_probability,
    score_decision_tree,
)
from quillon.operators.specs import generate_iter_model_specs, parameters, spec_label
from quillon.plans import funding


@pytest.fixture(scope="module")
def separable(spark):
    rng = random.Random(0)
    rows = [(i, rng.random(), rng.random()) for i in range(400)]
    df = spark.createDataFrame([(i, a, b, int(a + b > 1)) for i, a, b in rows], "key bigint, a double, b double, label int")
    return VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df).select("key", "label", "features").persist()


SPECS = [
    {"model": "dt", "criterion": "entropy", "max_depth": 35}, {"model": "lr", "solver": "sag", "n_jobs": -1},
    {"model": "lr", "penalty": "l1"}, {"model": "svc", "C": 0.75, "max_iter": 20}, {"model": "rf", "max_depth": 5},
    {"model": "bagging", "n_estimators": 5, "max_depth": 5}, {"model": "boosting", "n_estimators": 10},
    {"model": "knn", "n_neighbors": 10}, {"model": "dummy", "strategy": "most_frequent"}]


@pytest.mark.parametrize("spec", SPECS, ids=lambda s: s["model"] + s.get("penalty", ""))
def test_every_model_type_beats_the_baseline(separable, spec):
    train, test = separable.where("key % 2 = 0"), separable.where("key % 2 = 1")
    scored = predict_target_probability(generate_classifier(train, spec), test)
    assert scored.columns == ["key", "label", "features", "score"] or set(scored.columns) == {"key", "label", "features", "score"}
    rows = scored.collect()
    assert len(rows) == 200
    if spec["model"] != "svc":
        assert all(0 <= r.score <= 1 for r in rows)
    area = auc_roc(scored, "score", "label").first().auc_roc
    assert area == 0.5 if spec["model"] == "dummy" else area > 0.8


def test_dummy_strategies(separable):
    share = baseline(separable, "label").first().baseline
    prior = generate_classifier(separable, {"model": "dummy", "strategy": "prior"}).score(separable)
    assert prior.first().score == pytest.approx(share)
    drawn = generate_classifier(separable, {"model": "dummy"}).score(separable)
    assert {r.score for r in drawn.collect()} == {0.0, 1.0}


def test_training_rows_of_one_class(separable):
    zeros = separable.where("label = 0")
    for kind in ("dt", "rf", "lr", "knn"):
        scored = generate_classifier(zeros, {"model": kind}).score(separable)
        assert scored.agg({"score": "max"}).first()[0] < 0.5


def test_decision_tree_accuracy(separable):
    tree = generate_decision_tree(separable)
    assert score_decision_tree(tree, separable).first().accuracy > 0.97


def test_boosting_equals_a_plain_implementation(spark):
    """Stumps over a feature with few values, so that Spark's candidate splits are all splits."""
    rng = random.Random(2)
    data = [(float(rng.randint(0, 9)), float(rng.randint(0, 9))) for _ in range(120)]
    labels = [int(x + y + rng.random() * 6 > 12) for x, y in data]
    df = VectorAssembler(inputCols=["x", "y"], outputCol="features").transform(
        spark.createDataFrame([(x, y, c) for (x, y), c in zip(data, labels)], "x double, y double, label int"))
    scored = fit_boosted_stumps(df, "features", "label", 4, 1.0, 0, "score")(df).select("x", "y", "score").collect()
    found = {(r.x, r.y): r.score for r in scored}

    v, c = np.array(data), np.array(labels)
    w, total = np.ones(len(c)), np.zeros(len(c))
    for _ in range(4):
        best = None
        for f in (0, 1):
            for cut in np.arange(0.5, 9):
                left = v[:, f] <= cut
                p = np.array([(w[s] * c[s]).sum() / w[s].sum() if s.any() else 0.0 for s in (left, ~left)])
                gini = sum(w[s].sum() * 2 * q * (1 - q) for s, q in zip((left, ~left), p))
                if best is None or gini < best[0] - 1e-9:
                    best = (gini, np.where(left, p[0], p[1]))
        p = np.clip(best[1], 2.2e-16, 1 - 2.2e-16)
        odds = np.log(p / (1 - p))
        total += odds
        w = w * np.exp(-0.5 * (2 * c - 1) * odds)
        w = w / w.mean()
    expected = 1 / (1 + np.exp(-total / 4))
    assert [found[tuple(row)] for row in v] == pytest.approx(list(expected), abs=1e-6)


@pytest.mark.parametrize("block_rows", [7, 1000])
def test_neighbours_equal_brute_force(spark, block_rows):
    rng = np.random.default_rng(4)
    train = np.vstack([rng.normal(size=(60, 3)), np.zeros((40, 3))])  # 40 identical rows
    test = np.vstack([rng.normal(size=(25, 3)), np.zeros((2, 3))])
    t = spark.createDataFrame([(i, v.tolist(), i % 3 == 0) for i, v in enumerate(train)], "id bigint, v array<double>, y boolean")
    q = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(test)], "id bigint, v array<double>")
    search = NearestNeighbours(t, "id", "v", "y", 6, pivots=5, block_rows=block_rows)
    found = {}
    for r in search.neighbours(q).orderBy("distance", "n_key").collect():
        found.setdefault(r.q_key, []).append(r.n_key)
    for i, v in enumerate(test):
        distance = np.sqrt(((train - v) ** 2).sum(axis=1))
        assert found[i] == sorted(range(100), key=lambda j: (distance[j], j))[:6]
    assert search.score(q).count() == 27


def test_fewer_training_rows_than_neighbours(spark):
    t = spark.createDataFrame([(0, [0.0], 1), (1, [1.0], 0)], "id bigint, v array<double>, y int")
    q = spark.createDataFrame([(5, [0.2])], "id bigint, v array<double>")
    assert NearestNeighbours(t, "id", "v", "y", 5).score(q).first().score == 0.5


def test_specifications():
    base = {"model": "dt", "criterion": "entropy"}
    specs = generate_iter_model_specs(base, "max_depth", range(5, 35, 5))
    assert specs == [{"model": "dt", "criterion": "entropy", "max_depth": d} for d in (5, 10, 15, 20, 25, 30)]
    assert base == {"model": "dt", "criterion": "entropy"}
    assert spec_label({"name": "x"}) == "x" and spec_label({}, 3) == "Model #3"
    assert parameters({"model": "lr", "n_jobs": -1, "solver": "sag"}, {"C": 1.0}) == {"C": 1.0}
    with pytest.raises(ValueError):
        parameters({"model": "lr", "speed": 1}, {"C": 1.0})


def test_unknown_model_type(separable):
    with pytest.raises(ValueError):
        generate_classifier(separable, {"model": "gbt"})


def test_pipeline_from_csv(spark, tmp_path):
    """The whole job on a small file: exploration tables, features per split, models, metrics."""
    rng = random.Random(9)
    names = [*funding.TEXTS, *funding.NUMBERS]
    lines = [",".join(names)]
    for i in range(240):
        row = {c: rng.choice("abc") for c in names}
        month = 1 + i % 12
        row |= {"projectid": f"p{i}", "date_posted": f"{2012 + i % 2}-{month:02d}-{1 + i % 27:02d}", "school_charter": rng.choice("tf"),
                "datefullyfunded": f"{2013 + i % 2}-{month:02d}-01" if i % 3 else f"{2012 + i % 2}-{month:02d}-28",
                "students_reached": str(rng.randint(1, 90)) if i % 7 else "", "total_price_including_optional_support": str(rng.random() * 1000),
                "school_latitude": "41.5", "school_longitude": "-87.1", "secondary_focus_area": "" if i % 4 else "x"}
        lines.append(",".join(row[c] for c in names))
    path = tmp_path / "projects.csv"
    path.write_text("\n".join(lines) + "\n")
    projects = funding.load_projects(spark, str(path))
    assert projects.where(F.col("not_fully_funded_60days")).count() > 0
    tables = funding.explore_data(projects, counted=["schoolid"], groups=[("school_metro",)], numbers=["students_reached"])
    assert tables["general"].first().n_projects == 240
    assert {r["column"]: r.n_missing for r in tables["missing"].collect()}["students_reached"] == sum(i % 7 == 0 for i in range(240))
    settings = {
        "n_ocurr_cols": ["schoolid"], "scale_cols": ["students_reached", "schoolid_n_occur"], "bin_cols": {},
        "dummy_cols": funding.CATEGORIES, "binary_cut_cols": {},
        "drop_cols": [*funding.UNUSED, "daystofullfunding", "datefullyfunded"]}
    metrics = funding.apply_pipeline(
        projects, {"methods": {"secondary_focus_area": "manual"}, "manual_vals": {"secondary_focus_area": "N/A"}},
        settings, [{"model": "dt", "max_depth": 3}, {"model": "dummy", "strategy": "prior"}], time_length={"months": 12})
    rows = metrics.collect()
    assert {r.model for r in rows} == {"Model #1", "Model #2"}
    assert all(0 <= r.value <= 1 for r in rows if r.value is not None)


def test_fitted_transforms_run_on_a_stream(spark, tmp_path):
    from quillon.functions import cut_binary
    from quillon.operators import cleaning

    path = str(tmp_path / "in")
    df = spark.createDataFrame([(0, 1.0), (1, None), (2, 5.0)], "id int, x double")
    df.write.parquet(path)
    methods = {"x": "median"}
    fitted = cleaning.fit_fill_values(df, methods)
    stream = spark.readStream.schema("id int, x double").parquet(path)
    filled = cleaning.apply_fill_values(stream, fitted, methods).withColumn("big", cut_binary(F.col("x"), 2))
    query = filled.writeStream.format("memory").queryName("filled").trigger(availableNow=True).start()
    query.awaitTermination(60)
    rows = spark.table("filled").orderBy("id").collect()
    assert [(r.x, r.x_missing, r.big) for r in rows] == [(1.0, False, False), (3.0, True, True), (5.0, False, True)]
