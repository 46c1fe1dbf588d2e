import pytest
from pyspark.sql import functions as F

from quillon.functions import cut_binary, identify_missing, safe_name
from quillon.operators import cleaning, features


def test_default_imputation_and_flags(animals, column_of, any_size):
    out = cleaning.preprocess_data(animals, columns=["species", "age", "name"])
    assert column_of(out, "age") == [1, 3, 9, 4, 3.5]
    assert column_of(out, "name") == ["Lance", "Barry", "Barry", "Barry", "Tom"]
    assert column_of(out, "age_missing") == [False] * 4 + [True]
    assert column_of(out, "name_missing") == [False, False, True, False, False]
    assert not any(column_of(out, "species_missing"))


def test_mean_and_manual_imputation(animals, column_of):
    out = cleaning.preprocess_data(
        animals, {"age": "mean", "name": "manual"}, {"name": "MISSING"}, columns=["age", "name"])
    assert column_of(out, "age")[4] == 4.25
    assert column_of(out, "name")[2] == "MISSING"


def test_manual_default_and_single_column(animals, column_of):
    assert column_of(cleaning.impute_missing(animals, "name", "manual"), "name")[2] == "N/A"
    assert column_of(cleaning.impute_missing(animals, "age", "manual", -1.0), "age")[4] == -1.0
    assert "name_missing" not in cleaning.replace_missing(animals).columns


def test_mode_takes_smallest_of_tied_values(spark, column_of):
    df = spark.createDataFrame([(0, "b"), (1, "a"), (2, None), (3, "b"), (4, "a")], "id int, v string")
    assert column_of(cleaning.impute_missing(df, "v"), "v")[2] == "a"
    numbers = spark.createDataFrame([(0, 10), (1, 9), (2, None), (3, 10), (4, 9)], "id int, v int")
    assert column_of(cleaning.impute_missing(numbers, "v", "mode"), "v")[2] == 9


def test_column_without_values_stays_missing(spark, column_of):
    df = spark.createDataFrame([(0, None, None), (1, None, None)], "id int, t string, x double")
    out = cleaning.preprocess_data(df, columns=["t", "x"])
    assert column_of(out, "t") == [None, None] and column_of(out, "x") == [None, None]
    assert column_of(out, "x_missing") == [True, True]


def test_bad_methods_are_rejected(animals):
    with pytest.raises(ValueError):
        cleaning.impute_missing(animals, "name", "mean")
    with pytest.raises(ValueError):
        cleaning.impute_missing(animals, "age", "guess")


def test_imputation_per_group(spark, column_of, any_size):
    rows = [(0, 1, "train", 1.0), (1, 1, "train", 3.0), (2, 1, "train", None), (3, 1, "test", 10.0), (4, 1, "test", None)]
    df = spark.createDataFrame(rows, "id int, split_id int, role string, x double")
    own = cleaning.preprocess_data(df, columns=["x"], by=["split_id", "role"])
    assert column_of(own, "x") == [1, 3, 2, 10, 10]
    shared = cleaning.preprocess_data(df, columns=["x"], by=["split_id", "role"], fit_on="train")
    assert column_of(shared, "x") == [1, 3, 2, 10, 2]


def test_cut_binary(animals, column_of):
    cut = animals.withColumn("old", cut_binary(F.col("age"), 5)).withColumn("nine", cut_binary(F.col("age"), 9, True))
    assert column_of(cut, "old") == [False, False, True, False, False]
    assert column_of(cut, "nine") == [False, False, True, False, False]


def test_missing_flags_for_every_column(animals):
    flagged = identify_missing(animals)
    assert [c for c in flagged.columns if c.endswith("_missing")] == [f"{c}_missing" for c in animals.columns]


@pytest.mark.parametrize("small_limit", [100, 0])
def test_occurrence_counts(animals, column_of, small_limit):
    out = features.generate_n_occurrences(animals, "species", small_limit=small_limit, hot_keys=1)
    assert column_of(out, "species_n_occur") == [2, 1, 1, 2, 1]
    out = features.generate_n_occurrences(animals, "name", small_limit=small_limit, hot_keys=1)
    assert column_of(out, "name_n_occur") == [1, 2, None, 2, 1]


@pytest.mark.parametrize("small_limit", [100, 0])
def test_split_occurrence_counts(spark, column_of, small_limit):
    rows = [(0, 1, "train", "a"), (1, 1, "train", "a"), (2, 1, "test", "a"), (3, 1, "test", "b"), (4, 2, "train", "b"),
            (5, 2, "test", None)]
    df = spark.createDataFrame(rows, "id int, split_id int, role string, v string")
    out = features.split_n_occurrences(df, ["v"], ["id"], small_limit=small_limit, hot_keys=1)
    assert column_of(out, "v_n_occur") == [2, 2, 3, 1, 1, None]


def test_minmax(animals, column_of):
    filled = cleaning.preprocess_data(animals, {"age": "mean"}, columns=["age"])
    assert column_of(features.scale_variable_minmax(filled, "age"), "age") == [-1, -0.5, 1, -0.25, -0.1875]
    assert column_of(features.scale_variable_minmax(filled, "age", a=5, b=1), "age")[2] == 3
    constant = animals.withColumn("age", F.lit(2.0))
    assert column_of(features.scale_variable_minmax(constant, "age"), "age") == [None] * 5


def test_bins_by_edges(spark, column_of):
    df = spark.createDataFrame(list(enumerate([-1.0, 0.0, 1.0, 2.0, None])), "id int, x double")
    late = features.cut_variable(df, "x", [0, 1, float("inf")], ["Zero", "One or more"])
    assert column_of(late, "x") == [None, "Zero", "Zero", "One or more", None]
    left = features.cut_variable(df, "x", [0, 1, 2], closed="left")
    assert column_of(left, "x_bin") == [None, 1, 2, None, None]
    with pytest.raises(ValueError):
        features.cut_variable(df, "x", [0, 1], ["a", "b"])


def test_bins_by_count(spark, column_of, any_size):
    df = spark.createDataFrame([(i, float(i)) for i in range(1, 11)], "id int, x double")
    assert column_of(features.cut_variable(df, "x", 5), "x_bin") == [1, 1, 2, 2, 3, 3, 4, 4, 5, 5]
    # quartile edges 0, 0, 0, 6.75, 9: the three equal ones are merged
    ties = spark.createDataFrame([(i, 0.0 if i < 6 else float(i)) for i in range(10)], "id int, x double")
    assert column_of(features.cut_variable(ties, "x", 4), "x_bin") == [1] * 7 + [2, 2, 2]


def test_fitted_bins_stretch_to_test_values(spark, column_of):
    rows = [(i, 1, "train", float(i)) for i in range(1, 9)] + [(9, 1, "test", -50.0), (10, 1, "test", 99.0), (11, 1, "test", None)]
    df = spark.createDataFrame(rows, "id int, split_id int, role string, x double")
    out = features.split_bins(df, {"x": {"bins": 2, "labels": ["low", "high"]}})
    assert column_of(out, "x") == ["low"] * 4 + ["high"] * 4 + ["low", "high", None]


def test_dummies(animals, column_of):
    out = features.create_dummies(animals, "name")
    assert out.columns[-3:] == ["name_Barry", "name_Lance", "name_Tom"] and "name" not in out.columns
    assert column_of(out, "name_Barry") == [False, True, False, True, False]
    nulls = features.create_dummies(animals, "name", missing="null")
    assert column_of(nulls, "name_Tom") == [False, False, None, False, True]
    fixed = features.create_dummies(animals, "species", ["dog", "bird"])
    assert column_of(fixed, "species_dog") == [True, False, False, True, False]
    assert not any(column_of(fixed, "species_bird"))


def test_integer_dummies(animals, column_of):
    out = features.create_dummies_many(animals, ["species", "name"], drop_first=True, dummy_na=True, prefix={"name": "n"})
    assert out.columns == ["id", "age", "species_dog", "species_mouse", "species_pig", "species_nan", "n_Lance", "n_Tom", "n_nan"]
    assert column_of(out, "n_nan") == [0, 0, 1, 0, 0]


def test_dummy_names_stay_apart():
    assert features.dummy_names("c", ["a.b", "a b", "(1, 2]"]) == ["c_a_b", "c_a_b_2", "c_1_2"]
    assert safe_name("...") == "blank"


def test_sparse_encoder_ignores_unseen_values(spark):
    train = spark.createDataFrame([(0, "a", 1.0), (1, "a", 2.0), (2, "b", 3.0)], "id int, c string, x double")
    test = spark.createDataFrame([(3, "z", 1.0), (4, None, 1.0), (5, "b", 1.0)], "id int, c string, x double")
    rows = features.sparse_encoder(train, ["c"], ["x"]).transform(test).orderBy("id").collect()
    assert [list(r.features) for r in rows] == [[1, 0, 0], [1, 0, 0], [1, 0, 1]]


def test_whole_feature_sequence(spark):
    rows = [(i, 1, "train" if i < 8 else "test", "ab"[i % 2], float(i), float(i % 3)) for i in range(12)]
    rows.append((12, 1, "test", "c", 50.0, None))
    df = spark.createDataFrame(rows, "id int, split_id int, role string, v string, x double, y double")
    out = features.generate_features(
        df, ["v"], ["x", "v_n_occur"], {"y": {"bins": [0, 1, 2], "labels": ["lo", "hi"]}}, ["v"],
        {"x": {"threshold": 0.0}}, [], spread_on=["id"])
    assert set(out.columns) == {"id", "split_id", "role", "x", "v_n_occur", "v_a", "v_b", "y_hi", "y_lo"}
    last = out.where("id = 12").first()
    assert last.x is True and not last.v_a and not last.v_b and not last.y_lo and not last.y_hi
