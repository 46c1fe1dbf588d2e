"""Serious credit distress within two years: exploration and one decision tree."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from quillon.functions import numeric_columns
from quillon.operators.cleaning import replace_missing
from quillon.operators.describe import distribution, group_means, pw_correlate, summarize_data
from quillon.operators.features import create_dummies, cut_variable, sparse_encoder
from quillon.operators.models import generate_decision_tree, score_decision_tree
from quillon.operators.outliers import find_outliers, outlier_histogram, outliers_per_column
from quillon.session import materialize
from quillon.sources import read_csv

KEY, LABEL, ZIP = "PersonID", "SeriousDlqin2yrs", "zipcode"
# The columns of the credit data.
NUMBERS = [
    "SeriousDlqin2yrs", "RevolvingUtilizationOfUnsecuredLines", "age", "NumberOfTime30-59DaysPastDueNotWorse",
    "DebtRatio", "MonthlyIncome", "NumberOfOpenCreditLinesAndLoans", "NumberOfTimes90DaysLate",
    "NumberRealEstateLoansOrLines", "NumberOfTime60-89DaysPastDueNotWorse", "NumberOfDependents",
]
QUANTILE_BINS = {"MonthlyIncome": 20, "RevolvingUtilizationOfUnsecuredLines": 10}
LATE_COUNTS = ["NumberOfTime30-59DaysPastDueNotWorse", "NumberOfTime60-89DaysPastDueNotWorse", "NumberOfTimes90DaysLate"]
# Edges and labels for counts of late payments. One itself falls into the first bin.
LATE_EDGES, LATE_LABELS = [0, 1, float("inf")], ["Zero", "One or more"]
TREE = {"criterion": "entropy", "max_depth": 15}


def load_people(spark: SparkSession, path: str) -> DataFrame:
    types = {KEY: "bigint", ZIP: "string", **dict.fromkeys(NUMBERS, "double")}
    return read_csv(spark, path, col_types=types, index_col=KEY)


def explore_data(people: DataFrame, group: str = ZIP, key: str = KEY) -> dict[str, DataFrame]:
    """Summaries, correlations, group means, distributions and outliers."""
    numbers = [c for c in numeric_columns(people) if c != key]
    outliers = find_outliers(people.select(*[c for c in people.columns if c != group]), key)
    tables = {
        "summary": summarize_data(people, agg_cols=numbers),
        "correlations": pw_correlate(people, numbers),
        "group_means": group_means(people, [group], numbers),
        "outlier_histogram": outlier_histogram(outliers),
        "outliers_per_column": outliers_per_column(outliers, key),
    }
    for name in [*numbers, group]:
        for kind, table in distribution(people, name).items():
            tables[f"{name}_{kind}"] = table
    return tables


def generate_features(
    people: DataFrame, group: str = ZIP, quantile_bins: Mapping[str, int] | None = None,
    late_counts: Sequence[str] = tuple(LATE_COUNTS),
) -> DataFrame:
    """Dummies of the group, of equally filled bins, and of no or some late payments."""
    out = create_dummies(people, group, missing="null")
    for name, bins in (QUANTILE_BINS if quantile_bins is None else quantile_bins).items():
        out = create_dummies(cut_variable(out, name, bins).drop(f"{name}_bin"), name, missing="null")
    for name in late_counts:
        out = create_dummies(
            cut_variable(out, name, LATE_EDGES, LATE_LABELS).drop(f"{name}_bin"), name, LATE_LABELS, missing="null")
    return out


def build_and_score(people: DataFrame, label: str = LABEL, key: str = KEY, spec: Mapping | None = None, **features) -> DataFrame:
    """Clean, build features, grow one tree and report its accuracy on the rows it was grown on."""
    cleaned = replace_missing(people, [c for c in people.columns if c != key])
    built = materialize(generate_features(cleaned, **features))
    numeric = [c for c in numeric_columns(built, booleans=True) if c not in (key, label)]
    rows = sparse_encoder(built, [], numeric).transform(built)
    tree = generate_decision_tree(rows, label, spec or TREE)
    return score_decision_tree(tree, rows, label)
