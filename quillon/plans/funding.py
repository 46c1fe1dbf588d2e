"""Will a school project miss full funding within sixty days? Exploration and prediction."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.functions import column, create_time_diff, cut_binary, flag_to_double, numeric_columns, to_timestamp, whole_days
from quillon.operators.cleaning import preprocess_data, replace_missing
from quillon.operators.describe import (
    count_per_categorical,
    distinct_counts,
    distribution,
    pw_correlate,
    report_n_missing,
    summarize_data,
)
from quillon.operators.evaluate import (
    THRESHOLDS,
    auc_roc,
    fixed_class_metrics,
    precision_recall_curve,
    quantile_metrics,
)
from quillon.operators.features import create_dummies_many, cut_variable, generate_features
from quillon.operators.models import SCORE
from quillon.operators.params import drop_columns
from quillon.operators.splits import ROLE, SPLIT
from quillon.operators.windows import consecutive_windows, temporal_windows
from quillon.plans.grid import evaluate_grid, score_grid
from quillon.sources import read_csv

KEY, POSTED, FUNDED = "projectid", "date_posted", "datefullyfunded"
DAYS, LATE = "daystofullfunding", "not_fully_funded_60days"
DEADLINE_DAYS = 60
# The columns of the funding data.
TEXTS = [
    "projectid", "teacher_acctid", "schoolid", "school_ncesid", "school_city", "school_state", "school_metro",
    "school_district", "school_county", "school_charter", "school_magnet", "teacher_prefix",
    "primary_focus_subject", "primary_focus_area", "secondary_focus_subject", "secondary_focus_area",
    "resource_type", "poverty_level", "grade_level", "eligible_double_your_impact_match", "date_posted",
    "datefullyfunded",
]
NUMBERS = ["school_latitude", "school_longitude", "total_price_including_optional_support", "students_reached"]
COLUMN_TYPES = {**dict.fromkeys(TEXTS, "string"), **dict.fromkeys(NUMBERS, "double")}
FLAGS = ["school_charter", "school_magnet", "eligible_double_your_impact_match"]
CATEGORIES = [
    "school_city", "school_state", "school_metro", "teacher_prefix", "primary_focus_subject", "primary_focus_area",
    "secondary_focus_subject", "secondary_focus_area", "resource_type", "poverty_level", "grade_level",
]
UNUSED = ["school_longitude", "school_latitude", "schoolid", "teacher_acctid", "school_district", "school_ncesid",
          "school_county"]


def load_projects(spark: SparkSession, path: str) -> DataFrame:
    return transform_data(read_csv(spark, path, col_types=COLUMN_TYPES, index_col=KEY))


def transform_data(projects: DataFrame) -> DataFrame:
    """Dates, whole days until funding, the label, and text flags as numbers."""
    dated = projects.withColumns({POSTED: to_timestamp(column(POSTED)), FUNDED: to_timestamp(column(FUNDED))})
    return add_label(dated).withColumns({c: flag_to_double(column(c)) for c in FLAGS})


def add_label(projects: DataFrame, posted: str = POSTED, funded: str = FUNDED) -> DataFrame:
    """Days from posting to funding, and whether that took more than sixty; never funded counts as no."""
    days = whole_days(create_time_diff(column(posted), column(funded)))
    return projects.withColumn(DAYS, days).withColumn(LATE, cut_binary(F.col(DAYS), DEADLINE_DAYS))


def explore_data(
    projects: DataFrame, counted: Sequence[str] = ("teacher_acctid", "school_district", "schoolid"),
    groups: Sequence[Sequence[str]] = (
        ("school_metro",), ("school_state",), ("school_charter",), ("school_magnet",), ("poverty_level",),
        ("primary_focus_area", "secondary_focus_area"), ("primary_focus_subject", "secondary_focus_subject"),
        ("grade_level",), ("resource_type",), ("eligible_double_your_impact_match",)),
    numbers: Sequence[str] = ("total_price_including_optional_support", "students_reached"),
    distinct: Sequence[str] = ("teacher_acctid", "schoolid"), left_out: Sequence[str] = (),
) -> dict[str, DataFrame]:
    """The exploration tables: sizes, funding time by group, distributions, correlations, missing values."""
    tables = {"general": general_statistics(projects), "distinct": distinct_counts(projects, distinct)}
    for name in counted:
        tables[f"per_{name}"] = count_per_categorical(projects, name)
    tables["days"] = summarize_data(projects, agg_cols=[DAYS])
    for name, table in distribution(projects, DAYS).items():
        tables[f"days_{name}"] = table
    for group in groups:
        tables["days_by_" + "_".join(group)] = summarize_data(projects, list(group), [DAYS])
    for name in {g[0] for g in groups}:
        tables[f"{name}_counts"] = distribution(projects.select(column(name).cast("string").alias(name)), name)["counts"]
    for name in numbers:
        for kind, table in distribution(projects, name).items():
            tables[f"{name}_{kind}"] = table
    tables["numbers"] = summarize_data(projects, agg_cols=list(numbers))
    tables["correlations"] = pw_correlate(
        projects, [c for c in numeric_columns(projects) if c not in (KEY, *left_out)])
    tables["missing"] = report_n_missing(projects)
    return tables


def general_statistics(projects: DataFrame) -> DataFrame:
    """Number of projects, and how many (and what percentage) were funded within sixty days."""
    on_time = F.count_if(F.col(DAYS) <= DEADLINE_DAYS)
    return projects.agg(F.count(F.lit(1)).alias("n_projects"), on_time.alias("n_funded_on_time")).withColumn(
        "pct_funded_on_time", F.try_divide(F.col("n_funded_on_time") * 100.0, F.col("n_projects")))


def apply_pipeline(
    projects: DataFrame, preprocessing: Mapping, features: Mapping, specs: Sequence[Mapping], key: str = KEY,
    date_col: str = POSTED, label: str = LATE, time_length: Mapping[str, int] | None = None,
    gap: Mapping[str, int] | None = None, thresholds: Sequence[float] = THRESHOLDS, tie_breaker: str = "random",
    seed: int = 0, parallelism: int = 4,
) -> DataFrame:
    """Split by time, clean and build features per split, train every specification, evaluate.

    Columns that the feature settings drop are not imputed unless an occurrence count needs them.
    Returns ``model_id, model, split_id, metric, threshold, value``.
    """
    steps = dict(features)
    if "n_ocurr_cols" in steps:  # the spelling of existing settings files
        steps["n_occur_cols"] = steps.pop("n_ocurr_cols")
    categorical = [*steps.get("dummy_cols", ()), *(steps.get("bin_cols") or {})]
    dropped = set(steps.get("drop_cols", ()))
    idle = (dropped - set(steps.get("n_occur_cols", ()))) | {key, label, date_col}
    cleaned_columns = [c for c in projects.columns if c not in idle]
    used = projects.select(*[column(c) for c in projects.columns if c in {key, label, date_col, *cleaned_columns}])
    placed = temporal_windows(used, date_col, time_length or {"months": 6}, gap or {"days": 60})

    def build(rows: DataFrame) -> DataFrame:
        cleaned = preprocess_data(rows, columns=cleaned_columns, by=[SPLIT, ROLE], **preprocessing)
        drops = [c for c in {*dropped, date_col} if c in cleaned.columns]
        return generate_features(cleaned, **{**steps, "drop_cols": drops}, spread_on=[key], keep_categories=True)

    scores = score_grid(placed, specs, label, key, categorical, parallelism, build)
    return evaluate_grid(scores, label, key, thresholds, tie_breaker, seed)


def apply_earlier_pipeline(
    projects: DataFrame, specs: Sequence[Mapping], key: str = KEY, date_col: str = POSTED, label: str = LATE,
    manual_fill: Sequence[str] = ("secondary_focus_area", "secondary_focus_subject"),
    deciles: Sequence[str] = ("students_reached", "total_price_including_optional_support"),
    categories: Sequence[str] = tuple(CATEGORIES), unused: Sequence[str] = (*UNUSED, DAYS, FUNDED),
    time_length: Mapping[str, int] | None = None, thresholds: Sequence[float] = THRESHOLDS, parallelism: int = 4,
) -> DataFrame:
    """The earlier pipeline: clean and bin the whole table, then split it into consecutive windows.

    Cleaning before splitting lets test rows influence the fitted values; ``apply_pipeline`` does not. Missing
    days until funding are filled before the label is made of them. A dummy model's own classes count at
    every threshold; all others' follow from the quantiles of their scores. ``auc_roc`` rows have no threshold;
    ``earlier_curve`` has the points of the precision-recall curves.
    """
    scores = earlier_scores(projects, specs, key, date_col, label, manual_fill, deciles, categories, unused, time_length, parallelism)
    by = ["model_id", "model", SPLIT]
    own = [i for i, spec in enumerate(specs, start=1) if spec["model"] == "dummy"]
    dummy = F.col("model_id").isin(own)
    said = scores.where(dummy).withColumn("__said", F.col(SCORE) > 0.5)
    metrics = quantile_metrics(scores.where(~dummy), SCORE, label, thresholds, by).unionByName(
        fixed_class_metrics(said, "__said", label, thresholds, by))
    auc = auc_roc(scores, SCORE, label, by).select(
        *by, F.lit("auc_roc").alias("metric"), F.lit(None).cast("double").alias("threshold"), F.col("auc_roc").alias("value"))
    return metrics.unionByName(auc.select(*metrics.columns))


def earlier_curve(scores: DataFrame, label: str = LATE) -> DataFrame:
    """Precision and recall at every score, from ``earlier_scores``: ``model_id, model, split_id, score, precision, recall``."""
    return precision_recall_curve(scores, SCORE, label, ["model_id", "model", SPLIT])


def earlier_scores(
    projects: DataFrame, specs: Sequence[Mapping], key: str = KEY, date_col: str = POSTED, label: str = LATE,
    manual_fill: Sequence[str] = ("secondary_focus_area", "secondary_focus_subject"),
    deciles: Sequence[str] = ("students_reached", "total_price_including_optional_support"),
    categories: Sequence[str] = tuple(CATEGORIES), unused: Sequence[str] = (*UNUSED, DAYS, FUNDED),
    time_length: Mapping[str, int] | None = None, parallelism: int = 4,
) -> DataFrame:
    """Scores of every specification on every test window of the earlier pipeline."""
    if DAYS in projects.columns:
        known = replace_missing(projects, [DAYS])
        projects = known.withColumn(label, cut_binary(column(DAYS), DEADLINE_DAYS))
    wanted = drop_columns(projects, list(unused)).withColumns(
        {c: F.coalesce(column(c), F.lit("N/A")) for c in manual_fill})
    fixed = {key, date_col, label}
    cleaned = replace_missing(wanted, [c for c in wanted.columns if c not in fixed])
    binned = cleaned
    for name in deciles:
        binned = cut_variable(binned, name, 10, [f"dec{i / 10}" for i in range(10)]).drop(f"{name}_bin")
    dummies = create_dummies_many(binned, [*categories, *deciles])
    placed = consecutive_windows(dummies, date_col, time_length or {"months": 6})
    return score_grid(placed.without(date_col), specs, label, key, [], parallelism)
