"""Fits by gradients run hundreds of small jobs: their tasks follow the rows, not the parts these come in."""

import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from quillon.operators import models


@pytest.mark.parametrize("spec", [
    {"model": "lr"}, {"model": "lr", "penalty": "l1"}, {"model": "svc", "max_iter": 20}], ids=lambda s: s["model"] + s.get("penalty", ""))
def test_steps_of_a_small_fit_are_one_task(spark, spec):
    i = F.col("id")
    rows = spark.range(0, 3200, 1, 32).select(
        i.alias("key"), (i % 7 + i % 3 > 4).cast("int").alias("label"), array_to_vector(F.array((i % 7) / 7.0, (i % 5) / 5.0)).alias("features"))
    train = rows.persist()
    assert train.count() == 3200 and train.rdd.getNumPartitions() == 32
    group = f"fit {spec}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        models.generate_classifier(train, spec)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker, tasks = spark.sparkContext.statusTracker(), []
    for job in tracker.getJobIdsForGroup(group):
        found = [tracker.getStageInfo(s) for s in tracker.getJobInfo(job).stageIds]
        tasks.append(sum(s.numTasks for s in found if s))
    train.unpersist()
    assert len(tasks) > 5 and sorted(tasks)[len(tasks) // 2] == 1  # 32 of the first stage and 6 of a second one before


def test_many_rows_keep_their_parts(spark, monkeypatch):
    monkeypatch.setattr(models, "ROWS_PER_TASK", 10)
    rows = spark.range(0, 80, 1, 8).select(F.lit(1).alias("label"))
    assert models._gathered(rows, "label")[0].rdd.getNumPartitions() == 8
