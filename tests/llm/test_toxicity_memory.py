"""The sample of the toxicity classifier is described a few rows at a time, by several tasks."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import functions as F

from quillon.llm import toxicity
from quillon.session import Scratch


def test_sampled_texts_are_described_in_slices():
    texts = [f"He said w{i}. She went home, he did not." for i in range(500)]
    batch = pa.RecordBatch.from_arrays([pa.array([i % 2 for i in range(500)], pa.int32()), pa.array(texts)], ["label", "text"])
    out = list(toxicity._described(toxicity.following_terms(toxicity.IDENTITY_TERMS))(iter([batch])))
    assert max(b.num_rows for b in out) <= 64
    assert [i for b in out for i in b.column("ids").to_pylist()] == [toxicity.features(t) for t in texts]


def test_sample_is_described_by_several_tasks(spark):
    docs = spark.range(600).select(F.col("id").alias("doc_id"), F.concat(F.lit("some words he said "), F.col("id") % 7).alias("text"))
    labels = spark.range(600).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("toxic"))

    class Counted(Scratch):
        parts: list[int] = []

        def keep(self, df):
            self.parts.append(df.rdd.getNumPartitions())
            return super().keep(df)

    sample = toxicity.labelled_sample(docs, labels, Counted(spark))
    assert len(sample.labels) == 600 and Counted.parts[0] == spark.sparkContext.defaultParallelism
