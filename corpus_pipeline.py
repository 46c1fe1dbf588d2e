"""The corpus pipeline: quality rules, line dedup, near duplicates, benchmark decontamination, packing.

Each stage takes what its predecessor kept, written as Parquet and read again. All but the last return the
columns of ``documents``; where a stage changes a text, ``n_chars`` follows. Stages write the tables that their result is read
from under ``scratch`` (one of their own in ``spark.checkpoint.dir`` if none is given), which can be cleared once that result is
written. All other tables they make go as soon as these are there.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.llm import decontaminate, line_quality, line_runs, near_duplicates, packing
from quillon.session import Scratch

SPECIAL_BROADCAST_ROWS = 1_000_000

def _with_text(docs: DataFrame, names: list[str], text: Column) -> DataFrame:
    """The columns ``names`` with another text, and its length where there is a column for it."""
    parts = docs.select("*", text.alias("__new"))
    kind = dict(docs.dtypes)
    values = {"text": F.col("__new"), "n_chars": F.length("__new").cast(kind.get("n_chars", "bigint"))}
    return parts.select(*[values[c].alias(c) if c in values else F.col(f"`{c}`") for c in names])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str, scratch: Scratch | None = None) -> DataFrame:
    """Documents that pass the quality rules, without the lines too many documents of their source share.

    NULL and empty texts fail the rules.
    """
    kept = line_quality.clean(docs, scratch or Scratch(spark))
    return _with_text(kept, docs.columns, F.col("text"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str, scratch: Scratch | None = None) -> DataFrame:
    """Documents without the later copies of repeated line runs; those left without any word go."""
    scratch = scratch or Scratch(spark)
    others, work = [c for c in docs.columns if c not in ("text", "__removed", "__text")], Scratch(spark)
    # written first: a filter on the lines left would bring the split of the whole text into each look at a line
    done = scratch.keep(line_runs.remove_repeated_runs(docs, work).select(*[F.col(f"`{c}`") for c in others], "__removed", "__text"))
    work.clear()
    left = done.where((F.size("__removed") == 0) | line_runs.has_word(F.regexp_replace("__text", "\n", " ")))
    return _with_text(left, docs.columns, F.col("__text"))


def jaccard_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str, scratch: Scratch | None = None) -> DataFrame:
    """One document of each group of near duplicates (5 words, similarity 0.8): that of the smallest id.

    Rows that repeat both id and text are one document, of which the row stays whose other columns are the least as
    JSON. NULL ids come last. Texts without words are in no group.
    """
    scratch = scratch or Scratch(spark)
    key = line_runs.document_key("doc_id", "text")
    named = docs.select(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), key.alias("key")).alias("doc_id"), "text")
    work = Scratch(spark)
    found = scratch.keep(near_duplicates.near_duplicates(named, work, shingle=5, percent=80).select("doc_id", "component_id"))
    work.clear()
    keys = found.groupBy(F.col("doc_id.key").alias("__key")).agg(F.count("*").alias("rows"), F.bool_or(F.col("doc_id") != F.col("component_id")).alias("__gone"))
    special = scratch.keep(keys.where("__gone OR rows > 1").select("__key", "__gone"))
    if special.count() <= SPECIAL_BROADCAST_ROWS:
        special = F.broadcast(special)  # a digest and a flag a row
    safe = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    rows = docs.toDF(*safe.values()).withColumn("__key", line_runs.document_key(safe["doc_id"], safe["text"]))
    own = list(safe.values())
    single = rows.join(special, "__key", "left_anti").select(*own)
    others = F.to_json(F.struct(*[s for c, s in safe.items() if c not in ("doc_id", "text")], F.lit(0).alias("none")))
    repeated = rows.join(special.where(~F.col("__gone")), "__key", "left_semi")
    once = repeated.groupBy("__key").agg(F.min_by(F.struct(*own), others).alias("row")).select("row.*")
    return single.unionByName(once).toDF(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str, scratch: Scratch | None = None) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    safe = [f"__c{i}" for i in range(len(docs.columns))]
    at = {c: s for c, s in zip(docs.columns, safe, strict=True)}
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.find_contaminated(docs.toDF(*safe), benchmark, at["doc_id"], at["text"], keep=tuple(safe))
    return found.where(F.size("items") == 0).select(*[F.col(s).alias(c) for c, s in at.items()])


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str, scratch: Scratch | None = None) -> DataFrame:
    """Pieces of the documents in sequences of at most 1024 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), scratch or Scratch(spark))


STAGES: list[tuple[str, Callable[..., DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("jaccard_dedup", jaccard_dedup),
    ("decontamination", decontamination),
    ("best_fit_packing", best_fit_packing),
]

# Which pieces share a sequence is the packing's own choice, which SQL can't state; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; a stage's tables go once its result is written, and its input with them.

    What stays is the table of pieces that the returned rows are read from.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for _, stage in STAGES[:-1]:
        scratch, result = Scratch(spark), Scratch(spark)
        docs = result.keep(stage(spark, docs, sf_dir, scratch))
        scratch.clear()
        if before:
            before.clear()
        before = result
    packed = STAGES[-1][1](spark, docs, sf_dir)
    before.clear()  # the pieces are written already
    return packed


QUERIES = {"pipeline": run}
ORACLE = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
