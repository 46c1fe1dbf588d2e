"""Token counts with a digest cache: each distinct content is encoded once per tokenizer version."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.llm.encoders import encoder, encoder_version
from quillon.session import Scratch, spread


class TokenCache:
    """Counts on disk, one row per (tokenizer version, content digest), in a Parquet folder all executors share.

    Appending is the only change ever made. Two jobs that append the same content at once leave equal
    rows; ``read`` gives one of them.
    """

    SCHEMA = "content binary, n_tokens bigint, tokenizer string"

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def read(self, tokenizer: str) -> DataFrame:
        try:
            stored = self.spark.read.schema(self.SCHEMA).parquet(self.folder)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            stored = self.spark.createDataFrame([], self.SCHEMA)
        return stored.where(F.col("tokenizer") == tokenizer).groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))

    def append(self, counts: DataFrame, tokenizer: str) -> None:
        counts.withColumn("tokenizer", F.lit(tokenizer)).write.mode("append").partitionBy("tokenizer").parquet(self.folder)


def same_text(text: Column) -> Column:
    """The normal form for byte-level files: the text itself, for any change could change its count."""
    return F.coalesce(text.cast("string"), F.lit(""))


def count_tokens(
    docs: DataFrame, tokenizer_path: str, cache: TokenCache, scratch: Scratch, id_column: str = "doc_id", text_column: str = "text",
    normalise: Callable[[Column], Column] = same_text, limit: int = 1024,
) -> DataFrame:
    """One row per document: id, ``n_bytes`` (UTF-8), ``n_tokens``, ``over_limit`` (more than ``limit`` tokens).

    The digest of the normalised content is joined to the counts stored under the digest of the
    tokenizer. Contents not found are reduced to one row per digest before they are shuffled, encoded,
    and appended to the cache; a second run over the same corpus encodes nothing. ``normalise`` must not
    change a count; it decides which texts share a cache row.

    NULL and empty texts have 0 bytes and 0 tokens. Rows are never merged: repeated rows, also with the
    same or a NULL id, each give a row. Other columns of ``docs`` are not looked at. An empty table gives
    an empty result.
    """
    version = encoder_version(tokenizer_path)
    content = normalise(F.col(text_column))
    digest = F.unhex(F.sha2(content, 256)).alias("content")
    texts = spread(docs.select(text_column)).select(digest, content.alias("text"))
    distinct = texts.groupBy("content").agg(F.first("text").alias("text"))
    misses = distinct.join(cache.read(version).select("content"), "content", "left_anti")
    cache.append(misses.mapInArrow(_counter(tokenizer_path), "content binary, n_tokens bigint"), version)
    rows = docs.select(
        F.col(id_column), F.coalesce(F.octet_length(F.col(text_column).cast("string")), F.lit(0)).cast("bigint").alias("n_bytes"), digest)
    # a table of its own, so that the join may split a content that a third of the rows share
    counted = rows.join(scratch.keep(cache.read(version)), "content", "left")
    return counted.select(id_column, "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def _counter(path: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = encoder(path)
        for batch in batches:
            counts = [counter.count(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("content"), pa.array(counts, pa.int64())], ["content", "n_tokens"])

    return count
