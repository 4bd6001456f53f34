"""From raw documents to token ids, stage by stage.

``STAGES`` lists ``(name, function)``; each function takes ``(spark, docs,
sf_dir)`` and returns a DataFrame, which is written as Parquet to the shared
folder and read again as the next stage's ``docs``. All but the last return the
columns of ``documents`` (and whatever other columns the table has).

Null texts count as empty and stay until the mix, which takes no document
without words; rows equal in id and text count as they come in every stage; an
empty table passes all stages empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from eventide.llm import bpe, exact_dedup, mixing, near_dedup, toxicity
from eventide.llm.queries import tokenizer
from eventide.llm.shared import saved
from eventide.llm.textops import table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score under the threshold, by a lexicon learned from the labelled ones."""
    lexicon = toxicity.learn_from_labels(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"))
    rows = docs.select(F.struct("*").alias("row"), "text")
    return toxicity.score(rows, lexicon).where(F.col("score") < toxicity.THRESHOLD).select("row.*")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id."""
    return exact_dedup.keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near copies the document with the smallest id."""
    return near_dedup.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of its source takes it."""
    return mixing.repeated(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, source, n_tokens, ids`` and the digest of the text that the ids decode to."""
    ranks, pattern = tokenizer()
    ids = bpe.encode(docs, ranks, pattern, keep=("doc_id", "source"), bytes_col="bytes")
    return ids.select("doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids",
                                         F.sha2("bytes", 256).alias("decoded_sha256"))


STAGES = [("toxicity", drop_toxic), ("exact_dedup", drop_copies), ("near_dedup", drop_near_copies),
          ("mixing", mix_sources), ("byte_bpe", encode)]

#: The learned lexicon and the merges are not SQL; tests/llm/test_pipeline.py checks the rows by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
