"""A training corpus from raw documents, stage by stage: quality, near-duplicates, repeated passages, mix, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet below the shared folder
and hands the reread rows to the next. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemerge.llm import bpe, mixing, near, quality, suffixes
from tidemerge.llm.base import give_back, small_batches, stored, table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, learned from the labelled ones among them, predicts as good."""
    model = quality.train(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))
    return quality.scored(docs, model, into="_quality").where(F.col("_quality") >= quality.THRESHOLD).drop("_quality")


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, Jaccard similarity of 0.8 or more."""
    return near.first_of_each(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that stand elsewhere too; ``n_chars`` follows the text."""
    return suffixes.remove_repeats(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them; ``n_chars`` follows the text."""
    return mixing.mix(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, with their number and the digests of the ids and of the decoded bytes."""
    ids = bpe.encode(docs, bpe.vocabulary_path(), keep=["doc_id", "source"], decoded="decoded")
    return bpe.digests(ids.withColumn("token_ids", F.col("ids")))


def _stage(f):
    """A stage that starts with what the driver held for the ones before given back."""

    @wraps(f)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        give_back(spark)
        return small_batches(f)(spark, docs, sf_dir)

    return run_stage


STAGES = [
    ("quality", _stage(keep_good)),
    ("near", _stage(keep_one_of_each)),
    ("suffixes", _stage(cut_repeats)),
    ("mix", _stage(mix_sources)),
    ("tokens", _stage(to_tokens)),
]

#: The classifier and the hashes of the mix have no SQL; tests/llm runs the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
