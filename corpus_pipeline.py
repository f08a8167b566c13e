"""A training corpus from documents: score quality, drop exact and near copies, mix sources, encode.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read again as the next one's
docs. Extra columns of documents pass through all stages; null columns are handled as each operator states.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnwork.llm import bpe, exact_dedup, mixture, near, quality
from tarnwork.llm.common import Scratch, unused

#: Documents that score below this go.
KEEP_SCORE = 0.3


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is at least KEEP_SCORE."""
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    score = unused(docs.columns, "quality_score")
    return quality.score_quality(docs, model, name=score).filter(F.col(score) >= KEEP_SCORE).select(*(F.col(f"`{c}`") for c in docs.columns))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.exact_dedup(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near-duplicates: shingles of five words, Jaccard similarity of 0.8 or more."""
    return near.keep_one(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in training order."""
    return mixture.mixed_documents(docs)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their token ids and the decoded text, under names that no column of theirs has."""
    return bpe.encode_and_decode(docs, public_tokenizers.path("byte_bpe_50k.json"), ids=unused(docs.columns, "ids"), decoded=unused(docs.columns, "decoded"))


STAGES = [("quality classifier", quality_stage), ("exact dedup", exact_stage), ("simhash near-dedup", near_stage), ("mixing to target weights", mixing_stage), ("bpe encoding", encoding_stage)]

#: SQL can't express a trained network, similarity components or a tokenizer; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each from the written result of the one before."""
    scratch, docs = Scratch(spark), spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = scratch.write(stage(spark, docs, sf_dir))
        scratch.keep(docs)  # only the newest is read from here on
    return STAGES[-1][1](spark, docs, sf_dir)
