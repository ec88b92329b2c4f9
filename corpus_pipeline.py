"""From documents to packed training sequences, in five stages over one shared table layout."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from estatelens.llm.jaccard import drop_near_copies
from estatelens.llm.mixing import MixParams, mixed_rows
from estatelens.llm.packing import pack_documents
from estatelens.llm.personal import redact_personal
from estatelens.llm.queries import MIX
from estatelens.llm.storage import drop_shuffles, written
from estatelens.llm.toxicity import drop_toxic

#: The mixture of the pipeline: each document at most once, nearly all of the tokens there are.
PIPELINE_MIX = MixParams(domains=MIX.domains, weights=MIX.weights, epochs=1, share=0.95)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return drop_near_copies(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts is replaced by its kind."""
    drop_shuffles(spark)  # near_copies is over, its shuffles are not small
    return redact_personal(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents within the token budgets of their domain, language and source."""
    return mixed_rows(docs, PIPELINE_MIX)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every text with its place in a training sequence."""
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("toxicity", toxicity), ("near_copies", near_copies), ("personal_data", personal_data),
          ("mixing", mixing), ("packing", packing)]

#: A trained classifier's verdicts cannot be had in SQL; tests hold the stages to plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; every stage before it is written to the shared folder and reread."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
