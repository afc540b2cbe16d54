"""Training text from raw documents: stages that each call one operator, written and read again between them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from aeromart.llm import bpe, decontaminate, language, simhash, toxicity
from aeromart.llm.common import table, written
from aeromart.llm.queries import vocabulary


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go."""
    return toxicity.drop_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which no learnt language is likely go: texts that every tree finds strange, texts without letters, nulls."""
    return language.drop_unknown(docs, language.learn(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return simhash.keep_one(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of the benchmark go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of what is left, one row per document."""
    return bpe.encode_decode(docs, vocabulary())


STAGES = [
    ("toxicity", toxic),
    ("language", languages),
    ("near_duplicates", near_duplicates),
    ("benchmark", benchmark),
    ("tokens", tokens),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
